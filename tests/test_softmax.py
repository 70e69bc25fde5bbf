import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textspark.functions import numeric
from textspark.operators import optim, shuffle, softmax
from textspark.plans import minibatch
from textspark.plans.classifier import SoftmaxModel, fit_softmax
from textspark.plans.minibatch import Setting


@pytest.fixture(scope="module")
def toy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 4)) * (rng.random((60, 4)) < 0.7)
    y = (x[:, 0] + 0.3 * rng.normal(size=60) > 0).astype(int) + (x[:, 1] > 0.8)
    sparse = [Vectors.sparse(4, [(j, v) for j, v in enumerate(row) if v]) for row in x]
    rows = [(i, v, int(c)) for i, (v, c) in enumerate(zip(sparse, y))]
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("features", VectorUDT()), T.StructField("y", T.IntegerType())]
    )
    return x, y, spark.createDataFrame(rows, schema).coalesce(1).cache()


def sparse_docs(spark, x, y):
    rows = [
        (i, [(j, float(v)) for j, v in enumerate(row) if v], int(c)) for i, (row, c) in enumerate(zip(x, y))
    ]
    return spark.createDataFrame(rows, "doc_id long, features array<struct<term_id:long,value:double>>, y int")


def probabilities(x, w, b):
    z = x @ w + b
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def test_softmax_golden(spark):
    p = one(spark, numeric.softmax(numeric.doubles([1, 2, 3])))
    assert [round(v, 6) for v in p] == [0.090031, 0.244728, 0.665241]
    big = one(spark, numeric.softmax(numeric.doubles([1000, 1000])))
    assert big == [0.5, 0.5]
    loss = one(spark, softmax.row_loss(numeric.doubles(p), F.lit(2)))
    assert round(loss, 6) == 0.407606


def test_argmax_ties(spark):
    assert one(spark, numeric.argmax(numeric.doubles([1, 3, 3]))) == 1


def test_activations(spark):
    assert one(spark, numeric.relu(F.lit(-2.0))) == 0 and one(spark, numeric.elu(F.lit(2.0))) == 2
    assert one(spark, numeric.elu(F.lit(-1.0))) == pytest.approx(np.expm1(-1))
    assert one(spark, numeric.sigmoid(F.lit(0.0))) == 0.5


def test_hash_normals(spark):
    row = spark.range(20000).select(numeric.hash_normal(F.col("id").cast("string")).alias("n")).agg(
        F.avg("n").alias("m"), F.stddev("n").alias("s")
    ).first()
    assert abs(row["m"]) < 0.03 and abs(row["s"] - 1) < 0.03


def test_logits_and_gradient_match_numpy(spark, toy):
    x, y, _ = toy
    x = x.copy()
    x[5] = 0  # a document without features
    docs = sparse_docs(spark, x, y)
    rng = np.random.default_rng(1)
    w, b = rng.normal(size=(4, 3)), [0.1, -0.2, 0.3]
    table = spark.createDataFrame([(j, w[j].tolist()) for j in range(4)], "term_id long, w array<double>")
    scored = softmax.predictions(softmax.probabilities(softmax.logits(docs, table, b)))
    got = {r["doc_id"]: r for r in scored.collect()}
    p = probabilities(x, w, b)
    assert np.allclose([got[i]["probs"] for i in range(60)], p)
    assert np.allclose([sum(got[i]["probs"]) for i in range(60)], 1)
    assert [got[i]["pred"] for i in range(60)] == p.argmax(1).tolist()
    grads = {r["term_id"]: r["g"] for r in softmax.gradient(docs, table, b, l2=0.01).collect()}
    r = p.copy()
    r[np.arange(60), y] -= 1
    assert np.allclose([grads[j] for j in range(4)], x.T @ r / 60 + 0.01 * w)
    assert np.allclose(grads[softmax.BIAS], r.mean(0))
    loss = softmax.cross_entropy(scored.join(docs.select("doc_id", "y"), "doc_id"), table, 0.01).first()["loss"]
    assert loss == pytest.approx(-np.log(p[np.arange(60), y] + 1e-12).mean() + 0.005 * (w**2).sum())


def test_accuracy_of_nothing(spark):
    assert softmax.accuracy(spark.createDataFrame([], "pred int, y int")).first()[0] == 0.0


def test_optimizer_goldens(spark):
    params = spark.createDataFrame([(0, [1.0])], "term_id long, w array<double>")
    grads = spark.createDataFrame([(0, [0.5])], "term_id long, g array<double>")
    for name, want in (("sgd", [0.95, 0.855]), ("adam", [0.9, 0.8])):
        state = optim.start(params)
        for step, value in enumerate(want, start=1):
            state = optim.optimizer_step(name, state, grads, 0.1, step)
            assert state.first()["w"][0] == pytest.approx(value, abs=1e-6)


def test_unknown_optimizer():
    with pytest.raises(ValueError, match="rmsprop"):
        Setting("rmsprop")


def test_early_stopping(spark):
    scores = [0.2, 0.5, 0.5, 0.4, 0.6, 0.6, 0.1]
    df = spark.createDataFrame([(i + 1, s) for i, s in enumerate(scores)], "epoch int, score double")
    rows = optim.early_stopping(df, 2).orderBy("epoch").collect()
    assert [r["best_epoch"] for r in rows] == [1, 2, 2, 2, 5, 5, 5]
    assert [r["waited"] for r in rows] == [0, 0, 1, 2, 0, 1, 2]
    assert [r["stop"] for r in rows] == [False] * 3 + [True] + [False] * 2 + [True]


@pytest.mark.parametrize("l2", [0.01, 0.3])
def test_lbfgs_is_optimal(spark, toy, l2):
    x, y, df = toy
    model = fit_softmax(df, None, 4, 3, l2=l2, max_iter=500, tol=1e-10)
    w = np.array([r["w"] for r in model.weights.orderBy("term_id").collect()])
    r = probabilities(x, w, np.array(model.bias))
    r[np.arange(60), y] -= 1
    assert np.abs(x.T @ r / 60 + l2 * w).max() < 1e-5 and np.abs(r.mean(0)).max() < 1e-5


def trained(spark, run, n_features, n_classes, last=True):
    """Parameters of a run as an array, the bias in the last row."""
    rows = {r["term_id"]: r["w"] for r in run.weights(spark, n_features, n_classes, last).collect()}
    return np.array([rows[i] for i in [*range(n_features), -1]])


@pytest.mark.parametrize("by_epoch", [False, True])
@pytest.mark.parametrize("optimizer", ["sgd", "adam"])
def test_one_shard_trains_like_a_plain_loop(spark, toy, optimizer, by_epoch, tmp_path):
    x, y, df = toy
    setting = Setting(optimizer, 0.1, 0.01, 25)
    run = minibatch.train(df, df, [setting], 4, 3, 4, 10, seed=1, shards=1, checkpoint=str(tmp_path / "c") if by_epoch else None)[0]
    w = np.vstack([np.random.default_rng(1).standard_normal((5, 3)) * (2 / 7) ** 0.5])
    w[-1] = 0
    m, v, t = np.zeros_like(w), np.zeros_like(w), 0
    hashed = {r["doc_id"]: r["h"] for r in df.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    rank = np.array(sorted(hashed, key=hashed.get))
    ones = np.hstack([x, np.ones((60, 1))])
    assert len(run.history) == 4
    for epoch, entry in enumerate(run.history, start=1):
        line = rank[np.argsort(shuffle.places(60, shuffle.keys(1, epoch, 0)))]
        loss = 0.0
        for at in range(0, 60, 25):
            some = line[at : at + 25]
            p = probabilities(ones[some], w, 0)
            loss += len(some) * (-np.log(p[np.arange(len(some)), y[some]] + 1e-12).mean() + 0.005 * (w[:-1] ** 2).sum())
            p[np.arange(len(some)), y[some]] -= 1
            g = ones[some].T @ p / len(some)
            g[:-1] += 0.01 * w[:-1]
            t += 1
            if optimizer == "sgd":
                v = 0.9 * v - 0.1 * g
                w = w + v
            else:
                m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
                w = w - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        assert entry["loss"] == pytest.approx(loss / 60)
        assert entry["score"] == pytest.approx((probabilities(ones, w, 0).argmax(1) == y).mean())
    assert np.allclose(trained(spark, run, 4, 3), w)
    assert run.train_acc == pytest.approx(run.best_score)


def test_shards_average_to_the_whole(spark, toy):
    """One SGD step per shard, averaged by document count, is one step over all documents."""
    _, _, df = toy
    apart, whole = (minibatch.train(df, None, [Setting("sgd", 0.3, 0.01, 1000)], 4, 3, 4, 9, seed=5, shards=n)[0] for n in (4, 1))
    assert [e["loss"] for e in apart.history] == [pytest.approx(e["loss"]) for e in whole.history]
    assert [e["score"] for e in apart.history] == [pytest.approx(e["score"]) for e in whole.history]
    assert np.allclose(trained(spark, apart, 4, 3), trained(spark, whole, 4, 3))


def test_training_depends_on_no_layout(spark, toy):
    _, _, df = toy
    settings = [Setting("adam", 0.05, 0.0, 8), Setting("sgd", 0.1, 0.0, 5)]
    found = []
    for partitions, batch in ((1, "10000"), (16, "7")):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            runs = minibatch.train(df.repartition(partitions), None, settings, 4, 3, 3, 3, shards=3)
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        found.append(([r.history for r in runs], [trained(spark, r, 4, 3) for r in runs]))
    for history, weights in found[1:]:
        assert [[e["loss"] for e in h] for h in history] == [pytest.approx([e["loss"] for e in h]) for h in found[0][0]]
        assert all(np.allclose(a, b) for a, b in zip(weights, found[0][1]))
    assert found[0][0][0][-1]["loss"] < found[0][0][0][0]["loss"]


def test_an_epoch_moves_parameters_but_no_documents(spark, toy):
    _, _, df = toy
    runs = [minibatch.Run(Setting(), 0)]
    dealt = minibatch.deal(minibatch.sparse_columns(df), 1, 3)
    try:
        blocks = spark.read.parquet(minibatch.start_blocks(spark, runs, 4, 3, 1))
        plan = minibatch.epoch_plan(blocks, dealt, {0: Setting()}, 3, 1, 1)
        text = plan._jdf.queryExecution().sparkPlan().toString()
        assert "FlatMapCoGroupsInPandas" in text
        executed = plan._jdf.queryExecution().executedPlan().toString()
        tree = executed.split("FlatMapCoGroupsInPandas")[1].splitlines()
        # Two exchanges: of the parameters to the cells, and none on the side of the documents, which are read by bucket.
        assert sum("Exchange" in line for line in tree) == 1 and "Bucketed: true" in executed
        documents = [line for line in tree if "FileScan" in line and "columns" in line]
        assert len(documents) == 1
    finally:
        dealt.drop()


def test_an_ended_call_goes_on_from_its_last_epoch(spark, toy, tmp_path, monkeypatch):
    _, _, df = toy
    settings = [Setting("adam", 0.1, 0.0, 16), Setting("sgd", 1e-9, 0.0, 16)]
    whole = minibatch.train(df, df, settings, 4, 3, 6, 3, shards=2, checkpoint=str(tmp_path / "whole"))
    real, calls = minibatch.accuracies, []

    def dies(*args):
        calls.append(1)
        if len(calls) == 4:  # in epoch 4, after its parameters are written and before its manifest is
            raise RuntimeError("driver lost")
        return real(*args)

    monkeypatch.setattr(minibatch, "accuracies", dies)
    with pytest.raises(RuntimeError, match="driver lost"):
        minibatch.train(df, df, settings, 4, 3, 6, 3, shards=2, checkpoint=str(tmp_path / "ended"))
    monkeypatch.setattr(minibatch, "accuracies", real)
    epochs = []
    plan = minibatch.epoch_plan
    monkeypatch.setattr(minibatch, "epoch_plan", lambda *a: epochs.append(a[-1]) or plan(*a))
    again = minibatch.train(df, df, settings, 4, 3, 6, 3, shards=2, checkpoint=str(tmp_path / "ended"))
    assert epochs == [4, 5, 6]
    for one, other in zip(whole, again):
        assert [e["epoch"] for e in one.history] == [e["epoch"] for e in other.history]
        assert [e["loss"] for e in one.history] == pytest.approx([e["loss"] for e in other.history])
        assert (one.best_epoch, one.waited, one.best_score, one.train_acc) == (other.best_epoch, other.waited, other.best_score, other.train_acc)
        assert np.allclose(trained(spark, one, 4, 3, False), trained(spark, other, 4, 3, False))
    assert len(whole[1].history) == 4 and whole[1].best_epoch == 1
    with pytest.raises(ValueError, match="other settings"):
        minibatch.train(df, df, settings[:1], 4, 3, 6, 3, shards=2, checkpoint=str(tmp_path / "ended"))


def test_orders_are_bijections(spark):
    for n in (1, 2, 3, 10, 97, 1000, 1009):
        key = shuffle.keys("s", n)
        p = shuffle.places(n, key)
        assert sorted(p.tolist()) == list(range(n))
        got = spark.range(n).select("id", shuffle.place(F.col("id"), n, key).alias("p")).collect()
        assert [r["p"] for r in sorted(got)] == p.tolist()
    far = shuffle.places(1009, shuffle.keys("s", 1))
    assert np.corrcoef(far, np.arange(1009))[0, 1] < 0.2 and (far != shuffle.places(1009, shuffle.keys("s", 2))).mean() > 0.9
    a, b = shuffle.bases(10**12 + 39)
    assert 0 <= a * b - (10**12 + 39) < 1000


def test_no_documents_to_train_on(toy):
    with pytest.raises(ValueError, match="no documents"):
        minibatch.train(toy[2].where("false"), None, [Setting()], 4, 3, 1, 1)


def test_dense_vectors_score_and_train_as_sparse_ones(spark):
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql import types as T

    rows = [(i, [float(i % 3), 0.0, 1.0, float(i % 2)], i % 2) for i in range(12)]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("features", VectorUDT()), T.StructField("y", T.IntegerType())])
    dense = spark.createDataFrame([(i, Vectors.dense(v), y) for i, v, y in rows], schema)
    sparse = spark.createDataFrame([(i, Vectors.sparse(4, [(j, x) for j, x in enumerate(v) if x]), y) for i, v, y in rows], schema)
    setting = Setting("adam", 0.1, 0.0, 4)
    one, other = (minibatch.train(d, d, [setting], 4, 2, 5, 5)[0] for d in (dense, sparse))
    w = trained(spark, one, 4, 2)
    assert np.allclose(w, trained(spark, other, 4, 2))
    model = SoftmaxModel.from_array(spark, w, {})
    scores = [{r["doc_id"]: r["logits"] for r in model.score(d).collect()} for d in (dense, sparse)]
    assert all(np.allclose(scores[0][i], scores[1][i]) for i, _, _ in rows)
    assert np.allclose(scores[0][5], np.array([2.0, 0, 1, 1, 1]) @ w)


def test_settings_train_in_groups_of_bounded_size(toy, monkeypatch):
    _, _, df = toy
    settings = [Setting("sgd", lr, 0.0, 20) for lr in (0.01, 0.1, 0.3)]
    whole = minibatch.train(df, df, settings, 4, 3, 3, 5)
    monkeypatch.setattr(minibatch, "PARAMETER_BYTES", 5 * 3 * 24)
    parts = minibatch.train(df, df, settings, 4, 3, 3, 5)
    assert [r.history for r in whole] == [r.history for r in parts]


def test_stops_early(toy):
    _, _, df = toy
    run = minibatch.train(df, df, [Setting("sgd", 1e-9, 0.0, 60)], 4, 3, epochs=50, patience=2)[0]
    assert len(run.history) == 3 and run.best_epoch == 1


def packed(rows):
    """Pieces of documents ``(columns, values, y)`` as the dealt table has them."""
    import pandas as pd

    joined = {"y": [r[2] for r in rows], "sizes": [len(r[0]) for r in rows], "columns": [c for r in rows for c in r[0]]}
    piece = {name: np.array(x, "<i4").tobytes() for name, x in joined.items()}
    return pd.DataFrame([{"piece": 0, **piece, "values": np.array([v for r in rows for v in r[1]], "<f8").tobytes()}])


def test_documents_stay_in_the_buffers_they_came_in():
    pieces = packed([([1, 7], [0.5, 2.0], 0), ([], [], 1), ([0, 1], [3.0, 4.0], 1)])
    docs = minibatch.Documents(pieces)
    assert all(not c.flags.owndata and not c.flags.writeable for c in [*docs.columns, *docs.values])
    columns, block = docs.batch(np.array([2, 1, 0]))
    assert columns.tolist() == [0, 1, 7, -1] and docs.y.tolist() == [0, 1, 1]
    assert block.tolist() == [[3.0, 4.0, 0.0, 1.0], [0.0, 0.0, 0.0, 1.0], [0.0, 0.5, 2.0, 1.0]]
    assert docs.batch(np.array([1]))[1].tolist() == [[1.0]]


def test_a_shard_is_dealt_by_several_tasks_in_small_rows(spark):
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.array(F.lit(0)).alias("indices"), F.array(F.col("id").cast("double")).alias("values"), F.lit(0).alias("y"))
    dealt = minibatch.deal(rows, 1, 2, bucketed=False)
    pieces = dealt.table.toPandas()
    assert pieces["n"].max() <= 32 and pieces["n"].sum() == 400
    order = {r["doc_id"]: (r["h"] % 2, r["h"]) for r in rows.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    for shard, own in pieces.groupby("shard"):
        assert len({p >> 28 for p in own["piece"]}) == 8  # slices of the keys
        got = [int(d) for v in minibatch.Documents(own).values for d in v]
        assert got == sorted((d for d, (s, _) in order.items() if s == shard), key=lambda d: order[d][1])


def test_trainings_side_by_side_share_the_cores(toy, monkeypatch):
    """Each group of runs reads all documents, so four searches at once do not make four times the groups."""
    _, _, df = toy
    groups, deal = [], minibatch.deal
    monkeypatch.setattr(minibatch, "deal", lambda docs, n, *rest: groups.append(n) or deal(docs, n, *rest))
    settings = [Setting("sgd", 0.1, 0.0, 8 + i) for i in range(16)]
    alone, shared = (minibatch.train(df, df, settings, 4, 3, 1, 1, shards=1, beside=n) for n in (1, 4))
    assert groups == [16, 16, 4, 4]
    assert [r.history for r in alone] == [r.history for r in shared]
