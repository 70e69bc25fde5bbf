"""Queries over softmax regression, on the embeddings table and on bag-of-words features."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textspark.operators import labels as label_ops
from textspark.operators import optim, softmax
from textspark.operators.shuffle import keys
from textspark.operators.unnest import unnest
from textspark.plans import minibatch
from textspark.plans.classifier import decide, fit_softmax
from textspark.plans.extractor import FeatureExtractor
from textspark.registry import sql
from textspark.registry.features import fitted, rounded
from textspark.session import materialise
from textspark.sources.tables import dense_examples, split_of, utterances

L2, LR, SEED, BATCH = 1e-3, 0.1, 42, 32


def _start(docs: DataFrame) -> tuple[DataFrame, list[float]]:
    """Start weights for the features and classes that occur."""
    terms = unnest(docs, [], "features", "term_id").select("term_id").distinct()
    n_terms, n_classes = terms.count(), docs.select("y").distinct().count()
    return materialise(softmax.init_weights(terms, n_terms, n_classes)), [0.0] * n_classes


def _per_class(df: DataFrame, source: str, name: str, keys: list[str]) -> DataFrame:
    return df.select(*keys, F.posexplode(source).alias("class", name)).withColumn(name, rounded(F.col(name)))


def _params(state: DataFrame, names: tuple[str, ...]) -> DataFrame:
    zipped = F.arrays_zip(*[F.col(n) for n in names])
    long = state.select("term_id", F.posexplode(zipped).alias("class", "p"))
    return long.select("term_id", "class", *[rounded(F.col("p")[n]).alias(n) for n in names])


def _weights_init(spark, sf):
    return _per_class(_start(dense_examples(spark, sf))[0], "w", "w", ["term_id"])


def _scored(spark, sf):
    docs = dense_examples(spark, sf)
    weights, bias = _start(docs)
    scored = softmax.probabilities(softmax.logits(docs, weights, bias))
    return softmax.predictions(scored).join(docs.select("doc_id", "y"), "doc_id"), weights


def _logits(spark, sf):
    return _per_class(_scored(spark, sf)[0], "logits", "z", ["doc_id"])


def _proba(spark, sf):
    return _per_class(_scored(spark, sf)[0], "probs", "p", ["doc_id"])


def _argmax(spark, sf):
    return _scored(spark, sf)[0].select("doc_id", "y", "pred")


def _accuracy(spark, sf):
    return softmax.accuracy(_scored(spark, sf)[0]).withColumn("accuracy", rounded(F.col("accuracy")))


def _cross_entropy(spark, sf):
    scored, weights = _scored(spark, sf)
    return softmax.cross_entropy(scored, weights, L2).withColumn("loss", rounded(F.col("loss")))


def _minibatch(spark, sf):
    docs = dense_examples(spark, sf).select("doc_id")
    return softmax.minibatches(docs, BATCH, SEED)


def _epoch_loss(spark, sf):
    scored, _ = _scored(spark, sf)
    batches = softmax.minibatches(scored, BATCH, SEED).groupBy("batch")
    losses = batches.agg(F.avg(softmax.row_loss(F.col("probs"), F.col("y"))).alias("loss"), F.count("*").alias("n"))
    return softmax.weighted_mean_loss(losses).withColumn("loss", rounded(F.col("loss")))


def _gradient(spark, sf):
    docs = dense_examples(spark, sf)
    return _per_class(softmax.gradient(docs, *_start(docs), L2), "g", "g", ["term_id"])


def descend(docs: DataFrame, optimizer: str, steps: int, lr: float = LR, l2: float = L2):
    """Yield the optimiser state after each full-batch step."""
    weights, bias = _start(docs)
    state = materialise(optim.start(softmax.with_bias(weights, bias)))
    for step in range(1, steps + 1):
        weights, bias = softmax.split_bias(state)
        grads = softmax.gradient(docs, weights, bias, l2)
        state = materialise(optim.optimizer_step(optimizer, state, grads, lr, step))
        yield state


def _steps(optimizer: str, steps: int, names: tuple[str, ...]):
    def query(spark, sf):
        state = None
        for state in descend(dense_examples(spark, sf), optimizer, steps):
            pass
        return _params(state, names)

    return query


EPOCHS, PATIENCE = 6, 2


def _early_stop(spark, sf):
    """Training history with the best epoch so far and the epochs since; where training would stop."""
    docs = dense_examples(spark, sf).withColumn("split", split_of(F.col("doc_id")))
    train = materialise(docs.where("split = 'train'"))
    dev = materialise(docs.where("split = 'dev'"))
    epochs = []
    for epoch, state in enumerate(descend(train, "sgd", EPOCHS, lr=0.5), start=1):
        scored = softmax.predictions(softmax.logits(dev, *softmax.split_bias(state)))
        hits = softmax.accuracy(scored.join(dev.select("doc_id", "y"), "doc_id"))
        epochs.append(hits.select(F.lit(epoch).alias("epoch"), rounded(F.col("accuracy")).alias("score")))
    return optim.early_stopping(softmax.union_all(epochs), PATIENCE)


TOP_TERMS = 3000


def _submission(spark, sf):
    """Test documents scored by start weights over bag-of-words features: ID and label code."""
    data = utterances(spark, sf)
    train, dev, test = (data.where(F.col("split") == s) for s in ("train", "dev", "test"))
    extractor = FeatureExtractor("bow", TOP_TERMS).fit(train)
    index, codes = label_ops.label_index(train), label_ops.label_codes(train, dev)
    n_classes = index.count()
    terms = extractor.vocabulary.select("term_id")
    weights = softmax.init_weights(terms, extractor.vocab_size, n_classes)
    rows = extractor.transform_rows(test.select("doc_id", "sentence_sep"))
    scored = softmax.predictions(softmax.logits(rows, weights, [0.0] * n_classes))
    return decide(scored, test, index, codes).select("ID", "c_numerical")


RUNS = [("sgd", 0.5), ("adam", 0.1)]


def _trained(spark, sf) -> list[minibatch.Run]:
    """Both optimisers over the whole train split in each step, from the same start values as the relational steps."""
    docs = dense_examples(spark, sf)
    vectors = docs.withColumn("split", split_of("doc_id")).withColumn("features", array_to_vector(F.transform("features", lambda f: f["value"])))
    train, dev = vectors.where("split = 'train'"), vectors.where("split = 'dev'")
    weights, bias = _start(docs.join(train.select("doc_id"), "doc_id", "left_semi"))
    settings = [minibatch.Setting(name, lr, L2, 1 << 30) for name, lr in RUNS]
    return minibatch.train(train, dev, settings, weights.count(), len(bias), EPOCHS, EPOCHS, start=softmax.with_bias(weights, bias))


def _train_history(spark, sf):
    """Loss and dev accuracy of every epoch."""
    rows = [(r.number, e["epoch"], e["loss"], e["score"]) for r in _trained(spark, sf) for e in r.history]
    df = spark.createDataFrame(rows, "run int, epoch int, loss double, score double")
    return df.select("run", "epoch", rounded(F.col("loss")).alias("loss"), rounded(F.col("score")).alias("score"))


def _train_best(spark, sf):
    """The best epoch of each run, and the best run: the first strict improvement wins."""
    runs = _trained(spark, sf)
    top = max(range(len(runs)), key=lambda i: (runs[i].best_score, -i))
    rows = [(r.number, r.best_epoch, r.best_score, i == top) for i, r in enumerate(runs)]
    df = spark.createDataFrame(rows, "run int, best_epoch int, best_score double, best boolean")
    return df.withColumn("best_score", rounded(F.col("best_score")))


def _softmax_optimum(spark, sf):
    """Where the gradient at the solution of the exact fit is zero to four places: everywhere, for a convex loss."""
    docs = dense_examples(spark, sf)
    vectors = docs.withColumn("features", array_to_vector(F.transform("features", lambda f: f["value"])))
    n_features, n_classes = docs.select(F.max(F.size("features"))).first()[0], docs.select("y").distinct().count()
    model = fit_softmax(vectors, None, n_features, n_classes, l2=0.01, max_iter=500, tol=1e-10)
    grads = softmax.gradient(docs, model.weights, model.bias, 0.01)
    return grads.select("term_id", F.posexplode("g").alias("class", "g")).select("term_id", "class", (F.abs("g") < 1e-4).alias("flat"))


QUERIES = {
    "weights_init": _weights_init,
    "softmax_logits": _logits,
    "softmax_proba": _proba,
    "predict_argmax": _argmax,
    "accuracy": _accuracy,
    "cross_entropy": _cross_entropy,
    "minibatch": _minibatch,
    "epoch_loss": _epoch_loss,
    "softmax_grad": _gradient,
    "sgd_step": _steps("sgd", 1, ("w", "v")),
    "adam_step": _steps("adam", 1, ("w", "m", "v")),
    "softmax_gd_steps": _steps("sgd", 2, ("w", "v")),
    "softmax_adam_steps": _steps("adam", 2, ("w", "m", "v")),
    "early_stop": _early_stop,
    "train_history": _train_history,
    "train_best": _train_best,
    "softmax_optimum": _softmax_optimum,
    "submission": _submission,
}

_INIT = sql.normal("'W/' || CAST(term_id AS VARCHAR) || '/' || CAST(class AS VARCHAR)")


def _base(condition: str = "true") -> str:
    return f"""WITH
    feats AS (SELECT vec_id AS doc_id, label AS y, unnest(range(len(embedding))) AS term_id,
                     CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings),
    train AS (SELECT * FROM feats WHERE {condition}),
    classes AS (SELECT unnest(range((SELECT count(DISTINCT y) FROM train))) AS class),
    terms AS (SELECT DISTINCT term_id FROM train),
    w AS (SELECT term_id, class, {_INIT} * sqrt(2.0 / ((SELECT count(*) FROM terms) + (SELECT count(*) FROM classes)))
          AS w FROM terms, classes)"""


def _scores(params: str, name: str, source: str) -> str:
    """CTEs ``{name}z`` with logits and ``{name}p`` with probabilities."""
    return f"""{name}z AS (SELECT doc_id, y, class, sum(value * w) AS z FROM {source} JOIN {params} USING (term_id)
        GROUP BY ALL),
    {name}e AS (SELECT *, exp(z - max(z) OVER (PARTITION BY doc_id)) AS e FROM {name}z),
    {name}p AS (SELECT doc_id, y, class, z, e / sum(e) OVER (PARTITION BY doc_id) AS p FROM {name}e)"""


_SCORED = f"{_base()}, {_scores('w', 's', 'train')}"
_PRED_ROWS = """pred AS (SELECT doc_id, y, class AS pred FROM
    (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY z DESC, class) AS rn FROM {z}) WHERE rn = 1)"""


def _rounds(source: str) -> str:
    """``doc_id, p``: the places ``p`` of ``source`` one step on, by the same half rounds in SQL."""
    rows = f"SELECT doc_id, p // b AS x, p % b AS y, a, b, n FROM {source}, ab"
    for i, key in enumerate(keys(SEED, 1)):
        one, other, base = ("x", "y", "a") if i % 2 == 0 else ("y", "x", "b")
        rows = f"SELECT *, ({other} % 2147483648 * 1103515245 + {key}) % 2147483648 AS t FROM ({rows})"
        rows = f"SELECT * REPLACE (({one} + (((xor(t, t >> 15) * 1103515245 + 12345) % 2147483648) >> 4)) % {base} AS {one}) FROM ({rows})"
        rows = f"SELECT * EXCLUDE (t) FROM ({rows})"
    return f"SELECT doc_id, x * b + y AS p, n FROM ({rows})"


_BATCHES = f"""ranks AS (SELECT vec_id AS doc_id, CAST(row_number() OVER (ORDER BY vec_id) - 1 AS BIGINT) AS p FROM embeddings),
    total AS (SELECT count(*) AS n, CAST(floor(sqrt(count(*))) AS BIGINT) AS root FROM ranks),
    ab AS (SELECT n, a, (n + a - 1) // a AS b FROM total, range(greatest(root // 2, least(root, 2)), 2 * root + 2) AS r(a)
           ORDER BY a * ((n + a - 1) // a), abs(a - root), a LIMIT 1),
    walk AS (SELECT * FROM ({_rounds('ranks')}) UNION ALL SELECT * FROM ({_rounds('(SELECT doc_id, p FROM walk WHERE p >= n)')})),
    batches AS (SELECT doc_id, CAST(floor(p / {BATCH}) AS BIGINT) AS batch FROM walk WHERE p < n)"""


def descent(optimizer: str, steps: int, lr: float = LR, l2: float = L2, condition: str = "true") -> str:
    """CTEs ``p0`` … ``p{steps}`` of ``(term_id, class, w, m, v)``; the bias is ``term_id`` -1."""
    n = "(SELECT count(DISTINCT doc_id) FROM train)"
    ctes = [
        _base(condition),
        "full_feats AS (SELECT doc_id, y, term_id, value FROM train "
        "UNION ALL SELECT DISTINCT doc_id, y, -1, 1.0 FROM train)",
        "p0 AS (SELECT term_id, class, w, 0.0::DOUBLE AS m, 0.0::DOUBLE AS v FROM w "
        "UNION ALL SELECT -1, class, 0.0, 0.0, 0.0 FROM classes)",
    ]
    for t in range(1, steps + 1):
        before = f"p{t - 1}"
        ctes.append(_scores(before, f"t{t}", "full_feats"))
        ctes.append(
            f"""g{t} AS (SELECT term_id, class, s / {n} + CASE WHEN term_id = -1 THEN 0 ELSE {l2} END * w AS g
            FROM {before} JOIN (SELECT term_id, class, sum(value * (p - CASE WHEN y = class THEN 1 ELSE 0 END)) AS s
                                FROM full_feats JOIN t{t}p USING (doc_id, y) GROUP BY ALL) USING (term_id, class))"""
        )
        if optimizer == "sgd":
            ctes.append(
                f"""p{t} AS (SELECT term_id, class, w + (0.9 * v - {lr} * g) AS w, m, 0.9 * v - {lr} * g AS v
                FROM {before} JOIN g{t} USING (term_id, class))"""
            )
        else:
            ctes.append(
                f"""q{t} AS (SELECT term_id, class, w, 0.9::DOUBLE * m + (1 - 0.9::DOUBLE) * g AS m,
                    0.999::DOUBLE * v + (1 - 0.999::DOUBLE) * g * g AS v
                    FROM {before} JOIN g{t} USING (term_id, class)),
                p{t} AS (SELECT term_id, class, w - {lr} * (m / (1 - power(0.9::DOUBLE, {t}))) /
                    (sqrt(v / (1 - power(0.999::DOUBLE, {t}))) + 1e-8) AS w, m, v FROM q{t})"""
            )
    return ", ".join(ctes)


def _descent_sql(optimizer: str, steps: int, names: tuple[str, ...]) -> str:
    columns = ", ".join(f"{sql.rounded(n)} AS {n}" for n in names)
    return f"{descent(optimizer, steps)} SELECT term_id, CAST(class AS INTEGER) AS class, {columns} FROM p{steps}"


def _epochs(optimizer: str, lr: float) -> tuple[str, list[str]]:
    """CTEs ``a1`` … with the dev accuracy after each epoch, and their names."""
    base = descent(optimizer, EPOCHS, lr=lr, condition=sql.SPLIT.format(id="doc_id") + " = 'train'")
    dev = (
        "dev AS (SELECT doc_id, y, term_id, value FROM feats WHERE {c} UNION ALL "
        "SELECT DISTINCT doc_id, y, -1, 1.0 FROM feats WHERE {c})"
    ).format(c=sql.SPLIT.format(id="doc_id") + " = 'dev'")
    epochs = []
    for t in range(1, EPOCHS + 1):
        epochs.append(
            f"""d{t} AS (SELECT doc_id, y, class, sum(value * w) AS z FROM dev JOIN p{t} USING (term_id) GROUP BY ALL),
            a{t} AS (SELECT avg(CASE WHEN class = y THEN 1.0 ELSE 0.0 END) AS score FROM
              (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY z DESC, class) AS rn FROM d{t}) WHERE rn = 1)"""
        )
    return f"{base}, {dev}, {', '.join(epochs)}", [f"a{t}" for t in range(1, EPOCHS + 1)]


def _history_sql() -> str:
    """``run, epoch, loss, score``: the loss before an epoch's step and the dev accuracy after it."""
    runs = []
    for number, (optimizer, lr) in enumerate(RUNS):
        ctes, scores = _epochs(optimizer, lr)
        parts = [
            f"""SELECT {number} AS run, {t} AS epoch, (SELECT avg(-ln(p + 1e-12)) FROM t{t}p WHERE class = y)
                + {L2 / 2} * (SELECT sum(w * w) FROM p{t - 1} WHERE term_id <> -1) AS loss, score FROM {name}"""
            for t, name in enumerate(scores, start=1)
        ]
        runs.append(f"SELECT * FROM ({ctes} {' UNION ALL '.join(parts)})")
    return " UNION ALL ".join(runs)


def _early_stop_sql() -> str:
    ctes, scores = _epochs("sgd", 0.5)
    parts = [f"SELECT {t} AS epoch, {sql.rounded('score')} AS score FROM {name}" for t, name in enumerate(scores, start=1)]
    return f"""{ctes}, history AS ({' UNION ALL '.join(parts)}),
    marked AS (SELECT *, CASE WHEN score > coalesce(max(score) OVER (ORDER BY epoch
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) THEN epoch END AS hit FROM history),
    seen AS (SELECT epoch, score, max(score) OVER (ORDER BY epoch) AS best,
        max(hit) OVER (ORDER BY epoch) AS best_epoch FROM marked)
    SELECT epoch, score, best, best_epoch, epoch - best_epoch AS waited,
           epoch - best_epoch >= {PATIENCE} AS stop FROM seen"""


ORACLES = {
    "weights_init": f"{_base()} SELECT term_id, CAST(class AS INTEGER) AS class, {sql.rounded('w')} AS w FROM w",
    "softmax_logits": f"{_SCORED} SELECT doc_id, CAST(class AS INTEGER) AS class, {sql.rounded('z')} AS z FROM sz",
    "softmax_proba": f"{_SCORED} SELECT doc_id, CAST(class AS INTEGER) AS class, {sql.rounded('p')} AS p FROM sp",
    "predict_argmax": f"{_SCORED}, {_PRED_ROWS.format(z='sz')} SELECT doc_id, y, CAST(pred AS INTEGER) AS pred FROM pred",
    "accuracy": f"""{_SCORED}, {_PRED_ROWS.format(z='sz')}
        SELECT {sql.rounded('avg(CASE WHEN pred = y THEN 1.0 ELSE 0.0 END)')} AS accuracy FROM pred""",
    "cross_entropy": f"""{_SCORED} SELECT {sql.rounded(
        f'(SELECT avg(-ln(p + 1e-12)) FROM sp WHERE class = y) + 0.5 * {L2} * (SELECT sum(w * w) FROM w)')} AS loss""",
    "minibatch": f"WITH RECURSIVE {_BATCHES} SELECT * FROM batches",
    "epoch_loss": f"""{_SCORED.replace('WITH', 'WITH RECURSIVE', 1)}, {_BATCHES},
        losses AS (SELECT batch, avg(-ln(p + 1e-12)) AS loss, count(*) AS n
                   FROM sp JOIN batches USING (doc_id) WHERE class = y GROUP BY batch)
        SELECT {sql.rounded('sum(loss * n) / sum(n)')} AS loss FROM losses""",
    "softmax_grad": f"""{descent('sgd', 1)}
        SELECT term_id, CAST(class AS INTEGER) AS class, {sql.rounded('g')} AS g FROM g1""",
    "sgd_step": _descent_sql("sgd", 1, ("w", "v")),
    "adam_step": _descent_sql("adam", 1, ("w", "m", "v")),
    "softmax_gd_steps": _descent_sql("sgd", 2, ("w", "v")),
    "softmax_adam_steps": _descent_sql("adam", 2, ("w", "m", "v")),
    "early_stop": _early_stop_sql(),
    "train_history": f"""SELECT run, epoch, {sql.rounded('loss')} AS loss, {sql.rounded('score')} AS score
        FROM ({_history_sql()})""",
    "train_best": f"""WITH tops AS (SELECT run, max(score) AS score, arg_max(epoch, (score, -epoch)) AS best_epoch
                 FROM ({_history_sql()}) GROUP BY run)
        SELECT run, best_epoch, {sql.rounded('score')} AS best_score,
               row_number() OVER (ORDER BY score DESC, run) = 1 AS best FROM tops""",
    "softmax_optimum": """SELECT CAST(term_id AS BIGINT) AS term_id, CAST(class AS INTEGER) AS class, true AS flat FROM
        (SELECT unnest(range(-1, (SELECT max(len(embedding)) FROM embeddings))) AS term_id),
        (SELECT unnest(range((SELECT count(DISTINCT label) FROM embeddings))) AS class)""",
    "submission": f"""{sql.TEXT}, {sql.CODES},
        {fitted('x', sql.word_grams(1, 1), TOP_TERMS, 1, 1.0, False, False)},
        labels_in AS (SELECT label_raw, row_number() OVER (ORDER BY label_raw) - 1 AS class
                      FROM (SELECT DISTINCT label_raw FROM docs WHERE split = 'train')),
        w AS (SELECT term_id, class, {_INIT} * sqrt(2.0 / ((SELECT count(*) FROM x_v) + (SELECT count(*) FROM labels_in)))
              AS w FROM x_v, labels_in),
        z AS (SELECT doc_id, class, sum(value * w) AS z FROM x JOIN w USING (term_id) GROUP BY ALL),
        every AS (SELECT d.doc_id, "ID", l.class, l.label_raw, coalesce(z, 0) AS z
                  FROM docs d CROSS JOIN labels_in l LEFT JOIN z ON z.doc_id = d.doc_id AND z.class = l.class
                  WHERE d.split = 'test'),
        best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY z DESC, class) AS rn FROM every)
        SELECT "ID", CAST(c_numerical AS INTEGER) AS c_numerical FROM best JOIN codes USING (label_raw) WHERE rn = 1""",
}
