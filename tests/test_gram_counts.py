from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textspark.operators import gram_counts
from textspark.operators.features import analyse
from textspark.plans import minibatch
from textspark.plans.extractor import FeatureExtractor

TEXTS = ["a bc a bc d", "", None, "您 好 a1 您 好", "aaa aa a", "zz yy x", "bc", "d bc", "qq ab 的确"]


@pytest.mark.parametrize("dense", [True, False])
@pytest.mark.parametrize("method, lo, hi", [("bow", 1, 1), ("ngram", 1, 2), ("tfidf", 2, 3), ("char_tfidf", 1, 3), ("char_wb_tfidf", 1, 2), ("char_wb_tfidf", 2, 5), ("char_wb_tfidf", 3, 4)])
def test_counts_are_those_of_the_analyser(spark, monkeypatch, method, lo, hi, dense):
    monkeypatch.setattr(gram_counts, "DENSE_CELLS", 1 << 23 if dense else 0)
    monkeypatch.setattr(gram_counts, "GROUP_CHARS", 12)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").coalesce(1)
    found = {r["doc_id"]: Counter(r["g"] or []) for r in df.select("doc_id", analyse(F.coalesce("text", F.lit("")), method, lo, hi).alias("g")).collect()}
    terms = sorted({t for c in found.values() for t in c})[::2]
    number = {t: i for i, t in enumerate(terms)}

    def made(sizes, term, counts):
        import pyarrow as pa

        ends = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
        return [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (term, counts)]

    rows = gram_counts.term_counts(df, terms, method, lo, hi, "ids array<bigint>, n array<bigint>", made, ["doc_id"]).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert list(zip(r["ids"], r["n"])) == sorted((number[t], n) for t, n in found[r["doc_id"]].items() if t in number)


def test_counts_go_through_bytes():
    sizes = np.array([0, 3, 0, 1, 2])
    columns, counts = np.array([0, 254, 70_000, 255, 3, 510]), np.array([1, 255, 256, 70_000, 1, 2])
    read = [[r.as_py() for r in a] for a in minibatch.count_bytes(sizes, columns, counts)]
    assert read[2] == sizes.tolist() and len(read[0][4]) == 1 + 2 and read[0][0] == b""
    back = minibatch.read_counts(sizes, b"".join(read[0]), b"".join(read[1]))
    assert back[0].tolist() == columns.tolist() and back[1].tolist() == counts.tolist()


def test_vectors_are_written_as_counts(spark, tmp_path):
    """Their weights would take eight bytes a number and more."""
    texts = [(i, " ".join(f"w{(i * j) % 997}" for j in range(1, 400)), "train" if i % 2 else "dev") for i in range(60)]
    df = spark.createDataFrame(texts, "doc_id long, sentence_sep string, split string")
    extractor = FeatureExtractor("tfidf", 900, (1, 1), sublinear_tf=True).fit(df)
    vectors = extractor.transform(df)
    want = {r["doc_id"]: r["features"] for r in extractor.transform_rows(df).collect()}
    got = {r["doc_id"]: r["features"] for r in vectors.where("split = 'dev'").collect()}
    assert len(got) == 30 and all(dict(zip(v.indices.tolist(), v.values.tolist())) == {p["term_id"]: p["value"] for p in want[i]} for i, v in got.items())
    read = spark.read.parquet(vectors.inputFiles()[0].split("/split=")[0])
    bytes_held, numbers = read.select(F.sum(F.octet_length("indices") + F.octet_length("values")), F.sum("sizes")).first()
    assert bytes_held < 2.2 * numbers


def test_counts_train_like_vectors(spark):
    texts = [(i, " ".join(f"w{(i * j) % 31}" for j in range(1, 9 + i % 5)), i % 2) for i in range(80)]
    df = spark.createDataFrame(texts, "doc_id long, sentence_sep string, y int")
    for method in ("bow", "tfidf"):
        extractor = FeatureExtractor(method, 25, (1, 1), sublinear_tf=method == "tfidf").fit(df)
        counts, scale = extractor.transform_counts(df)
        settings = [minibatch.Setting("adam", 0.1, 0.01, 8), minibatch.Setting("sgd", 0.1, 0.0, 16)]
        vectors = extractor.transform(df)
        one = minibatch.train(counts, counts, settings, 25, 2, 4, 3, shards=3, scale=scale, sizes=(80, 80))
        other = minibatch.train(vectors, vectors, settings, 25, 2, 4, 3, shards=3)
        assert [[e["loss"] for e in r.history] for r in one] == [pytest.approx([e["loss"] for e in r.history]) for r in other]
        assert [r.best_score for r in one] == [r.best_score for r in other]


def test_what_a_task_can_hold_trains_there_as_epoch_by_epoch(spark, monkeypatch):
    """Several shards no longer mean a job for every epoch."""
    df = spark.createDataFrame([(i, f"a{i % 5} b{i % 3} c{i % 7}", i % 3) for i in range(90)], "doc_id long, sentence_sep string, y int")
    extractor = FeatureExtractor("bow", 15, (1, 1)).fit(df)
    vectors = extractor.transform(df)
    settings = [minibatch.Setting("adam", 0.1, 0.01, 8), minibatch.Setting("sgd", 0.05, 0.001, 8), minibatch.Setting("adam", 0.03, 0.0, 16)]
    plans, real = [], minibatch.epoch_plan
    monkeypatch.setattr(minibatch, "epoch_plan", lambda *a: plans.append(a[-1]) or real(*a))
    whole = minibatch.train(vectors, vectors, settings, 15, 3, 4, 2, shards=3)
    assert not plans
    monkeypatch.setattr(minibatch, "WHOLE_BYTES", 0)
    apart = minibatch.train(vectors, vectors, settings, 15, 3, 4, 2, shards=3)
    assert plans
    for a, b in zip(whole, apart):
        assert [e["score"] for e in a.history] == [e["score"] for e in b.history] and a.best_epoch == b.best_epoch
        assert [e["loss"] for e in a.history] == pytest.approx([e["loss"] for e in b.history])
        assert a.train_acc == b.train_acc
        wa, wb = ({r["term_id"]: r["w"] for r in run.weights(spark, 15, 3).collect()} for run in (a, b))
        assert wa.keys() == wb.keys() and all(np.allclose(wa[k], wb[k]) for k in wa)
