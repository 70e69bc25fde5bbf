import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textspark.operators.features import METHODS, top_terms
from textspark.plans.extractor import FeatureExtractor, features_by_split

TEXTS = ["a b a", "b c", "", "the cat sat on the mat", "a cat, a mat!", "b b b b c"]


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, t, "train" if i < 4 else "dev") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, sentence_sep string, split string").cache()


def grams(text, method, lo, hi):
    words = text.replace(",", "").replace("!", "").lower().split()
    joined = " ".join(words)
    if method == "char_tfidf":
        return [joined[i : i + n] for n in range(lo, hi + 1) for i in range(len(joined) - n + 1)]
    if method == "char_wb_tfidf":
        padded = [f" {w} " for w in words]
        return [p[i : i + n] for p in padded for n in range(lo, hi + 1) for i in range(len(p) - n + 1)]
    return [" ".join(words[i : i + n]) for n in range(lo, hi + 1) for i in range(len(words) - n + 1)]


def expected(fit_texts, texts, method, span, top, min_df, max_df, sublinear):
    counts = [Counter(grams(t, method, *span)) for t in fit_texts]
    df, tf = Counter(), Counter()
    for c in counts:
        tf.update(c)
        df.update(c.keys())
    n = len(fit_texts)
    kept = [t for t in df if min_df <= df[t] <= max_df * n]
    kept = sorted(sorted(kept, key=lambda t: (-tf[t], t))[:top])
    out = []
    for text in texts:
        c = Counter(grams(text, method, *span))
        row = {}
        for i, t in enumerate(kept):
            if c[t]:
                row[i] = float(c[t])
                if method.endswith("tfidf"):
                    row[i] = (1 + math.log(c[t]) if sublinear else c[t]) * (math.log((1 + n) / (1 + df[t])) + 1)
        if method.endswith("tfidf") and row:
            norm = math.sqrt(sum(v * v for v in row.values()))
            row = {i: v / norm for i, v in row.items()}
        out.append(row)
    return kept, out


@pytest.mark.parametrize("method", METHODS)
@pytest.mark.parametrize("options", [(100, 1, 1.0, False), (7, 1, 0.7, True), (100, 2, 1.0, True)])
def test_methods_match_the_definition(corpus, method, options):
    top, min_df, max_df, sublinear = options
    span = (2, 3) if method.startswith("char") else (1, 2)
    kept, want = expected(TEXTS[:4], TEXTS, method, span, top, min_df, max_df, sublinear)
    x = FeatureExtractor(method, top, span, min_df, max_df, sublinear).fit(corpus.where("split = 'train'"))
    assert [r["term"] for r in x.vocabulary.orderBy("term_id").collect()] == kept
    assert x.vocab_size == len(kept)
    by_row = {r["doc_id"]: r["features"] for r in x.transform_rows(corpus).collect()}
    by_join = {r["doc_id"]: r["features"] for r in x._transform_by_join(corpus).collect()}
    vectors = {r["doc_id"]: r["features"] for r in x.transform(corpus).collect()}
    for i, row in enumerate(want):
        for got in (by_row[i], by_join[i]):
            assert {p["term_id"]: pytest.approx(p["value"]) for p in got} == row
        v = vectors[i]
        assert v.size == len(kept)
        assert dict(zip(v.indices.tolist(), v.values.tolist())) == pytest.approx(row)


def test_golden_tfidf(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "b c")], "doc_id long, sentence_sep string")

    def values(sublinear):
        x = FeatureExtractor("tfidf", sublinear_tf=sublinear).fit(df)
        return [round(r["value"], 6) for r in x.transform_long(df).orderBy("doc_id", "term_id").collect()]

    assert values(False) == [0.942156, 0.335176, 0.579739, 0.814802]
    assert values(True) == [0.921907, 0.387411, 0.579739, 0.814802]


def test_unknown_method():
    with pytest.raises(ValueError, match="nope"):
        FeatureExtractor("nope")


def test_transform_needs_fit(corpus):
    with pytest.raises(RuntimeError, match="fit"):
        FeatureExtractor().transform(corpus)
    assert FeatureExtractor().vocab_size == 0


def test_unknown_terms_drop_out(corpus):
    vectors = features_by_split(FeatureExtractor("bow"), corpus)
    assert vectors.count() == len(TEXTS)
    assert "sentence_sep" not in vectors.columns


def test_dev_filter_reads_dev_files_only(corpus):
    vectors = features_by_split(FeatureExtractor("bow"), corpus)
    plan = vectors.where("split = 'dev'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_save_and_load(spark, corpus, tmp_path):
    x = FeatureExtractor("tfidf", 5, (1, 2), sublinear_tf=True).fit(corpus)
    x.save(str(tmp_path / "x"))
    y = FeatureExtractor.load(spark, str(tmp_path / "x"))
    assert y.params() == x.params() and y.vocab_size == 5
    assert sorted(y.transform_long(corpus).collect()) == sorted(x.transform_long(corpus).collect())


def test_unit_norm_and_partitioning(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "text AS sentence_sep")
    x = FeatureExtractor("char_wb_tfidf", 800, (2, 4), sublinear_tf=True).fit(docs)
    y = FeatureExtractor("char_wb_tfidf", 800, (2, 4), sublinear_tf=True).fit(docs.repartition(9))
    assert sorted(x.vocabulary.collect()) == sorted(y.vocabulary.collect())
    norms = x.transform_long(docs).groupBy("doc_id").agg(F.sum(F.col("value") ** 2).alias("n"))
    assert norms.where(F.abs(F.col("n") - 1) > 1e-9).count() == 0


def test_transform_counts_each_document_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "text AS sentence_sep")
    x = FeatureExtractor("tfidf", 50).fit(docs)
    plan = x.transform_long(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.count("regexp_extract_all(regexp_replace") == 1


def test_top_terms_ways_agree(spark):
    rows = [(f"t{i:03d}", (i * 7) % 13, 1) for i in range(200)]
    stats = spark.createDataFrame(rows, "term string, tf long, df long")
    for k in (1, 17, 200, 500):
        assert sorted(top_terms(stats, k).collect()) == sorted(top_terms(stats, k, one_task_rows=0).collect())
