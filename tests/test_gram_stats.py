import pytest
from pyspark.sql import functions as F

from textspark.operators import gram_stats
from textspark.operators.features import analyse, with_text
from textspark.operators.vocab import bag_of_terms, term_stats
from textspark.registry.text import QUERIES

TEXTS = ["the cat sat on the mat", "", None, "a", "中文 ab 中文字 A-b  c", "the the the", "x" * 40, " ".join(f"w{i} 字{i % 7}" for i in range(300))]


@pytest.mark.parametrize("method,lo,hi", [("bow", 1, 1), ("ngram", 1, 3), ("char_tfidf", 1, 4), ("char_wb_tfidf", 1, 5), ("char_wb_tfidf", 3, 4)])
def test_groups_count_what_documents_count(spark, monkeypatch, method, lo, hi):
    docs = with_text(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, sentence_sep string")).coalesce(1)
    grams = docs.select("doc_id", analyse(F.col("text"), method, lo, hi).alias("grams"))
    want = {tuple(r) for r in term_stats(bag_of_terms(grams, "grams")).collect()}
    for most, chars in ((1 << 62, 1 << 21), (1 << 62, 50), (1 << 9, 1 << 21)):  # the last: halved texts, tuples
        monkeypatch.setattr(gram_stats, "_MOST", most)
        monkeypatch.setattr(gram_stats, "GROUP_CHARS", chars)
        assert {tuple(r) for r in gram_stats.gram_stats(docs, method, lo, hi).collect()} == want


def test_the_queries_count_by_groups(spark, sf_dir):
    for name in ("word_ngrams", "char_ngrams", "char_wb_ngrams"):
        assert "MapInArrow" in QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
