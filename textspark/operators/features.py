"""Feature statistics in long form: one row per (document, term)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textspark.functions.text import char_ngrams, char_wb_ngrams, document_text, tokenize, word_ngrams
from textspark.operators.lookup import BROADCAST_BYTES, lookup
from textspark.operators.rank import global_rank

ONE_TASK_ROWS = 5_000_000

METHODS = ("bow", "ngram", "tfidf", "char_tfidf", "char_wb_tfidf")


def analyse(text: Column, method: str, lo: int, hi: int) -> Column:
    """The array of n-grams that ``method`` counts in a prepared text."""
    if method in ("bow", "ngram", "tfidf"):
        return word_ngrams(text, lo, hi)
    if method == "char_tfidf":
        return char_ngrams(text, lo, hi)
    if method == "char_wb_tfidf":
        return char_wb_ngrams(text, lo, hi)
    raise ValueError(f"unknown method: {method}")


def is_weighted(method: str) -> bool:
    return method.endswith("tfidf")


def with_text(
    df: DataFrame, source: str = "sentence_sep", han_mode: str = "char", null_token: str = ""
) -> DataFrame:
    """Add ``text``: tokens without stop words, lower-cased and joined by blanks."""
    return df.withColumn("text", document_text(tokenize(source, han_mode, null_token=null_token)))


def df_band(stats: DataFrame, n_docs: int, min_df: int = 1, max_df: float = 1.0) -> DataFrame:
    """Terms with ``min_df <= df <= max_df * n_docs``."""
    return stats.where((F.col("df") >= min_df) & (F.col("df") <= max_df * n_docs))


def top_terms(
    stats: DataFrame, max_features: int | None, one_task_rows: int = ONE_TASK_ROWS
) -> DataFrame:
    """The ``max_features`` most frequent terms; the lower term wins a tie.

    A sorted limit hands the best rows of every partition to one task. If those could exceed
    ``one_task_rows``, the terms are ranked by a distributed sort instead.
    """
    if max_features is None:
        return stats
    order = [F.desc("tf"), F.col("term")]
    parts = int(stats.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if parts * max_features <= one_task_rows:
        return stats.orderBy(*order).limit(max_features)
    return global_rank(stats, order, "_rank").where(F.col("_rank") < max_features).drop("_rank")


def smooth_idf(df: Column, n_docs: int) -> Column:
    return F.log(F.lit(1.0 + n_docs) / (1 + df)) + 1


def term_weight(tf: Column, sublinear: bool) -> Column:
    return 1 + F.log(tf) if sublinear else tf.cast("double")


def weigh(
    bag: DataFrame,
    terms: DataFrame,
    weighted: bool,
    sublinear: bool = False,
    key: str = "doc_id",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(key, term, value)`` for any vocabulary size, from ``(key, term, tf)``.

    ``terms`` holds ``term``, ``df`` and ``idf``; its ``term_id``, if there is one, comes along. TF-IDF
    rows have unit L2 norm per document.
    """
    names = ["term", *(["term_id"] if "term_id" in terms.columns else [])]
    kept = lookup(bag, terms.select(*names, "df", "idf"), "term", "inner", "df", limit)
    if not weighted:
        return kept.select(key, *names, F.col("tf").cast("double").alias("value"))
    raw = kept.select(key, *names, (term_weight(F.col("tf"), sublinear) * F.col("idf")).alias("v"))
    norm = F.sqrt(F.sum(F.col("v") * F.col("v")).over(Window.partitionBy(key)))
    return raw.select(key, *names, (F.col("v") / norm).alias("value"))
