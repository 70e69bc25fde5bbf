"""The given Parquet tables in the shape of the pipelines' inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textspark.operators.labels import label_index
from textspark.operators.lookup import lookup
from textspark.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def split_of(doc_id: Column) -> Column:
    """Every document belongs to one of three splits, in proportion 6 : 2 : 2."""
    digit = F.pmod(doc_id, F.lit(10))
    return F.when(digit < 6, "train").when(digit < 8, "dev").otherwise("test")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, ID, sentence_sep, label_raw, split`` over all documents."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("doc_id").cast("string").alias("ID"),
        F.col("text").alias("sentence_sep"),
        F.col("lang").alias("label_raw"),
        split_of(F.col("doc_id")).alias("split"),
    )
    return spread(docs, "doc_id")


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with ``c_numerical``, the alphabetical rank of the label."""
    docs = documents(spark, sf_dir)
    codes = label_index(docs).select("label_raw", F.col("idx").cast("int").alias("c_numerical"))
    return lookup(docs, codes, "label_raw", "inner")


def quality_utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A two-class task over the documents that carry a quality label."""
    quality = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return (
        documents(spark, sf_dir)
        .join(quality, "doc_id")
        .withColumn("label_raw", F.col("quality").cast("string"))
        .withColumn("c_numerical", F.col("quality").cast("int"))
        .drop("quality")
    )


def dialog_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dialogue text with its turn markers, one row per turn.

    Turns are not joined into one string per dialogue: a dialogue has no size bound.
    """
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.concat(F.col("text"), F.lit(" [SEP] ")).alias("sentence_sep")
    )


def dense_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, y, features array<struct<term_id, value>>`` from the embeddings table."""
    values = F.transform(
        "embedding", lambda x, i: F.struct(i.cast("bigint").alias("term_id"), x.cast("double").alias("value"))
    )
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("label").cast("int").alias("y"), values.alias("features")
    )
