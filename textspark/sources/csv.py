"""CSV in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns and types of the input files.
LABELLED = {"sentence_sep": "string", "label_raw": "string", "c_numerical": "int"}
UNLABELLED = {"ID": "string", "sentence_sep": "string"}


def read_csv(spark: SparkSession, path: str | list[str], columns: dict[str, str], multi_line: bool = True) -> DataFrame:
    """Columns by trimmed header name, cast to fixed types.

    Reads UTF-8 with or without BOM, doubled quotes and line breaks inside quotes. A given
    schema would bind by position, so all columns come in as strings and are picked by name.

    ``path`` is a file, a folder of files with the same header, or a list of them. A line break inside
    quotes can only be told from a row's end by reading a file from its start, so each file is one task:
    a large corpus is a folder of files. Where no cell holds line breaks, ``multi_line=False`` also splits files.
    """
    raw = spark.read.options(header=True, multiLine=multi_line, escape='"', encoding="UTF-8").csv(path)
    named = raw.toDF(*[c.strip() for c in raw.columns])
    whole = {c for c, t in columns.items() if t == "int"}
    picked = named.select(*[_whole(F.col(f"`{c}`")).alias(c) if c in whole else F.col(f"`{c}`").cast(t).alias(c) for c, t in columns.items()])
    if whole:
        bad = named.agg(*[F.count_if(_unreadable(F.col(f"`{c}`"))).alias(c) for c in sorted(whole)]).first().asDict()
        if any(bad.values()):
            raise ValueError(f"cells that are neither blank nor whole numbers in {path}: {bad}")
    return picked


def _whole(cell: Column) -> Column:
    """A whole number, also one written ``3.0``; blank cells are null."""
    return cell.try_cast("double").try_cast("int")


def _unreadable(cell: Column) -> Column:
    number = cell.try_cast("double")
    return (F.trim(cell) != "") & F.coalesce(number.isNull() | (number != F.floor(number)) | number.try_cast("int").isNull(), F.lit(True))


def load_splits(spark: SparkSession, train: str, dev: str, test: str) -> DataFrame:
    """The three files as one table with a ``split`` column."""
    parts = [
        read_csv(spark, train, LABELLED).withColumn("split", F.lit("train")),
        read_csv(spark, dev, LABELLED).withColumn("split", F.lit("dev")),
        read_csv(spark, test, UNLABELLED).withColumn("split", F.lit("test")),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def write_submission(scored: DataFrame, path: str) -> str:
    """Write exactly ``ID,c_numerical`` with a header, ordered by ``ID``; folders are created."""
    (
        scored.select("ID", "c_numerical")
        .orderBy("ID")
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )
    return path
