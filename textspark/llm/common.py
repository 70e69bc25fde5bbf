"""What the operators share: columns, hashes, and prefix sums without a large group in one task."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = "\x20\t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"
BUCKET_ROWS = 1024  # rows that one running total handles together


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns an operator is about to add, whatever their case."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


@contextmanager
def configured(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session for what is executed inside."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def small_batches(spark: SparkSession, rows: int = 1000, size: str | None = None) -> AbstractContextManager[None]:
    """Arrow batches of at most ``rows`` rows, and about ``size``, for what is executed inside, so that long texts stay small in memory."""
    settings = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)}
    return configured(spark, settings | ({"spark.sql.execution.arrow.maxBytesPerBatch": size} if size else {}))


def light_rounds(spark: SparkSession, adaptive: bool) -> AbstractContextManager[None]:
    """For loops of many small writes: the driver builds no hash table of a join, which costs it some MB each.

    Without ``adaptive``, for joins whose keys cannot be hot, a write is one job planned once; else Spark plans it
    anew after each of its shuffles, and keeps a thread for each of them for a minute.
    """
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    return configured(spark, settings | ({} if adaptive else {"spark.sql.adaptive.enabled": "false"}))


def quoted(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def annotated(docs: DataFrame, text: str, judge, added: str) -> DataFrame:
    """Columns of ``docs`` and those that ``judge`` makes of its texts, batch by batch; ``added`` is their schema.

    ``judge`` takes an Arrow array of strings and returns Arrow arrays. Rows travel as one struct, so any
    column names are fine.
    """
    new = T.StructType.fromDDL(added)
    row = T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema])
    names = ["_row", *new.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(1), *judge(batch.column(0))], names=names)

    packed = docs.select(quoted(text).cast("string").alias("_text"), F.struct(*[quoted(c) for c in docs.columns]).alias("_row"))
    return packed.mapInArrow(run, T.StructType([T.StructField("_row", row), *new.fields])).select("_row.*", *new.names)


def runs(work: Callable[[pa.Table], pa.RecordBatch | None]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Applies ``work`` to every run of equal values in the first column of a sorted partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if held and held[0].column(0)[0].as_py() != key[lo]:
                    got = work(pa.Table.from_batches(held))
                    if got is not None:
                        yield got
                    held = []
                held.append(batch.slice(lo, hi - lo))
        if held:
            got = work(pa.Table.from_batches(held))
            if got is not None:
                yield got

    return run


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def bucketed(df: DataFrame, groups: list[str], hashed: str, rows: int | None = None) -> tuple[DataFrame, Column]:
    """The bucket of a row: the top bits of its hash, about ``BUCKET_ROWS`` rows each if all are one group.

    Buckets follow the order of the hash, so their number changes the plan but no result.
    """
    rows = df.count() if rows is None else rows
    bits = max(0, math.ceil(math.log2(max(1, rows / BUCKET_ROWS))))
    bucket = F.shiftrightunsigned(F.col(hashed), 64 - bits) if bits else F.lit(0).cast("long")
    return df, bucket


def running_total(
    df: DataFrame,
    groups: list[str],
    hashed: str,
    order: list[str | Column],
    value: str,
    name: str,
    rows: int | None = None,
    extra: DataFrame | None = None,
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows before this one, per group, in order of hash.

    ``groups`` hold no nulls and ``hashed`` is a 64-bit hash, read as unsigned. A group of any size is
    cut into buckets by the hash; their sums come from a pre-aggregated pass that reads only these
    columns, and rows move once, by group and bucket. ``extra`` has one row per group and is joined to
    the bucket sums, so its columns reach the rows without a join on a hot key.
    """
    df, bucket = bucketed(df, groups, hashed, rows)
    keys = [*groups, "_bucket"]
    df = df.withColumn("_bucket", bucket)
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    if extra is not None:
        sums = sums.join(extra, groups)
    shifts = sums.withColumn("_shift", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = (
        Window.partitionBy(*keys)
        .orderBy(F.col(hashed), *order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        df.join(shifts, keys)
        .withColumn(name, F.col("_shift") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_bucket", "_shift")
    )
