"""Lookup joins whose strategy follows the measured size of the dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20
ELEMENT_BYTES = 8


def measured_bytes(df: DataFrame) -> int:
    """Size of the payload of ``df``, computed on the executors."""

    def width(c: Column, kind: T.DataType) -> Column:
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0)) + 16
        if isinstance(kind, T.ArrayType):
            if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType)):
                each = F.transform(c, lambda x: width(x, kind.elementType).cast("bigint"))
                return F.coalesce(F.aggregate(each, F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(0)) + 16
            return F.greatest(F.size(c), F.lit(0)) * ELEMENT_BYTES + 16
        if isinstance(kind, T.StructType):
            return sum((width(c[f.name], f.dataType) for f in kind.fields), F.lit(16))
        return F.lit(8)

    row = sum((width(F.col(_quoted(f.name)), f.dataType) for f in df.schema.fields), F.lit(0))
    return int(df.agg(F.sum(row.cast("bigint")).alias("b")).first()["b"] or 0)


def fits(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "left",
    weight: str | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``facts`` to a dimension with unique ``key``.

    A dimension measured below ``limit`` bytes is broadcast. A larger one is joined by
    shuffle; if it carries a row-count column ``weight`` for its keys, keys heavier than an
    average partition are salted, so no task receives all rows of a hot key.
    """
    if fits(dim, limit):
        return facts.join(F.broadcast(dim), key, how)
    if weight is None:
        return facts.join(dim, key, how)
    return _salted(facts, dim, key, how, weight)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _salted(facts: DataFrame, dim: DataFrame, key: str, how: str, weight: str) -> DataFrame:
    parts = max(int(dim.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    total = dim.agg(F.sum(weight).alias("t")).first()["t"] or 0
    hot_at = max(total // parts, 1)
    # As many salts as average partitions the key would fill; one for all other keys.
    salts = F.greatest(F.ceil(F.col(weight) / hot_at), F.lit(1)).cast("int")
    # Weights add up to ``total``, so at most ``parts`` keys can pass: broadcasting them is bounded.
    hot = dim.where(F.col(weight) > hot_at).select(key, salts.alias("_salts"))
    salted_dim = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    others = [F.col(_quoted(c)) for c in facts.columns if c != key] or [F.lit(0)]
    # Hashing the rest of the row keeps the salt the same when a task is retried.
    salt = F.pmod(F.xxhash64(*others), F.coalesce("_salts", F.lit(1))).cast("int")
    marked = facts.join(F.broadcast(hot), key, "left").withColumn("_salt", salt)
    return marked.join(salted_dim, [key, "_salt"], how).drop("_salt", "_salts")
