"""Sharding by jump consistent hashing: stable keys to shards without a ring table."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textspark.llm.common import running_total, without

MULTIPLIER = 2862933555777941757  # fixed value of the published algorithm


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key; one step per batch of keys still under way, about ln(shards) in all."""
    keys = keys.astype(np.uint64, copy=True)
    shard = np.zeros(len(keys), np.int64)
    active = np.arange(len(keys))
    with np.errstate(over="ignore"):
        while len(active):
            keys[active] = keys[active] * np.uint64(MULTIPLIER) + np.uint64(1)
            draw = ((keys[active] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
            ahead = ((shard[active] + 1) * (float(1 << 31) / draw)).astype(np.int64)
            stays = ahead < shards
            active = active[stays]
            shard[active] = ahead[stays]
    return shard.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """Shard 0 to ``shards - 1`` of a 64-bit key column without nulls."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @F.pandas_udf("int")
    def jumped(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64).view(np.uint64), shards))

    return jumped(key)


def shard_rows(docs: DataFrame, shards: int, key: str = "doc_id") -> DataFrame:
    """All columns of ``docs`` with ``shard``, ``slot`` and ``grown_shard``.

    The shard depends on the key and the shard count alone; with one more shard (``grown_shard``) a row
    stays or moves into the new one. Rows of a shard are numbered from 0 without gaps (``slot``) in
    order of the key's hash. A null key is a key like any other; rows with equal keys share a shard and
    take neighbouring slots, ordered by their text if there is one. Columns of ``docs`` with one of the
    three names are replaced. An empty table stays empty.
    """
    docs = without(docs, "shard", "slot", "grown_shard", "_key", "_one", "_tie", "_bucket")
    tie = F.xxhash64("text") if "text" in docs.columns else F.lit(0).cast("long")
    keyed = docs.withColumn("_key", F.xxhash64(key)).withColumns(
        {"_one": F.lit(1).cast("long"), "_tie": tie, "shard": shard_of(F.col("_key"), shards)}
    )
    rows = docs.count()
    placed = running_total(keyed, ["shard"], "_key", [key, "_tie"], "_one", "slot", rows)
    return placed.withColumn("grown_shard", shard_of(F.col("_key"), shards + 1)).drop("_key", "_one", "_tie")


def write_shards(docs: DataFrame, path: str, shards: int, key: str = "doc_id") -> None:
    """Write one folder per shard; the many tasks of a shard write files of their own."""
    shard_rows(docs, shards, key).write.partitionBy("shard").parquet(path)
