"""Saved configurations, tables and fitted stages."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# Default settings of the linear and the graph pipeline.
LINEAR_DEFAULTS: dict[str, Any] = {
    "feature_method": "char_wb_tfidf",
    "ngram_range": (2, 5),
    "max_features": 12000,
    "sublinear_tf": True,
    "optimizer": "adam",
    "lr": 0.03,
    "l2": 1e-4,
    "batch_size": 16,
    "best_epoch": 80,
}
GRAPH_DEFAULTS: dict[str, Any] = {
    "embed_dim": 200,
    "num_hidden": 128,
    "num_layers": 3,
    "num_heads": 2,
    "k": 5,
    "alpha": 0.5,
    "ngram": 4,
    "max_length": 350,
}


def normalise_config(config: dict[str, Any] | None, defaults: dict[str, Any]) -> dict[str, Any]:
    """Merge over the defaults; every known key takes the type of its default."""
    merged = {**defaults, **(config or {})}
    return {k: type(defaults[k])(v) if k in defaults else v for k, v in merged.items()}


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def require(spark: SparkSession, *paths: str) -> None:
    """Raise for the first artefact that is missing, before any work starts."""
    for path in paths:
        if not exists(spark, path):
            raise FileNotFoundError(f"missing artefact, train first: {path}")


def save_json(spark: SparkSession, path: str, payload: dict[str, Any]) -> None:
    """Write one small document as a JSON text table."""
    body = json.dumps(payload, ensure_ascii=False)
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_json(spark: SparkSession, path: str) -> dict[str, Any]:
    return json.loads(spark.read.text(path).first()["value"])


def load_best_config(spark: SparkSession, path: str) -> dict[str, Any]:
    """The saved best configuration, or the defaults if there is none."""
    saved = load_json(spark, path) if exists(spark, path) else None
    return normalise_config(saved, LINEAR_DEFAULTS)


def save_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
