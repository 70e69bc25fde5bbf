"""Session, durable intermediate tables and input spreading."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_local_dirs: dict[str, str] = {}
_written: list[str] = []
# What the job of this thread has written; a thread started with a copy of the context adds to the same list.
_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def local_session(app: str = "textspark", cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediates: the cluster's ``spark.checkpoint.dir``.

    Only a single-machine session without that setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="textspark-")
    return _local_dirs[app]


def materialise(
    df: DataFrame, schema: StructType | None = None, partition_by: str | None = None
) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage in a way that survives the loss of executors, fixes the outcome
    of anything that depends on physical placement, and gives Catalyst real size
    statistics for what follows. ``schema`` overrides the types on reading; filters on the
    column ``partition_by`` then read only the files that match.
    """
    return materialise_at(df, schema, partition_by)[0]


def materialise_at(
    df: DataFrame, schema: StructType | None = None, partition_by: str | None = None
) -> tuple[DataFrame, str]:
    """``materialise``, and the folder of the table."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/stage-{uuid.uuid4().hex}"
    claim(path)
    df.write.parquet(path, partitionBy=partition_by)
    return spark.read.schema(schema or df.schema).parquet(path), path


def claim(path: str) -> None:
    """Note a folder this job is about to write as an intermediate."""
    _written.append(path)
    scope = _scope.get()
    if scope is not None:
        scope.append(path)


@contextmanager
def written_here() -> Iterator[list[str]]:
    """The intermediates written inside, one job's own: drop them once nothing reads its result any more."""
    outer, own = _scope.get(), []
    token = _scope.set(own)
    try:
        yield own
    finally:
        _scope.reset(token)
        if outer is not None:
            outer.extend(own)


def drop_tables(spark: SparkSession, paths: list[str]) -> int:
    """Delete intermediates; results read from them become invalid. Empties the list."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    count = len(paths)
    while paths:
        name = paths.pop()
        with suppress(ValueError):
            _written.remove(name)
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
    return count


def drop_written(spark: SparkSession) -> int:
    """Delete all intermediates this process has written."""
    return drop_tables(spark, list(_written))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rebalance an input read in fewer pieces than there are cores.

    Text work is CPU-bound, so a small file must not pin a job to one core; an
    input with enough splits is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)
