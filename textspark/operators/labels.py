"""Label dimensions: orders, codes, checks and translations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textspark.operators.lookup import lookup
from textspark.operators.rank import global_rank
from textspark.session import materialise

SHOWN = 100  # names in an error message; the table it points to has all
PAIR = ["label_raw", "c_numerical"]


def label_index(df: DataFrame, label: str = "label_raw") -> DataFrame:
    """``(label, idx)``: distinct labels in code-point order from 0."""
    return global_rank(df.select(label).distinct(), [label], "idx")


def label_index_by_code(train: DataFrame) -> DataFrame:
    """``(label_raw, c_numerical, idx)`` of the train labels, ordered by code, then label."""
    pairs = train.select(*PAIR).distinct()
    return global_rank(pairs, ["c_numerical", "label_raw"], "idx")


def label_pairs(*splits: DataFrame) -> DataFrame:
    """Distinct (label, code) pairs over several splits."""
    pairs = splits[0].select(*PAIR)
    for other in splits[1:]:
        pairs = pairs.unionByName(other.select(*PAIR))
    return pairs.distinct()


def label_codes(train: DataFrame, dev: DataFrame) -> DataFrame:
    """Label to code by full outer join; of several codes the largest, which sorts last, wins."""
    left, right = train.select(*PAIR).distinct(), dev.select(*PAIR).distinct()
    joined = left.join(right, PAIR, "full")
    return joined.groupBy("label_raw").agg(F.max("c_numerical").alias("c_numerical"))


def labels_missing(train: DataFrame, dev: DataFrame) -> DataFrame:
    """Labels of ``dev`` that ``train`` lacks, sorted."""
    known = train.select("label_raw").distinct()
    return dev.select("label_raw").distinct().join(known, "label_raw", "left_anti").orderBy("label_raw")


def _fail_on(unknown: DataFrame, message: str) -> None:
    """Raise with the exact count, the first names and a table of all of them, sorted."""
    count = unknown.count()
    if count:
        listed = materialise(unknown.orderBy(unknown.columns[0]))
        names = [str(r[0]) for r in listed.orderBy(listed.columns[0]).limit(SHOWN).collect()]
        more = ", …" if count > SHOWN else ""
        folder = listed.inputFiles()[0].rsplit("/", 1)[0]
        raise ValueError(f"{message}{', '.join(names)}{more} ({count} in all, listed in {folder})")


def label_metadata(train: DataFrame, dev: DataFrame) -> DataFrame:
    """``(label_raw, c_numerical, idx)``; raises if ``dev`` holds labels unknown to ``train``.

    ``idx`` is the class index of a train pair and null for a pair that only ``dev`` has.
    """
    _fail_on(labels_missing(train, dev), "dev holds labels missing from train: ")
    codes = label_pairs(train, dev)
    return codes.join(label_index_by_code(train), PAIR, "left")


def encode_labels(df: DataFrame, index: DataFrame, label: str = "label_raw") -> DataFrame:
    """Add ``idx``; raises on a label that is not in the index."""
    distinct = df.select(label).distinct()
    _fail_on(distinct.join(index, label, "left_anti"), "unknown labels: ")
    return lookup(df, index.select(label, "idx"), label, "inner")


def decode_labels(df: DataFrame, index: DataFrame, label: str = "label_raw") -> DataFrame:
    """Add the label of each ``idx``."""
    return lookup(df, index.select("idx", label), "idx", "inner")
