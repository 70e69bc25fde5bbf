"""Documents to training sequences: operators of ``textspark.llm`` one after the other.

Every stage works on all that the one before it kept; what it returns is written and read again. Tables
that a stage has written for itself go when the next one begins, for by then its result is written.
"""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from textspark.llm import jaccard, mixing, packing, pii, quality
from textspark.session import drop_tables, materialise_at, written_here

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
KNOWN = ("doc_id", "text", "lang", "source", "n_chars")
_left: ContextVar[tuple[str, ...]] = ContextVar("left", default=())  # what the last stage of this thread wrote for itself


def stage(work: Stage) -> Stage:
    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_tables(spark, list(_left.get()))
        # Further columns travel under names that no operator uses for its own.
        safe = docs.toDF(*[c if c in KNOWN else f"extra_{i}" for i, c in enumerate(docs.columns)])
        with written_here() as written:
            out = work(spark, safe, sf_dir)
        _left.set(tuple(written))
        return out.select(*safe.columns).toDF(*docs.columns) if set(safe.columns) <= set(out.columns) else out

    return run_stage


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; a null or empty text is too short. Other columns stay as they are."""
    return quality.judged(docs).where("kept").select(*docs.columns)


@stage
def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the least id, of repeated rows one; empty texts are alone."""
    return jaccard.deduplicated(docs)


@stage
def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; a null text stays null, no row goes."""
    return pii.redacted(docs)


@stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as far, as the mix takes them; a null source is one of its own."""
    return mixing.mixed(docs).drop("mix_shard")


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids, in sequences of 4096 tokens; a null text is its end alone."""
    import public_tokenizers

    # Small caches: workers of earlier stages may still hold memory.
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), cached=1 << 16, chunk=2 << 20)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("PII", private_data),
    ("mixing sources to target weights", mix),
    ("packing", pack),
]

ORACLE_SQL = None  # model fits and token ids; tests/llm holds it against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; none of an empty table. What a stage returned goes once the next one's result is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, work in STAGES[:-1]:
        docs, path = materialise_at(work(spark, docs, sf_dir))
        drop_tables(spark, before)
        before = [path]
    pieces = STAGES[-1][1](spark, docs, sf_dir)  # reads the ids it has written, no more the documents
    drop_tables(spark, before)
    return pieces
