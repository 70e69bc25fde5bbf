"""Token statistics, vocabularies and encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textspark.functions.text import counted
from textspark.operators.elements import lookup_elements
from textspark.operators.lookup import BROADCAST_BYTES
from textspark.operators.rank import global_rank
from textspark.operators.unnest import unnest, unnest_values
from textspark.session import materialise

# Reserved vocabulary entries.
PAD_TOKEN, PAD_ID = "<PAD>", 0
UNK_TOKEN, UNK_ID = "<UNK>", 1


def bag_of_terms(df: DataFrame, values: str = "tokens", key: str = "doc_id") -> DataFrame:
    """``(key, term, tf)``: term frequency per document, without a shuffle."""
    return unnest(df, [key], counted(F.col(values)), "term")


def term_stats(bag: DataFrame) -> DataFrame:
    """``(term, tf, df)`` over a corpus given as ``(doc, term, tf)``; combines map-side."""
    return bag.groupBy("term").agg(F.sum("tf").alias("tf"), F.count("*").alias("df"))


def token_freq(df: DataFrame, values: str = "tokens", key: str = "doc_id") -> DataFrame:
    """``(term, freq)`` over a corpus; no count per document is needed, so none is made."""
    return unnest_values(df, [], values, "term").groupBy("term").agg(F.count("*").alias("freq"))


def build_vocab(
    df: DataFrame, values: str = "tokens", min_freq: int = 1, key: str = "doc_id"
) -> DataFrame:
    """``(term, id, freq)``: PAD 0, UNK 1, then terms in code-point order from 2.

    Read by ``id`` the same table is the reverse map.
    """
    kept = token_freq(df, values, key).where(F.col("freq") >= min_freq)
    ranked = global_rank(kept, ["term"], "id", start=2).select("term", "id", "freq")
    reserved = df.sparkSession.createDataFrame(
        [(PAD_TOKEN, PAD_ID, 0), (UNK_TOKEN, UNK_ID, 0)], "term string, id bigint, freq bigint"
    )
    return materialise(reserved.unionByName(ranked))


def encode(
    df: DataFrame,
    vocab: DataFrame,
    values: str = "tokens",
    max_length: int | None = None,
    key: str = "doc_id",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(key, ids array<bigint>)`` in token order; unknown tokens become UNK.

    ``max_length`` keeps the first tokens only. Documents without tokens keep an empty array.
    """
    tokens = F.col(values)
    if max_length is not None:
        tokens = F.slice(tokens, 1, max_length)
    # A token that spells a reserved entry finds that entry, as in a plain map lookup.
    ids = vocab.select("term", "id", "freq")
    known = F.coalesce("id", F.lit(UNK_ID))
    return lookup_elements(df, tokens, ids, "term", known, "ids", key, "freq", limit)
