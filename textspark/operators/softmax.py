"""Softmax regression as relational operators.

Documents carry ``features array<struct<term_id, value>>``; weights are a table
``(term_id, w array<double>)`` with one entry per class, the bias a list of numbers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textspark.functions.numeric import argmax, doubles, hash_normal, softmax
from textspark.operators.lookup import fits, lookup
from textspark.operators.rank import global_rank
from textspark.operators.shuffle import keys, place
from textspark.operators.unnest import unnest
from textspark.session import materialise

BIAS = -1  # term id under which gradients and updates of the bias travel


def init_weights(terms: DataFrame, n_terms: int, n_classes: int) -> DataFrame:
    """Scaled normal start values per ``term_id``; the bias starts at zero."""
    scale = (2.0 / (n_terms + n_classes)) ** 0.5
    w = F.transform(
        F.sequence(F.lit(0), F.lit(n_classes - 1)),
        lambda c: hash_normal(F.concat_ws("/", F.lit("W"), F.col("term_id").cast("string"), c.cast("string")))
        * scale,
    )
    return terms.select("term_id", w.alias("w"))


IN_ROW_BYTES = 1 << 20  # weights up to here are looked up inside the row


def _gathered(weights: DataFrame, limit: int) -> list[list[float]] | None:
    """Per class the weights by term id, if ids from 0 to the largest fit the limit."""
    size = weights.agg(F.count("*").alias("n"), F.min("term_id").alias("lo"), F.max("term_id").alias("hi"), F.max(F.size("w")).alias("c")).first()
    if not size["n"] or size["lo"] < 0 or (size["hi"] + 1) * size["c"] * 8 > limit:
        return None
    columns = [[0.0] * (size["hi"] + 1) for _ in range(size["c"])]
    for r in weights.select("term_id", "w").collect():
        for c, x in enumerate(r["w"]):
            columns[c][r["term_id"]] = x
    return columns


def logits(
    docs: DataFrame, weights: DataFrame, bias: Sequence[float], key: str = "doc_id", limit: int = IN_ROW_BYTES
) -> DataFrame:
    """``(key, logits)``; a document without known features scores the bias.

    Weights of up to ``limit`` bytes are looked up inside the row of a document. Beyond it features are
    joined to them one by one, the frequent ones salted, and summed by document.
    """
    columns = _gathered(weights, limit)
    if columns is not None and all(math.isfinite(x) for column in columns for x in column):
        def summed(column: list[float], b: float) -> Column:
            # One literal for all numbers, folded to an array before execution.
            table = F.split(F.lit(",".join(map(repr, column))), ",").cast("array<double>")
            terms = F.coalesce("features", F.array().cast(docs.schema["features"].dataType))
            return F.aggregate(terms, F.lit(0.0), lambda acc, f: acc + f["value"] * F.coalesce(F.get(table, f["term_id"].cast("int")), F.lit(0.0))) + float(b)

        return docs.select(key, F.array(*[summed(column, b) for column, b in zip(columns, bias)]).alias("logits"))
    long = docs.select(key, F.inline_outer("features"))
    uses = long.where("term_id is not null").groupBy("term_id").agg(F.count("*").alias("_uses"))
    dim = weights if fits(weights) else materialise(weights.join(uses, "term_id"))
    scored = lookup(long, dim, "term_id", "left", "_uses" if "_uses" in dim.columns else None)
    sums = [
        F.coalesce(F.sum(F.col("value") * F.get("w", F.lit(c))), F.lit(0.0)) + float(b)
        for c, b in enumerate(bias)
    ]
    return scored.groupBy(key).agg(F.array(*sums).alias("logits"))


def probabilities(scored: DataFrame) -> DataFrame:
    return scored.withColumn("probs", softmax(F.col("logits")))


def predictions(scored: DataFrame, scores: str = "logits") -> DataFrame:
    return scored.withColumn("pred", argmax(F.col(scores)))


def accuracy(df: DataFrame, pred: str = "pred", truth: str = "y") -> DataFrame:
    """One row ``accuracy``; 0 for an empty input."""
    hit = (F.col(pred) == F.col(truth)).cast("double")
    return df.agg(F.coalesce(F.avg(hit), F.lit(0.0)).alias("accuracy"))


def row_loss(probs: Column, y: Column) -> Column:
    return -F.log(F.get(probs, y) + 1e-12)


def cross_entropy(
    df: DataFrame, weights: DataFrame | None = None, l2: float = 0.0, probs: str = "probs", y: str = "y"
) -> DataFrame:
    """One row ``loss``: mean cross-entropy plus ``l2 / 2`` times the squared weights, bias apart."""
    parts = df.select(row_loss(F.col(probs), F.col(y)).alias("nll"), F.lit(1).alias("n"), F.lit(0.0).alias("sq"))
    if weights is not None and l2 > 0:
        squares = F.aggregate("w", F.lit(0.0), lambda acc, x: acc + x * x)
        parts = parts.unionByName(
            weights.select(F.lit(0.0).alias("nll"), F.lit(0).alias("n"), squares.alias("sq"))
        )
    return parts.agg((F.sum("nll") / F.sum("n") + 0.5 * l2 * F.sum("sq")).alias("loss"))


def weighted_mean_loss(batches: DataFrame) -> DataFrame:
    """One row ``loss`` from ``(loss, n)`` per batch."""
    return batches.agg((F.sum(F.col("loss") * F.col("n")) / F.sum("n")).alias("loss"))


def gradient(
    docs: DataFrame, weights: DataFrame, bias: Sequence[float], l2: float = 0.0, key: str = "doc_id"
) -> DataFrame:
    """``(term_id, g array<double>)`` of the mean loss; the bias travels as ``term_id`` -1.

    Every weight has a row, also one whose feature occurs nowhere.
    """
    classes = range(len(bias))
    n = docs.count()
    scored = probabilities(logits(docs, weights, bias, key)).select(key, "probs")
    with_bias = F.concat(
        "features", F.array(F.struct(F.lit(BIAS).cast("bigint").alias("term_id"), F.lit(1.0).alias("value")))
    )
    long = docs.select(key, "y", with_bias.alias("features")).join(scored, key)
    long = unnest(long, ["y", "probs"], "features", "term_id")
    residual = [F.get("probs", F.lit(c)) - (F.col("y") == c).cast("double") for c in classes]
    sums = long.groupBy("term_id").agg(
        F.array(*[F.sum(F.col("value") * r) / n for r in residual]).alias("s")
    )
    every = weights.unionByName(_bias_row(docs, bias))
    decay = F.when(F.col("term_id") == BIAS, F.lit(0.0)).otherwise(F.lit(float(l2)))
    zero = F.array_repeat(F.lit(0.0), len(bias))
    return every.join(sums, "term_id", "left").select(
        "term_id",
        F.zip_with(F.coalesce("s", zero), "w", lambda s, w: s + decay * w).alias("g"),
    )


def _bias_row(df: DataFrame, bias: Sequence[float]) -> DataFrame:
    return df.sparkSession.range(1).select(F.lit(BIAS).cast("bigint").alias("term_id"), doubles(bias).alias("w"))


def with_bias(weights: DataFrame, bias: Sequence[float]) -> DataFrame:
    """The weights with the bias as ``term_id`` -1, the form the optimisers step."""
    return weights.unionByName(_bias_row(weights, bias))


def split_bias(params: DataFrame) -> tuple[DataFrame, list[float]]:
    """Weights and bias of a table of parameters; the bias has one number per class."""
    bias = list(params.where(F.col("term_id") == BIAS).select("w").first()["w"])
    return params.where(F.col("term_id") != BIAS).select("term_id", "w"), bias


def dealt(df: DataFrame, key: str = "doc_id") -> tuple[DataFrame, int]:
    """``df`` with ``_rank``, its place by ``key``, and the number of rows: what every epoch's order starts from."""
    ranked = materialise(global_rank(df, [key], "_rank"))
    return ranked, ranked.count()


def epoch_batches(ranked: DataFrame, n: int, batch_size: int, seed: int, epoch: int = 1) -> DataFrame:
    """``dealt`` rows with ``batch`` in place of ``_rank``: a seeded order cut into equal batches, the last one short.

    A projection: the order is a bijection of the ranks, so no epoch sorts or moves a row.
    """
    at = place(F.col("_rank"), n, keys(seed, epoch))
    return ranked.withColumn("batch", F.floor(at / batch_size)).drop("_rank")


def minibatches(df: DataFrame, batch_size: int, seed: int, epoch: int = 1, key: str = "doc_id") -> DataFrame:
    """Add ``batch``: a seeded shuffle per epoch cut into equal batches, the last one short."""
    return epoch_batches(*dealt(df, key), batch_size, seed, epoch)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
