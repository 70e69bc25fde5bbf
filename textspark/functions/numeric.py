"""Activations, array algebra and portable pseudo-random numbers as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

from textspark.functions.text import let


def relu(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0))


def elu(x: Column) -> Column:
    return F.when(x > 0, x).otherwise(F.exp(x) - 1)


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x)


def dot(xs: Column, ys: Column) -> Column:
    return total(F.zip_with(xs, ys, lambda x, y: x * y))


def softmax(logits: Column) -> Column:
    """Numerically stable softmax of an array of scores."""

    def scaled(z: Column) -> Column:
        top = let(F.array_max(z), lambda m: F.transform(z, lambda x: F.exp(x - m)))
        return let(top, lambda e: let(total(e), lambda s: F.transform(e, lambda x: x / s)))

    return let(logits, scaled)


def argmax(scores: Column) -> Column:
    """Index of the largest score; the lowest index wins a tie."""
    return let(scores, lambda z: F.array_position(z, F.array_max(z)).cast("int") - 1)


def doubles(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values]).cast("array<double>")


def _uniform(digest: Column, part: int) -> Column:
    """Uniform in (0, 1) from eight of the hex digits of a digest."""
    digits = F.substring(digest, 1 + 8 * part, 8)
    return (F.conv(digits, 16, 10).cast("double") + 1) / F.lit(4294967297.0)


def hash_normal(key: Column) -> Column:
    """Standard normal by Box-Muller over two parts of one md5, equal in every engine."""
    return let(
        F.md5(key), lambda h: F.sqrt(-2 * F.log(_uniform(h, 0))) * F.cos(2 * pi * _uniform(h, 1))
    )
