"""Optimiser steps as projections over tables of parameters and gradients."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Optimiser constants.
MOMENTUM = 0.9
BETA1, BETA2, EPS = 0.9, 0.999, 1e-8
OPTIMIZERS = ("sgd", "adam")


def check_optimizer(name: str) -> str:
    if name not in OPTIMIZERS:
        raise ValueError(f"unknown optimizer: {name}")
    return name


def _zeros(like: str):
    return F.transform(like, lambda _: F.lit(0.0))


def start(params: DataFrame) -> DataFrame:
    """Add zero state ``v`` (velocity or second moment) and ``m`` (first moment)."""
    return params.select("term_id", "w", _zeros("w").alias("m"), _zeros("w").alias("v"))


def sgd_step(state: DataFrame, grads: DataFrame, lr: float, momentum: float = MOMENTUM) -> DataFrame:
    """``v = momentum * v - lr * g``, then ``w = w + v``."""
    moved = state.join(grads, "term_id").withColumn(
        "v", F.zip_with("v", "g", lambda v, g: momentum * v - lr * g)
    )
    return moved.select("term_id", F.zip_with("w", "v", lambda w, v: w + v).alias("w"), "m", "v")


def adam_step(state: DataFrame, grads: DataFrame, lr: float, step: int) -> DataFrame:
    """Adam with bias correction; ``step`` counts from 1."""
    moved = (
        state.join(grads, "term_id")
        .withColumn("m", F.zip_with("m", "g", lambda m, g: BETA1 * m + (1 - BETA1) * g))
        .withColumn("v", F.zip_with("v", "g", lambda v, g: BETA2 * v + (1 - BETA2) * g * g))
    )
    m_scale, v_scale = 1 - BETA1**step, 1 - BETA2**step
    shift = F.zip_with("m", "v", lambda m, v: lr * (m / m_scale) / (F.sqrt(v / v_scale) + EPS))
    return moved.select("term_id", F.zip_with("w", shift, lambda w, d: w - d).alias("w"), "m", "v")


def optimizer_step(name: str, state: DataFrame, grads: DataFrame, lr: float, step: int) -> DataFrame:
    if check_optimizer(name) == "sgd":
        return sgd_step(state, grads, lr)
    return adam_step(state, grads, lr, step)


def early_stopping(history: DataFrame, patience: int) -> DataFrame:
    """``(epoch, score, best, best_epoch, waited, stop)`` from ``(epoch, score)``.

    Only a strict improvement counts. One row per epoch, so a single window is bounded by
    the number of epochs.
    """
    past = Window.orderBy("epoch")
    before = past.rowsBetween(Window.unboundedPreceding, -1)
    so_far = past.rowsBetween(Window.unboundedPreceding, 0)
    improved = F.col("score") > F.coalesce(F.max("score").over(before), F.lit(-1.0))
    marked = history.withColumn("hit", F.when(improved, F.col("epoch")))
    return marked.select(
        "epoch",
        "score",
        F.max("score").over(so_far).alias("best"),
        F.max("hit").over(so_far).alias("best_epoch"),
        (F.col("epoch") - F.max("hit").over(so_far)).alias("waited"),
        (F.col("epoch") - F.max("hit").over(so_far) >= patience).alias("stop"),
    )
