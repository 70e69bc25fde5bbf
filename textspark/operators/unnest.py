"""Array columns to rows, with the array computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, keep: list[str], structs: Column | str, field: str) -> DataFrame:
    """``keep`` plus the fields of each struct in an array column; ``field`` is never null.

    A plain generator makes the optimiser add a non-empty test on the array below it, which
    repeats whatever computes the array, even under a shuffle. The outer form has no such test.
    """
    return df.select(*keep, F.inline_outer(structs)).where(F.col(field).isNotNull())


def unnest_values(df: DataFrame, keep: list[str], values: Column | str, name: str) -> DataFrame:
    """``keep`` plus one row per element of an array without nulls."""
    return df.select(*keep, F.explode_outer(values).alias(name)).where(F.col(name).isNotNull())
