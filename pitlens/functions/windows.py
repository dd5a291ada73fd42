"""Window shapes and null-safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def ordered(keys: list[str], order: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_last())


def trailing(keys: list[str], order: str, n: int) -> WindowSpec:
    """The current row and the n - 1 before it."""
    return ordered(keys, order).rowsBetween(-(n - 1), 0)


def warm(row_number: Column, n: int, value: Column) -> Column:
    """`value` from the n-th row on, null before."""
    return F.when(row_number >= n, value)


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0 or null."""
    return a / F.nullif(b, F.lit(0.0))


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key, the first in `order`; ties beyond it are broken by all columns, so the choice never depends on row order."""
    ties = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *ties)))
    return ranked.where("_rank = 1").drop("_rank")
