"""Conditional sums and manual pivots (one pass, partial aggregation)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conditional_sums(df: DataFrame, keys, measures: dict[str, tuple[Column, Column]]) -> DataFrame:
    """``sum(when(cond, value))`` per measure; NULL when no row of the group matches."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(*[F.sum(F.when(cond, val)).alias(name)
                                   for name, (cond, val) in measures.items()])


def pivot_sums(df: DataFrame, keys, pivot: str, value: str, columns: dict[str, str]) -> DataFrame:
    """Pivot ``value`` by ``pivot`` into fixed ``columns`` {out_name: pivot_value}; missing -> 0."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(*[
        F.sum(F.when(F.col(pivot) == F.lit(v), F.col(value)).otherwise(F.lit(0))).alias(name)
        for name, v in columns.items()])
