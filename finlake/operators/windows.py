"""Window operators written so no window partition grows with the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finlake.operators.cdc import null_safe_join_cond


def _l(x):
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def running_total(df: DataFrame, order: str, value: str, out: str,
                  bucket=None, partition=None) -> DataFrame:
    """Cumulative ``sum(value)`` ordered by ``order`` (ROWS frame, unbounded preceding).

    A plain ``Window.orderBy`` without partitions moves every row to one task.
    With ``bucket`` (an expression monotone in ``order``, such as the month of a
    day) the sum is computed in two levels: bucket totals and their exclusive
    prefix sum (one row per bucket), then a running sum inside each bucket plus
    that offset. Work is spread over the buckets; only the bucket totals meet in
    one place. ``order`` must be unique within ``partition`` for the result to
    be deterministic, as with the plain window.
    """
    part = _l(partition)
    if bucket is None:
        w = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.sum(value).over(w))
    b = F.col(bucket) if isinstance(bucket, str) else bucket
    keyed = df.withColumn("_bucket", b)
    totals = keyed.groupBy(*part, "_bucket").agg(F.sum(value).alias("_bt"))
    wb = Window.partitionBy(*part).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*part, "_bucket",
                            F.coalesce(F.sum("_bt").over(wb), F.lit(0)).alias("_off"))
    wi = (Window.partitionBy(*part, "_bucket").orderBy(order)
          .rowsBetween(Window.unboundedPreceding, 0))
    inner = keyed.withColumn("_in", F.sum(value).over(wi))
    o = offsets.alias("_o")
    joined = inner.alias("_i").join(o, null_safe_join_cond(inner, offsets, part + ["_bucket"]))
    return joined.select(*[F.col(f"_i.{c}") for c in df.columns],
                         (F.col("_i._in") + F.col("_o._off")).alias(out))


def trailing_sum(value, partition, order, preceding: int, following: int = -1) -> Column:
    """``sum(value)`` over the rows ``preceding`` .. ``following`` before the current one."""
    w = (Window.partitionBy(*_l(partition)).orderBy(order)
         .rowsBetween(-preceding, following))
    return F.sum(value).over(w)


def trailing_mean(value, partition, order, rows: int, divisor: int) -> Column:
    """Sum of the ``rows`` previous rows divided by ``divisor`` (double, 6 places).

    Defaults elsewhere reproduce the source behaviour where the "3-month mean"
    sums four rows and divides by three.
    """
    s = trailing_sum(value, partition, order, rows)
    return F.round(s.cast("double") / F.lit(float(divisor)), 6)


def previous_value(value, partition, order, offset: int = 1) -> Column:
    return F.lag(value, offset).over(Window.partitionBy(*_l(partition)).orderBy(order))


def partition_totals(df: DataFrame, keys, sums: dict[str, str]) -> DataFrame:
    """Attach ``sum(src)`` per ``keys`` group to every row as ``out`` columns.

    Same result as ``sum(src) over (partition by keys)`` but computed as a
    partial/final aggregate joined back NULL-safely: a group holding a third of
    the rows never has to be buffered by a single window task, and the joined
    side is only one row per group.
    """
    keys = _l(keys)
    agg = df.groupBy(*keys).agg(*[F.sum(src).alias(out) for out, src in sums.items()])
    a = agg.alias("_t")
    j = df.alias("_d").join(a, null_safe_join_cond(df, agg, keys), "left")
    return j.select(*[F.col(f"_d.{c}") for c in df.columns],
                    *[F.col(f"_t.{o}") for o in sums])
