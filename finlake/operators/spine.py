"""Calendar spines and dense panels (generators, never joins)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.functions.dates import month_key, month_start, year_end


def month_bounds(inputs) -> DataFrame:
    """One row ``(lo, hi)``: min and max over several ``(df, date_col)`` inputs.

    Each input is reduced by a partial/final ``min``/``max`` aggregate before the
    union, so no distinct and no shuffle of the facts is needed.
    """
    parts = [df.select(F.min(F.col(c).cast("date")).alias("lo"),
                       F.max(F.col(c).cast("date")).alias("hi")) for df, c in inputs]
    u = reduce(DataFrame.unionByName, parts)
    return u.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def day_spine(inputs, date_col: str = "sk_data", month_col: str = "ano_mes") -> DataFrame:
    """Daily calendar from the first day of the earliest month to 31 December
    of the latest year over all ``(df, date_col)`` inputs.

    Output ``(sk_data DATE, ano_mes 'yyyy-MM-01')``. Empty inputs give no rows.
    The generator runs on the single bounds row; its size is bounded by the
    date range (366 rows per year), not by the data.
    """
    b = month_bounds(inputs)
    days = b.select(F.explode(F.sequence(month_start("lo"), year_end("hi"),
                                         F.expr("INTERVAL 1 DAY"))).alias(date_col))
    return days.withColumn(month_col, month_key(date_col))


def month_spine(df: DataFrame, start, end, out: str = "mes") -> DataFrame:
    """Explode each row into the months from ``start`` to ``end`` (DATE columns)."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return df.withColumn(out, F.explode(F.sequence(month_start(s), month_start(e),
                                                   F.expr("INTERVAL 1 MONTH"))))


def dense_panel(dim: DataFrame, months: DataFrame, month_col: str, out: str = "mes") -> DataFrame:
    """Every ``dim`` row for every month of the (contiguous) ``months`` spine.

    The spine bounds enter as scalar subqueries and each dimension row is
    expanded by a ``sequence`` generator: the panel is produced where the
    dimension rows already are, without a cross join and without moving the
    spine. Equal to ``months x dim`` whenever the spine has no gaps, which the
    calendar guarantees by construction.
    """
    m = months.select(F.to_date(F.col(month_col)).alias("_m"))
    b = m.select(F.struct(F.min("_m").alias("lo"), F.max("_m").alias("hi"))).scalar()
    return dim.withColumn(out, F.explode(F.sequence(b.getField("lo"), b.getField("hi"),
                                                    F.expr("INTERVAL 1 MONTH"))))
