"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import materialise


def _stars(links: DataFrame, larger: bool) -> DataFrame:
    """Links every neighbour of a node to the least node around it.

    ``larger``: from each node's neighbours on both sides, only those above the
    node move; otherwise each node's lower neighbours and the node itself do.
    """
    if larger:
        sides = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    moved = sides.join(least, "a")
    if larger:
        out = moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = moved.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            least.select("a", F.col("low").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, class_id`` for every node of the links ``a, b``; the class is its least node.

    Each round is written to the shared checkpoint folder; rounds end when the
    links, compared by an order-free checksum, no longer change.
    """
    def checksum(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = materialise(links.select("a", "b").where("a <> b").distinct(), "links")
    seen = None
    while (state := checksum(now)) != seen:
        seen = state
        now = materialise(_stars(_stars(now, larger=True), larger=False), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("class_id")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("class_id"))).groupBy("node").agg(
        F.min("class_id").alias("class_id"))
