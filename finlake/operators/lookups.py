"""Dimension lookups: a declared list of joins that add columns to a fact."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Lookup:
    """Match ``fact_key`` with the dimension's ``dim_key`` and take ``take`` (output name -> dimension column).

    ``kind`` is ``left``, or ``inner`` to drop facts without a match.
    """
    dimension: str
    fact_key: str
    take: dict = field(default_factory=dict)
    kind: str = "left"
    dim_key: str = "id"


def add_lookups(facts: DataFrame, dimensions: dict[str, DataFrame], lookups) -> DataFrame:
    """``facts`` with the columns of every lookup; join strategy and order are Spark's choice.

    Only the key and the taken columns of a dimension enter the join, under
    names of their own, so equal column names on both sides don't matter.
    """
    out = facts
    for n, look in enumerate(lookups):
        key = f"_key{n}"
        dim = dimensions[look.dimension].select(
            F.col(look.dim_key).alias(key), *[F.col(c).alias(f"_{n}_{name}") for name, c in look.take.items()])
        out = out.join(dim, out[look.fact_key] == dim[key], look.kind).drop(key)
    taken = {f"_{n}_{name}": name for n, look in enumerate(lookups) for name in look.take}
    return out.withColumnsRenamed(taken)
