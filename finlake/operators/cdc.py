"""Change-data operators: SCD-1 upsert, latest snapshot, snapshot diff/apply.

All of them are plain aggregations and joins, so they run the same on a
DataFrame read from a table, inside ``foreachBatch`` or over a union of a
stored state and a new batch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPS = ("insert", "update", "delete", "same")
BUCKETS = 4096      # key buckets whose digests are compared; as many small rows are broadcast


def _as_list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def scd1_upsert(df: DataFrame, keys, sequence_by, tiebreak=None) -> DataFrame:
    """Keep, per natural key, the row with the greatest sequence (SCD type 1).

    * ``keys``: natural key columns; NULL is a key value like any other.
    * ``sequence_by``: one or more ordering columns; a row with an older
      sequence that arrives later loses, so the result does not depend on
      arrival order.
    * ``tiebreak``: extra ordering columns for equal sequences; a hash of the
      row's values, then of the whole row with its audit columns (``_...``), is
      always appended so ties resolve the same way on every run and wherever
      the row came from.

    ``max_by`` is an aggregate with a partial (map-side) phase: a key holding a
    third of all rows is reduced to one row per input partition before the
    shuffle, never gathered into one task.
    """
    keys, seq, tie = _as_list(keys), _as_list(sequence_by), _as_list(tiebreak)
    cols = df.columns
    values = [c for c in cols if not c.startswith("_")] or cols
    order = F.struct(*[F.col(c) for c in seq + tie],
                     F.xxhash64(*[F.col(c) for c in values]).alias("_valuehash"),
                     F.xxhash64(*[F.col(c) for c in cols]).alias("_rowhash"))
    winner = F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("_w")
    return df.groupBy(*[F.col(k) for k in keys]).agg(winner).select(
        *[F.col(f"_w.{c}").alias(c) for c in cols])


def latest_snapshot(df: DataFrame, load_col) -> DataFrame:
    """Rows of the newest load: ``load_col`` equal to its maximum over the whole table.

    ``load_col`` may be a column name or an expression (for example the
    extraction timestamp parsed from the file name). The maximum is a scalar
    subquery, so the plan stays lazy and nothing passes through the driver; an
    empty input gives an empty result. Partitions say nothing about loads: a
    backfill writes an older partition later.
    """
    load = F.col(load_col) if isinstance(load_col, str) else load_col
    newest = df.select(F.max(load)).scalar()
    return df.where(load == newest)


def null_safe_join_cond(left: DataFrame, right: DataFrame, keys, right_keys=None) -> Column:
    right_keys = _as_list(right_keys) or _as_list(keys)
    return reduce(lambda a, b: a & b,
                  [left[k].eqNullSafe(right[r]) for k, r in zip(_as_list(keys), right_keys)])


def key_bucket(keys, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets))


def bucket_digests(df: DataFrame, keys, values, buckets: int) -> DataFrame:
    """A digest of the rows of every key bucket that doesn't depend on their order.

    Count, exact sum and exclusive or of two independent 64-bit hashes of each
    row: one aggregate with a partial phase, no row is shuffled.
    """
    cols = [F.col(c) for c in [*keys, *values]]
    nulls = F.array(*[c.isNull() for c in cols])        # the hash skips nulls
    one, two = F.xxhash64(nulls, *cols), F.xxhash64(F.lit("digest"), *reversed(cols), nulls)
    wide = lambda c: F.sum(c.cast("decimal(20,0)"))
    return df.groupBy(key_bucket(keys, buckets).alias("_bucket")).agg(
        F.struct(F.count(F.lit(1)), wide(one), wide(two), F.bit_xor(one), F.bit_xor(two)).alias("_digest"))


def changed_buckets(current: DataFrame, new: DataFrame, keys, values, buckets: int) -> DataFrame:
    """Key buckets whose digests differ, at most ``buckets`` rows."""
    c = bucket_digests(current, keys, values, buckets).withColumnRenamed("_digest", "_cur")
    n = bucket_digests(new, keys, values, buckets).withColumnRenamed("_digest", "_new")
    return c.join(n, "_bucket", "full_outer").where(~F.col("_cur").eqNullSafe(F.col("_new"))).select("_bucket")


def _once(df: DataFrame, keys, name: str) -> DataFrame:
    """One row per key with the value struct ``name``; a repeated key is an error that names it."""
    shown = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("NULL"))) for k in keys])
    repeated = F.raise_error(F.concat(F.lit("a snapshot repeats the key "), shown))
    value = F.when(F.col("_n") > 1, repeated.cast(df.schema[name].dataType)).otherwise(F.col(name)).alias(name)
    return (df.groupBy(*keys).agg(F.any_value(name).alias(name), F.count(F.lit(1)).alias("_n")).select(*keys, value))


def snapshot_diff(current: DataFrame, new: DataFrame, keys, values=None,
                  op_col: str = "_op", buckets: int = BUCKETS, several: bool = False) -> DataFrame:
    """Compare two full snapshots keyed by ``keys`` (NULL-safe).

    Returns one row per key present in either side with ``op_col`` in
    ``insert`` / ``update`` / ``delete`` / ``same`` and the value columns of
    the after-image (the before-image for deletes).

    Both sides are first reduced to one digest per key bucket.  Rows of buckets
    with equal digests are the same; only the others are shuffled by key and
    joined (a full outer sort-merge join).  A key that one side repeats is an
    error that names it; with ``several`` such rows are compared one by one, in
    the order of their values, and the result has one row for each.
    """
    keys = _as_list(keys)
    values = _as_list(values) or [c for c in new.columns if c not in keys]
    on, copy = list(keys), []
    if several:
        on = [*keys, "_copy"]
        copy = [F.row_number().over(Window.partitionBy(*keys).orderBy(*(values or keys))).alias("_copy")]
    changed = F.broadcast(changed_buckets(current, new, keys, values, buckets))

    def side(df: DataFrame, name: str, how: str, more=()) -> DataFrame:
        near = df.withColumn("_bucket", key_bucket(keys, buckets)).join(changed, "_bucket", how)
        return near.select(*keys, *more, F.struct(*[F.col(v) for v in values]).alias(name))

    c = _once(side(current, "_cur", "left_semi", copy), on, "_cur")
    n = _once(side(new, "_new", "left_semi", copy), on, "_new")
    c = c.select(*[F.col(k).alias(f"_ck_{k}") for k in on], "_cur")
    n = n.select(*[F.col(k).alias(f"_nk_{k}") for k in on], "_new")
    cond = reduce(lambda a, b: a & b, [c[f"_ck_{k}"].eqNullSafe(n[f"_nk_{k}"]) for k in on])
    j = c.join(n, cond, "full_outer")
    op = (F.when(F.col("_cur").isNull(), F.lit("insert"))
          .when(F.col("_new").isNull(), F.lit("delete"))
          .when(F.col("_cur").eqNullSafe(F.col("_new")), F.lit("same"))
          .otherwise(F.lit("update")))
    after = F.when(F.col("_new").isNull(), F.col("_cur")).otherwise(F.col("_new"))
    joined = j.select(
        *[F.when(F.col("_new").isNull(), F.col(f"_ck_{k}")).otherwise(F.col(f"_nk_{k}")).alias(k)
          for k in keys],
        op.alias(op_col),
        after.alias("_after"),
    )
    untouched = side(new, "_after", "left_anti").select(*keys, F.lit("same").alias(op_col), "_after")
    return joined.unionByName(untouched).select(*keys, op_col, *[F.col(f"_after.{v}").alias(v) for v in values])


def snapshot_apply(current: DataFrame, new: DataFrame, keys, values=None) -> DataFrame:
    """State of an SCD-1 target after applying snapshot ``new``.

    Inserts and updates take the new values, unchanged keys stay, keys absent
    from ``new`` are deleted. The resulting state equals ``new``; the operator
    exists so the write path can persist the same diff as a change feed.
    """
    d = snapshot_diff(current, new, keys, values)
    return d.where(F.col("_op") != "delete").drop("_op")
