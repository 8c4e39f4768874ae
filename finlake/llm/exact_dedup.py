"""Exact de-duplication by a distributed content sort.

Normalised texts (white space removed) are range-partitioned with sampled
splitters and sorted externally, so that equal texts become neighbours; a row
starts a new run exactly when its whole normalised text differs from its
neighbour's.  Only built-in functions run.

* The partitioning key is (first characters, digest, salt): content order with
  splitters of bounded size.  The digest never decides equality, it only
  spreads texts that begin alike; the neighbour comparison is on whole texts.
* A digest that holds more than ``SALT_ROWS`` rows, or more than one thousandth
  of all rows, is dealt over salts, one for every ``SALT_ROWS`` rows and
  ``SALTS`` at least, so no task takes in much more than that of one text.
  Each salt is compared on its own and only the runs' heads, one or few per
  salt, are compared across salts, again on whole texts.

Defined results: null text counts as empty; null ``doc_id`` sorts after every
id; of repeated rows (same id and text) exactly one is kept; an empty table
gives an empty result; other columns, whatever their names, do not matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from finlake.llm.common import SPACE_CLASS, materialise, text_of

SALTS = 64
SALT_ROWS = 100_000       # hot: more rows than this,
HOT_SHARE = 1000          # or more than 1/1000 of all rows
HEAD_CHARS = 16           # leading characters of a splitter


def mark_duplicates(docs: DataFrame, carry: bool = False) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep_id`` is the row of the group with the most code points in its
    original text, then the smallest ``doc_id``.  With ``carry`` the input row
    comes along as the struct ``row``.
    """
    base = docs.select(
        F.col("doc_id"), F.length(text_of()).alias("n_cp"),
        F.regexp_replace(text_of(), f"[{SPACE_CLASS}]+", "").alias("norm"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []),
    ).withColumn("digest", F.sha2("norm", 256))

    total = docs.count()
    counts = base.groupBy("digest").count()
    # a table of written, known size: broadcast by the planner while it is small, else joined
    hot = materialise(counts.where((F.col("count") * HOT_SHARE > total) | (F.col("count") > SALT_ROWS)).select(
        "digest", F.greatest(F.lit(SALTS), F.ceil(F.col("count") / SALT_ROWS)).cast("long").alias("salts")), "hot-texts")
    salt = F.pmod(F.xxhash64("doc_id", "n_cp"), F.col("salts")).cast("int")
    keyed = (base.join(hot, "digest", "left").withColumn("salt", F.coalesce(salt, F.lit(-1))).drop("salts")
             .withColumn("head", F.substring("norm", 1, HEAD_CHARS)))

    key = ["head", "digest", "salt"]
    order = [F.col("n_cp").desc(), F.col("doc_id").asc_nulls_last()]
    near = W.partitionBy(*key).orderBy("norm", *order)
    starts = F.coalesce(F.lag("norm").over(near) != F.col("norm"), F.lit(True))
    runs = (keyed.repartitionByRange(*key)
            .withColumn("starts", starts)
            .withColumn("run", F.sum(F.col("starts").cast("int")).over(near))
            # the text travels on only with the heads that meet their like from other salts
            .withColumn("norm", F.when((F.col("salt") >= 0) & F.col("starts"), F.col("norm"))))
    run = W.partitionBy(*key, "run")
    local = materialise(
        runs.select("doc_id", "n_cp", "digest", "salt", "run", "starts", "norm",
                    F.first("doc_id").over(run.orderBy(*order)).alias("keep_id"),
                    F.count(F.lit(1)).over(run).alias("group_size"),
                    *(["row"] if carry else [])), "content-sort")

    same = W.partitionBy("digest", "norm")
    best = same.orderBy(*order)
    merged = (local.where((F.col("salt") >= 0) & F.col("starts"))
              .select("digest", "salt", "run", F.first("doc_id").over(best).alias("all_keep"),
                      F.sum("group_size").over(same).alias("all_size"),
                      (F.row_number().over(best) == 1).alias("wins")))
    merged = materialise(merged, "hot-runs")
    cold = local.where("salt < 0").select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), F.col("starts").alias("kept"),
        F.col("digest").alias("text_sha256"), *(["row"] if carry else []))
    return cold.unionByName(local.where("salt >= 0").join(merged, ["digest", "salt", "run"]).select(
        "doc_id", F.col("all_keep").alias("keep_id"), F.col("all_size").cast("long").alias("group_size"),
        (F.col("starts") & F.col("wins")).alias("kept"), F.col("digest").alias("text_sha256"),
        *(["row"] if carry else [])))


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns unchanged."""
    return mark_duplicates(docs, carry=True).where("kept").select("row.*")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       CAST(count(*) OVER (PARTITION BY norm) AS BIGINT) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(norm) AS text_sha256
FROM d
WINDOW w AS (PARTITION BY norm ORDER BY length(text) DESC, doc_id)
"""
