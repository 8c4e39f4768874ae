"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import io
import os
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import finlake
from finlake.session import checkpoint_root, scratch_path

# White space as the contracts define it: space and U+0009..U+000D.
SPACE_CLASS = r"\x20\x09-\x0D"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, by way of the shared folder."""
    from pyarrow import fs
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    data, home = io.BytesIO(), os.path.dirname(os.path.abspath(finlake.__file__))
    with zipfile.ZipFile(data, "w") as z:
        for folder, _, names in os.walk(home):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                z.write(path, os.path.join("finlake", os.path.relpath(path, home)))
    uri = f"{checkpoint_root(spark)}/finlake/package-{app}.zip"
    filesystem, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    filesystem.create_dir(os.path.dirname(path), recursive=True)
    with filesystem.open_output_stream(path) as f:
        f.write(data.getvalue())
    spark.sparkContext.addPyFile(uri)
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage with files that every executor can read, so a lost
    executor costs a retried task and never the table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(col: str = "text") -> Column:
    """The text column, null as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Words of a text: maximal runs of characters that are no white space."""
    return F.array_remove(F.split(text, f"[{SPACE_CLASS}]+", -1), "")


def text_nodes(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Every text as a node of its own: (doc_id, text), and the numbers given to later texts of an id.

    Rows without an id have no node.  Where ids are not repeated, a node is its
    doc_id and there are no such numbers (None).  Of the texts that share an id
    the least keeps the id; each other one has a number above all ids, in
    (node, id, digest), so it counts as a later document.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).where("doc_id IS NOT NULL")
    repeated = base.groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return base, None
    top = base.agg(F.max("doc_id")).first()[0]
    several = base.join(repeated, "doc_id", "left_semi").groupBy("doc_id", "text").agg(F.lit(1).alias("n")).drop("n")
    least = several.groupBy("doc_id").agg(F.min("text").alias("text"))
    later = materialise(
        several.join(least.withColumnRenamed("text", "least"), "doc_id").where("text <> least")
        .select(F.col("doc_id").alias("id"), "text", F.sha2("text", 256).alias("digest"))
        .withColumn("node", F.monotonically_increasing_id() + F.lit(top + 1)), "later-texts")
    nodes = (base.join(repeated, "doc_id", "left_anti").unionByName(least)
             .unionByName(later.select(F.col("node").alias("doc_id"), "text")))
    return nodes, later.select("node", "id", "digest")


def ids_of(df: DataFrame, later: DataFrame | None, *columns: str) -> DataFrame:
    """``df`` with the doc_id of the node in each of ``columns``."""
    if later is None:
        return df
    order = df.columns
    for c in columns:
        names = later.select(F.col("node").alias("_node"), F.col("id").alias("_id"))
        df = df.join(names, F.col(c) == F.col("_node"), "left").withColumn(c, F.coalesce("_id", c)).drop("_node", "_id")
    return df.select(*order)


def rows_with_nodes(docs: DataFrame, later: DataFrame | None) -> DataFrame:
    """Every row of ``docs`` as the struct ``row``, with its ``node`` (null without an id)."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").cast("long").alias("node"))
    if later is None:
        return rows
    names = later.select(F.col("node").alias("_node"), F.col("id").alias("_id"), F.col("digest").alias("_digest"))
    same = (F.col("node") == F.col("_id")) & (F.sha2(text_of("row.text"), 256) == F.col("_digest"))
    return rows.join(names, same, "left").select("row", F.coalesce("_node", "node").alias("node"))
