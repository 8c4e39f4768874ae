"""File sources and sinks: snapshot CSV extracts, schema inference, by-name
schema evolution, and the incremental (streaming) file source.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

from finlake.storage import Files


def as_struct(schema) -> StructType:
    if isinstance(schema, StructType):
        return schema
    return _parse_datatype_string(schema)


# --- snapshot extract sink (A11, A12) --------------------------------------------------

def write_snapshot_csv(df: DataFrame, root: str, table: str, extraction_ts: str) -> str | None:
    """Write one extraction of ``table`` under ``<root>/<table>/extraction_ts=<ts>``.

    Header row, no index; an empty extract leaves nothing (returns None) so the
    previous snapshot stays the latest one. The rows are counted by the write
    itself. Re-running the same extraction overwrites only its own directory.
    """
    path, seen = f"{root.rstrip('/')}/{table}/extraction_ts={extraction_ts}", Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("header", True).csv(path)
    if seen.get["rows"]:
        return path
    Files(df.sparkSession).delete(path)
    return None


def write_feeds_csv(df: DataFrame, root: str, feed: str, names, extraction_ts: str) -> dict[str, str | None]:
    """Write one extraction of several tables, told apart by the column ``feed``, in one pass.

    One write partitioned by ``feed`` goes to a staging folder; then the folder
    of every table in ``names`` that has rows, by the counts that the write
    itself observed, takes its place under ``<root>/<table>/extraction_ts=<ts>``.
    """
    spark, names = df.sparkSession, list(names)
    stage, seen, files = f"{root.rstrip('/')}/_stage/{extraction_ts}", Observation(), Files(df.sparkSession)
    counts = [F.count_if(F.col(feed) == n).alias(n) for n in names]
    (df.where(F.col(feed).isin(names)).observe(seen, *counts).write.mode("overwrite").option("header", True)
     .partitionBy(feed).csv(stage))
    out: dict[str, str | None] = {}
    for name in names:
        path = f"{root.rstrip('/')}/{name}/extraction_ts={extraction_ts}"
        files.delete(path)
        out[name] = path if seen.get[name] else None
        if out[name]:
            files.rename(f"{stage}/{feed}={name}", path)
    Files(spark).delete(stage)
    return out


def read_snapshot_csv(spark: SparkSession, root: str, table: str, schema) -> DataFrame:
    """All extractions of ``table``; ``extraction_ts`` comes from the directory."""
    s = as_struct(schema)
    if "extraction_ts" not in s.fieldNames():
        s = StructType(s.fields + [StructField("extraction_ts", StringType())])
    return spark.read.schema(s).option("header", True).csv(f"{root.rstrip('/')}/{table}")


# --- schema inference (A2) ---------------------------------------------------------

def infer_schema(spark: SparkSession, path: str, fmt: str = "csv", sampling_ratio: float = 1.0,
                 options: dict | None = None) -> StructType:
    """Infer column types once from (a sample of) the files at ``path``.

    The result is meant to be persisted (:func:`save_schema`) and handed to the
    stream, which cannot infer on its own.
    """
    r = spark.read.format(fmt).option("header", True).option("inferSchema", True)
    r = r.option("samplingRatio", sampling_ratio)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path).schema


def save_schema(spark: SparkSession, schema: StructType, path: str) -> None:
    spark.createDataFrame([(schema.json(),)], "schema string").coalesce(1) \
        .write.mode("overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> StructType:
    row = spark.read.text(path).first()
    return StructType.fromJson(json.loads(row[0]))


# --- by-name schema evolution (A3) -----------------------------------------------------

def header_width(spark: SparkSession, path: str, sep: str = ",") -> int:
    """Greatest number of columns that the first line of any file at ``path`` can have."""
    lines = spark.read.text(path).select(
        F.col("value"), F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
        F.monotonically_increasing_id().alias("r"))
    first = lines.where(F.col("b") == 0).groupBy("f").agg(F.min_by("value", "r").alias("line"))
    parts = F.length("line") - F.length(F.replace(F.col("line"), F.lit(sep), F.lit("")))
    return int(first.agg(F.max(parts / F.lit(len(sep)))).first()[0] or 0) + 1


def read_evolving(spark: SparkSession, path: str, schema, width: int | None = None,
                  strict: bool = False, options: dict | None = None) -> DataFrame:
    """Read CSV files whose headers differ (added, dropped or reordered columns)
    and bind every value **by column name** to ``schema``.

    Plain Spark CSV binds by position using the first file's header, which is
    silently wrong once a column is added in the middle. Here every file is
    read positionally as text; its header is its first line (the first row of
    the split that starts at byte 0), collected per file as a name array and
    joined back on the file path, one row per file. Values are then looked up
    by name: columns missing from older files come back NULL, text such as
    ``0012`` stays text, and types are applied with ``try_cast`` (``strict``
    uses ``cast`` and fails on bad values).

    ``width`` is the greatest number of columns of any file; without it, it is
    measured by one pass over the lines (a single number). A header that is
    wider than a given ``width`` fails the read instead of losing columns.
    """
    target = as_struct(schema)
    sep = (options or {}).get("sep") or (options or {}).get("delimiter") or ","
    width = (width or header_width(spark, path, sep)) + 1   # one more, to see a wider header
    raw_schema = StructType([StructField(f"_c{i}", StringType()) for i in range(width)])
    r = spark.read.schema(raw_schema).option("header", False)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    vals = F.array(*[F.col(f"_c{i}") for i in range(width)])
    raw = (r.csv(path)
           .select(vals.alias("_v"), F.col("_metadata.file_path").alias("_f"),
                   F.col("_metadata.file_block_start").alias("_b"),
                   F.monotonically_increasing_id().alias("_r")))
    heads = (raw.where(F.col("_b") == 0).groupBy("_f")
             .agg(F.min_by("_v", "_r").alias("_h"), F.min("_r").alias("_hr")))
    too_wide = F.raise_error(F.concat(F.lit("header wider than width in "), F.col("_f")))
    heads = heads.withColumn("_h", F.when(F.get("_h", F.lit(width - 1)).isNotNull(), too_wide.cast("array<string>"))
                             .otherwise(F.col("_h")))
    j = raw.join(heads, "_f").where(F.col("_r") != F.col("_hr"))
    entries = F.filter(F.arrays_zip(F.col("_h").alias("k"), F.col("_v").alias("v")),
                       lambda e: e["k"].isNotNull())
    m = F.map_from_entries(entries)
    out = []
    for f in target.fields:
        v = F.try_element_at(m, F.lit(f.name))
        out.append((v.cast(f.dataType) if strict else v.try_cast(f.dataType)).alias(f.name))
    return j.select(*out)


# --- incremental file source (A1, A4, A13) -----------------------------------------------

def stream_files(spark: SparkSession, path: str, schema, fmt: str = "csv",
                 max_files_per_trigger: int | None = None, clean_source: str | None = None,
                 archive_dir: str | None = None, options: dict | None = None) -> DataFrame:
    """Streaming read of every new file under ``path`` exactly once.

    ``schema`` is explicit (inferred once with :func:`infer_schema` if
    needed). ``clean_source`` = ``archive`` / ``delete`` removes files of
    committed batches (the purge step), ``archive_dir`` receives archived files.
    """
    r = spark.readStream.format(fmt).schema(as_struct(schema))
    if fmt == "csv":
        r = r.option("header", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if clean_source:
        r = r.option("cleanSource", clean_source)
        if archive_dir:
            r = r.option("sourceArchiveDir", archive_dir)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path)
