"""Bronze ingest: new files -> rows bound by name, with audit columns, in published batches.

The stream hands over the *paths* of new files (its checkpoint records which
ones were seen); each micro-batch reads those files by layout
(``finlake.sources.layouts``), so a column added in the middle, dropped or
moved never shifts values, and writes them as one batch of a
:class:`~finlake.storage.BatchLog`.  The batch's mark holds its load time, run
date, schema, counts of rows and of rows with unreadable values, and a digest
of its files, which are listed beside it.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import os
from collections import defaultdict
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from finlake.sources.audit import run_date_key, with_audit
from finlake.sources.layouts import Registry, bind, first_lines, header_names, plain_path, read_layout
from finlake.specs import RESCUED, TableSpec
from finlake.storage import BatchLog, Files, read_notes, write_note

# A listing of files; their content is not read where only the path is asked for.
LISTING = "path string, modificationTime timestamp, length long, content binary"
FILES_PER_BATCH = 10_000     # paths that a micro-batch takes to the driver


def bronze_log(target_dir: str, spec: TableSpec | None = None) -> BatchLog:
    return BatchLog(target_dir, spec and spec.bronze_columns())


def _groups(spark: SparkSession, spec: TableSpec, files: list[str]) -> dict[tuple[str, ...], DataFrame]:
    """The files' rows by layout; a file without a header line has none."""
    if spec.fmt != "csv":
        names = spec.columns().fieldNames()
        r = spark.read.format(spec.fmt)
        if spec.fmt == "json":       # text values, bound and typed as those of other text files
            r = r.option("primitivesAsString", True)
        elif names:
            r = r.schema(spec.columns())
        df = r.load([plain_path(f) for f in files])
        return {tuple(df.columns): df}
    layouts = defaultdict(list)
    for path, line in first_lines(spark, files).items():
        if line is not None:
            layouts[header_names(line)].append(path)
    return {names: read_layout(spark, paths, names) for names, paths in layouts.items()}


def _digest(files: list[str]) -> str:
    return hashlib.sha256("\n".join(files).encode()).hexdigest()


def load_files(spark: SparkSession, spec: TableSpec, files: list[str], log: BatchLog, registry: Registry, batch: int,
               run_date, ingest_time: dt.datetime) -> None:
    """Read ``files`` and publish their rows as ``batch``."""
    groups = _groups(spark, spec, files)
    registry.take(groups)
    path = F.col("_metadata.file_path")
    rows = [bind(raw, names, registry, path) for names, raw in groups.items()]
    if rows:
        out = reduce(DataFrame.unionByName, rows)
    else:
        empty = StructType([*registry.schema().fields, StructField(RESCUED, StringType()),
                            StructField("_sourcefile", StringType())])
        out = spark.createDataFrame([], empty)
    out = with_audit(out, run_date, spec.business_date, ingest_time=False, source_file=False)
    out = out.withColumn("_ingesttime", F.lit(ingest_time).cast("timestamp"))
    out = out.select(*[c for c in out.columns if c != "_sourcefile"], "_sourcefile")
    seen = Observation()
    out = out.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(RESCUED).alias("bad_rows"))

    def facts() -> dict:
        counts = seen.get if rows else {"rows": 0, "bad_rows": 0}
        return {"run_date": run_date_key(run_date), "ingest_time": ingest_time.isoformat(), "files": _digest(files),
                "rows": counts["rows"], "bad_rows": counts["bad_rows"], "schema_version": registry.version}

    spark.createDataFrame([(f,) for f in files], "value string").coalesce(1).write.mode("overwrite").text(
        f"{log.root}/files/batch={batch}")
    log.write(out, batch, facts)


def run_bronze(spark: SparkSession, spec: TableSpec, source_dir: str, target_dir: str,
               checkpoint: str, run_date, max_files_per_trigger: int | None = None,
               clean_source: str | None = None, archive_dir: str | None = None) -> None:
    """Ingest every file not yet seen into ``target_dir`` and stop (triggered run).

    A source folder that is not there is an empty stream.  All batches of a run
    have one load time.  A batch that is handed over again (after a lost driver)
    is skipped if its mark is there, else written anew.  ``clean_source``
    (``delete`` or ``archive``) removes the files of published batches at the end.
    """
    if not Files(spark).exists(source_dir):
        return
    log = bronze_log(target_dir, spec)
    ingest_time = dt.datetime.now(dt.timezone.utc)

    def ingest(paths: DataFrame, batch: int) -> None:
        files = sorted(r["path"] for r in paths.collect())
        done = dict(log.marks(spark)).get(batch)
        if done is not None:
            if done["facts"].get("files") != _digest(files):
                raise ValueError(f"{target_dir} has a batch {batch} of other files: its checkpoint {checkpoint} was replaced")
            return
        if files:
            registry = Registry(spark, f"{checkpoint}.schema", spec.columns())
            load_files(spark, spec, files, log, registry, batch, run_date, ingest_time)

    paths = (spark.readStream.format("binaryFile").schema(LISTING).option("recursiveFileLookup", True)
             .option("maxFilesPerTrigger", max_files_per_trigger or FILES_PER_BATCH).load(source_dir).select("path"))
    q = (paths.writeStream.foreachBatch(ingest).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    if clean_source:
        purge(spark, target_dir, source_dir, clean_source, archive_dir)


def read_bronze(spark: SparkSession, target_dir: str, spec: TableSpec | None = None) -> DataFrame:
    """All published rows of a bronze table, in its newest schema; ``spec`` declares an empty one."""
    return bronze_log(target_dir, spec).read(spark)


def newest_load(spark: SparkSession, target_dir: str, spec: TableSpec) -> DataFrame:
    """Rows of the newest load: only the batches that the marks give its load time are read.

    The load time counts, not the run date: a backfill under an older run date wins.
    """
    log = bronze_log(target_dir, spec)
    times = {n: m["facts"]["ingest_time"] for n, m in log.marks(spark) if m["facts"].get("rows")}
    newest = max(times.values(), default=None)
    return log.read(spark, only=[n for n, t in times.items() if t == newest])


def purge(spark: SparkSession, target_dir: str, source_dir: str, how: str = "delete", archive_dir: str | None = None) -> int:
    """Delete (or move to ``archive_dir``) the files that published batches have taken in; returns their number.

    ``<target>/purged`` notes how far this got, so a purge that failed is taken up by the next one.
    """
    if how not in ("delete", "archive") or how == "archive" and not archive_dir:
        raise ValueError(f"purge by {how!r}: 'delete', or 'archive' with a folder")
    files, log, gone = Files(spark), bronze_log(target_dir), 0
    done = max((n for n, _ in read_notes(spark, f"{target_dir}/purged", "batch")), default=-1)
    new = [(n, m) for n, m in log.marks(spark) if n > done]
    for n, _ in new:
        for path in (r["value"] for r in spark.read.text(f"{log.root}/files/batch={n}").toLocalIterator()):
            if files.exists(path):
                if how == "archive":
                    inside = path.partition(source_dir.rstrip("/").partition(":")[2] or source_dir.rstrip("/"))[2]
                    files.move(path, f"{archive_dir}/{inside.lstrip('/') or os.path.basename(path)}")
                else:
                    files.delete(path)
                gone += 1
    if new:
        write_note(spark, f"{target_dir}/purged/batch={new[-1][0]}", {"files": gone})
    return gone
