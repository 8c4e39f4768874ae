"""Ingest and streaming checks.

Each check first lets Spark *extract* files from the driver's tables (the
role of the API extract), under a fresh directory in the shared checkpoint
root, then ingests them with the operator under test and returns a batch read
of the result. Non-comparable audit columns (ingest time, source file) are
dropped before returning.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.session import scratch_path
from finlake.sources import files, views
from finlake.sources.views import Tables
from finlake.specs import MOVEMENTS_SCHEMA, SPECS_BY_NAME, TableSpec
from finlake.streaming.bronze import read_bronze, run_bronze
from finlake.streaming.scd1 import Scd1Table

RUN_DATE = "2024-01-15"
EXTRACTION_TS = "20240115_120000"
EVOLVE_OLD_SEGMENTS = ("AUTOMOBILE", "BUILDING")
EVOLVE_SCHEMA = "id bigint, nome string, segmento string, codigo string"


def _extract_movements(spark: SparkSession, sf: str, root: str, table: str) -> None:
    """Two extractions (settled, pending) of the movement feed as CSV files,
    written by one job into ``<root>/<table>/extraction_ts=<ts>``; the
    REBALANCE hint lets AQE size the files (and split a large extraction)."""
    mov = views.movements(Tables(spark, sf))
    ts = (F.when(F.col("situacao") == "efetivado", F.lit("20240110_000000"))
          .otherwise(F.lit("20240111_000000")))
    (mov.withColumn("extraction_ts", ts).hint("rebalance", "extraction_ts")
     .write.mode("overwrite").option("header", True).partitionBy("extraction_ts")
     .csv(f"{root}/{table}"))


def ingest_files(spark, sf) -> DataFrame:
    """CSV extracts -> streaming bronze (availableNow)."""
    base = scratch_path(spark, "ingest_files")
    raw, bronze, ckpt = f"{base}/raw", f"{base}/bronze", f"{base}/_checkpoint"
    _extract_movements(spark, sf, raw, "transacoes_efetivadas")
    spec = SPECS_BY_NAME["transacoes_efetivadas"]
    schema = MOVEMENTS_SCHEMA + ", extraction_ts string"
    run_bronze(spark, replace(spec, schema=schema), f"{raw}/transacoes_efetivadas", bronze, ckpt,
               RUN_DATE)
    return read_bronze(spark, bronze).drop("_rescued", "_ingesttime", "_sourcefile", "extraction_ts")


def ingest_infer(spark, sf) -> DataFrame:
    """Infer the CSV schema once, persist it, read the extract with it."""
    base = scratch_path(spark, "ingest_infer")
    raw = f"{base}/raw"
    _extract_movements(spark, sf, raw, "transacoes")
    path = f"{raw}/transacoes"
    schema = files.infer_schema(spark, path)
    files.save_schema(spark, schema, f"{base}/_schema")
    schema = files.load_schema(spark, f"{base}/_schema")
    return (spark.read.schema(schema).option("header", True).csv(path)
            .drop("extraction_ts"))


def ingest_evolve(spark, sf) -> DataFrame:
    """Account extracts in two header layouts (a column added in the middle and
    a zero-padded code), read back by column name."""
    base = scratch_path(spark, "ingest_evolve")
    c = Tables(spark, sf)("customer")
    old = c.where(F.col("c_mktsegment").isin(*EVOLVE_OLD_SEGMENTS))
    new = c.where(~F.col("c_mktsegment").isin(*EVOLVE_OLD_SEGMENTS))
    (old.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nome"))
     .write.option("header", True).csv(f"{base}/contas/extraction_ts=1"))
    (new.select(F.col("c_custkey").alias("id"),
                F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("codigo"),
                F.col("c_mktsegment").alias("segmento"), F.col("c_name").alias("nome"))
     .write.option("header", True).csv(f"{base}/contas/extraction_ts=2"))
    return files.read_evolving(spark, f"{base}/contas/*", EVOLVE_SCHEMA)


EVOLVE_STREAM = TableSpec("contas", "id bigint, nome string, saldo decimal(12,2)", ("id",))
UNREADABLE = "n/d"


def ingest_evolve_stream(spark, sf) -> DataFrame:
    """Account extracts in two header layouts through the bronze stream, one run
    after each: the second has columns added in front and in the middle, one of
    them a zero-padded code, and in both some balances are no numbers."""
    base = scratch_path(spark, "ingest_evolve_stream")
    c = Tables(spark, sf)("customer")
    saldo = (F.when(F.col("c_custkey") % 50 == 0, F.lit(UNREADABLE))
             .otherwise(F.col("c_acctbal").cast("decimal(12,2)").cast("string")).alias("saldo"))
    old = F.col("c_mktsegment").isin(*EVOLVE_OLD_SEGMENTS)
    key, name = F.col("c_custkey").alias("id"), F.col("c_name").alias("nome")
    code = F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("codigo")
    for run, (rows, columns) in enumerate([
            (c.where(old), (key, name, saldo)), (c.where(~old), (code, key, F.col("c_mktsegment").alias("segmento"), name, saldo))]):
        rows.select(*columns).write.option("header", True).csv(f"{base}/raw/extraction_ts={run}")
        run_bronze(spark, EVOLVE_STREAM, f"{base}/raw", f"{base}/bronze", f"{base}/_checkpoint", RUN_DATE)
    return read_bronze(spark, f"{base}/bronze", EVOLVE_STREAM).select(
        "id", "nome", "saldo", "codigo", "segmento", F.get_json_object("_rescued", "$.saldo").alias("saldo_lido"))


INFER_STREAM = TableSpec("pedidos", "", ("pedido",))


def ingest_infer_merge(spark, sf) -> DataFrame:
    """Order extracts through the bronze stream without a declared schema: whole
    numbers first, then amounts with cents and references with letters, so the
    types of the first run widen without its files being read again."""
    base = scratch_path(spark, "ingest_infer_merge")
    o = Tables(spark, sf)("orders")
    key, day = F.col("o_orderkey").alias("pedido"), F.to_date("o_orderdate").alias("data")
    total = F.col("o_totalprice").cast("decimal(12,2)")
    for run, (rows, total_sent, ref) in enumerate([
            (o.where("o_orderkey % 2 = 0"), F.floor(total), F.col("o_custkey").cast("string")),
            (o.where("o_orderkey % 2 <> 0"), total, F.concat(F.lit("C-"), F.col("o_custkey").cast("string")))]):
        (rows.select(key, total_sent.alias("total"), ref.alias("ref"), day)
         .write.option("header", True).csv(f"{base}/raw/extraction_ts={run}"))
        run_bronze(spark, INFER_STREAM, f"{base}/raw", f"{base}/bronze", f"{base}/_checkpoint", RUN_DATE)
    return read_bronze(spark, f"{base}/bronze").select(
        F.col("pedido").cast("bigint").alias("pedido"), F.col("total").cast("decimal(18,2)").alias("total"), "ref", "data")


def snapshot_csv_roundtrip(spark, sf) -> DataFrame:
    base = scratch_path(spark, "snapshot_csv")
    acc = Tables(spark, sf)("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nome"))
    files.write_snapshot_csv(acc, base, "contas", EXTRACTION_TS)
    files.write_snapshot_csv(acc.limit(0), base, "contas", "20240116_120000")  # empty: skipped
    return files.read_snapshot_csv(spark, base, "contas", "id bigint, nome string")


def scd1_stream(spark, sf) -> DataFrame:
    """Events land as daily Parquet files in two drops; one stream (one
    checkpoint) is triggered after each drop and processes only the new files
    into the log-structured SCD-1 table. The log is compacted between the two
    runs."""
    base = scratch_path(spark, "scd1_stream")
    src, ckpt = f"{base}/events", f"{base}/_checkpoint"
    ev = Tables(spark, sf)("events").withColumn("dia", F.to_date("ts").cast("string"))
    schema = ev.schema
    tbl = Scd1Table(f"{base}/silver", ["user_id", "event_type"], ["ts", "event_id"])

    def trigger():
        s = spark.readStream.schema(schema).parquet(src)
        tbl.run(s.drop("dia"), ckpt)

    d = F.to_date("dia")
    mid = ev.select(F.date_add(F.min(d), (F.datediff(F.max(d), F.min(d)) / 2).cast("int"))
                    .cast("string")).first()[0]  # one scalar: the drop boundary
    def drop(df, mode):  # one daily file per day; AQE splits a very large day
        df.hint("rebalance", "dia").write.mode(mode).partitionBy("dia").parquet(src)

    drop(ev.where(F.col("dia") < mid) if mid else ev, "error")
    trigger()
    tbl.compact(spark)
    if mid:
        drop(ev.where(F.col("dia") >= mid), "append")
        trigger()
    return tbl.read(spark)


QUERIES = {
    "ingest_files": ingest_files,
    "ingest_infer": ingest_infer,
    "ingest_evolve": ingest_evolve,
    "ingest_evolve_stream": ingest_evolve_stream,
    "ingest_infer_merge": ingest_infer_merge,
    "snapshot_csv_roundtrip": snapshot_csv_roundtrip,
    "scd1_stream": scd1_stream,
}
