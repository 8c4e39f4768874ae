from pyspark.sql import functions as F

from finlake.operators.cdc import scd1_upsert
from finlake.streaming.scd1 import Scd1Table
from tests.conftest import SF0001, rows


def test_scd1_stream_equals_batch(spark, scratch):
    ev = spark.read.parquet(f"{SF0001}/events.parquet").withColumn("dia", F.to_date("ts").cast("string"))
    src, ck = f"{scratch}/events", f"{scratch}/ck"
    keys, seq = ["user_id", "event_type"], ["ts", "event_id"]
    tbl = Scd1Table(f"{scratch}/silver", keys, seq)
    ev.where(F.col("dia") < "2024-01-10").write.partitionBy("dia").parquet(src)

    def trigger():
        s = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 4).parquet(src)
        tbl.run(s.drop("dia"), ck)

    trigger()
    tbl.compact(spark)
    ev.where(F.col("dia") >= "2024-01-10").write.mode("append").partitionBy("dia").parquet(src)
    trigger()
    trigger()                                   # no new files: state unchanged
    batch = scd1_upsert(ev.drop("dia"), keys, seq)
    assert rows(tbl.read(spark), *batch.columns) == rows(batch)
    assert spark.read.parquet(tbl.changes).select("batch").distinct().count() >= 2


def test_scd1_stream_recovers_from_a_failed_batch(spark, scratch):
    """A batch that fails after writing part of its output is replayed from the
    checkpoint with the same id and overwrites its own change set."""
    import pytest
    ev = spark.read.parquet(f"{SF0001}/events.parquet").withColumn("dia", F.to_date("ts").cast("string"))
    src, ck = f"{scratch}/events", f"{scratch}/ck"
    keys, seq = ["user_id", "event_type"], ["ts", "event_id"]
    ev.write.partitionBy("dia").parquet(src)

    class Flaky(Scd1Table):
        failed = False

        def write_batch(self, batch, batch_id):
            super().write_batch(batch, batch_id)          # output written ...
            if batch_id == 1 and not Flaky.failed:        # ... then the batch dies
                Flaky.failed = True
                raise RuntimeError("executor lost")

    tbl = Flaky(f"{scratch}/silver", keys, seq)
    stream = lambda: spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 5).parquet(src).drop("dia")
    with pytest.raises(Exception):
        tbl.run(stream(), ck)
    tbl.run(stream(), ck)                                 # restart: batch 1 replayed
    batch = scd1_upsert(ev.drop("dia"), keys, seq)
    assert rows(tbl.read(spark), *batch.columns) == rows(batch)


def test_scd1_state_read_prunes_by_month(spark, scratch):
    """A month filter on the SCD-1 state reaches both Parquet scans (base and
    change log) below the upsert aggregate."""
    import contextlib
    import io
    df = spark.range(200).select(
        F.col("id"), (F.col("id") % 5).cast("int").alias("tipo"),
        F.concat(F.lit("1998"), F.lpad(((F.col("id") % 12) + 1).cast("string"), 2, "0"), F.lit("01"))
        .alias("_businessmonth"), F.col("id").alias("seq"))
    t = Scd1Table(f"{scratch}/s", ["id", "tipo", "_businessmonth"], ["seq"], cluster_by="_businessmonth")
    t.write_batch(df, 0)
    t.compact(spark)
    t.write_batch(df, 1)
    out = t.read(spark, where=F.col("_businessmonth").isin("19980301", "19980401"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain("formatted")
    pushed = [ln for ln in buf.getvalue().splitlines() if ln.startswith("PushedFilters") and "_businessmonth" in ln]
    assert len(pushed) == 2
    assert out.count() == df.where(F.col("_businessmonth").isin("19980301", "19980401")).count()
