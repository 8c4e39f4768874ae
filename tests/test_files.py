import datetime as dt
import os

from pyspark.sql import functions as F

from finlake.session import local_path
from finlake.sources import files
from finlake.sources.audit import with_audit
from finlake.specs import TableSpec
from finlake.streaming.bronze import read_bronze, run_bronze
from tests.conftest import rows


def _write(path, name, text):
    p = local_path(path)
    os.makedirs(p, exist_ok=True)
    with open(os.path.join(p, name), "w") as f:
        f.write(text)


def test_read_evolving_binds_by_name(spark, scratch):
    _write(f"{scratch}/t", "a.csv", "id,name\n1,0012\n2,bob\n")
    _write(f"{scratch}/t", "b.csv", "id,mid,name\n3,x,carl\n4,,\"d,e\"\n")
    _write(f"{scratch}/t", "c.csv", "name,id\nzed,5\n")          # reordered
    out = files.read_evolving(spark, f"{scratch}/t", "id bigint, name string, mid string")
    assert rows(out) == [(1, "0012", None), (2, "bob", None), (3, "carl", "x"), (4, "d,e", None),
                         (5, "zed", None)]


def test_audit_columns(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),)], "data date")
    r = with_audit(df, "2024-03-05", "data", ingest_time=False, source_file=False).first()
    assert (r["_processdate"], r["_businessdate"], r["_businessmonth"]) == ("20240305", "20240229", "20240201")
    r2 = with_audit(df, "20240305", None, ingest_time=False, source_file=False).first()
    assert (r2["_businessdate"], r2["_businessmonth"]) == ("20240305", "20240301")


def test_snapshot_csv_skips_empty(spark, scratch):
    df = spark.createDataFrame([(1, "a")], "id bigint, nome string")
    assert files.write_snapshot_csv(df, scratch, "contas", "20240101_000000")
    assert files.write_snapshot_csv(df.limit(0), scratch, "contas", "20240102_000000") is None
    back = files.read_snapshot_csv(spark, scratch, "contas", "id bigint, nome string")
    assert rows(back) == [(1, "a", "20240101_000000")]


def test_schema_inference_roundtrip(spark, scratch):
    _write(f"{scratch}/inf", "a.csv", "id,valor,data,flag\n1,1.50,2024-01-02,true\n2,3.25,2024-01-03,false\n")
    s = files.infer_schema(spark, f"{scratch}/inf")
    files.save_schema(spark, s, f"{scratch}/schema")
    s2 = files.load_schema(spark, f"{scratch}/schema")
    assert s2 == s
    assert [f.dataType.simpleString() for f in s2.fields] == ["int", "double", "date", "boolean"]


def test_bronze_exactly_once_and_clean_source(spark, scratch):
    spec = TableSpec("contas", "id bigint, nome string", ("id",))
    raw, bronze, ck = f"{scratch}/raw", f"{scratch}/bronze", f"{scratch}/ck"
    _write(raw, "20240101_contas.csv", "id,nome\n1,a\n2,b\n")
    run_bronze(spark, spec, raw, bronze, ck, "2024-01-01", clean_source="archive",
               archive_dir=f"{scratch}/archive")
    assert read_bronze(spark, bronze).count() == 2
    run_bronze(spark, spec, raw, bronze, ck, "2024-01-01")       # nothing new: nothing read twice
    assert read_bronze(spark, bronze).count() == 2
    _write(raw, "20240102_contas.csv", "id,nome\n1,a2\n")
    run_bronze(spark, spec, raw, bronze, ck, "2024-01-02", clean_source="archive",
               archive_dir=f"{scratch}/archive")
    b = read_bronze(spark, bronze)
    assert b.count() == 3
    assert set(b.columns) >= {"_processdate", "_businessdate", "_businessmonth", "_ingesttime", "_sourcefile"}
    assert sorted(r[0] for r in b.select("_processdate").distinct().collect()) == ["20240101", "20240102"]
    assert b.where(F.col("_sourcefile").endswith("20240102_contas.csv")).count() == 1
