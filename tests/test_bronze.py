"""Bronze ingest by name: layouts, growing schemas, merged types, rescued values, missing sources, purge."""

import datetime as dt
import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from finlake.session import local_path
from finlake.sources import layouts
from finlake.specs import SPECS_BY_NAME, TableSpec
from finlake.storage import BatchLog
from finlake.streaming import bronze
from finlake.streaming.bronze import newest_load, purge, read_bronze, run_bronze
from finlake.streaming.scd1 import Scd1Table

SPEC = TableSpec("contas", "id bigint, nome string", ("id",))


def put(root, name, text):
    path = os.path.join(local_path(root), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def ingest(spark, scratch, spec=SPEC, day="2024-01-01", **more):
    run_bronze(spark, spec, f"{scratch}/raw", f"{scratch}/bronze", f"{scratch}/ck", day, **more)
    return read_bronze(spark, f"{scratch}/bronze", spec)


def values(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def facts(spark, scratch):
    return [m["facts"] for _, m in BatchLog(f"{scratch}/bronze").marks(spark)]


def test_columns_bind_by_name_across_runs(spark, scratch):
    put(f"{scratch}/raw", "1.csv", "id,nome\n1,0012\n2,bob\n")
    got = ingest(spark, scratch)
    assert values(got, "id", "nome") == [(1, "0012"), (2, "bob")]
    put(f"{scratch}/raw", "2.csv", "id,saldo,nome\n3,99,carl\n")           # added in the middle
    put(f"{scratch}/raw", "3.csv", "NOME,id\nzed,4\n")                     # reordered, other case, dropped
    got = ingest(spark, scratch, day="2024-01-02")
    assert values(got, "id", "nome", "saldo") == [(1, "0012", None), (2, "bob", None), (3, "carl", 99), (4, "zed", None)]
    assert dict(got.dtypes)["saldo"] == "int" and got.where("_rescued IS NOT NULL").isEmpty()
    registry = layouts.Registry(spark, f"{scratch}/ck.schema", SPEC.columns())
    assert sorted(registry.layouts) == [["NOME", "id"], ["id", "nome"], ["id", "saldo", "nome"]]
    assert ingest(spark, scratch).count() == 4 and len(facts(spark, scratch)) == 2     # nothing new, nothing written


def test_values_that_do_not_fit_are_kept_as_text(spark, scratch):
    spec = TableSpec("t", "id bigint, valor decimal(18,2), data date", ("id",), business_date="data")
    put(f"{scratch}/raw", "1.csv", "id,valor,data\n1,2.50,2024-02-03\n2,n/d,2024-02-04\nx,1,03/02/2024\n4,,\n5\n6,1,2024-01-01,more\n")
    got = {(r.id, r.valor): (r.data, r._rescued) for r in ingest(spark, scratch, spec).collect()}
    assert got[1, D("2.50")] == (dt.date(2024, 2, 3), None)
    assert got[2, None] == (dt.date(2024, 2, 4), '{"valor":"n/d"}')
    assert got[None, D("1.00")] == (None, '{"id":"x","data":"03/02/2024"}')
    assert got[4, None] == (None, None)
    assert got[5, None] == (None, '{"_line":"5"}') and got[6, D("1.00")][1] == '{"_line":"6,1,2024-01-01,more"}'
    assert [(f["rows"], f["bad_rows"]) for f in facts(spark, scratch)] == [(6, 4)]


def test_types_widen_from_new_files_only(spark, scratch, monkeypatch):
    spec = TableSpec("t", "", ("id",))
    read = []
    real = layouts.read_layout
    monkeypatch.setattr(bronze, "read_layout", lambda s, files, *a: read.append(len(files)) or real(s, files, *a))
    put(f"{scratch}/raw", "1.csv", "id,qty,code,day,flag,none\n1,7,12,2024-01-02,true,\n")
    types = dict(ingest(spark, scratch, spec).dtypes)
    assert [types[c] for c in ("id", "qty", "code", "day", "flag", "none")] == ["int", "int", "int", "date", "boolean", "string"]
    put(f"{scratch}/raw", "2.csv", "id,qty,code,day,flag,none\n3000000000,0.25,0013,2024-01-02 10:00:00,false,5\n")
    got = ingest(spark, scratch, spec)
    types = dict(got.dtypes)
    assert [types[c] for c in ("id", "qty", "code", "day", "flag", "none")] == [
        "bigint", "decimal(3,2)", "string", "timestamp", "boolean", "int"]
    put(f"{scratch}/raw", "3.csv", "id,qty,code,day,flag,none\n4,many,C,never,maybe,1e300\n")
    got = ingest(spark, scratch, spec)
    assert [dict(got.dtypes)[c] for c in ("qty", "day", "flag", "none")] == ["string", "string", "string", "double"]
    assert values(got, "id", "qty", "code", "flag", "none") == sorted([
        (1, "7", "12", "true", None), (3000000000, "0.25", "0013", "false", 5.0), (4, "many", "C", "maybe", 1e300)], key=repr)
    assert read == [1, 1, 1]


def test_merged_summaries_equal_those_of_all_values(spark):
    texts = ["1", "-20", "0.5", "007", "true", "2024-01-01", "2024-01-01 00:00:01", "1e5", "", "x", "+3", "12345678901"]
    for a in range(len(texts)):
        for b in range(a, len(texts)):
            one, two, both = (layouts.summarise(spark.createDataFrame([(t or None,) for t in ts], "v string"), ["v"])["v"]
                              for ts in (texts[a:a + 1], texts[b:b + 1], [texts[a], texts[b]])) if b < a + 3 else (None,) * 3
            if one:
                assert layouts.merge(one, two) == both
    kinds = {t: layouts.type_of(layouts.summarise(spark.createDataFrame([(t,)], "v string"), ["v"])["v"]) for t in texts if t}
    assert kinds == {"1": "int", "-20": "int", "0.5": "decimal(2,1)", "007": "string", "true": "boolean", "2024-01-01": "date",
                     "2024-01-01 00:00:01": "timestamp", "1e5": "double", "x": "string", "+3": "int", "12345678901": "bigint"}


def test_repeated_header_names_are_an_error(spark, scratch):
    put(f"{scratch}/raw", "1.csv", "id,nome,ID\n1,a,2\n")
    with pytest.raises(Exception, match="header repeats"):
        ingest(spark, scratch)


def test_missing_folder_and_empty_files(spark, scratch):
    got = ingest(spark, scratch)                       # no folder
    assert got.columns[:2] == ["id", "nome"] and got.count() == 0
    put(f"{scratch}/raw", "1.csv", "")
    put(f"{scratch}/raw", "2.csv", "id,nome\n")
    assert ingest(spark, scratch).count() == 0
    assert Scd1Table(f"{scratch}/s", ["id"], ["id"], schema=SPEC.bronze_columns()).read(spark).count() == 0
    assert newest_load(spark, f"{scratch}/none", SPEC).columns == [f.name for f in SPEC.bronze_columns()]


def test_awkward_file_names_and_quotes(spark, scratch):
    put(f"{scratch}/raw", "a[1] {x}*.csv", '﻿"id","nome"\n1,"d,e"\n2,"say ""hi"""\n')
    put(f"{scratch}/raw", "extraction_ts=7/ç ã.csv", "id,nome\n3,ok\n")
    spec = TableSpec("contas", "id bigint, nome string, extraction_ts string", ("id",))
    got = ingest(spark, scratch, spec)
    assert [(r.id, r.extraction_ts) for r in got.orderBy("id").collect()] == [(1, None), (2, None), (3, "7")]
    assert {r.nome for r in got.where("id = 1").collect()} == {"d,e"}


def test_other_formats(spark, scratch):
    spark.createDataFrame([(1, "a", 2.5)], "id bigint, nome string, extra double").write.json(f"{scratch}/raw/d")
    spec = TableSpec("contas", SPEC.schema, ("id",), fmt="json")
    got = ingest(spark, scratch, spec)
    assert values(got, "id", "nome", "extra") == [(1, "a", D("2.5"))]


def test_a_batch_that_died_is_written_once(spark, scratch, monkeypatch):
    put(f"{scratch}/raw", "1.csv", "id,nome\n1,a\n2,b\n")
    real, state = BatchLog.write, {"die": "before"}

    def flaky(self, df, batch, facts=None):
        if state["die"] == "before":           # rows written, mark not
            df.write.mode("overwrite").parquet(f"{self.rows}/form=1/batch={batch}")
        else:
            real(self, df, batch, facts)
        if state["die"]:
            raise RuntimeError("driver lost")

    monkeypatch.setattr(BatchLog, "write", flaky)
    for die in ("before", "after"):
        state["die"] = die
        with pytest.raises(Exception, match="driver lost"):
            ingest(spark, scratch)
    assert read_bronze(spark, f"{scratch}/bronze", SPEC).count() == 2       # published, not yet committed
    state["die"] = None
    assert ingest(spark, scratch).count() == 2 and len(facts(spark, scratch)) == 1


def test_a_replaced_checkpoint_is_an_error(spark, scratch):
    put(f"{scratch}/raw", "1.csv", "id,nome\n1,a\n")
    ingest(spark, scratch)
    put(f"{scratch}/raw", "2.csv", "id,nome\n2,b\n")
    with pytest.raises(Exception, match="checkpoint"):
        run_bronze(spark, SPEC, f"{scratch}/raw", f"{scratch}/bronze", f"{scratch}/other", "2024-01-01")


def test_newest_load_reads_its_batches_only(spark, scratch):
    put(f"{scratch}/raw", "1.csv", "id,nome\n1,a\n2,b\n")
    ingest(spark, scratch, day="2024-01-05")
    put(f"{scratch}/raw", "2.csv", "id,nome\n9,z\n")
    ingest(spark, scratch, day="2024-01-01")           # a backfill under an older run date
    got = newest_load(spark, f"{scratch}/bronze", SPEC)
    assert values(got, "id", "_processdate") == [(9, "20240101")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan and "(batch#" in plan and "= 1)" in plan


def test_purge_takes_consumed_files_only(spark, scratch):
    put(f"{scratch}/raw", "d/1.csv", "id,nome\n1,a\n")
    ingest(spark, scratch)
    put(f"{scratch}/raw", "2.csv", "id,nome\n2,b\n")                       # not yet taken in
    assert purge(spark, f"{scratch}/bronze", f"{scratch}/raw", "archive", f"{scratch}/old") == 1
    raw = local_path(f"{scratch}/raw")
    assert sorted(n for _, _, ns in os.walk(raw) for n in ns if n.endswith(".csv")) == ["2.csv"]
    assert os.path.exists(os.path.join(local_path(f"{scratch}/old"), "d/1.csv"))
    assert ingest(spark, scratch).count() == 2
    assert purge(spark, f"{scratch}/bronze", f"{scratch}/raw") == 1 and purge(spark, f"{scratch}/bronze", f"{scratch}/raw") == 0
    assert not [n for _, _, ns in os.walk(raw) for n in ns if n.endswith(".csv")]
    assert read_bronze(spark, f"{scratch}/bronze").where(F.col("id") > 0).count() == 2
    with pytest.raises(ValueError):
        purge(spark, f"{scratch}/bronze", f"{scratch}/raw", "archive")


def test_silver_follows_a_column_that_came_later(spark, scratch):
    from finlake.plans import pipeline
    from finlake.plans.lake import Lake
    lake, spec = Lake(spark, f"{scratch}/lake"), SPECS_BY_NAME["contas"]
    put(f"{scratch}/raw/contas", "1.csv", "id,nome\n1,a\n2,b\n")
    for day in ("2024-01-01", "2024-01-02"):
        pipeline.ingest_bronze(spark, lake, f"{scratch}/raw", day, [spec])
        with lake.run(1):
            pipeline.build_silver(lake, [spec])
        if day.endswith("01"):
            pipeline.silver_table(lake, spec).compact(spark)
            put(f"{scratch}/raw/contas", "2.csv", "id,banco,nome\n2,X,bb\n3,Y,c\n")
    assert values(pipeline.read_silver(lake, spec), "id", "nome", "banco") == sorted(
        [(1, "a", None), (2, "bb", "X"), (3, "c", "Y")], key=repr)


