"""Results stay whole: wide headers, late loads, undated movements, half-written versions, hot accounts."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from finlake.operators.cdc import latest_snapshot
from finlake.operators.lookups import Lookup, add_lookups
from finlake.plans import analytics
from finlake.plans.lake import Lake
from finlake.plans.pipeline import build_gold, gold_fact, in_months
from finlake.sources import files
from finlake.sources.views import TEST_PARAMS
from finlake.streaming.scd1 import Scd1Table


def test_evolving_csv_reads_any_width(spark, scratch):
    wide = [f"c{i}" for i in range(40)]
    spark.createDataFrame([(1, *range(40), "x")], ["id", *wide, "name"]).write.option("header", True).csv(f"{scratch}/a/t=1")
    spark.createDataFrame([(2, "y")], ["id", "name"]).write.option("header", True).csv(f"{scratch}/a/t=2")
    got = files.read_evolving(spark, f"{scratch}/a/*", "id int, name string").collect()
    assert sorted(map(tuple, got)) == [(1, "x"), (2, "y")]
    with pytest.raises(Exception, match="wider"):
        files.read_evolving(spark, f"{scratch}/a/*", "id int, name string", width=10).collect()


def test_latest_snapshot_takes_a_backfill_with_an_older_run_date(spark):
    df = spark.createDataFrame([("old", 1, "20240102"), ("new", 2, "20240101")], "x string, load int, _processdate string")
    assert [r.x for r in latest_snapshot(df, "load").collect()] == ["new"]


def test_in_months_is_never_null(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-02-01",), (None,)], "m string")
    keep = lambda ms: [r.m for r in df.where(in_months("m", ms)).collect()]
    rest = lambda ms: [r.m for r in df.where(~in_months("m", ms)).collect()]
    assert keep(["2024-01-01", None]) == ["2024-01-01", None] and rest(["2024-01-01", None]) == ["2024-02-01"]
    assert keep(["2024-01-01"]) == ["2024-01-01"] and rest(["2024-01-01"]) == ["2024-02-01", None]
    assert keep([]) == [] and len(rest([])) == 3


MOVES = ("unique_id string, id long, conta_id long, cartao_id long, tipo_transacao_id long, tipo_transacao_filho_id long, "
         "data date, descricao string, tipo int, situacao string, ignorada boolean, fixa boolean, "
         "valor decimal(18,2), valor_abs decimal(18,2)")


def moves(spark, rows):
    return spark.createDataFrame(
        [(f"{i}", i, 1, None, 1, 1, d, "x", 0, "efetivado", False, False, D(v), abs(D(v))) for i, d, v in rows], MOVES)


def test_undated_movements_stay_in_the_fact_and_the_balance(spark, scratch):
    lake = Lake(spark, scratch)
    named = spark.createDataFrame([(1, "a")], "id long, nome string")
    cats = spark.createDataFrame([(1, "p", "s", "Despesas")], "id long, categoriaPai string, categoria string, natureza string")
    orc = spark.createDataFrame([(dt.date(2024, 1, 1), "p", "s", D("1"), D("0"), D("0"))],
                                "data date, categoria string, subcategoria string, planejado decimal(18,2), "
                                "efetivado decimal(18,2), previsto decimal(18,2)")
    first = [(1, dt.date(2024, 1, 5), "-4.00"), (2, None, "-7.00"), (3, dt.date(2024, 2, 5), "-3.00")]
    common = dict(accounts=named, cards=named, categories=cats, budgets=orc, params=TEST_PARAMS)
    assert build_gold(lake, movements=moves(spark, first), version=1, watermark=1, **common)
    assert gold_fact(lake).count() == 3
    # a later extraction stamps the categories anew; that is no change, so only the touched months are rebuilt
    again = dict(common, categories=cats.withColumn("_ingesttime", F.current_timestamp()))
    second = [(1, dt.date(2024, 1, 5), "-4.00"), (4, dt.date(2024, 1, 6), "-1.00")]
    build_gold(lake, movements=moves(spark, first), version=2, watermark=2, **again)
    again["categories"] = cats.withColumn("_ingesttime", F.current_timestamp())
    assert not build_gold(lake, movements=moves(spark, second), version=3, watermark=3, months=["2024-01-01"], **again)
    fact = gold_fact(lake)
    assert sorted(r.id for r in fact.collect()) == [1, 2, 3, 4]
    assert build_gold(lake, movements=moves(spark, [(2, None, "-8.00")]), version=4, watermark=4, months=[None], **again) is False
    assert sorted((r.id, r.valor) for r in gold_fact(lake).collect())[1] == (2, D("-8.00"))
    got = {r.ano_mes: r.saldo_conta for r in analytics.account_balance(gold_fact(lake)).collect()}
    assert got == {None: D("-8.00"), "2024-01-01": D("-13.00"), "2024-02-01": D("-16.00")}


def test_half_written_base_is_ignored(spark, scratch):
    table = Scd1Table(f"{scratch}/t", ["k"], ["s"])
    row = lambda k, s: spark.createDataFrame([(k, s)], "k int, s int")
    table.write_batch(row(1, 1), 0)
    table.write_batch(row(2, 1), 1)
    spark.createDataFrame([(1, 1)], "k int, s int").write.parquet(f"{table.base}/v=1")     # never published
    assert sorted(r.k for r in table.read(spark).collect()) == [1, 2] and table.base_version(spark) == -1
    table.compact(spark)
    assert sorted(r.k for r in table.read(spark).collect()) == [1, 2] and table.base_version(spark) == 1


def test_hot_account_with_many_cards(spark):
    n = 4000
    df = spark.range(n).select(
        F.concat(F.lit("2024-"), F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0"), F.lit("-01")).alias("ano_mes"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 50).cast("string"))).alias("conta"),
        F.concat(F.lit("card"), (F.col("id") % 977).cast("string")).alias("cartao"), F.lit("efetivado").alias("situacao"),
        F.lit(D("1.00")).cast("decimal(18,2)").alias("valor"))
    got = analytics.account_balance(df)
    hot = {r.ano_mes: r.saldo_conta for r in got.where("conta = 'hot'").collect()}
    counts = {r.ano_mes: r["count"] for r in df.where("conta = 'hot'").groupBy("ano_mes").count().collect()}
    total = 0
    for month in sorted(counts):
        total += counts[month]
        assert hot[month] == D(total)
    assert got.count() == df.select("ano_mes", "conta", "cartao").distinct().count()


def test_lookups_keep_kind_and_names(spark):
    facts = spark.createDataFrame([(1, 7, "f"), (2, 8, "g"), (3, None, "h")], "id int, k int, nome string")
    dims = {"d": spark.createDataFrame([(7, "x"), (7, "y")], "id int, nome string")}
    left = add_lookups(facts, dims, [Lookup("d", "k", {"d_nome": "nome"})])
    assert left.columns == ["id", "k", "nome", "d_nome"] and left.count() == 4
    inner = add_lookups(facts, dims, [Lookup("d", "k", {"d_nome": "nome"}, kind="inner")])
    assert sorted(r.d_nome for r in inner.collect()) == ["x", "y"]
