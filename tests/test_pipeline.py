"""End-to-end: extract CSV from the test tables, run the medallion pipeline
twice (the second extraction changes pending movements and budgets) and
check bronze/silver/gold/marts invariants."""

import pytest
from pyspark.sql import functions as F

from finlake.plans import gold, pipeline
from finlake.plans.lake import Lake
from finlake.sources import files, views
from finlake.sources.views import TEST_PARAMS, Tables
from finlake.specs import SPECS_BY_NAME, silver
from finlake.storage import Files
from finlake.streaming.bronze import read_bronze
from tests.conftest import SF0001, rows


def _extract(t, raw, ts, pending_filter=None, settled_filter=None, without=()):
    mov = views.movements(t)
    pend = mov.where(F.col("situacao") == "pendente")
    if pending_filter is not None:
        pend = pend.where(pending_filter)
    settled = mov.where(F.col("situacao") == "efetivado")
    if settled_filter is not None:
        settled = settled.where(settled_filter)
    out = {
        "contas": views.accounts(t), "cartoes": views.cards(t), "categorias": views.categories(t),
        "orcamentos": views.budgets(t), "transacoes_efetivadas": settled,
        "transacoes_pendentes": pend,
    }
    for name, df in out.items():
        if name in without:
            continue
        files.write_snapshot_csv(df.coalesce(1), raw, name, ts)


def test_pipeline_two_runs(spark, scratch):
    t = Tables(spark, SF0001)
    raw, root = f"{scratch}/raw", f"{scratch}/lake"
    late = F.col("data") >= "1997-06-01"
    _extract(t, raw, "20240101_000000", pending_filter=late)
    lake = pipeline.run(spark, raw, root, "2024-01-01", TEST_PARAMS, version=1)
    n_pending_1 = pipeline.read_silver(lake, SPECS_BY_NAME["transacoes_pendentes"]).count()
    assert n_pending_1 == views.pending(t).where(late).count()
    mk1 = lake.read_state("analytics", "main_kpis")
    assert mk1.count() > 0
    assert {r[0] for r in lake.read_changes("analytics", "main_kpis", 1).select("_op").distinct().collect()} == {"insert"}

    # second extraction: a recent window of settled movements (with changed
    # amounts) and fewer pending movements (some were settled / cancelled)
    recent = F.col("data") >= "1998-06-01"
    _extract(t, raw, "20240102_000000", pending_filter=late & (F.col("tipo") < 2), settled_filter=recent)
    # the first attempt of run 2 dies when all is written but the manifest; the retry has a version of its own
    real = Lake._publish

    def lost(self):
        raise RuntimeError("driver lost")

    Lake._publish = lost
    try:
        with pytest.raises(RuntimeError):
            pipeline.run(spark, raw, root, "2024-01-02", TEST_PARAMS, version=2)
    finally:
        Lake._publish = real
    assert Lake(spark, root).latest_version() == 1
    before = Lake(spark, root).parts("gold", "transacoes")
    lake = pipeline.run(spark, raw, root, "2024-01-02", TEST_PARAMS, version=3, clean_source="delete")
    after = lake.parts("gold", "transacoes")
    assert lake.latest_version() == 3 and not Files(spark).names(f"{raw}/contas/extraction_ts=20240101_000000")[1:]
    kept = {m for m in before if after.get(m) == before[m]}
    assert kept and all(m < "1997-06-01" for m in kept)       # the incremental path: old months were not written
    pend2 = pipeline.read_silver(lake, SPECS_BY_NAME["transacoes_pendentes"])
    assert pend2.count() == views.pending(t).where(late & (F.col("tipo") < 2)).count()   # latest snapshot only
    # settled CDC state equals the batch upsert of everything in bronze
    spec = SPECS_BY_NAME["transacoes_efetivadas"]
    b = read_bronze(spark, lake.path("bronze", spec.name))
    assert rows(pipeline.read_silver(lake, spec), *b.columns) == rows(silver(spec, b), *b.columns)
    # the month-incremental gold fact equals a full rebuild from silver
    feeds = [pipeline.read_silver(lake, SPECS_BY_NAME[n]) for n in ("transacoes_efetivadas", "transacoes_pendentes")]
    cols = [c for c in feeds[0].columns if not c.startswith("_")]
    full = gold.transactions([f.select(*cols) for f in feeds], lake.read_state("gold", "contas"),
                             lake.read_state("gold", "cartoes"), lake.read_state("gold", "categorias"))
    inc = pipeline.gold_fact(lake)
    assert rows(inc, *full.columns) == rows(full)
    assert set(after) == {r[0] for r in full.select("ano_mes").distinct().collect()}
    assert pipeline.gold_watermark(lake) == pipeline.silver_table(lake, spec).last_batch(spark)
    # marts from the incrementally kept summaries equal marts from the full fact
    from_fact = pipeline.mart_plans(*pipeline.gold_tables(lake, summaries=False), TEST_PARAMS)
    for name, df in from_fact.items():
        stored = lake.read_state("analytics", name)
        assert rows(stored, *df.columns) == rows(df), name
    state = lake.read_state("analytics", "monthly_cashflow")
    assert dict(state.dtypes)["ano_mes"] == "string"
    meta = lake.properties("silver", "transacoes_efetivadas")
    assert meta["strategy"] == "cdc" and meta["keys"] == "id,tipo,_businessmonth"
    assert dict(pipeline.gold_fact(lake).dtypes)["ano_mes"] == "string"
    ops = {r[0] for r in lake.read_changes("analytics", "monthly_cashflow", 3).select("_op").distinct().collect()}
    assert "update" in ops


def test_optional_sources_may_come_later(spark, scratch):
    """A run without budgets and pending movements gives marts; with them later, all is as if they had been there."""
    t = Tables(spark, SF0001)
    for at, parts in (("late", [("20240101_000000", ("orcamentos", "transacoes_pendentes")), ("20240102_000000", ())]),
                      ("whole", [("20240102_000000", ())])):
        for n, (ts, without) in enumerate(parts, 1):
            _extract(t, f"{scratch}/{at}/raw", ts, without=without)
            lake = pipeline.run(spark, f"{scratch}/{at}/raw", f"{scratch}/{at}/lake", f"2024-01-0{n}", TEST_PARAMS, version=n)
            if without:
                assert pipeline.read_silver(lake, SPECS_BY_NAME["orcamentos"]).count() == 0
                assert lake.read_state("analytics", "account_balance").count() > 0
                assert lake.read_state("analytics", "budget_balance").count() == 0
    late, whole = (Lake(spark, f"{scratch}/{at}/lake") for at in ("late", "whole"))
    for name in pipeline.MART_KEYS:
        assert rows(late.read_state("analytics", name)) == rows(whole.read_state("analytics", name)), name
    fact = [c for c in pipeline.gold_fact(whole).columns]
    assert rows(pipeline.gold_fact(late), *fact) == rows(pipeline.gold_fact(whole), *fact)
