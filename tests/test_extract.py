"""Payload pages -> extract CSVs -> medallion pipeline -> marts."""

from pyspark.sql import functions as F

from finlake.checks import payloads
from finlake.functions.dates import extract_window_bounds
from finlake.plans import pipeline
from finlake.plans.extract import extract, flatten_run
from finlake.sources.views import TEST_PARAMS, Tables
from finlake.specs import SPECS_BY_NAME
from tests.conftest import SF0001

REFDATE = "1998-03-15"


def _pages(t):
    return {"cards": payloads.card_pages(t), "accounts": payloads.account_pages(t),
            "income_categories": payloads.category_pages(t, True),
            "expense_categories": payloads.category_pages(t, False),
            "movements": payloads.movement_pages(t), "budgets": payloads.budget_pages(t)}


def test_flatten_run_window_and_routing(spark):
    t = Tables(spark, SF0001)
    out = flatten_run(_pages(t), REFDATE)
    lo, hi = extract_window_bounds(REFDATE)
    for name in ("transacoes_pendentes", "transacoes_efetivadas", "orcamentos"):
        r = out[name].agg(F.min("data"), F.max("data")).first()
        assert r[0] is None or (r[0] >= lo and r[1] <= hi)
    assert {r[0] for r in out["transacoes_efetivadas"].select("situacao").distinct().collect()} <= {"efetivado"}
    assert {r[0] for r in out["transacoes_pendentes"].select("situacao").distinct().collect()} <= {"pendente"}


def test_payload_to_marts(spark, scratch):
    t = Tables(spark, SF0001)
    raw, root = f"{scratch}/raw", f"{scratch}/lake"
    written = extract(_pages(t), raw, "19980315_060000", REFDATE)
    assert all(written[k] for k in ("cartoes", "contas", "categorias", "transacoes_efetivadas"))
    lake = pipeline.run(spark, raw, root, REFDATE, TEST_PARAMS, version=1)
    settled = flatten_run(_pages(t), REFDATE)["transacoes_efetivadas"]
    keys = settled.select("id", "tipo", F.date_format("data", "yyyyMM01").alias("m")).distinct().count()
    assert pipeline.read_silver(lake, SPECS_BY_NAME["transacoes_efetivadas"]).count() == keys
    cal = lake.read_state("gold", "calendar")
    assert cal.agg(F.min("sk_data")).first()[0].isoformat() == "1998-02-01"
    assert lake.read_state("analytics", "main_kpis").count() == 11      # Feb .. Dec 1998
