
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake import constants as K
from finlake.checks import payloads
from finlake.checks.marts import gold_layer, stored
from finlake.functions.dates import (business_date_key, business_month_key, extract_window_bounds,
                                     month_key, month_start, year_end)
from finlake.functions.money import money, money_total
from finlake.functions.text import instalment
from finlake.operators import cdc, spine, windows
from finlake.operators.lookups import add_lookups
from finlake.plans import gold
from finlake.sources import audit, payload, views
from finlake.sources.views import TEST_PARAMS as P, Tables
from finlake.specs import TableSpec, silver

EVENT_KEYS = ["user_id", "event_type"]
EVENT_SEQ = ["ts", "event_id"]
RUN_DATE = "2024-01-15"
EXTRACT_REFDATE = "1998-03-15"
SNAPSHOT_STATUS = (K.STATUS_SETTLED, K.STATUS_PENDING)


# --- D: change data ---------------------------------------------------------------

def scd1_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.scd1_upsert(Tables(spark, sf)("events"), EVENT_KEYS, EVENT_SEQ)


MOVEMENT_TIEBREAK = ["unique_id", "valor_abs", "descricao", "conta_id", "tipo_transacao_filho_id",
                     "cartao_id", "ignorada", "fixa"]


def scd1_composite_key(spark, sf) -> DataFrame:
    """Settled feed keyed by (id, tipo, _businessmonth), a derived audit column."""
    mov = audit.with_audit(views.settled(Tables(spark, sf)), RUN_DATE, "data",
                           ingest_time=False, source_file=False)
    return cdc.scd1_upsert(mov, ["id", "tipo", "_businessmonth"], ["data"], MOVEMENT_TIEBREAK)


def latest_snapshot(spark, sf) -> DataFrame:
    ev = Tables(spark, sf)("events")
    return cdc.latest_snapshot(ev, F.to_date("ts"))


def activity_snapshot(mov: DataFrame, status: str) -> DataFrame:
    """Statement per (account, card) of all movements with one status; the card
    is NULL for non-card movements."""
    return mov.where(F.col("situacao") == status).groupBy("conta_id", "cartao_id").agg(money_total(F.sum("valor")).alias("movimento"))


def snapshot_diff(spark, sf) -> DataFrame:
    mov = views.movements(Tables(spark, sf))
    cur, new = (activity_snapshot(mov, s) for s in SNAPSHOT_STATUS)
    return cdc.snapshot_diff(cur, new, ["conta_id", "cartao_id"])


def snapshot_apply(spark, sf) -> DataFrame:
    mov = views.movements(Tables(spark, sf))
    cur, new = (activity_snapshot(mov, s) for s in SNAPSHOT_STATUS)
    return cdc.snapshot_apply(cur, new, ["conta_id", "cartao_id"])


EVENT_SPECS = [
    TableSpec("events_cdc", "", tuple(EVENT_KEYS), "cdc", sequence_by=tuple(EVENT_SEQ), tiebreak=()),
    TableSpec("events_snapshot", "", tuple(EVENT_KEYS), "snapshot", load_col="_load"),
]


def silver_dispatch(spark, sf) -> DataFrame:
    ev = Tables(spark, sf)("events")
    loaded = ev.withColumn("_load", F.to_date("ts"))
    return reduce(DataFrame.unionByName, [
        silver(spec, loaded).select(F.lit(spec.name).alias("tabela"), *ev.columns) for spec in EVENT_SPECS])


# --- A / C: sources, audit ------------------------------------------------------------

def audit_columns(spark, sf) -> DataFrame:
    return audit.with_audit(views.movements(Tables(spark, sf)), RUN_DATE, "data",
                            ingest_time=False, source_file=False)


def extract_window(spark, sf) -> DataFrame:
    lo, hi = extract_window_bounds(EXTRACT_REFDATE)
    mov = views.movements(Tables(spark, sf))
    return mov.where(F.col("situacao").isin(K.STATUS_SETTLED)
                     & F.col("data").between(F.lit(lo), F.lit(hi))
                     & F.col("tipo").isin(*K.MOVEMENT_TYPES))


# --- B: payload flattening ------------------------------------------------------------

def flatten_cards(spark, sf) -> DataFrame:
    return payload.cards(payloads.card_pages(Tables(spark, sf)))


def flatten_accounts(spark, sf) -> DataFrame:
    return payload.accounts(payloads.account_pages(Tables(spark, sf)))


def categories_hierarchy(spark, sf) -> DataFrame:
    t = Tables(spark, sf)
    return payload.categories(payloads.category_pages(t, True), payloads.category_pages(t, False))


def flatten_transactions(spark, sf) -> DataFrame:
    return payload.movements(payloads.movement_pages(Tables(spark, sf)))


def flatten_budgets(spark, sf) -> DataFrame:
    return payload.budgets(payloads.budget_pages(Tables(spark, sf)), month_col="data")


def month_spine(spark, sf) -> DataFrame:
    """Budget months requested by each extraction run (one run per order date):
    first of (refdate - 1 month) .. December of that year."""
    runs = payloads.order_months(Tables(spark, sf))
    start = month_start(F.add_months(F.col("refdate"), -1))
    bounded = runs.select("refdate", start.alias("_ini"),
                          F.make_date(F.year(start), F.lit(12), F.lit(1)).alias("_fim"))
    return spine.month_spine(bounded, "_ini", "_fim", out="mes").select("refdate", "mes")


# --- E-J: projections, joins, windows, scalar functions -------------------------------

def join_inner(spark, sf) -> DataFrame:
    t = Tables(spark, sf)
    known = add_lookups(views.movements(t), {"accounts": views.accounts(t)}, [gold.ACCOUNT])
    return known.select("unique_id", "id", "conta_id", "conta")


def join_left_dims(spark, sf) -> DataFrame:
    t = Tables(spark, sf)
    cat = gold.categories(views.categories(t), P.lifestyle_parents)
    known = add_lookups(views.movements(t), {"cards": views.cards(t), "categories": cat}, [gold.CARD, gold.CATEGORY])
    return known.select("unique_id", "cartao", "categoria", "subcategoria", "agrupador")


def dense_panel(spark, sf) -> DataFrame:
    _, _, cal, cat = gold_layer(spark, sf)
    cats = cat.where(F.col("natureza") == K.NATURE_EXPENSE).select("agrupador", "categoria", "subcategoria")
    return (spine.dense_panel(cats, cal, "ano_mes", out="_m")
            .select(month_key("_m").alias("ano_mes"), "agrupador", "categoria", "subcategoria"))


def month_key_join(spark, sf) -> DataFrame:
    """Calendar month keys (text) joined to budget totals keyed by DATE month:
    both sides compared as DATE, the output keeps the text key."""
    _, orc, cal, _ = gold_layer(spark, sf)
    months = cal.select("ano_mes").distinct()
    tot = orc.groupBy("data_orcamento").agg(money_total(F.sum("saldo")).alias("total_orcamento"))
    return (months.join(tot, F.to_date(months.ano_mes) == tot.data_orcamento)
            .select("ano_mes", "total_orcamento"))


def running_total(spark, sf) -> DataFrame:
    mov = views.movements(Tables(spark, sf))
    daily = mov.groupBy("data").agg(money_total(F.sum("valor")).alias("total_dia"))
    daily = stored(daily, "daily")      # read twice: bucket totals, rows
    r = windows.running_total(daily, "data", "total_dia", "acumulado", bucket=month_start("data"))
    return r.select("data", "total_dia", money_total("acumulado").alias("acumulado"))


def trailing_mean(spark, sf) -> DataFrame:
    """Per sub-category monthly spend with previous month and trailing means
    (months without spend are gaps, not zeros)."""
    mov = views.movements(Tables(spark, sf))
    m = (mov.groupBy("tipo_transacao_filho_id", month_start("data").alias("mes"))
         .agg(F.sum("valor_abs").alias("valor")))
    part, order = ["tipo_transacao_filho_id"], "mes"
    (r3, d3), (r6, d6) = K.TRAILING_SHORT, K.TRAILING_LONG
    return m.select(
        "tipo_transacao_filho_id", "mes", money_total("valor").alias("valor"),
        money_total(windows.previous_value("valor", part, order)).alias("valor_mes_anterior"),
        windows.trailing_mean("valor", part, order, r3, d3).alias("media_3_meses"),
        windows.trailing_mean("valor", part, order, r6, d6).alias("media_6_meses"))


def installments(spark, sf) -> DataFrame:
    mov = views.movements(Tables(spark, sf))
    cur, tot = instalment("descricao", 1), instalment("descricao", 2)
    return mov.select("unique_id", "descricao", "valor_abs", cur.alias("parcela_atual"),
                      tot.alias("total_parcelas"),
                      money((tot - cur) * F.col("valor_abs")).alias("futuro_vendido"))


def month_keys(spark, sf) -> DataFrame:
    mov = views.movements(Tables(spark, sf))
    d = F.col("data")
    return mov.select("unique_id", "data", month_key(d).alias("ano_mes"),
                      business_date_key(d).alias("chave_dia"),
                      business_month_key(d).alias("chave_mes"),
                      year_end(d).alias("fim_ano"))


QUERIES = {
    "scd1_upsert": scd1_upsert,
    "scd1_composite_key": scd1_composite_key,
    "latest_snapshot": latest_snapshot,
    "snapshot_diff": snapshot_diff,
    "snapshot_apply": snapshot_apply,
    "silver_dispatch": silver_dispatch,
    "audit_columns": audit_columns,
    "extract_window": extract_window,
    "flatten_cards": flatten_cards,
    "flatten_accounts": flatten_accounts,
    "categories_hierarchy": categories_hierarchy,
    "flatten_transactions": flatten_transactions,
    "flatten_budgets": flatten_budgets,
    "month_spine": month_spine,
    "join_inner": join_inner,
    "join_left_dims": join_left_dims,
    "dense_panel": dense_panel,
    "month_key_join": month_key_join,
    "running_total": running_total,
    "trailing_mean": trailing_mean,
    "installments": installments,
    "month_keys": month_keys,
}
