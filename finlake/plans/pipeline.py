"""The medallion run: raw files -> bronze -> silver -> gold -> analytics.

Every step is a Spark job over the lake; the only values that reach the
driver are version numbers and the calendar/panel bounds (scalars).
"""

from __future__ import annotations

from dataclasses import asdict
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake import constants as K
from finlake.functions.dates import month_key
from finlake.params import Params
from finlake.plans import analytics, gold
from finlake.plans.lake import KEPT_RUNS, Lake, in_values
from finlake.specs import FINANCE_SPECS, TableSpec, silver
from finlake.storage import Files
from finlake.streaming.bronze import bronze_log, newest_load, purge, run_bronze
from finlake.streaming.scd1 import Scd1Table

GOLD_KEYS = {
    "categorias": ["id"],
    "contas": ["id"],
    "cartoes": ["id"],
    "orcamentos": ["subcategoria", "categoria", "data_orcamento"],
    "calendar": ["sk_data"],
}

MART_KEYS = {
    "account_balance": ["ano_mes", "conta", "cartao"],
    "budget_balance": ["data_orcamento", "agrupador", "categoria", "subcategoria"],
    "budget_planning": ["ano_mes", "agrupador", "categoria", "subcategoria"],
    "daily_cashflow": ["sk_data"],
    "monthly_cashflow": ["ano_mes"],
    "income_vs_outcome": ["ano_mes"],
    "main_kpis": ["ano_mes"],
}


# --- gold ----------------------------------------------------------------------------

FACT = "transacoes"
BY_CATEGORY = "transacoes_categoria"   # summaries of the fact read by the marts
DAILY = "transacoes_diario"
INDEX = "transacoes_indice"            # months in which a dimension's ids have movements
STAGE = "transacoes_lote"              # the movements that the last run took in

# Dimension table to the movement column that names its rows.
DIMENSION_IDS = {"contas": "conta_id", "cartoes": "cartao_id", "categorias": "tipo_transacao_filho_id"}

# Marts whose key may stand for several rows: category names can repeat (Q7).
SEVERAL = ("budget_balance", "budget_planning")

in_months = in_values


def month_key_of(business_month: str | None) -> str | None:
    """``yyyyMM01`` -> ``yyyy-MM-01``."""
    return business_month and f"{business_month[:4]}-{business_month[4:6]}-01"


def business_month_of(month: str | None) -> str | None:
    """``yyyy-MM-01`` -> ``yyyyMM01``."""
    return month and month.replace("-", "")


def months_by_id(movements: DataFrame) -> DataFrame:
    """(dimensao, id, ano_mes) of every dimension row that movements of a month refer to."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dimensao"), F.col(c).cast("bigint").alias("id"))
                      for d, c in DIMENSION_IDS.items()])
    return (movements.select(F.explode(pairs).alias("x"), month_key(F.col("data")).alias("ano_mes"))
            .select("x.dimensao", "x.id", "ano_mes").where("id IS NOT NULL").distinct())


def months_of_changed_dimensions(lake: Lake) -> set:
    """Months with movements of the dimension rows that this run inserted, changed or deleted."""
    changed = None
    for name in DIMENSION_IDS:
        ids = lake.read_changes("gold", name).select(F.lit(name).alias("dimensao"), "id")
        changed = ids if changed is None else changed.unionByName(ids)
    if changed.isEmpty():
        return set()
    index = lake.read_parts("gold", INDEX, base=True)
    return _distinct(index.join(changed, ["dimensao", "id"], "left_semi"), "ano_mes")


def build_gold(lake: Lake, *, movements, accounts: DataFrame, cards: DataFrame,
               categories: DataFrame, budgets: DataFrame, params: Params, version: int,
               timings: dict | None = None, months=None, watermark: int | None = None) -> bool:
    """Conform the silver inputs into the gold tables of ``lake``, as part of run ``version``.

    Categories, accounts, cards, budgets and the calendar are keyed targets
    (snapshot apply, with change feeds); the transaction fact, its summaries
    and the index of dimension ids are kept by month.  ``movements`` are the
    feeds of all months, or a function that gives those of some months (None:
    all).  With ``months`` (``yyyy-MM-01`` keys, None for undated rows) only
    these and the months that the index names for changed dimension rows are
    written; feeds that are no function have to hold exactly those months.
    Without, or in a lake without a fact, all months are.  Returns True when the
    fact was rebuilt in full.  ``watermark`` (the last settled change batch
    included) and the months with pending movements are noted in the manifest.
    """
    import time

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        if timings is not None:
            timings[name] = round(time.perf_counter() - t0, 3)
        return out

    dims = {
        "categorias": gold.categories(categories, params.lifestyle_parents),
        "contas": accounts.select("id", "nome"),
        "cartoes": cards.select("id", "nome"),
    }
    with lake.run(version):
        full = months is None or not lake.exists("gold", FACT)
        for name, df in dims.items():
            timed(f"gold.{name}", lambda df=df, name=name: lake.apply_snapshot(df, "gold", name, GOLD_KEYS[name]))
        timed("gold.orcamentos", lambda: lake.apply_snapshot(
            gold.budgets(budgets, params.as_of), "gold", "orcamentos", GOLD_KEYS["orcamentos"]))

        def write_fact():
            replace = None
            if not full:
                replace = set(months) | months_of_changed_dimensions(lake)
                if replace != set(months) and not callable(movements):
                    raise ValueError("dimensions changed in months that the movements don't hold")
            feeds = movements(replace) if callable(movements) else movements
            feeds = [feeds] if isinstance(feeds, DataFrame) else list(feeds)
            lake.write_state(reduce(DataFrame.unionByName, feeds), "gold", STAGE)
            taken = lake.read_state("gold", STAGE)
            cat, acc, crd = (lake.read_state("gold", n) for n in ("categorias", "contas", "cartoes"))
            lake.write_parts(gold.transactions(taken, acc, crd, cat), "gold", FACT, "ano_mes", replace)
            stored = lake.read_parts("gold", FACT, replace)
            lake.write_parts(gold.category_summary(stored), "gold", BY_CATEGORY, "ano_mes", replace)
            lake.write_parts(gold.daily_summary(stored), "gold", DAILY, "ano_mes", replace)
            lake.write_parts(months_by_id(taken), "gold", INDEX, "ano_mes", replace)
            pending = _distinct(stored.where(F.col("situacao") == K.STATUS_PENDING), "ano_mes")
            kept = set() if full else set(lake.notes().get("pending_months", [])) - replace
            lake.note(pending_months=sorted(pending | kept, key=str),
                      refreshed=None if full else sorted(replace, key=str))
            if watermark is not None:
                lake.note(settled_batch=watermark)

        timed("gold.transacoes", write_fact)
        timed("gold.calendar", lambda: lake.apply_snapshot(
            gold.calendar(lake.read_parts("gold", DAILY), lake.read_state("gold", "orcamentos")),
            "gold", "calendar", GOLD_KEYS["calendar"]))
    return full


def gold_watermark(lake: Lake) -> int | None:
    """Last settled change batch reflected by the gold fact (None: rebuild in full)."""
    return lake.notes().get("settled_batch") if lake.exists("gold", FACT) else None


def gold_fact(lake: Lake, months=None) -> DataFrame:
    """The published transaction fact (of ``months``)."""
    return lake.read_parts("gold", FACT, months)


def gold_tables(lake: Lake, summaries: bool = True):
    """(transactions, budgets, calendar, categories) as stored in ``lake``.

    With ``summaries`` the transactions are ``(fact, by_category, daily)``:
    the fact for the per-account mart, the summaries for all the others."""
    fact = gold_fact(lake)
    trs = ((fact, lake.read_parts("gold", BY_CATEGORY), lake.read_parts("gold", DAILY))
           if summaries else fact)
    return (trs, lake.read_state("gold", "orcamentos"),
            lake.read_state("gold", "calendar"), lake.read_state("gold", "categorias"))


def mart_plans(trs, orc, cal, cat, p: Params) -> dict[str, DataFrame]:
    """The seven marts; ``trs`` is the fact or ``(fact, by_category, daily)``."""
    fact, by_cat, daily = trs if isinstance(trs, tuple) else (trs, trs, trs)
    trs = by_cat
    return {
        "account_balance": analytics.account_balance(fact),
        "budget_balance": analytics.budget_balance(orc, cat, p.as_of, p.dedupe_categories),
        "budget_planning": analytics.budget_planning(trs, orc, cal, cat,
                                                     dedupe_categories=p.dedupe_categories),
        "daily_cashflow": analytics.daily_cashflow(daily, orc, cal, p.interest_rate),
        "monthly_cashflow": analytics.monthly_cashflow(trs, orc, cal),
        "income_vs_outcome": analytics.income_vs_outcome(trs, p.start_month),
        "main_kpis": analytics.main_kpis(trs, orc, cal, cat, p.salary_subcategory,
                                         p.instalment_subcategory,
                                         dedupe_categories=p.dedupe_categories),
    }


RUNNING = ("account_balance", "daily_cashflow", "monthly_cashflow")
NO_MONTH = "9999-12-01"


def carried_from(lake: Lake, params: Params) -> str | None:
    """First month whose running balances can differ from the published marts (None: any month).

    That is the earliest month that this run refreshed in the fact or in which
    a budget line changed. Undated rows come before all months, so a change
    there means all; so do other parameters.
    """
    notes = lake.notes()
    months, was = notes.get("refreshed"), notes.get("mart_params")
    if months is None or None in months or was != asdict_text(params) or not all(
            lake.exists("analytics", name) for name in RUNNING):
        return None
    budgets = lake.read_changes("gold", "orcamentos").agg(
        F.min(month_key("data_orcamento")).alias("first"), F.count_if(F.col("data_orcamento").isNull()).alias("undated")).first()
    if budgets["undated"]:
        return None
    return min([*months, budgets["first"] or NO_MONTH], default=NO_MONTH)


def asdict_text(params: Params) -> dict[str, str]:
    return {k: str(v) for k, v in asdict(params).items()}


def running_marts(lake: Lake, since: str, p: Params) -> dict[str, DataFrame]:
    """The marts with running balances, continued from what is published before month ``since``."""
    _, orc, cal, _ = gold_tables(lake)
    later = [m for m in lake.parts("gold", FACT) if m is not None and m >= since]
    base = {name: lake.read_base("analytics", name) for name in RUNNING}
    accounts = base["account_balance"].where(F.col("ano_mes").isNull() | (F.col("ano_mes") < since))
    return {
        "account_balance": analytics.account_balance(gold_fact(lake, later), accounts),
        "daily_cashflow": analytics.daily_cashflow(lake.read_parts("gold", DAILY, later), orc, cal, p.interest_rate,
                                                   base["daily_cashflow"], since),
        "monthly_cashflow": analytics.monthly_cashflow(lake.read_parts("gold", BY_CATEGORY, later), orc, cal,
                                                       base["monthly_cashflow"], since),
    }


def build_marts(lake: Lake, params: Params, version: int, names=None,
                timings: dict | None = None) -> None:
    """The marts as keyed targets with change feeds, as part of run ``version``.

    Running balances go on from the published ones before the first month that
    the run changed.
    """
    import time
    with lake.run(version):
        plans = mart_plans(*gold_tables(lake), params)
        since = carried_from(lake, params)
        if since is not None:
            plans |= running_marts(lake, since, params)
        for name in names or list(plans):
            t0 = time.perf_counter()
            lake.apply_snapshot(plans[name], "analytics", name, MART_KEYS[name], several=name in SEVERAL)
            if timings is not None:
                timings[f"analytics.{name}"] = round(time.perf_counter() - t0, 3)
        lake.note(mart_params=asdict_text(params))


# --- bronze / silver --------------------------------------------------------------------

def ingest_bronze(spark: SparkSession, lake: Lake, raw_root: str, run_date, specs=FINANCE_SPECS) -> None:
    """Stream every new raw file of every spec into bronze (triggered, exactly once)."""
    for spec in specs:
        run_bronze(spark, spec, f"{raw_root.rstrip('/')}/{spec.name}", lake.path("bronze", spec.name),
                   f"{lake.root}/_checkpoints/bronze/{spec.name}", run_date)


def purge_raw(lake: Lake, raw_root: str, how: str, specs=FINANCE_SPECS) -> int:
    """Delete or archive the raw files that published bronze batches have taken in."""
    return sum(purge(lake.spark, lake.path("bronze", spec.name), f"{raw_root.rstrip('/')}/{spec.name}", how,
                     f"{lake.root}/_archive/{spec.name}") for spec in specs)


def silver_table(lake: Lake, spec: TableSpec) -> Scd1Table:
    cluster = "_businessmonth" if "_businessmonth" in spec.keys else None
    return Scd1Table(lake.path("silver", spec.name), list(spec.keys), list(spec.sequence_by), list(spec.tiebreak),
                     cluster_by=cluster, schema=spec.bronze_columns())


def build_silver(lake: Lake, specs=FINANCE_SPECS) -> None:
    """Bring every silver table up to date with bronze, within a run of the lake.

    ``cdc`` tables are fed incrementally: a stream over the marks of bronze
    hands each newly published batch to the SCD-1 table, so a run touches only
    the data that arrived since the last one, in whatever schema it was
    written. ``snapshot`` tables are the newest load of bronze, of which only
    the batches are read.
    """
    spark = lake.spark
    for spec in specs:
        bronze = lake.path("bronze", spec.name)
        log = bronze_log(bronze, spec)
        if spec.strategy == "cdc":
            table = silver_table(lake, spec)
            if not Files(spark).exists(log.batches):
                continue

            def take(marks: DataFrame, batch: int, table=table, log=log) -> None:
                new = {r["batch"] for r in marks.select("batch").collect()}
                if new:
                    table.write_batch(log.read(spark, only=new), batch)

            marks = spark.readStream.schema("value string, batch long").text(log.batches)
            q = (marks.writeStream.foreachBatch(take).trigger(availableNow=True)
                 .option("checkpointLocation", f"{lake.root}/_checkpoints/silver/{spec.name}").start())
            q.awaitTermination()
            if q.exception() is not None:
                raise q.exception()
        elif spec.load_col == "_ingesttime":
            lake.write_state(newest_load(spark, bronze, spec), "silver", spec.name)
        else:
            lake.write_state(silver(spec, log.read(spark)), "silver", spec.name)


def describe_tables(lake: Lake, specs=FINANCE_SPECS) -> None:
    """Comments and properties (keys, strategy) of the bronze and silver tables."""
    for spec in specs:
        lake.describe("bronze", spec.name, f"Bronze {spec.name}: append-only ingest of {spec.fmt} extracts",
                      business_date=spec.business_date or "run date")
        lake.describe("silver", spec.name,
                      f"Silver {spec.name}: " + (f"deduplicated by {list(spec.keys)}, SCD type 1"
                                                 if spec.strategy == "cdc" else "latest full snapshot"),
                      keys=",".join(spec.keys), strategy=spec.strategy,
                      sequence_by=",".join(spec.sequence_by))


def read_silver(lake: Lake, spec: TableSpec, where=None) -> DataFrame:
    """Current silver table; ``where`` (on key columns) prunes before the upsert."""
    if spec.strategy == "cdc":
        return silver_table(lake, spec).read(lake.spark, where)
    df = lake.read_state("silver", spec.name)
    return df if where is None else df.where(where)


SETTLED, PENDING = "transacoes_efetivadas", "transacoes_pendentes"


def _distinct(df: DataFrame, column: str) -> set:
    """Distinct month keys, None for undated rows (bounded by the calendar, not the data)."""
    return {r[0] for r in df.select(column).distinct().collect()}


def run(spark: SparkSession, raw_root: str, lake_root: str, run_date, params: Params,
        version: int, specs: list[TableSpec] = FINANCE_SPECS, incremental: bool = True,
        compact_every: int = 8, clean_source: str | None = None, keep_runs: int = KEPT_RUNS) -> Lake:
    """One triggered run of the whole pipeline.

    With ``incremental`` the gold fact is refreshed only for the months that
    changed since the published one: months of the settled change batches
    after its watermark, months that hold pending movements in it, months of
    the new pending snapshot, and months with movements of changed dimension
    rows. All references come from the published manifest, so a run that
    died is redone correctly by the next one, under any version. After a good
    run, files that its manifests don't name are dropped and, with
    ``clean_source``, the raw files that it has taken in.
    """
    lake = Lake(spark, lake_root)
    by_name = {sp.name: sp for sp in specs}
    settled = silver_table(lake, by_name[SETTLED])

    ingest_bronze(spark, lake, raw_root, run_date, specs)
    with lake.run(version):
        build_silver(lake, specs)
        months, last = None, settled.last_batch(spark)
        built = gold_watermark(lake) if incremental else None
        if built is not None:
            pending = read_silver(lake, by_name[PENDING])
            new = _distinct(pending, "_businessmonth") | _distinct(settled.changes_since(spark, built), "_businessmonth")
            months = {month_key_of(m) for m in new} | set(lake.notes().get("pending_months", []))
        columns = by_name[SETTLED].columns().fieldNames()

        def feeds(wanted) -> list[DataFrame]:
            where = None if wanted is None else in_months("_businessmonth", [business_month_of(m) for m in wanted])
            return [read_silver(lake, by_name[n], where).select(*columns) for n in (SETTLED, PENDING)]

        dims = {n: read_silver(lake, by_name[n]) for n in ("contas", "cartoes", "categorias", "orcamentos")}
        build_gold(lake, movements=feeds, accounts=dims["contas"], cards=dims["cartoes"], categories=dims["categorias"],
                   budgets=dims["orcamentos"], params=params, version=version, months=months, watermark=last)
        build_marts(lake, params, version)
    describe_tables(lake, specs)
    for sp in specs:  # fold long change logs into a new base
        if sp.strategy == "cdc":
            t = silver_table(lake, sp)
            if t.last_batch(spark) - t.base_version(spark) >= compact_every:
                t.compact(spark)
    if clean_source:
        purge_raw(lake, raw_root, clean_source, specs)
    lake.retain(keep_runs)
    return lake
