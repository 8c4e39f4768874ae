"""Analytics marts over the gold layer.

Each mart aggregates the fact first (partial + final aggregate, so hot keys
are combined map-side) and only then joins spines and dimensions; every window
runs over already-aggregated rows whose count is bounded by months x
categories or accounts x cards, not by the number of movements.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finlake import constants as K
from finlake.functions.dates import month_key, month_start
from finlake.functions.money import clamp_balance, interest, money, money_total, ratio
from finlake.operators.aggregates import conditional_sums, pivot_sums
from finlake.operators.spine import dense_panel
from finlake.operators.windows import previous_value, running_total, trailing_mean


def unique_categories(cat: DataFrame) -> DataFrame:
    """One row per (parent, name): category names need not be unique, and a
    duplicated name would count a budget line twice in the name-keyed joins.
    Deterministic: the smallest id wins. Off by default (source behaviour)."""
    w = F.min_by(F.struct(*[c for c in cat.columns if c not in ("categoria", "subcategoria")]), "id")
    return (cat.groupBy("categoria", "subcategoria").agg(w.alias("_c"))
            .select("categoria", "subcategoria", "_c.*").select(*cat.columns))


def account_balance(trs: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Monthly result per (month, account, card) of settled movements, the
    account's running balance and the card's monthly result.

    All cards of one account-month are peers and share the same balance, so
    the running sum runs over one row per account and month (no account has
    more than the calendar's months in its window, however many cards or
    movements it holds) and is joined back on account and month.

    With ``before``, this mart's rows of all months before those of ``trs``
    (rows without a month come first), each account goes on from its last
    balance there, and the result is ``before`` with the rows of ``trs`` added.
    """
    monthly = (trs.where(F.col("situacao") == K.STATUS_SETTLED)
               .groupBy("ano_mes", "conta", "cartao")
               .agg(money_total(F.sum("valor")).alias("resultado_mes")))
    running = Window.partitionBy("_conta").orderBy("_mes")
    balance = (monthly.groupBy(F.col("conta").alias("_conta"), F.col("ano_mes").alias("_mes"))
               .agg(F.sum("resultado_mes").alias("_sum"))
               .select("_conta", "_mes", F.sum("_sum").over(running).alias("_balance")))
    if before is not None:
        last = F.max_by("saldo_conta", F.coalesce("ano_mes", F.lit(""))).alias("_from")
        opening = before.groupBy(F.col("conta").alias("_account")).agg(last)
        balance = (balance.join(opening, F.col("_conta").eqNullSafe(F.col("_account")), "left")
                   .select("_conta", "_mes", (F.col("_balance") + F.coalesce("_from", F.lit(0))).alias("_balance")))
    same = F.col("conta").eqNullSafe(F.col("_conta")) & F.col("ano_mes").eqNullSafe(F.col("_mes"))
    out = monthly.join(balance, same).select(
        "ano_mes", "conta", "cartao", "resultado_mes",
        money_total(F.col("_balance")).alias("saldo_conta"),
        F.when(F.col("cartao").isNotNull(), F.col("resultado_mes")).alias("saldo_cartao"),
    )
    return out if before is None else before.select(*out.columns).unionByName(out)


def budget_balance(orc: DataFrame, cat: DataFrame, as_of: str,
                   dedupe_categories: bool = False) -> DataFrame:
    """Budget vs actual per line, rolled up to its group and its category on
    every row, with the clamped remaining budget.

    Budget lines are keyed by (month, category, subcategory), so a window
    partition holds at most the subcategories of one group in one month: its
    size is bounded by the category dimension, never by the data volume. The
    windows sharing a partition key are written next to each other so Spark
    plans one exchange per key (two in total).
    """
    c = (unique_categories(cat) if dedupe_categories else cat).select("agrupador", "categoria", "subcategoria")
    base = (orc.join(c, ["categoria", "subcategoria"], "left")
            .select("data_orcamento", "agrupador", "categoria", "subcategoria",
                    F.col("planejado").alias("orcado_subcategoria"),
                    F.col("consumido").alias("real_subcategoria")))
    by_group = Window.partitionBy("data_orcamento", "agrupador")
    by_cat = Window.partitionBy("data_orcamento", "categoria")
    return base.select(
        "data_orcamento", "agrupador", "categoria", "subcategoria",
        money_total(F.sum("orcado_subcategoria").over(by_group)).alias("orcado_agrupador"),
        money_total(F.sum("real_subcategoria").over(by_group)).alias("real_agrupador"),
        money_total(F.sum("orcado_subcategoria").over(by_cat)).alias("orcado_categoria"),
        money_total(F.sum("real_subcategoria").over(by_cat)).alias("real_categoria"),
        "orcado_subcategoria", "real_subcategoria",
        money(clamp_balance("orcado_subcategoria", "real_subcategoria", "data_orcamento", as_of))
        .alias("saldo_orcamento"),
    ).select("data_orcamento", "agrupador", "categoria", "subcategoria", "orcado_agrupador",
             "orcado_categoria", "orcado_subcategoria", "real_agrupador", "real_categoria",
             "real_subcategoria", "saldo_orcamento")


PANEL_KEYS = ["agrupador", "categoria", "subcategoria"]


def budget_planning(trs: DataFrame, orc: DataFrame, cal: DataFrame, cat: DataFrame,
                    short=K.TRAILING_SHORT, long=K.TRAILING_LONG,
                    dedupe_categories: bool = False) -> DataFrame:
    """Dense month x expense-category panel with the month's spend, previous
    month, trailing means and the budget line."""
    cat = unique_categories(cat) if dedupe_categories else cat
    cats = cat.where(F.col("natureza") == K.NATURE_EXPENSE).select(*PANEL_KEYS)
    panel = dense_panel(cats, cal, "ano_mes", out="_mes").select(
        month_key("_mes").alias("ano_mes"), *PANEL_KEYS)
    spend = (trs.groupBy("ano_mes", *PANEL_KEYS)
             .agg(F.sum("valor_abs").alias("valor_transacao")))
    plan = orc.select(month_key("data_orcamento").alias("ano_mes"), "categoria", "subcategoria",
                      F.col("planejado").alias("valor_orcamento"),
                      F.col("saldo").alias("saldo_orcamento"))
    j = (panel.join(spend, ["ano_mes", *PANEL_KEYS], "left")
         .join(plan, ["ano_mes", "categoria", "subcategoria"], "left"))
    v = F.col("valor_transacao")
    zero = F.lit(0)
    return j.select(
        "ano_mes", *PANEL_KEYS,
        money_total(F.coalesce(v, zero)).alias("valor_mes_atual"),
        money_total(F.coalesce(previous_value(v, PANEL_KEYS, "ano_mes"), zero)).alias("valor_mes_anterior"),
        F.coalesce(trailing_mean(v, PANEL_KEYS, "ano_mes", *short), F.lit(0.0)).alias("media_3_meses"),
        F.coalesce(trailing_mean(v, PANEL_KEYS, "ano_mes", *long), F.lit(0.0)).alias("media_6_meses"),
        money(F.coalesce("valor_orcamento", zero)).alias("valor_orcamento"),
        money(F.coalesce("saldo_orcamento", zero)).alias("saldo_orcamento"),
    )


def _carried(run: DataFrame, before: DataFrame | None, order: str, since: str | None) -> DataFrame:
    """Running cash that goes on from the last row of ``before`` (one scalar)."""
    if before is None:
        return run
    opening = before.where(F.col(order) < since).select(F.max_by("fluxo_de_caixa", order)).scalar()
    return run.withColumn("fluxo_de_caixa", F.col("fluxo_de_caixa") + F.coalesce(opening, F.lit(0)))


def _from(df: DataFrame, column: str, since: str | None) -> DataFrame:
    return df if since is None else df.where(F.col(column) >= F.lit(since).cast(df.schema[column].dataType))


def daily_cashflow(trs: DataFrame, orc: DataFrame, cal: DataFrame, rate: str = K.INTEREST_RATE,
                   before: DataFrame | None = None, since: str | None = None) -> DataFrame:
    """Per calendar day: movements, remaining budget charged on the 1st, the
    net of the day, running cash and projected interest on a negative cash.

    With ``before``, this mart as it was, its days before ``since`` stay and
    the running cash goes on from there; only later days are computed.
    """
    t = (_from(trs, "data_transacao", since).groupBy(F.col("data_transacao").alias("sk_data"))
         .agg(F.sum("valor").alias("total_transacoes")))
    o = (_from(orc, "data_orcamento", since).groupBy(F.col("data_orcamento").alias("sk_data"))
         .agg(F.sum("saldo").alias("total_orcamento")))
    days = (_from(cal, "sk_data", since).select("sk_data").join(t, "sk_data", "left").join(o, "sk_data", "left")
            .select("sk_data",
                    money_total(F.coalesce("total_transacoes", F.lit(0))).alias("total_transacoes"),
                    money_total(F.coalesce("total_orcamento", F.lit(0))).alias("total_orcamento"))
            .withColumn("total_dia", money_total(F.col("total_transacoes") - F.col("total_orcamento"))))
    run = running_total(days, "sk_data", "total_dia", "fluxo_de_caixa", bucket=month_start("sk_data"))
    run = _carried(run, before, "sk_data", since)
    out = run.select("sk_data", "total_transacoes", "total_orcamento", "total_dia",
                     money_total("fluxo_de_caixa").alias("fluxo_de_caixa"),
                     interest("fluxo_de_caixa", rate).alias("juros_projetado"))
    return out if before is None else before.where(F.col("sk_data") < since).select(*out.columns).unionByName(out)


def monthly_cashflow(trs: DataFrame, orc: DataFrame, cal: DataFrame,
                     before: DataFrame | None = None, since: str | None = None) -> DataFrame:
    """Per calendar month: movements, remaining budget, net and running cash.

    ``before`` and ``since`` as in :func:`daily_cashflow`, by month.
    """
    t = _from(trs, "ano_mes", since).groupBy("ano_mes").agg(F.sum("valor").alias("total_transacoes"))
    o = (_from(orc, "data_orcamento", since).groupBy(month_key("data_orcamento").alias("ano_mes"))
         .agg(F.sum("saldo").alias("total_orcamento")))
    months = _from(cal, "ano_mes", since).select("ano_mes").distinct()
    m = (months.join(t, "ano_mes", "left").join(o, "ano_mes", "left")
         .select("ano_mes",
                 money_total(F.coalesce("total_transacoes", F.lit(0))).alias("total_transacoes"),
                 money_total(F.coalesce("total_orcamento", F.lit(0))).alias("total_orcamento"))
         .withColumn("total_mes", money_total(F.col("total_transacoes") - F.col("total_orcamento"))))
    run = running_total(m, "ano_mes", "total_mes", "fluxo_de_caixa",
                        bucket=F.substring("ano_mes", 1, 4))
    run = _carried(run, before, "ano_mes", since)
    out = run.select("ano_mes", "total_transacoes", "total_orcamento", "total_mes",
                     money_total("fluxo_de_caixa").alias("fluxo_de_caixa"))
    return out if before is None else before.where(F.col("ano_mes") < since).select(*out.columns).unionByName(out)


def income_vs_outcome(trs: DataFrame, start_month: str) -> DataFrame:
    """Monthly expenses and income from ``start_month`` on (a pivot on nature)."""
    # the month key is the partition column of the stored fact: this prunes partitions
    f = trs.where((F.col("ano_mes") >= month_key(F.lit(start_month).cast("date")))
                  & F.col("natureza").isin(K.NATURE_EXPENSE, K.NATURE_INCOME))
    p = pivot_sums(f, "ano_mes", "natureza", "valor_abs",
                   {"despesas": K.NATURE_EXPENSE, "receitas": K.NATURE_INCOME})
    return p.select("ano_mes", money_total("despesas").alias("despesas"),
                    money_total("receitas").alias("receitas"))


def main_kpis(trs: DataFrame, orc: DataFrame, cal: DataFrame, cat: DataFrame,
              salary: str = K.SALARY_SUBCATEGORY, instalments: str = K.INSTALMENT_SUBCATEGORY,
              lifestyle: str = K.GROUP_LIFESTYLE, dedupe_categories: bool = False) -> DataFrame:
    """Monthly KPIs: salary, instalments, income, expenses, lifestyle share,
    budget, month performance and projected lifestyle share.

    The budget side is the (month, group) -> month two-level sum collapsed into
    one aggregate: a conditional sum of sums equals the conditional sum, so one
    shuffle instead of two.
    """
    sub, grp, nat, v = (F.col("subcategoria"), F.col("agrupador"), F.col("natureza"),
                        F.col("valor_abs"))
    t = conditional_sums(trs, "ano_mes", {
        "total_salario": (sub == salary, v),
        "parcelas_mes_atual": (sub == instalments, v),
        "total_parcelas": (sub == instalments, F.col("futuro_vendido")),
        "total_estilo_de_vida": (grp == lifestyle, v),
        "total_receitas": (nat == K.NATURE_INCOME, v),
        "total_despesas": (nat == K.NATURE_EXPENSE, v),
    })
    cat = unique_categories(cat) if dedupe_categories else cat
    o = (orc.join(cat.select("categoria", "subcategoria", "agrupador"), ["categoria", "subcategoria"])
         .groupBy(month_key("data_orcamento").alias("ano_mes"))
         .agg(F.sum(F.when(grp == lifestyle, F.col("saldo"))).alias("orcado_estilo_vida"),
              F.sum("saldo").alias("total_orcamento")))
    months = cal.select("ano_mes").distinct()
    j = months.join(t, "ano_mes", "left").join(o, "ano_mes", "left")
    c = F.col
    return j.select(
        "ano_mes",
        money_total("total_salario").alias("total_salario"),
        money_total("total_parcelas").alias("total_parcelas"),
        money_total("total_receitas").alias("total_receitas"),
        money_total("total_despesas").alias("total_despesas"),
        ratio("total_estilo_de_vida", "total_salario").alias("prc_estilo_de_vida"),
        ratio("parcelas_mes_atual", "total_salario").alias("prc_parcelas"),
        money_total("total_orcamento").alias("total_orcamento"),
        money_total(c("total_receitas") - c("total_despesas") - c("total_orcamento")).alias("performance_mes"),
        ratio(c("total_estilo_de_vida") + c("orcado_estilo_vida"), "total_salario").alias("prc_prj_estilo_vida"),
    )
