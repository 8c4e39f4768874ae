"""Spark side of the mart checks: gold layer and analytics marts over the
finance views of the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from finlake.plans import analytics, gold
from finlake.session import scratch_path
from finlake.sources import views
from finlake.sources.views import TEST_PARAMS as P, Tables


def gold_layer(spark: SparkSession, sf_dir: str):
    """(transactions, budgets, calendar, categories) gold DataFrames, lazily."""
    t = Tables(spark, sf_dir)
    cat = gold.categories(views.categories(t), P.lifestyle_parents)
    orc = gold.budgets(views.budgets(t), P.as_of)
    trs = gold.transactions(views.movements(t), views.accounts(t), views.cards(t), cat)
    return trs, orc, gold.calendar(gold.daily_summary(trs), orc), cat


def gold_with_summaries(spark: SparkSession, sf_dir: str):
    """The gold layer plus the category and daily summaries the marts read.

    The fact is evaluated once: its sums per day and category path are written
    under the shared checkpoint folder, and both summaries, the calendar and
    the marts read those, as they read stored summaries in the pipeline.
    """
    t = Tables(spark, sf_dir)
    cat = gold.categories(views.categories(t), P.lifestyle_parents)
    orc = stored(gold.budgets(views.budgets(t), P.as_of), "budgets")
    trs = gold.transactions(views.movements(t), views.accounts(t), views.cards(t), cat)
    both = stored(gold.daily_category_summary(trs), "summary")
    by_cat, daily = gold.category_summary(both), gold.daily_summary(both)
    cal = gold.calendar(daily, orc)
    return trs, orc, cal, cat, by_cat, daily


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared checkpoint folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def gold_categories(spark, sf_dir) -> DataFrame:
    return gold.categories(views.categories(Tables(spark, sf_dir)), P.lifestyle_parents)


def gold_budgets(spark, sf_dir) -> DataFrame:
    return gold.budgets(views.budgets(Tables(spark, sf_dir)), P.as_of)


def gold_transactions(spark, sf_dir) -> DataFrame:
    return gold_layer(spark, sf_dir)[0]


def calendar(spark, sf_dir) -> DataFrame:
    return gold_layer(spark, sf_dir)[2]


def account_balance(spark, sf_dir) -> DataFrame:
    return analytics.account_balance(gold_layer(spark, sf_dir)[0])


def budget_balance(spark, sf_dir) -> DataFrame:
    _, orc, _, cat = gold_layer(spark, sf_dir)
    return analytics.budget_balance(orc, cat, P.as_of)


def budget_planning(spark, sf_dir) -> DataFrame:
    _, orc, cal, cat, by_cat, _ = gold_with_summaries(spark, sf_dir)
    return analytics.budget_planning(by_cat, orc, cal, cat)


def daily_cashflow(spark, sf_dir) -> DataFrame:
    _, orc, cal, _, _, daily = gold_with_summaries(spark, sf_dir)
    return analytics.daily_cashflow(daily, orc, cal, P.interest_rate)


def monthly_cashflow(spark, sf_dir) -> DataFrame:
    _, orc, cal, _, by_cat, _ = gold_with_summaries(spark, sf_dir)
    return analytics.monthly_cashflow(by_cat, orc, cal)


def income_vs_outcome(spark, sf_dir) -> DataFrame:
    return analytics.income_vs_outcome(gold_with_summaries(spark, sf_dir)[4], P.start_month)


def main_kpis(spark, sf_dir) -> DataFrame:
    _, orc, cal, cat, by_cat, _ = gold_with_summaries(spark, sf_dir)
    return analytics.main_kpis(by_cat, orc, cal, cat, P.salary_subcategory,
                               P.instalment_subcategory)


QUERIES = {
    "gold_categories": gold_categories,
    "gold_budgets": gold_budgets,
    "gold_transactions": gold_transactions,
    "calendar": calendar,
    "account_balance": account_balance,
    "budget_balance": budget_balance,
    "budget_planning": budget_planning,
    "daily_cashflow": daily_cashflow,
    "monthly_cashflow": monthly_cashflow,
    "income_vs_outcome": income_vs_outcome,
    "main_kpis": main_kpis,
}
