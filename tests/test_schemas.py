"""Outputs keep the pinned column contract, from raw tables and from the lake."""

import pytest

import __spark_entry__ as E
from finlake import schemas
from finlake.plans import pipeline
from finlake.plans.lake import Lake
from finlake.sources import views
from finlake.sources.views import TEST_PARAMS, Tables
from tests.conftest import SF0001

CHECK_TO_GOLD = {"gold_categories": "categorias", "gold_budgets": "orcamentos",
                 "gold_transactions": "transacoes", "calendar": "calendar"}


@pytest.mark.parametrize("name", sorted(CHECK_TO_GOLD) + sorted(schemas.MARTS))
def test_check_outputs_match_pinned_schema(spark, name):
    ddl = schemas.GOLD[CHECK_TO_GOLD[name]] if name in CHECK_TO_GOLD else schemas.MARTS[name]
    got = E.queries()[name](spark, SF0001).schema
    assert schemas.shape(got) == schemas.shape(schemas.struct(ddl))


def test_lake_outputs_match_pinned_schema(spark, scratch):
    lake = Lake(spark, scratch)
    t = Tables(spark, SF0001)
    pipeline.build_gold(lake, movements=views.movements(t), accounts=views.accounts(t), cards=views.cards(t),
                        categories=views.categories(t), budgets=views.budgets(t), params=TEST_PARAMS, version=1)
    fact, orc, cal, cat = pipeline.gold_tables(lake, summaries=False)
    assert schemas.shape(fact.schema) == schemas.shape(schemas.struct(schemas.GOLD["transacoes"]))
    for name, df in pipeline.mart_plans(*pipeline.gold_tables(lake), TEST_PARAMS).items():
        assert schemas.shape(df.schema) == schemas.shape(schemas.struct(schemas.MARTS[name])), name
