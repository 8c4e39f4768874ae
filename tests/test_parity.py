"""Every registered query against its DuckDB oracle at sf0.001."""

import datetime as dt
import hashlib
import sys
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E
from finlake.checks import registry
from tests.conftest import SF0001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _digest(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in data)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_queries_without_the_training_data_package(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert set(E.queries()) == set(registry.queries()) and set(E.oracle_sql()) == set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, con, name):
    df = registry.queries()[name](spark, SF0001)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(registry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    exp = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(exp)
    assert _digest(df.columns, got) == _digest(ocols, exp)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
