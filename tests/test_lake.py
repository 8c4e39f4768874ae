"""Published runs: nothing half-written is read, retries under any version, months by dimension id, digests, retention."""

import contextlib
import datetime as dt
import io
import re
from decimal import Decimal as D

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from finlake.operators import cdc
from finlake.plans import pipeline
from finlake.plans.lake import Lake
from finlake.plans.pipeline import build_gold, build_marts, gold_fact
from finlake.sources.views import TEST_PARAMS
from finlake.storage import Files
from tests.conftest import rows
from tests.test_whole_results import MOVES

CATS = "id long, categoriaPai string, categoria string, natureza string"
BUDGETS = ("data date, categoria string, subcategoria string, planejado decimal(18,2), efetivado decimal(18,2), "
           "previsto decimal(18,2)")
NAMES = "id long, nome string"


def world(spark, names=("a", "b"), moves=(), cats=("s",)):
    """Inputs of build_gold: accounts 1, 2, ..., movements (id, account, date, amount) and subcategories."""
    ms = spark.createDataFrame(
        [(f"{i}", i, acc, None, 1, 1, d, "x", 0, "efetivado", False, False, D(v), abs(D(v))) for i, acc, d, v in moves], MOVES)
    accounts = spark.createDataFrame(list(enumerate(names, 1)), NAMES)
    return dict(
        movements=lambda months: ms if months is None else ms.where(F.date_format("data", "yyyy-MM-01").isin(list(months))),
        accounts=accounts, cards=spark.createDataFrame([], NAMES),
        categories=spark.createDataFrame([(i, "p", c, "Despesas") for i, c in enumerate(cats, 1)], CATS),
        budgets=spark.createDataFrame([(dt.date(2024, 1, 1), "p", "s", D("1"), D("0"), D("0"))], BUDGETS), params=TEST_PARAMS)


JAN, FEB, MAR = dt.date(2024, 1, 5), dt.date(2024, 2, 5), dt.date(2024, 3, 5)
FIRST = [(1, 1, JAN, "-4.00"), (2, 2, FEB, "-7.00"), (3, 1, MAR, "-3.00"), (4, 9, FEB, "-1.00")]


def same_as_full(spark, scratch, lake, inputs):
    full = Lake(spark, f"{scratch}/full")
    with full.run(1):
        build_gold(full, version=1, **inputs)
        build_marts(full, TEST_PARAMS, 1)
    cols = gold_fact(full).columns
    assert rows(gold_fact(lake), *cols) == rows(gold_fact(full), *cols)
    for name in ("contas", "categorias", "calendar", "orcamentos"):
        assert rows(lake.read_state("gold", name)) == rows(full.read_state("gold", name))
    for name in pipeline.MART_KEYS:
        if lake.exists("analytics", name):
            assert rows(lake.read_state("analytics", name)) == rows(full.read_state("analytics", name)), name


def test_a_changed_dimension_row_refreshes_its_months_only(spark, scratch):
    lake = Lake(spark, f"{scratch}/lake")
    build_gold(lake, version=1, watermark=1, **world(spark, moves=FIRST))
    one = lake.parts("gold", "transacoes")
    assert set(one) == {"2024-01-01", "2024-02-01", "2024-03-01"}
    renamed = world(spark, names=("a", "new"), moves=FIRST)
    assert build_gold(lake, version=2, watermark=1, months=[], **renamed) is False
    two = lake.parts("gold", "transacoes")
    assert {m for m in two if two[m] != one[m]} == {"2024-02-01"}
    new = Files(spark).names(f"{lake.path('gold', 'transacoes')}/parts/{two['2024-02-01']}")
    assert [f for f in new if f.startswith("ano_mes")] == ["ano_mes=2024-02-01"]
    assert {r.conta for r in gold_fact(lake).collect()} == {"a", "new"}
    # an account that was unknown: its movements had been left out of the fact
    known = world(spark, names=("a", "new", *"345678", "nine"), moves=FIRST)
    assert build_gold(lake, version=3, watermark=1, months=["2024-03-01"], **known) is False
    three = lake.parts("gold", "transacoes")
    assert {m for m in three if three[m] != two[m]} == {"2024-02-01", "2024-03-01"}
    assert sorted(r.id for r in gold_fact(lake).collect()) == [1, 2, 3, 4]
    same_as_full(spark, scratch, lake, known)


def test_frames_that_lack_the_months_of_a_changed_row_are_refused(spark, scratch):
    lake = Lake(spark, scratch)
    build_gold(lake, version=1, **world(spark, moves=FIRST))
    renamed = world(spark, names=("a", "new"), moves=FIRST)
    renamed["movements"] = renamed["movements"](["2024-01-01"])
    with pytest.raises(ValueError, match="months"):
        build_gold(lake, version=2, months=["2024-01-01"], **renamed)
    assert lake.latest_version() == 1 and {r.conta for r in gold_fact(lake).collect()} == {"a", "b"}


def test_a_run_that_dies_at_any_write_leaves_nothing(spark, scratch, monkeypatch):
    """Every write of the second run is the last one of an attempt; each next attempt has another version."""
    lake = Lake(spark, f"{scratch}/lake")
    build_gold(lake, version=1, watermark=1, **world(spark, moves=FIRST))
    before = rows(gold_fact(lake))
    later = world(spark, names=("a", "new"), moves=[(1, 1, JAN, "-5.00"), *FIRST[1:3], (5, 1, FEB, "-2.00")])
    count = {"left": 0}
    real = {n: getattr(DataFrameWriter, n) for n in ("parquet", "text")}

    def writer(name):
        def write(self, *args, **kw):
            real[name](self, *args, **kw)
            count["left"] -= 1
            if count["left"] == 0:
                raise RuntimeError("driver lost")
        return write

    for name in real:
        monkeypatch.setattr(DataFrameWriter, name, writer(name))

    died, version = 0, 1
    while True:
        version += died % 2 == 0            # every second attempt is a retry under the same version
        count["left"] = died + 1
        try:
            build_gold(lake, version=version, watermark=2, months=["2024-01-01", "2024-02-01"], **later)
            break
        except RuntimeError:
            died += 1
            if lake.latest_version() == 1:
                assert lake.notes()["settled_batch"] == 1
                if died % 5 == 0:
                    assert rows(gold_fact(lake)) == before
            else:                            # died right behind the manifest: the run counts
                assert lake.latest_version() == version
    count["left"] = -1
    assert died > 12
    same_as_full(spark, scratch, lake, later)
    named = set(lake.parts("gold", "transacoes").values())
    gone = lake.retain(1)
    left = Files(spark).names(f"{lake.root}/gold/transacoes/parts")
    assert set(left) == named and any("/gold/transacoes/parts/" in p for p in gone)
    assert len(Files(spark).names(f"{lake.root}/gold/contas/state")) == 1
    assert rows(gold_fact(lake)) != before


def test_planted_folders_are_ignored(spark, scratch):
    lake = Lake(spark, scratch)
    df = spark.createDataFrame([(1, "x"), (2, "y")], NAMES)
    with lake.run(1):
        lake.apply_snapshot(df, "gold", "contas", ["id"])
    df.limit(1).write.parquet(f"{lake.path('gold', 'contas')}/state/v=2")
    df.limit(1).write.parquet(f"{lake.path('gold', 'contas')}/state/v=2-00000000")
    assert lake.read_state("gold", "contas").count() == 2
    assert len(lake.retain()) == 2 and lake.read_state("gold", "contas").count() == 2


def test_changes_are_against_the_published_state(spark, scratch):
    lake = Lake(spark, scratch)
    one, two = ([(1, "x"), (2, "y")], [(2, "z"), (3, "w")])
    with lake.run(1):
        lake.apply_snapshot(spark.createDataFrame(one, NAMES), "gold", "contas", ["id"])
    with pytest.raises(RuntimeError):
        with lake.run(2):
            lake.apply_snapshot(spark.createDataFrame(two, NAMES), "gold", "contas", ["id"])
            raise RuntimeError("lost")
    for version in (2, 3):
        with lake.run(version):
            lake.apply_snapshot(spark.createDataFrame(two, NAMES), "gold", "contas", ["id"])
    ops = lambda v: sorted((r["id"], r["_op"]) for r in lake.read_changes("gold", "contas", v).collect())
    assert ops(2) == [(1, "delete"), (2, "update"), (3, "insert")] and ops(3) == [] and len(ops(1)) == 2
    with pytest.raises(ValueError, match="within a run"):
        lake.write_state(spark.range(1), "gold", "x")


def test_a_repeated_key_is_an_error_that_names_it(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z")], NAMES)
    with pytest.raises(Exception, match="repeats the key id=2"):
        cdc.snapshot_diff(df.limit(0), df, ["id"]).collect()
    assert {r["_op"] for r in cdc.snapshot_diff(df, df, ["id"]).collect()} == {"same"}      # no bucket differs
    other = spark.createDataFrame([(1, "x"), (2, "z"), (2, "q"), (None, "n")], NAMES)
    got = sorted(((r["id"], r["nome"], r["_op"]) for r in cdc.snapshot_diff(df, other, ["id"], several=True).collect()), key=repr)
    assert got == sorted([(1, "x", "same"), (2, "q", "update"), (2, "z", "same"), (None, "n", "insert")], key=repr)


def test_only_changed_buckets_are_joined(spark):
    n = 5000
    old = spark.range(n).select("id", (F.col("id") % 7).alias("x"), F.lit(None).cast("string").alias("y"))
    new = old.withColumn("x", F.when(F.col("id") == 4321, 99).otherwise(F.col("x")))
    changed = cdc.changed_buckets(old, new, ["id"], ["x", "y"], 1000).collect()
    bucket = old.where("id = 4321").select(cdc.key_bucket(["id"], 1000).alias("b")).first()["b"]
    assert [r["_bucket"] for r in changed] == [bucket]
    diff = cdc.snapshot_diff(old, new, ["id"], buckets=1000)
    diff.collect()
    counts = joined_rows(diff)
    inside = old.where(cdc.key_bucket(["id"], 1000) == bucket).count()
    assert counts and max(counts) == inside < 20
    got = {r["_op"]: r for r in diff.where("_op <> 'same'").collect()}
    assert set(got) == {"update"} and (got["update"]["id"], got["update"]["x"]) == (4321, 99)
    assert diff.count() == n
    nulls = old.withColumn("y", F.when(F.col("id") == 1, F.lit("")).otherwise(F.col("y")))
    assert [r["_op"] for r in cdc.snapshot_diff(old, nulls, ["id"]).where("_op <> 'same'").collect()] == ["update"]


def joined_rows(df: DataFrame) -> list[int]:
    """Rows that the full outer joins of the executed plan gave."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if "Join" in name and "FullOuter" in node.toString() and "_ck_" in node.toString():
            found.append(int(node.metrics().apply("numOutputRows").value()))
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_running_balances_go_on_from_the_published_ones(spark, scratch):
    lake = Lake(spark, f"{scratch}/lake")
    moves = [(0, 1, None, "-9.00"), *FIRST, (6, 2, MAR, "-1.00"), (7, 1, dt.date(2024, 4, 1), "8.00")]

    def run(version, moves, months, **more):
        inputs = world(spark, moves=moves)
        inputs.update(more)
        with lake.run(version):
            build_gold(lake, version=version, watermark=version, months=months, **inputs)
            since = pipeline.carried_from(lake, TEST_PARAMS)
            plans = pipeline.running_marts(lake, since, TEST_PARAMS) if since else {}
            build_marts(lake, TEST_PARAMS, version)
        return since, plans, inputs

    assert run(1, moves, None)[0] is None
    moves[3] = (3, 1, MAR, "-30.00")
    since, plans, inputs = run(2, moves, ["2024-03-01"])
    assert since == "2024-03-01"
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        plans["account_balance"].explain("formatted")
    filters = [line for line in text.getvalue().splitlines() if line.startswith("PartitionFilters")]
    months = {m for line in filters for m in re.findall(r"2024-\d\d-01", line)}
    assert months == {"2024-03-01", "2024-04-01"}
    same_as_full(spark, scratch, lake, inputs)
    # nothing changed; then a budget line of an earlier month; then the undated movement
    assert run(3, moves, [])[0] == pipeline.NO_MONTH
    budgets = spark.createDataFrame([(dt.date(2024, 2, 1), "p", "s", D("1"), D("0"), D("0"))], BUDGETS)
    since, _, inputs = run(4, moves, [], budgets=budgets)
    assert since == "2024-01-01"
    same_as_full(spark, f"{scratch}/four", lake, inputs)
    moves[0] = (0, 1, None, "-10.00")
    inputs = world(spark, moves=moves)
    everything = inputs["movements"](None)
    inputs.update(budgets=budgets, movements=lambda months: everything.where("data IS NULL"))
    with lake.run(5):
        build_gold(lake, version=5, watermark=5, months=[None], **inputs)
        assert pipeline.carried_from(lake, TEST_PARAMS) is None
        build_marts(lake, TEST_PARAMS, 5)
    same_as_full(spark, f"{scratch}/five", lake, {**inputs, "movements": everything})


def test_catalog_names_what_is_published(spark, scratch):
    lake = Lake(spark, f"{scratch}/lake")
    build_gold(lake, version=1, watermark=1, **world(spark, moves=FIRST))
    lake.describe("gold", "contas", "Accounts, it's one row each", keys="id", strategy="cdc")
    prefix = "t_" + scratch.rsplit("-", 1)[-1] + "_"
    names = lake.register(prefix)
    assert f"{prefix}gold.contas" in names and f"{prefix}gold.transacoes" in names
    shown = "\n".join(str(r) for r in spark.sql(f"DESCRIBE EXTENDED {prefix}gold.contas").collect())
    assert "it's one row each" in shown and "strategy=cdc" in shown and "keys=id" in shown and "version=1" in shown
    for name in ("contas", "categorias", "orcamentos", "calendar"):
        assert rows(spark.read.table(f"{prefix}gold.{name}")) == rows(lake.read_state("gold", name))
    fact = gold_fact(lake)
    assert rows(spark.read.table(f"{prefix}gold.transacoes"), *fact.columns) == rows(fact)
    build_gold(lake, version=2, watermark=1, months=[], **world(spark, names=("a", "new"), moves=FIRST))
    lake.register(prefix)
    assert {r.nome for r in spark.read.table(f"{prefix}gold.contas").collect()} == {"a", "new"}
    assert rows(spark.read.table(f"{prefix}gold.transacoes"), *fact.columns) == rows(gold_fact(lake))
    assert spark.read.table(f"{prefix}gold.transacoes").schema.simpleString() == fact.schema.simpleString()
    for name in names:
        spark.sql(f"DROP {'VIEW' if spark.catalog.getTable(name).tableType == 'VIEW' else 'TABLE'} {name}")
    assert lake.read_state("gold", "contas").count() == 2
