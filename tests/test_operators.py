import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from finlake.functions.dates import month_start
from finlake.operators import dense_panel, partition_totals, running_total, trailing_mean
from finlake.operators.spine import day_spine
from finlake.plans import analytics
from tests.conftest import rows


def test_two_level_running_total_equals_plain_window(spark):
    rnd = random.Random(7)
    start = dt.date(2023, 11, 15)
    data = [(start + dt.timedelta(days=i), rnd.randint(-500, 500)) for i in range(400)]
    df = spark.createDataFrame(data, "d date, v long")
    two = running_total(df, "d", "v", "acc", bucket=month_start("d"))
    plain = df.withColumn("acc", F.sum("v").over(Window.orderBy("d").rowsBetween(Window.unboundedPreceding, 0)))
    assert rows(two, "d", "v", "acc") == rows(plain, "d", "v", "acc")


def test_running_total_with_partitions(spark):
    data = [("a", 1, 5), ("a", 2, 7), ("b", 1, 1), ("b", 40, 2), ("a", 33, 1)]
    df = spark.createDataFrame(data, "p string, o int, v int")
    two = running_total(df, "o", "v", "acc", bucket=(F.col("o") / 10).cast("int"), partition="p")
    assert rows(two, "p", "o", "acc") == [("a", 1, 5), ("a", 2, 12), ("a", 33, 13), ("b", 1, 1), ("b", 40, 3)]


def test_partition_totals_match_window_incl_null_keys(spark):
    data = [("m1", "g1", 1), ("m1", "g1", 2), ("m1", None, 4), ("m1", None, 8), ("m2", "g1", 16)]
    df = spark.createDataFrame(data, "m string, g string, v int")
    got = partition_totals(df, ["m", "g"], {"t": "v"})
    w = df.withColumn("t", F.sum("v").over(Window.partitionBy("m", "g")))
    assert rows(got, "m", "g", "v", "t") == rows(w, "m", "g", "v", "t")


def test_account_balance_peers_share_balance(spark):
    s = "ano_mes string, conta string, cartao string, valor decimal(18,2), situacao string"
    data = [("2024-01-01", "acc", "c1", Decimal("10"), "efetivado"),
            ("2024-01-01", "acc", "c2", Decimal("20"), "efetivado"),
            ("2024-01-01", "acc", None, Decimal("5"), "efetivado"),
            ("2024-02-01", "acc", None, Decimal("1"), "efetivado"),
            ("2024-02-01", "acc", None, Decimal("100"), "pendente")]
    out = analytics.account_balance(spark.createDataFrame(data, s))
    got = rows(out, "ano_mes", "cartao", "saldo_conta", "saldo_cartao")
    assert got == sorted([("2024-01-01", "c1", Decimal("35.00"), Decimal("10.00")),
                          ("2024-01-01", "c2", Decimal("35.00"), Decimal("20.00")),
                          ("2024-01-01", None, Decimal("35.00"), None),
                          ("2024-02-01", None, Decimal("36.00"), None)], key=repr)


def test_trailing_mean_sums_four_divides_by_three(spark):
    months = [dt.date(2024, m, 1) for m in range(1, 10) if m != 5]   # gap in May
    df = spark.createDataFrame([("x", m, float(i + 1)) for i, m in enumerate(months)], "k string, m date, v double")
    out = df.select("m", trailing_mean("v", ["k"], "m", 4, 3).alias("t")).orderBy("m").collect()
    vals = [r["t"] for r in out]
    assert vals[0] is None                       # first month: empty frame
    assert vals[1] == round(1 / 3, 6)
    assert vals[4] == round((1 + 2 + 3 + 4) / 3, 6)   # rows, not months: the gap is skipped


def test_calendar_spine(spark):
    one = spark.createDataFrame([(dt.date(2024, 3, 10),)], "d date")
    cal = day_spine([(one, "d")])
    r = cal.agg(F.min("sk_data"), F.max("sk_data"), F.count(F.lit(1))).first()
    assert r[0] == dt.date(2024, 3, 1) and r[1] == dt.date(2024, 12, 31) and r[2] == 306
    two = spark.createDataFrame([(dt.date(2023, 6, 2),), (dt.date(2024, 1, 5),)], "d date")
    assert day_spine([(two, "d")]).count() == (dt.date(2024, 12, 31) - dt.date(2023, 6, 1)).days + 1
    empty = spark.createDataFrame([], "d date")
    assert day_spine([(empty, "d"), (empty, "d")]).count() == 0


def test_dense_panel_equals_cross_join(spark):
    months = spark.createDataFrame([("2024-01-01",), ("2024-02-01",), ("2024-03-01",)], "ano_mes string")
    dim = spark.createDataFrame([("a",), ("b",)], "c string")
    got = dense_panel(dim, months, "ano_mes", out="m").select(F.date_format("m", "yyyy-MM-01").alias("ano_mes"), "c")
    assert rows(got) == rows(months.crossJoin(dim).select("ano_mes", "c"))


def test_duplicate_category_names_flag(spark):
    from decimal import Decimal as D
    cat = spark.createDataFrame([(1, "Casa", "Luz", "Despesas", "Casa"), (2, "Casa", "Luz", "Despesas", "Casa")],
                                "id bigint, categoria string, subcategoria string, natureza string, agrupador string")
    orc = spark.createDataFrame([(dt.date(2024, 1, 1), "Casa", "Luz", D("10.00"), D("4.00"), D("6.00"))],
                                "data_orcamento date, categoria string, subcategoria string, planejado decimal(18,2), "
                                "consumido decimal(18,2), saldo decimal(18,2)")
    dup = analytics.budget_balance(orc, cat, "2023-01-01")
    assert dup.count() == 2 and dup.first()["orcado_categoria"] == D("20.00")      # source behaviour
    one = analytics.budget_balance(orc, cat, "2023-01-01", dedupe_categories=True)
    assert one.count() == 1 and one.first()["orcado_categoria"] == D("10.00")


def test_snapshot_load_by_extraction(spark):
    from finlake.specs import EXTRACTION_LOAD, TableSpec, silver
    b = spark.createDataFrame([(1, "f/extraction_ts=1/a.csv", 1), (2, "f/extraction_ts=2/a.csv", 1),
                               (3, "f/extraction_ts=2/b.csv", 2)], "id int, _sourcefile string, _ingesttime int")
    spec = TableSpec("p", "", ("id",), "snapshot", load_col=EXTRACTION_LOAD)
    assert sorted(r["id"] for r in silver(spec, b).collect()) == [2, 3]   # both files of the newest extraction
    by_time = TableSpec("p", "", ("id",), "snapshot")
    assert sorted(r["id"] for r in silver(by_time, b).collect()) == [3]  # ingest time keeps only the last batch
