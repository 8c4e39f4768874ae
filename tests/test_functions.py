import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from finlake.functions import (clamp_balance, extract_window_bounds, first_truthy, instalment, interest,
                               last_token, month_key, ratio, year_end)


def test_instalments(spark):
    df = spark.createDataFrame([("TV (3/10)",), ("no match",), (None,), ("a (1/2) b (5/6)",),
                                ("x (123456789012/3)",)], "d string")
    got = [(r[0], r[1]) for r in df.select(instalment("d", 1), instalment("d", 2)).collect()]
    assert got == [(3, 10), (None, None), (None, None), (1, 2), (None, 3)]


def test_last_token(spark):
    df = spark.createDataFrame([("Bank. Main",), ("plain",), ("a.b.",), (None,)], "n string")
    assert [r[0] for r in df.select(last_token("n")).collect()] == ["Main", "plain", "", None]


def test_first_truthy(spark):
    df = spark.createDataFrame([(0, 0, 5), (3, 1, 1), (0, None, None), (0, 7, None)], "a int, b int, c int")
    assert [r[0] for r in df.select(first_truthy("a", "b", "c")).collect()] == [5, 3, 0, 7]


def test_extract_window_bounds():
    assert extract_window_bounds("2024-01-20") == (dt.date(2023, 12, 1), dt.date(2023, 12, 31))
    assert extract_window_bounds("2024-12-05") == (dt.date(2024, 11, 1), dt.date(2024, 12, 31))
    assert extract_window_bounds("2024-03-31") == (dt.date(2024, 2, 1), dt.date(2024, 12, 31))


def test_ratio_zero_and_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (1.0, 3.0)], "a double, b double")
    assert [r[0] for r in df.select(ratio("a", "b")).collect()] == [None, None, 0.333333]


def test_month_keys(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),)], "d date")
    r = df.select(month_key("d"), year_end("d")).first()
    assert r[0] == "2024-02-01" and r[1] == dt.date(2024, 12, 31)


def test_clamp_and_interest(spark):
    df = spark.createDataFrame([(Decimal("10.00"), Decimal("4.00"), dt.date(2024, 5, 1)),
                                (Decimal("10.00"), Decimal("14.00"), dt.date(2024, 5, 1)),
                                (Decimal("10.00"), None, dt.date(2024, 5, 1)),
                                (Decimal("10.00"), Decimal("1.00"), dt.date(2024, 1, 1))],
                               "p decimal(18,2), a decimal(18,2), m date")
    got = [r[0] for r in df.select(clamp_balance("p", "a", "m", "2024-03-01")).collect()]
    assert [Decimal(x) for x in got] == [Decimal("6.00"), 0, 0, 0]
    b = spark.createDataFrame([(Decimal("-100.00"),), (Decimal("5.00"),)], "b decimal(38,2)")
    assert [r[0] for r in b.select(interest("b")).collect()] == [Decimal("0.350000"), Decimal("0E-6")]


def test_production_params_follow_the_run_date():
    from finlake import constants as K
    from finlake.params import production_params
    p = production_params("2024-03-17")
    assert (p.as_of, p.start_month) == ("2024-03-01", "2024-01-01")
    assert list(p.lifestyle_parents) == K.LIFESTYLE_PARENTS
    assert (p.salary_subcategory, p.instalment_subcategory) == (K.SALARY_SUBCATEGORY, K.INSTALMENT_SUBCATEGORY)
    assert production_params("2024-03-17", "2023-07-01").start_month == "2023-07-01"
