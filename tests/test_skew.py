"""One account holding a third of all movements: results stay whole and
exact, and the plans reduce the hot key before any shuffle."""

from decimal import Decimal

from pyspark.sql import functions as F

from finlake.operators.cdc import scd1_upsert
from finlake.plans import analytics, gold
from finlake.session import scale_conf
from finlake.sources import views
from finlake.sources.views import TEST_PARAMS, Tables
from tests.conftest import SF0001, rows


def _skewed_movements(t):
    mov = views.movements(t)
    # every third order is booked on the same (hot) account
    hot = mov.agg(F.min("conta_id")).first()[0]
    return mov.withColumn("conta_id", F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("conta_id"))), hot


def test_hot_account_results_are_whole(spark):
    t = Tables(spark, SF0001)
    mov, hot = _skewed_movements(t)
    accounts = views.accounts(t).unionByName(
        spark.range(1).select(F.lit(hot).alias("id"), F.lit("hot").alias("nome"))).dropDuplicates(["id"])
    cat = gold.categories(views.categories(t), TEST_PARAMS.lifestyle_parents)
    prev = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                                                  "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
                                                  "spark.sql.autoBroadcastJoinThreshold")}
    # force shuffle joins and an aggressive skew split
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    try:
        trs = gold.transactions(mov, accounts, views.cards(t), cat)
        n = trs.count()
        expected = mov.join(accounts, mov.conta_id == accounts.id).count()
        assert n == expected
        share = trs.where(F.col("conta") == F.lit(
            accounts.where(F.col("id") == hot).first()["nome"])).count()
        assert share * 4 > n                                   # the hot key really is hot
        bal = analytics.account_balance(trs)
        total = bal.agg(F.sum("resultado_mes")).first()[0]
        direct = trs.where(F.col("situacao") == "efetivado").agg(F.sum("valor")).first()[0]
        assert Decimal(total) == Decimal(direct)
    finally:
        for k, v in prev.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_scd1_hot_key_reduced_map_side(spark):
    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    out = scd1_upsert(hot, ["user_id", "event_type"], ["ts", "event_id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan                            # combined before the shuffle
    exp = hot.groupBy("user_id", "event_type").agg(F.max(F.struct("ts", "event_id")).alias("m"))
    assert rows(out.select("user_id", "event_type", "ts", "event_id")) == \
        rows(exp.select("user_id", "event_type", "m.ts", "m.event_id"))


def test_scale_conf_for_100tb():
    c = scale_conf(100 << 40, cores=8000)
    assert c["spark.sql.files.maxPartitionBytes"] == "1049m"
    assert int(c["spark.sql.shuffle.partitions"]) == 24000
    assert c["spark.sql.autoBroadcastJoinThreshold"] == "64m"
