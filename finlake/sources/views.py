"""Finance views over the driver's test tables.

The driver ships TPC-H style tables, not finance payloads. These views give the
silver-layer shapes the gold and analytics plans consume, derived from whole
tables so the work grows with the scale factor:

* accounts   (contas)      customers in credit (``c_acctbal >= 0``); customers
                           with a negative balance are closed accounts, absent
                           from the account list, so the inner account join
                           drops their movements.
* cards      (cartoes)     suppliers in credit.
* categories (categorias)  parents = part types, children = (type, brand),
                           PROMO is income, everything else expense, plus the two
                           sentinel categories.
* movements                lineitem x orders x part; type = line number - 1 kept
                           below 5, card only on urgent/high priority orders,
                           instalment text on small parts, F settled / O pending.
* budgets    (orcamentos)  month x type x brand over non-PROMO lineitem.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finlake import constants as K
from finlake.functions.dates import month_start
from finlake.functions.money import money
from finlake.params import Params


# Parameters over the test tables.
TEST_PARAMS = Params(as_of="1999-01-01", start_month="1998-01-01", lifestyle_parents=("SMALL", "MEDIUM"),
                     salary_subcategory="Brand#1", instalment_subcategory="Brand#2", income_parent="PROMO")


class Tables:
    """Lazy parquet loader for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def accounts(t: Tables) -> DataFrame:
    return (t("customer").where(F.col("c_acctbal") >= 0)
            .select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nome")))


def cards(t: Tables) -> DataFrame:
    return (t("supplier").where(F.col("s_acctbal") >= 0)
            .select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("nome")))


def type_ranks(t: Tables) -> DataFrame:
    """Parent category id per part type: 100 x dense rank of the type name.

    The window runs over the distinct type names only (the category domain,
    a handful of rows), never over the parts themselves.
    """
    types = t("part").select("p_type").distinct()
    return types.select("p_type", (F.dense_rank().over(Window.orderBy("p_type")) * 100)
                        .cast("bigint").alias("parent_id"))


def _brand_no():
    return F.substring_index(F.col("p_brand"), "#", -1).cast("bigint")


def _nature(p: Params = TEST_PARAMS):
    return (F.when(F.col("p_type") == p.income_parent, F.lit(K.NATURE_INCOME))
            .otherwise(F.lit(K.NATURE_EXPENSE)))


def categories(t: Tables, p: Params = TEST_PARAMS) -> DataFrame:
    """Silver categories ``(id, categoriaPai, categoria, natureza)``."""
    ranks = type_ranks(t)
    parents = ranks.select(F.col("parent_id").alias("id"),
                           F.lit(None).cast("string").alias("categoriaPai"),
                           F.col("p_type").alias("categoria"), _nature(p).alias("natureza"))
    children = (t("part").select("p_type", "p_brand").distinct().join(ranks, "p_type")
                .select((F.col("parent_id") + _brand_no()).alias("id"),
                        F.col("p_type").alias("categoriaPai"),
                        F.col("p_brand").alias("categoria"), _nature(p).alias("natureza")))
    return parents.unionByName(children).unionByName(sentinel_rows(t.spark))


def sentinel_rows(spark: SparkSession) -> DataFrame:
    """The fixed sentinel categories as a JVM-side inline table (own parent)."""
    rows = [F.struct(F.lit(i).cast("bigint").alias("id"), F.lit(n).alias("categoriaPai"),
                     F.lit(n).alias("categoria"), F.lit(nat).alias("natureza"))
            for i, _, n, nat in K.SENTINEL_CATEGORIES]
    return spark.range(1).select(F.inline(F.array(*rows)))


def movements(t: Tables) -> DataFrame:
    """All movements (settled and pending) in the silver transaction shape."""
    li = t("lineitem")
    o = t("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    p = t("part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size").join(type_ranks(t), "p_type")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    tipo = (F.col("l_linenumber") - 1) % 5   # every line is a movement of one of the five types
    transfer = tipo >= K.TRANSFER_MIN_TYPE
    instal = F.concat(F.col("p_name"), F.lit(" ("), F.col("l_linenumber").cast("string"), F.lit("/"),
                      F.ceil(F.col("l_quantity") / 5).cast("int").cast("string"), F.lit(")"))
    return j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("unique_id"),
        F.col("l_orderkey").alias("id"),
        F.col("o_custkey").alias("conta_id"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("l_suppkey")).alias("cartao_id"),
        F.when(transfer, F.lit(-1).cast("bigint")).otherwise(F.col("parent_id")).alias("tipo_transacao_id"),
        F.when(transfer, F.lit(-1).cast("bigint")).otherwise(F.col("parent_id") + _brand_no())
        .alias("tipo_transacao_filho_id"),
        F.col("l_shipdate").cast("date").alias("data"),
        F.when(F.col("p_size") <= 10, instal).otherwise(F.col("p_name")).alias("descricao"),
        tipo.cast("int").alias("tipo"),
        F.when(F.col("l_linestatus") == "F", F.lit(K.STATUS_SETTLED))
        .otherwise(F.lit(K.STATUS_PENDING)).alias("situacao"),
        (F.col("l_returnflag") == "R").alias("ignorada"),
        (F.col("o_orderpriority") == "5-LOW").alias("fixa"),
        money(F.when(tipo.isin(*K.NEGATIVE_TYPES), -F.col("l_extendedprice"))
              .otherwise(F.col("l_extendedprice"))).alias("valor"),
        money(F.col("l_extendedprice")).alias("valor_abs"),
    )


def settled(t: Tables) -> DataFrame:
    return movements(t).where(F.col("situacao") == K.STATUS_SETTLED)


def pending(t: Tables) -> DataFrame:
    return movements(t).where(F.col("situacao") == K.STATUS_PENDING)


def budgets(t: Tables, p: Params = TEST_PARAMS) -> DataFrame:
    """Silver budgets ``(data, categoria, subcategoria, planejado, efetivado, previsto)``."""
    li = t("lineitem").select("l_partkey", "l_quantity", "l_extendedprice", "l_linestatus", "l_shipdate")
    pt = t("part").where(F.col("p_type") != p.income_parent).select("p_partkey", "p_type", "p_brand")
    j = li.join(pt, li.l_partkey == pt.p_partkey)
    amt = money("l_extendedprice")
    return (j.groupBy(month_start("l_shipdate").alias("data"),
                      F.col("p_type").alias("categoria"), F.col("p_brand").alias("subcategoria"))
            .agg(money(F.sum("l_quantity") * 1500).alias("planejado"),
                 money(F.coalesce(F.sum(F.when(F.col("l_linestatus") == "F", amt)), F.lit(0))).alias("efetivado"),
                 money(F.coalesce(F.sum(F.when(F.col("l_linestatus") == "O", amt)), F.lit(0))).alias("previsto")))
