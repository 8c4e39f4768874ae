"""API-shaped JSON payload pages built by Spark from the driver's tables.

Each page groups a bounded number of items (the lines of one order, the
categories of one part type, the cards of one 100-id page, the budget lines of
one month), mirroring how an API pages its responses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.functions.money import money
from finlake.sources import views
from finlake.sources.views import Tables


def card_pages(t: Tables) -> DataFrame:
    s = t("supplier")
    return (s.groupBy(F.floor(F.col("s_suppkey") / 100).alias("page"))
            .agg(F.to_json(F.collect_list(F.struct(F.col("s_suppkey").alias("id"),
                                                   F.col("s_name").alias("nome"),
                                                   F.col("s_acctbal").alias("saldo")))).alias("payload")))


def account_name():
    """Bank-style display name: ``<nation>. <customer>``; building-segment
    accounts carry a trailing dot (their last token is empty)."""
    c = F.col
    return (F.when(c("c_mktsegment") == "BUILDING", F.concat(c("c_name"), F.lit(".")))
            .otherwise(F.concat(F.lit("NATION_"), c("c_nationkey").cast("string"), F.lit(". "), c("c_name"))))


def account_pages(t: Tables) -> DataFrame:
    c = t("customer")
    return (c.groupBy(F.floor(F.col("c_custkey") / 100).alias("page"))
            .agg(F.to_json(F.collect_list(F.struct(F.col("c_custkey").alias("id"),
                                                   account_name().alias("name")))).alias("payload")))


def category_items(t: Tables) -> DataFrame:
    """Category items ``(p_type, id, tipoCategoriaPaiId, nome, arquivado)``.

    Parents: part types (parent id 0 = none), ECONOMY is archived. Children:
    (type, brand) pairs, brands above 22 archived.
    """
    ranks = views.type_ranks(t)
    parents = ranks.select("p_type", F.col("parent_id").alias("id"),
                           F.lit(0).cast("bigint").alias("tipoCategoriaPaiId"),
                           F.col("p_type").alias("nome"),
                           (F.col("p_type") == "ECONOMY").alias("arquivado"))
    brand = F.substring_index(F.col("p_brand"), "#", -1).cast("bigint")
    children = (t("part").select("p_type", "p_brand").distinct().join(ranks, "p_type")
                .select("p_type", (F.col("parent_id") + brand).alias("id"),
                        F.col("parent_id").alias("tipoCategoriaPaiId"),
                        F.col("p_brand").alias("nome"), (brand > 22).alias("arquivado")))
    return parents.unionByName(children)


def category_pages(t: Tables, income: bool, income_parent: str = "PROMO") -> DataFrame:
    items = category_items(t)
    cond = F.col("p_type") == income_parent
    items = items.where(cond if income else ~cond)
    return (items.groupBy("p_type")
            .agg(F.to_json(F.collect_list(F.struct("id", "tipoCategoriaPaiId", "nome", "arquivado")))
                 .alias("payload")))


def movement_items(t: Tables) -> DataFrame:
    """One movement object per lineitem (all seven line numbers; the
    flattening keeps types below 5)."""
    li = t("lineitem")
    o = t("orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    p = (t("part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
         .join(views.type_ranks(t), "p_type"))
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    c = F.col
    tipo = c("l_linenumber") - 1
    key = c("l_orderkey")
    promo = c("p_type") == "PROMO"
    brand = F.substring_index(c("p_brand"), "#", -1).cast("bigint")
    instal = F.concat(c("p_name"), F.lit(" ("), c("l_linenumber").cast("string"), F.lit("/"),
                      F.ceil(c("l_quantity") / 5).cast("int").cast("string"), F.lit(")"))
    return j.select(
        c("l_orderkey").alias("page"),
        F.struct(
            F.concat_ws("-", key.cast("string"), c("l_linenumber").cast("string")).alias("uniqueId"),
            F.when(tipo == 0, key).otherwise(F.lit(0).cast("bigint")).alias("despesaId"),
            F.when(tipo.isin(1, 2), key).alias("receitaId"),
            F.when(tipo >= 3, key).alias("transferenciaId"),
            c("o_custkey").alias("contaId"),
            F.when(c("o_orderpriority").isin("1-URGENT", "2-HIGH"), c("l_suppkey")).alias("cartaoCreditoId"),
            tipo.cast("int").alias("tipoMovimentacao"),
            F.when(~promo, c("parent_id")).otherwise(F.lit(0).cast("bigint")).alias("tipoDespesaId"),
            F.when(promo, c("parent_id")).otherwise(F.lit(0).cast("bigint")).alias("tipoReceitaId"),
            F.when(c("p_size") <= 45, c("parent_id") + brand).alias("subcategoriaId"),
            F.date_format(c("l_shipdate"), "yyyy-MM-dd'T'HH:mm:ss").alias("dataMovimentacao"),
            F.when(c("p_size") <= 10, instal).otherwise(c("p_name")).alias("descricaoValidadoRepeticao"),
            money("l_extendedprice").alias("valor"),
            F.when((c("o_orderstatus") == "P") & (c("l_linestatus") == "O"), F.lit(-1))
            .when(c("l_linestatus") == "F", F.lit(0)).otherwise(F.lit(1)).alias("status"),
            (c("l_returnflag") == "R").alias("ignorada"),
            (c("o_orderpriority") == "5-LOW").alias("isMovimentacaoFixa"),
        ).alias("m"))


def movement_pages(t: Tables) -> DataFrame:
    """One page per order: ``{"movimentacoes": [...]}`` (at most seven lines)."""
    return (movement_items(t).groupBy("page")
            .agg(F.to_json(F.struct(F.collect_list("m").alias("movimentacoes"))).alias("payload")))


PLACEHOLDER_BELOW = 15000  # planned amounts under this are sent as the 0.01 "no budget" marker


def budget_pages(t: Tables) -> DataFrame:
    """One budget document per month; the income type is sent as a placeholder
    category with an empty sub-category list (it yields no rows)."""
    b = views.budgets(t)
    planned = (F.when(F.col("planejado") < PLACEHOLDER_BELOW, F.lit("0.01").cast("decimal(18,2)"))
               .otherwise(F.col("planejado")))
    sub = F.struct(F.struct(F.col("subcategoria").alias("name")).alias("category"),
                   planned.alias("planned"), F.col("efetivado").alias("paidExpenses"),
                   F.col("previsto").alias("pendingExpenses"))
    cats = b.groupBy("data", "categoria").agg(F.collect_list(sub).alias("subCategories"))
    empty = F.expr("filter(array(named_struct('category', named_struct('name', ''), "
                   "'planned', CAST(0 AS DECIMAL(18,2)), 'paidExpenses', CAST(0 AS DECIMAL(18,2)), "
                   "'pendingExpenses', CAST(0 AS DECIMAL(18,2)))), x -> false)")
    holders = (b.select("data").distinct()
               .select("data", F.lit("PROMO").alias("categoria"), empty.alias("subCategories")))
    cat = F.struct(F.struct(F.col("categoria").alias("name")).alias("category"), "subCategories")
    return (cats.unionByName(holders).groupBy("data")
            .agg(F.to_json(F.struct(F.collect_list(cat).alias("categories"))).alias("payload")))


def order_months(t: Tables) -> DataFrame:
    """Distinct extraction reference dates (order dates)."""
    return t("orders").select(F.col("o_orderdate").cast("date").alias("refdate")).distinct()

