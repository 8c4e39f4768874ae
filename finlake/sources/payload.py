"""Payload flattening: API JSON documents -> rows (DataFrame transforms).

Input is a DataFrame with one JSON document per row (a page of an API
response); every operator parses with ``from_json`` against a pinned schema
and flattens with ``explode``, so pages are processed where they are read and
no page is ever combined with another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake import constants as K
from finlake.functions.dates import iso_to_date
from finlake.functions.money import money
from finlake.functions.text import first_truthy, last_token

CARDS = "array<struct<id:bigint,nome:string>>"
ACCOUNTS = "array<struct<id:bigint,name:string>>"
CATEGORIES = "array<struct<id:bigint,tipoCategoriaPaiId:bigint,nome:string,arquivado:boolean>>"
MOVEMENT = ("struct<uniqueId:string,despesaId:bigint,receitaId:bigint,transferenciaId:bigint,"
            "contaId:bigint,cartaoCreditoId:bigint,tipoMovimentacao:int,tipoDespesaId:bigint,"
            "tipoReceitaId:bigint,subcategoriaId:bigint,dataMovimentacao:string,"
            "descricaoValidadoRepeticao:string,valor:decimal(18,2),status:int,ignorada:boolean,"
            "isMovimentacaoFixa:boolean>")
MOVEMENTS = f"struct<movimentacoes:array<{MOVEMENT}>>"
BUDGET_SUB = ("struct<category:struct<name:string>,planned:decimal(18,2),"
              "paidExpenses:decimal(18,2),pendingExpenses:decimal(18,2)>")
BUDGET = f"struct<categories:array<struct<category:struct<name:string>,subCategories:array<{BUDGET_SUB}>>>>"

MOVEMENT_COLUMNS = ["unique_id", "id", "conta_id", "cartao_id", "tipo_transacao_id",
                    "tipo_transacao_filho_id", "data", "descricao", "tipo", "situacao",
                    "ignorada", "fixa", "valor", "valor_abs"]


def _items(df: DataFrame, json_col: str, schema: str, keep=()) -> DataFrame:
    return df.select(*keep, F.explode(F.from_json(F.col(json_col), schema)).alias("_i"))


def cards(df: DataFrame, json_col: str = "payload") -> DataFrame:
    """Card list -> ``(id, nome)``."""
    return _items(df, json_col, CARDS).select("_i.id", "_i.nome")


def accounts(df: DataFrame, json_col: str = "payload") -> DataFrame:
    """Account list -> ``(id, nome)``; the name is the last ``.`` token, trimmed."""
    return _items(df, json_col, ACCOUNTS).select(
        F.col("_i.id").alias("id"), last_token(F.col("_i.name")).alias("nome"))


def categories(income: DataFrame, expense: DataFrame, json_col: str = "payload",
               sentinels=K.SENTINEL_CATEGORIES) -> DataFrame:
    """Income + expense category lists -> ``(id, categoriaPai, categoria, natureza)``.

    The two lists are tagged with their nature and unioned with the sentinel
    categories; the parent name is resolved by id over *all* categories and the
    archived ones are dropped only afterwards, so an active child of an archived
    parent keeps its parent's name.
    """
    def tagged(df, nature):
        return _items(df, json_col, CATEGORIES).select(
            F.col("_i.id").alias("id"), F.col("_i.tipoCategoriaPaiId").alias("pai_id"),
            F.col("_i.nome").alias("categoria"), F.lit(nature).alias("natureza"),
            F.col("_i.arquivado").alias("arquivado"))

    spark = income.sparkSession
    rows = [F.struct(F.lit(i).cast("bigint").alias("id"), F.lit(p).cast("bigint").alias("pai_id"),
                     F.lit(n).alias("categoria"), F.lit(nat).alias("natureza"),
                     F.lit(False).alias("arquivado"))
            for i, p, n, nat in sentinels]
    fixed = spark.range(1).select(F.inline(F.array(*rows)))
    allc = tagged(income, K.NATURE_INCOME).unionByName(tagged(expense, K.NATURE_EXPENSE)).unionByName(fixed)
    parents = allc.select(F.col("id").alias("_pid"), F.col("categoria").alias("categoriaPai"))
    j = allc.join(parents, allc.pai_id == parents._pid, "left")
    return (j.where(~F.coalesce(F.col("arquivado"), F.lit(False)))
            .select("id", "categoriaPai", "categoria", "natureza"))


def movements(df: DataFrame, json_col: str = "payload", status=None) -> DataFrame:
    """Movement pages -> silver transaction rows.

    Keeps movement types below 5; ``status`` (a list) selects the settled (0) or
    pending (1) feed from one shared transform.
    """
    m = (df.select(F.explode(F.from_json(F.col(json_col), MOVEMENTS)["movimentacoes"]).alias("m"))
         .select("m.*"))
    m = m.where(F.col("tipoMovimentacao") < 5)
    if status is not None:
        m = m.where(F.col("status").isin(*list(status)))
    tipo = F.col("tipoMovimentacao")
    transfer = tipo >= K.TRANSFER_MIN_TYPE
    valor = F.col("valor")
    st = F.col("status")
    return m.select(
        F.col("uniqueId").alias("unique_id"),
        first_truthy("despesaId", "receitaId", "transferenciaId").alias("id"),
        F.col("contaId").alias("conta_id"),
        F.col("cartaoCreditoId").alias("cartao_id"),
        F.when(transfer, F.lit(-1).cast("bigint"))
        .when(F.col("tipoDespesaId") > 0, F.col("tipoDespesaId"))
        .otherwise(F.col("tipoReceitaId")).alias("tipo_transacao_id"),
        F.when(transfer, F.lit(-1).cast("bigint"))
        .otherwise(F.coalesce(F.col("subcategoriaId"), F.lit(0).cast("bigint"))).alias("tipo_transacao_filho_id"),
        iso_to_date("dataMovimentacao").alias("data"),
        F.col("descricaoValidadoRepeticao").alias("descricao"),
        tipo.alias("tipo"),
        F.when(st == 0, F.lit(K.STATUS_SETTLED)).when(st >= 1, F.lit(K.STATUS_PENDING))
        .otherwise(F.lit(K.STATUS_UNKNOWN)).alias("situacao"),
        F.col("ignorada"),
        F.col("isMovimentacaoFixa").alias("fixa"),
        money(F.when(tipo.isin(*K.NEGATIVE_TYPES), -valor).otherwise(valor)).alias("valor"),
        money(F.abs(valor)).alias("valor_abs"),
    )


def budgets(df: DataFrame, json_col: str = "payload", month_col: str = "data") -> DataFrame:
    """Monthly budget documents -> ``(data, categoria, subcategoria, planejado, efetivado, previsto)``.

    Two inner explodes (category, then sub-category): a placeholder category
    with an empty sub-category list yields no row. A planned amount equal to
    the placeholder ``0.01`` means "no budget" and becomes 0.
    """
    cats = df.select(F.col(month_col).alias("data"),
                     F.explode(F.from_json(F.col(json_col), BUDGET)["categories"]).alias("c"))
    subs = cats.select("data", F.col("c.category.name").alias("categoria"),
                       F.explode("c.subCategories").alias("s"))
    planned = F.col("s.planned")
    return subs.select(
        "data", "categoria", F.col("s.category.name").alias("subcategoria"),
        money(F.when(planned == F.lit(K.BUDGET_PLACEHOLDER).cast("decimal(18,2)"), F.lit(0))
              .otherwise(planned)).alias("planejado"),
        money("s.paidExpenses").alias("efetivado"),
        money("s.pendingExpenses").alias("previsto"),
    )
