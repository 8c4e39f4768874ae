"""

Money is ``decimal(18,2)`` per row and ``decimal(38,2)`` once aggregated;
ratios and trailing means are doubles; month keys are ``yyyy-MM-01`` text.
Input (bronze/silver) schemas live with the table specs in ``specs.py``.
"""

from __future__ import annotations

from pyspark.sql.types import StructType, _parse_datatype_string

GOLD = {
    "categorias": "id bigint, categoria string, subcategoria string, natureza string, agrupador string",
    "orcamentos": ("data_orcamento date, categoria string, subcategoria string, planejado decimal(18,2), "
                   "consumido decimal(18,2), saldo decimal(18,2)"),
    "transacoes": ("unique_id string, id bigint, data_transacao date, descricao string, tipo int, "
                   "situacao string, conta string, cartao string, natureza string, categoria string, "
                   "subcategoria string, agrupador string, valor decimal(18,2), valor_abs decimal(18,2), "
                   "parcela_atual int, total_parcelas int, futuro_vendido decimal(18,2), ano_mes string"),
    "calendar": "sk_data date, ano_mes string",
}

MARTS = {
    "account_balance": ("ano_mes string, conta string, cartao string, resultado_mes decimal(38,2), "
                        "saldo_conta decimal(38,2), saldo_cartao decimal(38,2)"),
    "budget_balance": ("data_orcamento date, agrupador string, categoria string, subcategoria string, "
                       "orcado_agrupador decimal(38,2), orcado_categoria decimal(38,2), "
                       "orcado_subcategoria decimal(18,2), real_agrupador decimal(38,2), "
                       "real_categoria decimal(38,2), real_subcategoria decimal(18,2), "
                       "saldo_orcamento decimal(18,2)"),
    "budget_planning": ("ano_mes string, agrupador string, categoria string, subcategoria string, "
                        "valor_mes_atual decimal(38,2), valor_mes_anterior decimal(38,2), "
                        "media_3_meses double, media_6_meses double, valor_orcamento decimal(18,2), "
                        "saldo_orcamento decimal(18,2)"),
    "daily_cashflow": ("sk_data date, total_transacoes decimal(38,2), total_orcamento decimal(38,2), "
                       "total_dia decimal(38,2), fluxo_de_caixa decimal(38,2), juros_projetado decimal(38,6)"),
    "monthly_cashflow": ("ano_mes string, total_transacoes decimal(38,2), total_orcamento decimal(38,2), "
                         "total_mes decimal(38,2), fluxo_de_caixa decimal(38,2)"),
    "income_vs_outcome": "ano_mes string, despesas decimal(38,2), receitas decimal(38,2)",
    "main_kpis": ("ano_mes string, total_salario decimal(38,2), total_parcelas decimal(38,2), "
                  "total_receitas decimal(38,2), total_despesas decimal(38,2), prc_estilo_de_vida double, "
                  "prc_parcelas double, total_orcamento decimal(38,2), performance_mes decimal(38,2), "
                  "prc_prj_estilo_vida double"),
}


# Tables kept beside the gold tables and read by the marts and by the next run.
SUPPORT = {
    "contas": "id bigint, nome string",
    "cartoes": "id bigint, nome string",
    "transacoes_categoria": ("ano_mes string, natureza string, agrupador string, categoria string, subcategoria string, "
                             "valor decimal(28,2), valor_abs decimal(28,2), futuro_vendido decimal(28,2)"),
    "transacoes_diario": "data_transacao date, ano_mes string, valor decimal(28,2)",
    "transacoes_indice": "dimensao string, id bigint, ano_mes string",
}


def declared_schema(layer: str, table: str) -> StructType | None:
    """Columns of a table that may have no data yet; None where none are declared."""
    from finlake.specs import SPECS_BY_NAME
    if layer in ("bronze", "silver"):
        return SPECS_BY_NAME[table].bronze_columns() if table in SPECS_BY_NAME else None
    ddl = ({**GOLD, **SUPPORT} if layer == "gold" else MARTS).get(table)
    return struct(ddl) if ddl else None


def struct(ddl: str) -> StructType:
    return _parse_datatype_string(ddl)


def shape(schema: StructType) -> list[tuple[str, str]]:
    """(name, type) pairs, ignoring nullability."""
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]
