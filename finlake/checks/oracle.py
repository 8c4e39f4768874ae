"""Independent SQL oracles (DuckDB dialect) for the check queries.

Written from the semantics, not from the Spark plans: the finance views are
CTEs over the driver's tables, and each check is one SELECT over them. Money is
cast to decimal before summing, ratios are doubles rounded to 6 places, month
keys are ``yyyy-MM-01`` strings.
"""

from __future__ import annotations

# Parameters of the test mapping (same values as finlake.sources.views.Params).
AS_OF = "1999-01-01"
START_MONTH = "1998-01-01"

VIEWS = r"""
type_ranks AS (
  SELECT p_type, CAST(100 * dense_rank() OVER (ORDER BY p_type) AS BIGINT) AS parent_id
  FROM (SELECT DISTINCT p_type FROM part) tp
),
contas AS (SELECT c_custkey AS id, c_name AS nome FROM customer WHERE c_acctbal >= 0),
cartoes AS (SELECT s_suppkey AS id, s_name AS nome FROM supplier WHERE s_acctbal >= 0),
categorias AS (
  SELECT parent_id AS id, CAST(NULL AS VARCHAR) AS categoriaPai, p_type AS categoria,
         CASE WHEN p_type = 'PROMO' THEN 'Receitas' ELSE 'Despesas' END AS natureza
  FROM type_ranks
  UNION ALL
  SELECT parent_id + CAST(split_part(p_brand, '#', 2) AS BIGINT), p_type, p_brand,
         CASE WHEN p_type = 'PROMO' THEN 'Receitas' ELSE 'Despesas' END
  FROM (SELECT DISTINCT p_type, p_brand FROM part) tb JOIN type_ranks USING (p_type)
  UNION ALL SELECT -1, 'Transferências', 'Transferências', 'Transferências'
  UNION ALL SELECT -2, 'Não encontrado', 'Não encontrado', 'Não encontrado'
),
movimentos AS (
  SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS unique_id,
         l_orderkey AS id,
         o_custkey AS conta_id,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN l_suppkey END AS cartao_id,
         CASE WHEN (l_linenumber - 1) % 5 >= 3 THEN CAST(-1 AS BIGINT) ELSE parent_id END AS tipo_transacao_id,
         CASE WHEN (l_linenumber - 1) % 5 >= 3 THEN CAST(-1 AS BIGINT)
              ELSE parent_id + CAST(split_part(p_brand, '#', 2) AS BIGINT) END AS tipo_transacao_filho_id,
         CAST(l_shipdate AS DATE) AS data,
         CASE WHEN p_size <= 10
              THEN concat(p_name, ' (', CAST(l_linenumber AS VARCHAR), '/',
                          CAST(CAST(ceil(l_quantity / 5) AS INTEGER) AS VARCHAR), ')')
              ELSE p_name END AS descricao,
         CAST((l_linenumber - 1) % 5 AS INTEGER) AS tipo,
         CASE WHEN l_linestatus = 'F' THEN 'efetivado' ELSE 'pendente' END AS situacao,
         l_returnflag = 'R' AS ignorada,
         o_orderpriority = '5-LOW' AS fixa,
         CAST(CASE WHEN (l_linenumber - 1) % 5 IN (0, 4) THEN -l_extendedprice ELSE l_extendedprice END
              AS DECIMAL(18,2)) AS valor,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS valor_abs
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN type_ranks USING (p_type)
),
gold_categorias AS (
  SELECT id, categoriaPai AS categoria, categoria AS subcategoria, natureza,
         CASE WHEN categoriaPai IN ('SMALL', 'MEDIUM') THEN 'Estilo de Vida' ELSE categoriaPai END AS agrupador
  FROM categorias WHERE categoriaPai IS NOT NULL
),
orcamentos AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS data, p_type AS categoria, p_brand AS subcategoria,
         CAST(sum(l_quantity) * 1500 AS DECIMAL(18,2)) AS planejado,
         CAST(coalesce(sum(CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END), 0)
              AS DECIMAL(18,2)) AS efetivado,
         CAST(coalesce(sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END), 0)
              AS DECIMAL(18,2)) AS previsto
  FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE p_type <> 'PROMO'
  GROUP BY 1, 2, 3
),
gold_orcamentos AS (
  SELECT data_orcamento, categoria, subcategoria, planejado, consumido,
         CAST(CASE WHEN data_orcamento < DATE '1999-01-01' THEN 0
                   WHEN round(planejado - consumido, 2) < 0 THEN 0
                   ELSE round(planejado - consumido, 2) END AS DECIMAL(18,2)) AS saldo
  FROM (SELECT data AS data_orcamento, categoria, subcategoria, planejado,
               CAST(round(efetivado + previsto, 2) AS DECIMAL(18,2)) AS consumido
        FROM orcamentos) o
),
gold_transacoes AS (
  SELECT unique_id, id, data_transacao, descricao, tipo, situacao, conta, cartao, natureza, categoria,
         subcategoria, agrupador, valor, valor_abs, parcela_atual, total_parcelas,
         CAST((total_parcelas - parcela_atual) * valor_abs AS DECIMAL(18,2)) AS futuro_vendido,
         strftime(data_transacao, '%Y-%m-01') AS ano_mes
  FROM (
    SELECT t.unique_id, t.id, t.data AS data_transacao, t.descricao, t.tipo, t.situacao,
           ct.nome AS conta, crt.nome AS cartao, cat.natureza, cat.categoria, cat.subcategoria,
           cat.agrupador, t.valor, t.valor_abs,
           TRY_CAST(nullif(regexp_extract(t.descricao, '\((\d+)/(\d+)\)', 1), '') AS INTEGER) AS parcela_atual,
           TRY_CAST(nullif(regexp_extract(t.descricao, '\((\d+)/(\d+)\)', 2), '') AS INTEGER) AS total_parcelas
    FROM movimentos t
    JOIN contas ct ON t.conta_id = ct.id
    LEFT JOIN cartoes crt ON t.cartao_id = crt.id
    LEFT JOIN gold_categorias cat ON t.tipo_transacao_filho_id = cat.id
  ) x
),
calendario AS (
  SELECT CAST(d AS DATE) AS sk_data, strftime(CAST(d AS DATE), '%Y-%m-01') AS ano_mes
  FROM (
    SELECT unnest(generate_series(CAST(date_trunc('month', lo) AS DATE),
                                  CAST(strftime(hi, '%Y-12-31') AS DATE), INTERVAL 1 DAY)) AS d
    FROM (SELECT min(x) AS lo, max(x) AS hi
          FROM (SELECT data_transacao AS x FROM gold_transacoes
                UNION ALL SELECT data_orcamento FROM gold_orcamentos) u) b
    WHERE lo IS NOT NULL
  ) s
)
"""


def with_views(select: str) -> str:
    return "WITH " + VIEWS.strip() + "\n" + select.strip()


MART_SQL = {
    "gold_categories": "SELECT id, categoria, subcategoria, natureza, agrupador FROM gold_categorias",
    "gold_budgets": "SELECT * FROM gold_orcamentos",
    "gold_transactions": "SELECT * FROM gold_transacoes",
    "calendar": "SELECT sk_data, ano_mes FROM calendario",
    "account_balance": """
SELECT ano_mes, conta, cartao, resultado_mes,
       CAST(sum(resultado_mes) OVER (PARTITION BY conta ORDER BY ano_mes) AS DECIMAL(38,2)) AS saldo_conta,
       CASE WHEN cartao IS NOT NULL THEN resultado_mes END AS saldo_cartao
FROM (SELECT ano_mes, conta, cartao, CAST(sum(valor) AS DECIMAL(38,2)) AS resultado_mes
      FROM gold_transacoes WHERE situacao = 'efetivado' GROUP BY ano_mes, conta, cartao) m
""",
    "budget_balance": f"""
SELECT data_orcamento, agrupador, categoria, subcategoria,
       CAST(sum(orcado_subcategoria) OVER (PARTITION BY data_orcamento, agrupador) AS DECIMAL(38,2)) AS orcado_agrupador,
       CAST(sum(orcado_subcategoria) OVER (PARTITION BY data_orcamento, categoria) AS DECIMAL(38,2)) AS orcado_categoria,
       orcado_subcategoria,
       CAST(sum(real_subcategoria) OVER (PARTITION BY data_orcamento, agrupador) AS DECIMAL(38,2)) AS real_agrupador,
       CAST(sum(real_subcategoria) OVER (PARTITION BY data_orcamento, categoria) AS DECIMAL(38,2)) AS real_categoria,
       real_subcategoria,
       CAST(CASE WHEN data_orcamento < DATE '{AS_OF}' THEN 0
                 ELSE greatest(0, orcado_subcategoria - real_subcategoria) END AS DECIMAL(18,2)) AS saldo_orcamento
FROM (SELECT o.data_orcamento, c.agrupador, o.categoria, o.subcategoria,
             o.planejado AS orcado_subcategoria, o.consumido AS real_subcategoria
      FROM gold_orcamentos o
      LEFT JOIN (SELECT agrupador, categoria, subcategoria FROM gold_categorias) c
        ON o.categoria = c.categoria AND o.subcategoria = c.subcategoria) b
""",
    "budget_planning": """
SELECT ano_mes, agrupador, categoria, subcategoria,
       CAST(coalesce(valor_transacao, 0) AS DECIMAL(38,2)) AS valor_mes_atual,
       CAST(coalesce(lag(valor_transacao) OVER (PARTITION BY agrupador, categoria, subcategoria ORDER BY ano_mes), 0)
            AS DECIMAL(38,2)) AS valor_mes_anterior,
       coalesce(round(CAST(sum(valor_transacao) OVER (PARTITION BY agrupador, categoria, subcategoria ORDER BY ano_mes
                ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS DOUBLE) / 3.0, 6), 0.0) AS media_3_meses,
       coalesce(round(CAST(sum(valor_transacao) OVER (PARTITION BY agrupador, categoria, subcategoria ORDER BY ano_mes
                ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS DOUBLE) / 6.0, 6), 0.0) AS media_6_meses,
       CAST(coalesce(valor_orcamento, 0) AS DECIMAL(18,2)) AS valor_orcamento,
       CAST(coalesce(saldo_orcamento, 0) AS DECIMAL(18,2)) AS saldo_orcamento
FROM (SELECT DISTINCT ano_mes FROM calendario) cal
CROSS JOIN (SELECT agrupador, categoria, subcategoria FROM gold_categorias WHERE natureza = 'Despesas') cat
LEFT JOIN (SELECT ano_mes, agrupador, categoria, subcategoria, sum(valor_abs) AS valor_transacao
           FROM gold_transacoes GROUP BY ano_mes, agrupador, categoria, subcategoria) trs
  USING (ano_mes, agrupador, categoria, subcategoria)
LEFT JOIN (SELECT strftime(data_orcamento, '%Y-%m-01') AS ano_mes, categoria, subcategoria,
                  planejado AS valor_orcamento, saldo AS saldo_orcamento FROM gold_orcamentos) orc
  USING (ano_mes, categoria, subcategoria)
""",
    "daily_cashflow": """
SELECT sk_data, total_transacoes, total_orcamento, total_dia, fluxo_de_caixa,
       CAST(CASE WHEN fluxo_de_caixa < 0 THEN abs(fluxo_de_caixa) * CAST(0.0035 AS DECIMAL(10,6)) ELSE 0 END
            AS DECIMAL(38,6)) AS juros_projetado
FROM (
  SELECT sk_data, total_transacoes, total_orcamento, total_dia,
         CAST(sum(total_dia) OVER (ORDER BY sk_data ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              AS DECIMAL(38,2)) AS fluxo_de_caixa
  FROM (
    SELECT c.sk_data,
           CAST(coalesce(t.total_transacoes, 0) AS DECIMAL(38,2)) AS total_transacoes,
           CAST(coalesce(o.total_orcamento, 0) AS DECIMAL(38,2)) AS total_orcamento,
           CAST(coalesce(t.total_transacoes, 0) - coalesce(o.total_orcamento, 0) AS DECIMAL(38,2)) AS total_dia
    FROM calendario c
    LEFT JOIN (SELECT data_transacao AS sk_data, sum(valor) AS total_transacoes
               FROM gold_transacoes GROUP BY data_transacao) t ON c.sk_data = t.sk_data
    LEFT JOIN (SELECT data_orcamento AS sk_data, sum(saldo) AS total_orcamento
               FROM gold_orcamentos GROUP BY data_orcamento) o ON c.sk_data = o.sk_data
  ) d
) r
""",
    "monthly_cashflow": """
SELECT ano_mes, total_transacoes, total_orcamento, total_mes,
       CAST(sum(total_mes) OVER (ORDER BY ano_mes ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS DECIMAL(38,2)) AS fluxo_de_caixa
FROM (
  SELECT c.ano_mes,
         CAST(coalesce(t.total_transacoes, 0) AS DECIMAL(38,2)) AS total_transacoes,
         CAST(coalesce(o.total_orcamento, 0) AS DECIMAL(38,2)) AS total_orcamento,
         CAST(coalesce(t.total_transacoes, 0) - coalesce(o.total_orcamento, 0) AS DECIMAL(38,2)) AS total_mes
  FROM (SELECT DISTINCT ano_mes FROM calendario) c
  LEFT JOIN (SELECT ano_mes, sum(valor) AS total_transacoes FROM gold_transacoes GROUP BY ano_mes) t
    ON c.ano_mes = t.ano_mes
  LEFT JOIN (SELECT strftime(data_orcamento, '%Y-%m-01') AS ano_mes, sum(saldo) AS total_orcamento
             FROM gold_orcamentos GROUP BY 1) o ON c.ano_mes = o.ano_mes
) m
""",
    "income_vs_outcome": f"""
SELECT ano_mes,
       CAST(sum(CASE WHEN natureza = 'Despesas' THEN valor_abs ELSE 0 END) AS DECIMAL(38,2)) AS despesas,
       CAST(sum(CASE WHEN natureza = 'Receitas' THEN valor_abs ELSE 0 END) AS DECIMAL(38,2)) AS receitas
FROM gold_transacoes
WHERE ano_mes >= '{START_MONTH}' AND natureza IN ('Despesas', 'Receitas')
GROUP BY ano_mes
""",
    "main_kpis": """
SELECT c.ano_mes,
       CAST(t.total_salario AS DECIMAL(38,2)) AS total_salario,
       CAST(t.total_parcelas AS DECIMAL(38,2)) AS total_parcelas,
       CAST(t.total_receitas AS DECIMAL(38,2)) AS total_receitas,
       CAST(t.total_despesas AS DECIMAL(38,2)) AS total_despesas,
       round(CAST(t.total_estilo_de_vida AS DOUBLE) / nullif(CAST(t.total_salario AS DOUBLE), 0), 6) AS prc_estilo_de_vida,
       round(CAST(t.parcelas_mes_atual AS DOUBLE) / nullif(CAST(t.total_salario AS DOUBLE), 0), 6) AS prc_parcelas,
       CAST(o.total_orcamento AS DECIMAL(38,2)) AS total_orcamento,
       CAST(t.total_receitas - t.total_despesas - o.total_orcamento AS DECIMAL(38,2)) AS performance_mes,
       round(CAST(t.total_estilo_de_vida + o.orcado_estilo_vida AS DOUBLE)
             / nullif(CAST(t.total_salario AS DOUBLE), 0), 6) AS prc_prj_estilo_vida
FROM (SELECT DISTINCT ano_mes FROM calendario) c
LEFT JOIN (
  SELECT ano_mes,
         sum(CASE WHEN subcategoria = 'Brand#1' THEN valor_abs END) AS total_salario,
         sum(CASE WHEN subcategoria = 'Brand#2' THEN valor_abs END) AS parcelas_mes_atual,
         sum(CASE WHEN subcategoria = 'Brand#2' THEN futuro_vendido END) AS total_parcelas,
         sum(CASE WHEN agrupador = 'Estilo de Vida' THEN valor_abs END) AS total_estilo_de_vida,
         sum(CASE WHEN natureza = 'Receitas' THEN valor_abs END) AS total_receitas,
         sum(CASE WHEN natureza = 'Despesas' THEN valor_abs END) AS total_despesas
  FROM gold_transacoes GROUP BY ano_mes) t ON c.ano_mes = t.ano_mes
LEFT JOIN (
  SELECT data_orcamento, sum(orcado_estilo_vida) AS orcado_estilo_vida, sum(total_orcamento) AS total_orcamento
  FROM (SELECT o.data_orcamento, g.agrupador,
               sum(CASE WHEN g.agrupador = 'Estilo de Vida' THEN o.saldo END) AS orcado_estilo_vida,
               sum(o.saldo) AS total_orcamento
        FROM gold_orcamentos o JOIN gold_categorias g
          ON o.categoria = g.categoria AND o.subcategoria = g.subcategoria
        GROUP BY o.data_orcamento, g.agrupador) x
  GROUP BY data_orcamento) o ON c.ano_mes = strftime(o.data_orcamento, '%Y-%m-01')
""",
}


def oracle_sql() -> dict[str, str]:
    out = {k: with_views(v) for k, v in MART_SQL.items()}
    from finlake.checks import oracle_ops
    out.update({k: with_views(v) for k, v in oracle_ops.OPS_SQL.items()})
    return out
