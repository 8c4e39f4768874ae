"""Oracle SQL (DuckDB) for the operator-level checks.

Every statement is appended to the finance-view CTEs of ``oracle.VIEWS``.
"""

from __future__ import annotations

_SCD1_EVENTS = """
SELECT event_id, ts, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
"""

_LATEST_EVENTS = """
SELECT * FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)
"""

_AUDIT = """
SELECT *, '20240115' AS _processdate, strftime(data, '%Y%m%d') AS _businessdate,
       strftime(data, '%Y%m01') AS _businessmonth
FROM movimentos
"""


def _activity(status: str) -> str:
    return f"""SELECT conta_id, cartao_id, CAST(sum(valor) AS DECIMAL(38,2)) AS movimento, 1 AS _e
               FROM movimentos WHERE situacao = '{status}'
               GROUP BY conta_id, cartao_id"""


_CUR = _activity("efetivado")
_NEW = _activity("pendente")

_DIFF = f"""
SELECT CASE WHEN n._e IS NULL THEN c.conta_id ELSE n.conta_id END AS conta_id,
       CASE WHEN n._e IS NULL THEN c.cartao_id ELSE n.cartao_id END AS cartao_id,
       CASE WHEN c._e IS NULL THEN 'insert' WHEN n._e IS NULL THEN 'delete'
            WHEN c.movimento IS NOT DISTINCT FROM n.movimento THEN 'same' ELSE 'update' END AS _op,
       CASE WHEN n._e IS NULL THEN c.movimento ELSE n.movimento END AS movimento
FROM ({_CUR}) c
FULL OUTER JOIN ({_NEW}) n
  ON c.conta_id IS NOT DISTINCT FROM n.conta_id AND c.cartao_id IS NOT DISTINCT FROM n.cartao_id
"""

_CATEGORY_ITEMS = """
SELECT p_type, parent_id AS id, CAST(0 AS BIGINT) AS pai_id, p_type AS categoria,
       p_type = 'ECONOMY' AS arquivado FROM type_ranks
UNION ALL
SELECT p_type, parent_id + CAST(split_part(p_brand, '#', 2) AS BIGINT), parent_id, p_brand,
       CAST(split_part(p_brand, '#', 2) AS BIGINT) > 22
FROM (SELECT DISTINCT p_type, p_brand FROM part) b JOIN type_ranks USING (p_type)
"""

_CATEGORIES_HIERARCHY = f"""
SELECT a.id, p.categoria AS categoriaPai, a.categoria, a.natureza
FROM (SELECT id, pai_id, categoria,
             CASE WHEN p_type = 'PROMO' THEN 'Receitas' ELSE 'Despesas' END AS natureza, arquivado
      FROM ({_CATEGORY_ITEMS}) i
      UNION ALL SELECT -1, -1, 'Transferências', 'Transferências', false
      UNION ALL SELECT -2, -2, 'Não encontrado', 'Não encontrado', false) a
LEFT JOIN (SELECT id, categoria FROM ({_CATEGORY_ITEMS}) i
           UNION ALL SELECT -1, 'Transferências' UNION ALL SELECT -2, 'Não encontrado') p
  ON a.pai_id = p.id
WHERE NOT a.arquivado
"""

_FLATTEN_TRANSACTIONS = r"""
SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS unique_id,
       coalesce(nullif(CASE WHEN tipo = 0 THEN l_orderkey ELSE 0 END, 0),
                nullif(CASE WHEN tipo IN (1, 2) THEN l_orderkey END, 0),
                CASE WHEN tipo >= 3 THEN l_orderkey END, 0) AS id,
       o_custkey AS conta_id,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN l_suppkey END AS cartao_id,
       CASE WHEN tipo >= 3 THEN CAST(-1 AS BIGINT)
            WHEN p_type <> 'PROMO' AND parent_id > 0 THEN parent_id
            ELSE CASE WHEN p_type = 'PROMO' THEN parent_id ELSE 0 END END AS tipo_transacao_id,
       CASE WHEN tipo >= 3 THEN CAST(-1 AS BIGINT)
            ELSE coalesce(CASE WHEN p_size <= 45 THEN parent_id + CAST(split_part(p_brand, '#', 2) AS BIGINT) END, 0)
       END AS tipo_transacao_filho_id,
       CAST(l_shipdate AS DATE) AS data,
       CASE WHEN p_size <= 10
            THEN concat(p_name, ' (', CAST(l_linenumber AS VARCHAR), '/',
                        CAST(CAST(ceil(l_quantity / 5) AS INTEGER) AS VARCHAR), ')')
            ELSE p_name END AS descricao,
       tipo,
       CASE WHEN status = 0 THEN 'efetivado' WHEN status >= 1 THEN 'pendente' ELSE 'não informado' END AS situacao,
       l_returnflag = 'R' AS ignorada,
       o_orderpriority = '5-LOW' AS fixa,
       CAST(CASE WHEN tipo IN (0, 4) THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(18,2)) AS valor,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS valor_abs
FROM (SELECT *, CAST(l_linenumber - 1 AS INTEGER) AS tipo,
             CASE WHEN o_orderstatus = 'P' AND l_linestatus = 'O' THEN -1
                  WHEN l_linestatus = 'F' THEN 0 ELSE 1 END AS status
      FROM lineitem
      JOIN orders ON l_orderkey = o_orderkey
      JOIN part ON l_partkey = p_partkey
      JOIN type_ranks USING (p_type)) x
WHERE tipo < 5
"""

_MONTH_SPINE = """
SELECT refdate, CAST(mes AS DATE) AS mes
FROM (SELECT refdate, unnest(generate_series(ini, make_date(year(ini), 12, 1), INTERVAL 1 MONTH)) AS mes
      FROM (SELECT refdate, CAST(date_trunc('month', refdate - INTERVAL 1 MONTH) AS DATE) AS ini
            FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS refdate FROM orders) r) b) s
"""

_TRAILING = """
SELECT tipo_transacao_filho_id, mes, CAST(valor AS DECIMAL(38,2)) AS valor,
       CAST(lag(valor) OVER (PARTITION BY tipo_transacao_filho_id ORDER BY mes) AS DECIMAL(38,2)) AS valor_mes_anterior,
       round(CAST(sum(valor) OVER (PARTITION BY tipo_transacao_filho_id ORDER BY mes
             ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS DOUBLE) / 3.0, 6) AS media_3_meses,
       round(CAST(sum(valor) OVER (PARTITION BY tipo_transacao_filho_id ORDER BY mes
             ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS DOUBLE) / 6.0, 6) AS media_6_meses
FROM (SELECT tipo_transacao_filho_id, CAST(date_trunc('month', data) AS DATE) AS mes, sum(valor_abs) AS valor
      FROM movimentos GROUP BY 1, 2) m
"""

OPS_SQL = {
    "scd1_upsert": _SCD1_EVENTS,
    "scd1_composite_key": f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY id, tipo, _businessmonth
           ORDER BY data DESC NULLS LAST, unique_id DESC NULLS LAST, valor_abs DESC NULLS LAST,
                    descricao DESC NULLS LAST, conta_id DESC NULLS LAST,
                    tipo_transacao_filho_id DESC NULLS LAST, cartao_id DESC NULLS LAST,
                    ignorada DESC NULLS LAST, fixa DESC NULLS LAST) AS rn
  FROM ({_AUDIT}) a WHERE situacao = 'efetivado') r
WHERE rn = 1
""",
    "latest_snapshot": _LATEST_EVENTS,
    "snapshot_diff": _DIFF,
    "snapshot_apply": f"SELECT conta_id, cartao_id, movimento FROM ({_NEW}) n",
    "silver_dispatch": f"""
SELECT 'events_cdc' AS tabela, a.* FROM ({_SCD1_EVENTS}) a
UNION ALL
SELECT 'events_snapshot' AS tabela, b.* FROM ({_LATEST_EVENTS}) b
""",
    "audit_columns": _AUDIT,
    "extract_window": """
SELECT * FROM movimentos
WHERE situacao IN ('efetivado') AND data BETWEEN DATE '1998-02-01' AND DATE '1998-12-31'
  AND tipo IN (0, 1, 2, 3, 4)
""",
    "flatten_cards": "SELECT s_suppkey AS id, s_name AS nome FROM supplier",
    "flatten_accounts": """
SELECT c_custkey AS id, CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE trim(c_name) END AS nome FROM customer
""",
    "categories_hierarchy": _CATEGORIES_HIERARCHY,
    "flatten_transactions": _FLATTEN_TRANSACTIONS,
    "flatten_budgets": """
SELECT data, categoria, subcategoria,
       CAST(CASE WHEN planejado < 15000 THEN 0 ELSE planejado END AS DECIMAL(18,2)) AS planejado,
       efetivado, previsto
FROM orcamentos
""",
    "month_spine": _MONTH_SPINE,
    "join_inner": """
SELECT m.unique_id, m.id, m.conta_id, a.nome AS conta FROM movimentos m JOIN contas a ON m.conta_id = a.id
""",
    "join_left_dims": """
SELECT m.unique_id, c.nome AS cartao, g.categoria, g.subcategoria, g.agrupador
FROM movimentos m
LEFT JOIN cartoes c ON m.cartao_id = c.id
LEFT JOIN gold_categorias g ON m.tipo_transacao_filho_id = g.id
""",
    "dense_panel": """
SELECT cal.ano_mes, cat.agrupador, cat.categoria, cat.subcategoria
FROM (SELECT DISTINCT ano_mes FROM calendario) cal
CROSS JOIN (SELECT agrupador, categoria, subcategoria FROM gold_categorias WHERE natureza = 'Despesas') cat
""",
    "month_key_join": """
SELECT c.ano_mes, o.total_orcamento
FROM (SELECT DISTINCT ano_mes FROM calendario) c
JOIN (SELECT data_orcamento, CAST(sum(saldo) AS DECIMAL(38,2)) AS total_orcamento
      FROM gold_orcamentos GROUP BY data_orcamento) o ON CAST(c.ano_mes AS DATE) = o.data_orcamento
""",
    "running_total": """
SELECT data, total_dia,
       CAST(sum(total_dia) OVER (ORDER BY data ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS DECIMAL(38,2)) AS acumulado
FROM (SELECT data, CAST(sum(valor) AS DECIMAL(38,2)) AS total_dia FROM movimentos GROUP BY data) d
""",
    "trailing_mean": _TRAILING,
    "installments": r"""
SELECT unique_id, descricao, valor_abs, pa AS parcela_atual, tp AS total_parcelas,
       CAST((tp - pa) * valor_abs AS DECIMAL(18,2)) AS futuro_vendido
FROM (SELECT unique_id, descricao, valor_abs,
             TRY_CAST(nullif(regexp_extract(descricao, '\((\d+)/(\d+)\)', 1), '') AS INTEGER) AS pa,
             TRY_CAST(nullif(regexp_extract(descricao, '\((\d+)/(\d+)\)', 2), '') AS INTEGER) AS tp
      FROM movimentos) m
""",
    "ingest_files": _AUDIT,
    "ingest_infer": """
SELECT unique_id, CAST(id AS INTEGER) AS id, CAST(conta_id AS INTEGER) AS conta_id,
       CAST(cartao_id AS INTEGER) AS cartao_id, CAST(tipo_transacao_id AS INTEGER) AS tipo_transacao_id,
       CAST(tipo_transacao_filho_id AS INTEGER) AS tipo_transacao_filho_id, data, descricao, tipo, situacao,
       ignorada, fixa, CAST(valor AS DOUBLE) AS valor, CAST(valor_abs AS DOUBLE) AS valor_abs
FROM movimentos
""",
    "ingest_evolve": """
SELECT c_custkey AS id, c_name AS nome,
       CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN NULL ELSE c_mktsegment END AS segmento,
       CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN NULL
            ELSE lpad(CAST(c_custkey AS VARCHAR), 6, '0') END AS codigo
FROM customer
""",
    "ingest_evolve_stream": """
SELECT c_custkey AS id, c_name AS nome,
       CASE WHEN c_custkey % 50 <> 0 THEN CAST(c_acctbal AS DECIMAL(12,2)) END AS saldo,
       CASE WHEN c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING') THEN lpad(CAST(c_custkey AS VARCHAR), 6, '0') END AS codigo,
       CASE WHEN c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING') THEN c_mktsegment END AS segmento,
       CASE WHEN c_custkey % 50 = 0 THEN 'n/d' END AS saldo_lido
FROM customer
""",
    "ingest_infer_merge": """
SELECT o_orderkey AS pedido,
       CAST(CASE WHEN o_orderkey % 2 = 0 THEN floor(CAST(o_totalprice AS DECIMAL(12,2)))
                 ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS DECIMAL(18,2)) AS total,
       CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'C-' END || CAST(o_custkey AS VARCHAR) AS ref,
       CAST(o_orderdate AS DATE) AS data
FROM orders
""",
    "snapshot_csv_roundtrip": "SELECT c_custkey AS id, c_name AS nome, '20240115_120000' AS extraction_ts FROM customer",
    "scd1_stream": _SCD1_EVENTS,
    "month_keys": """
SELECT unique_id, data, strftime(data, '%Y-%m-01') AS ano_mes, strftime(data, '%Y%m%d') AS chave_dia,
       strftime(data, '%Y%m01') AS chave_mes, CAST(strftime(data, '%Y-12-31') AS DATE) AS fim_ano
FROM movimentos
""",
}
