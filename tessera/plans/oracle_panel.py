"""DuckDB definition of the derived panel (see ``plans/panel.py`` for the semantics)."""

PANEL_CTES = """
o_ranked AS (
  SELECT o_custkey AS cnpj, CAST(date_trunc('month', o_orderdate) AS DATE) AS ano_mes,
         o_orderstatus, o_totalprice, o_orderpriority,
         row_number() OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate)
                            ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders),
o_monthly AS (
  SELECT cnpj, ano_mes,
         max(CASE WHEN rn = 1 THEN CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 4 ELSE 8 END END) AS s,
         max(CASE WHEN rn = 1 THEN o_orderpriority END) AS p,
         sum(o_totalprice) AS m_value,
         count(*) AS m_orders,
         sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0.0 END) AS m_value_f,
         sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS m_urgent
  FROM o_ranked GROUP BY cnpj, ano_mes),
macro AS (
  SELECT CAST(date_trunc('month', l_shipdate) + INTERVAL 1 MONTH AS DATE) AS ano_mes,
         round(avg(l_discount), 6) AS selic_meta_mensal_t_minus_1,
         round(avg(l_tax), 6) AS ipca_mensal_t_minus_1,
         round(avg(l_quantity), 6) AS taxa_desemprego_t_minus_1
  FROM lineitem GROUP BY 1),
panel_core AS (
  SELECT m.cnpj, m.ano_mes, CAST(m.s AS INTEGER) AS situacao_cadastral,
         c.c_mktsegment AS cnae_fiscal_principal, n.n_name AS uf, m.p AS porte_empresa,
         c.c_acctbal AS capital_social,
         round(((year(m.ano_mes) - year(min(m.ano_mes) OVER (PARTITION BY m.cnpj))) * 12
                + (month(m.ano_mes) - month(min(m.ano_mes) OVER (PARTITION BY m.cnpj)))) / 12.0, 6)
           AS tempo_atividade_anos,
         CAST(lag(m.s, 1) OVER w AS INTEGER) AS situacao_cadastral_t_minus_1,
         round(CAST(coalesce(sum(m.m_value) OVER we, 0) AS DOUBLE), 2) AS pgfn_fgts_valor_acumulado_t_minus_1,
         round(CAST(coalesce(sum(m.m_orders) OVER we, 0) AS DOUBLE), 2) AS pgfn_naoprev_valor_acumulado_t_minus_1,
         round(CAST(coalesce(sum(m.m_value_f) OVER we, 0) AS DOUBLE), 2) AS pgfn_prev_valor_acumulado_t_minus_1,
         round(CAST(coalesce(sum(m.m_urgent) OVER we, 0) AS DOUBLE), 2) AS pgfn_fgts_ajuizados_t_minus_1
  FROM o_monthly m
  JOIN customer c ON c.c_custkey = m.cnpj
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  WINDOW w AS (PARTITION BY m.cnpj ORDER BY m.ano_mes),
         we AS (PARTITION BY m.cnpj ORDER BY m.ano_mes ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
panel AS (
  SELECT p.*, x.selic_meta_mensal_t_minus_1, x.ipca_mensal_t_minus_1, x.taxa_desemprego_t_minus_1
  FROM panel_core p LEFT JOIN macro x ON x.ano_mes = p.ano_mes)
"""


def with_panel(body: str, extra_ctes: str = "") -> str:
    """Prefix a query with the panel CTEs; ``extra_ctes`` are appended after them."""
    ctes = PANEL_CTES.strip()
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{body}"
