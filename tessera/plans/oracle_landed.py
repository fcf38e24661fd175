"""DuckDB SQL of the landed-file, load and stream queries, straight from the driver tables.

Values are written out here, not taken from the engine's constants.
"""

from __future__ import annotations

from .oracle_panel import with_panel

_EST_COLUMNS = ("cnpj_basico cnpj_ordem cnpj_dv identificador_matriz_filial nome_fantasia situacao_cadastral "
                "data_situacao_cadastral motivo_situacao_cadastral nome_cidade_exterior pais data_inicio_atividade "
                "cnae_fiscal_principal cnae_fiscal_secundaria tipo_logradouro logradouro numero complemento bairro cep uf "
                "municipio ddd_1 telefone_1 ddd_2 telefone_2 ddd_fax fax correio_eletronico situacao_especial "
                "data_situacao_especial").split()

_BASICO = "lpad(CAST(cnpj AS VARCHAR), 8, '0')"


def _row(**values: str) -> str:
    cells = ", ".join(f"CAST({values.get(c, 'NULL')} AS VARCHAR) AS {c}" for c in _EST_COLUMNS)
    return f"SELECT {cells}, strftime(ano_mes, '%Y-%m') AS ano_mes"


_CLEAN = _row(
    cnpj_basico=_BASICO, cnpj_ordem="'0001'", cnpj_dv="lpad(CAST(cnpj % 97 AS VARCHAR), 2, '0')",
    identificador_matriz_filial="'1'",
    nome_fantasia="""CASE WHEN cnpj % 5 = 0 THEN 'EMPRESA "' || cnpj || '"' || chr(10) || 'LTDA' ELSE 'EMPRESA ' || cnpj END""",
    situacao_cadastral="situacao_cadastral",
    data_inicio_atividade="strftime(min(ano_mes) OVER (PARTITION BY cnpj), '%Y%m%d')",
    cnae_fiscal_principal="cnae_fiscal_principal", uf="uf") + " FROM panel"
_SHORT = _row(cnpj_basico=_BASICO, cnpj_ordem="'0001'") + " FROM panel WHERE cnpj % 37 = 0"
_LONG = _row(cnpj_basico=_BASICO, cnpj_ordem="'0002'", cnpj_dv="'00'", identificador_matriz_filial="'1'",
             nome_fantasia="'NOME LONGO'", situacao_cadastral="'02'") + " FROM panel WHERE cnpj % 37 = 0"
_BAD = _row(cnpj_basico="'XX' || cnpj", cnpj_ordem="'0003'", cnpj_dv="'00'", identificador_matriz_filial="'1'",
            nome_fantasia="'RUIM'", situacao_cadastral="'02'") + " FROM panel WHERE cnpj % 37 = 0"
_EST = f"est AS ({_CLEAN} UNION ALL {_SHORT} UNION ALL {_LONG} UNION ALL {_BAD})"
_OK = "coalesce(regexp_full_match(cnpj_basico, '[0-9]{8}'), false)"

_COMP = f"""comp AS (SELECT {_BASICO} AS cnpj_basico, strftime(ano_mes, '%Y-%m') AS ano_mes, '2062' AS natureza_juridica,
  porte_empresa, CAST(printf('%.2f', capital_social) AS DOUBLE) AS capital_social FROM panel)"""

_ASSEMBLED = f"""{_EST}, {_COMP},
bare AS (
  SELECT e.cnpj_basico || e.cnpj_ordem || e.cnpj_dv AS cnpj, CAST(strptime(e.ano_mes, '%Y-%m') AS DATE) AS ano_mes,
         CAST(e.situacao_cadastral AS INTEGER) AS situacao_cadastral, e.cnae_fiscal_principal, e.uf, c.natureza_juridica,
         c.porte_empresa, c.capital_social, CAST(strptime(e.data_inicio_atividade, '%Y%m%d') AS DATE) AS inicio
  FROM est e JOIN comp c USING (cnpj_basico, ano_mes)
  WHERE e.cnpj_basico || e.cnpj_ordem || e.cnpj_dv IS NOT NULL),
assembled AS (
  SELECT * EXCLUDE (inicio),
         round(((year(ano_mes) - year(inicio)) * 12 + (month(ano_mes) - month(inicio))) / 12.0, 6) AS tempo_atividade_anos,
         lag(situacao_cadastral) OVER (PARTITION BY cnpj ORDER BY ano_mes) AS situacao_cadastral_t_minus_1
  FROM bare)"""

_SERIES = {
    "selic_meta_mensal": "avg(l_discount)", "ipca_acumulado_12m": "avg(l_tax)", "ipca_mensal": "avg(l_quantity)",
    "inadimplencia_pj_livre": "avg(l_extendedprice)", "volume_credito_pj_total": "max(l_discount)",
    "spread_credito_pj": "max(l_tax)", "cambio_dolar_media_mensal": "max(l_quantity)",
    "ibc_br_dessazonalizado": "max(l_extendedprice)", "icei": "min(l_quantity)",
    "nivel_utilizacao_capacidade": "min(l_extendedprice)", "taxa_desemprego": "count(*)"}
_MACRO = f"""wide AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS mes, {', '.join(
      f"round(CAST({e} AS DOUBLE), 6) AS {n}" if n != "icei" else
      f"CASE WHEN month(min(l_shipdate)) <> 7 THEN round(CAST({e} AS DOUBLE), 6) END AS {n}" for n, e in _SERIES.items())}
  FROM lineitem GROUP BY 1),
silver AS (SELECT mes, {', '.join(f"round(coalesce({n}, (SELECT avg({n}) FROM wide)), 6) AS {n}" for n in _SERIES)} FROM wide)"""

_TYPE = "CASE o_orderstatus WHEN 'F' THEN 'FGTS' WHEN 'O' THEN 'Previdenciario' ELSE 'Nao_Previdenciario' END"
_VALUE = "CASE WHEN o_orderkey % 211 = 0 THEN 'n/d' ELSE replace(printf('%.2f', o_totalprice), '.', ',') END"


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["load_bronze_csv"] = with_panel("SELECT * FROM assembled", _ASSEMBLED)
    months = "SELECT DISTINCT strftime(ano_mes, '%Y-%m') AS ano_mes"
    q["landed_periods"] = with_panel(f"{months}, 'estabelecimentos' AS tipo FROM panel UNION ALL {months}, 'empresas' FROM panel")
    q["load_corrupt_rows"] = with_panel(f"""
SELECT strftime(ano_mes, '%Y-%m') AS ano_mes, {_BASICO} AS cnpj_basico, '0001' AS cnpj_ordem, {_BASICO} || ';0001' AS texto
FROM panel WHERE cnpj % 37 = 0
UNION ALL
SELECT strftime(ano_mes, '%Y-%m'), {_BASICO}, '0002', {_BASICO} || ';0002;00;1;NOME LONGO;02' || repeat(';', 24) || ';extra;extra'
FROM panel WHERE cnpj % 37 = 0""")
    q["load_debts"] = f"""
SELECT printf('%08d/0001-%02d', o_custkey, o_custkey % 97) AS cpf_cnpj, 'PJ' AS tipo_pessoa, 'PRINCIPAL' AS tipo_devedor,
       'DEVEDOR ' || o_custkey AS nome_devedor, 'SP' AS uf_devedor, 'PGFN' AS unidade_responsavel,
       CAST(o_orderkey AS VARCHAR) AS numero_inscricao, 'ATIVA' AS tipo_situacao_inscricao, o_orderpriority AS situacao_inscricao,
       '0000' AS receita_principal, strftime(o_orderdate, '%d/%m/%Y') AS data_inscricao,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'SIM' ELSE 'NAO' END AS indicador_ajuizado, {_VALUE} AS valor_consolidado,
       CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(quarter(o_orderdate) AS INTEGER) AS trimestre, {_TYPE} AS tipo
FROM orders"""
    q["load_debt_rejects"] = f"""
SELECT {_TYPE} AS tipo, CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(quarter(o_orderdate) AS INTEGER) AS trimestre,
       count(*) AS "rows", CASE WHEN o_orderkey % 211 = 0 THEN 'rejeitos' ELSE 'tabela' END AS destino
FROM orders GROUP BY ALL"""
    q["macro_job"] = f"WITH {_MACRO} SELECT mes AS ano_mes, * EXCLUDE (mes) FROM silver"
    t1 = ["selic_meta_mensal", "ipca_acumulado_12m", "ipca_mensal", "cambio_dolar_media_mensal", "taxa_desemprego"]
    q["assembled_panel"] = with_panel(f"""
SELECT a.cnpj, a.ano_mes, situacao_cadastral, cnae_fiscal_principal, uf, natureza_juridica, porte_empresa, tempo_atividade_anos,
       situacao_cadastral_t_minus_1, {', '.join(f'{n} AS {n}_t_minus_1' for n in t1)}, round(capital_social, 6) AS capital_social,
       round(coalesce(fgts, 0), 2) AS pgfn_fgts_valor_acumulado_t_minus_1,
       round(coalesce(naoprev, 0), 2) AS pgfn_naoprev_valor_acumulado_t_minus_1,
       round(coalesce(prev, 0), 2) AS pgfn_prev_valor_acumulado_t_minus_1,
       CAST(coalesce(filed, 0) AS DOUBLE) AS pgfn_fgts_ajuizados_t_minus_1
FROM assembled a LEFT JOIN owed o ON o.cnpj = a.cnpj AND o.ano_mes = a.ano_mes
LEFT JOIN silver s ON CAST(strptime(s.mes, '%Y-%m') + INTERVAL 1 MONTH AS DATE) = a.ano_mes""", f"""{_ASSEMBLED}, {_MACRO},
debt AS (SELECT printf('%08d0001%02d', o_custkey, o_custkey % 97) AS cnpj,
                make_date(year(o_orderdate), quarter(o_orderdate) * 3, 1) AS mes, {_TYPE} AS tipo,
                CASE WHEN o_orderkey % 211 <> 0 THEN CAST(printf('%.2f', o_totalprice) AS DOUBLE) END AS valor,
                o_orderpriority = '1-URGENT' AS filed FROM orders),
owed AS (SELECT a.cnpj, a.ano_mes, sum(valor) FILTER (WHERE tipo = 'FGTS') AS fgts,
                sum(valor) FILTER (WHERE tipo = 'Nao_Previdenciario') AS naoprev,
                sum(valor) FILTER (WHERE tipo = 'Previdenciario') AS prev,
                count(*) FILTER (WHERE d.filed AND tipo = 'FGTS') AS filed
         FROM assembled a JOIN debt d ON d.cnpj = a.cnpj AND d.mes < a.ano_mes GROUP BY 1, 2)""")
    q["load_panel_csv"] = with_panel("""
SELECT lpad(CAST(cnpj AS VARCHAR), 14, '0') AS cnpj, ano_mes, situacao_cadastral, cnae_fiscal_principal, uf,
       CAST(NULL AS VARCHAR) AS natureza_juridica, porte_empresa, tempo_atividade_anos, situacao_cadastral_t_minus_1,
       selic_meta_mensal_t_minus_1, CAST(NULL AS DOUBLE) AS ipca_acumulado_12m_t_minus_1, ipca_mensal_t_minus_1,
       CAST(NULL AS DOUBLE) AS cambio_dolar_media_mensal_t_minus_1, taxa_desemprego_t_minus_1, capital_social,
       pgfn_fgts_valor_acumulado_t_minus_1, pgfn_naoprev_valor_acumulado_t_minus_1, pgfn_prev_valor_acumulado_t_minus_1,
       pgfn_fgts_ajuizados_t_minus_1 FROM panel""")
    q["load_tax_regime"] = """
SELECT CAST(ano AS INTEGER) AS ano, printf('%02d.%03d.%03d/0001-%02d', (k // 1000000) % 100, (k // 1000) % 1000, k % 1000, k % 97) AS cnpj,
       '0' AS cnpj_da_scp, upper(replace(regime, '_', ' ')) AS forma_de_tributacao, CAST(n AS INTEGER) AS quantidade_de_escrituracoes,
       regime
FROM (SELECT o_custkey AS k, year(o_orderdate) AS ano, count(*) AS n,
             CASE c_mktsegment WHEN 'BUILDING' THEN 'lucro_real' WHEN 'FURNITURE' THEN 'lucro_arbitrado'
                  WHEN 'MACHINERY' THEN 'imunes_e_isentas' ELSE 'lucro_presumido' END AS regime
      FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL) r"""
    q["load_period_overwrite"] = q["incremental_files"] = with_panel("SELECT * FROM est", _EST)
    status = (f"SELECT ano_mes, count(*) AS \"rows\", count(*) FILTER (WHERE NOT {_OK}) AS bad_rows, "
              f"CASE WHEN count(*) FILTER (WHERE NOT {_OK}) = 0 THEN 'success' "
              f"WHEN count(*) FILTER (WHERE NOT {_OK}) <= 10000 THEN 'partial' ELSE 'failed' END AS status FROM est GROUP BY 1")
    q["load_status"] = with_panel(status, _EST)
    q["load_summary"] = with_panel(f"""
SELECT count(*) AS units, CAST(sum("rows") AS BIGINT) AS "rows", CAST(sum(bad_rows) AS BIGINT) AS bad_rows,
       count(*) FILTER (WHERE status = 'success') AS success, count(*) FILTER (WHERE status = 'partial') AS partial,
       count(*) FILTER (WHERE status = 'failed') AS failed FROM ({status}) s""", _EST)
    q["load_rejects"] = with_panel(f"""
SELECT ano_mes, count(*) FILTER (WHERE {_OK}) AS "rows", count(*) FILTER (WHERE NOT {_OK}) AS bad_rows,
       min(cnpj_basico) FILTER (WHERE NOT {_OK}) AS first_bad FROM est GROUP BY 1""", _EST)
    kinds = ["view", "signup", "error", "click", "purchase"]
    q["json_series_load"] = f"""
WITH m AS (SELECT CAST(ts AS DATE) AS dia, event_type, round(avg(value), 6) AS v FROM events GROUP BY 1, 2),
w AS (SELECT dia, {', '.join(f"max(v) FILTER (WHERE event_type = '{k}') AS {k}" for k in kinds)} FROM m GROUP BY 1)
SELECT dia, {', '.join(f'round(coalesce({k}, (SELECT avg({k}) FROM w)), 6) AS {k}' for k in kinds)} FROM w"""
    q["split_null_periods"] = with_panel("""
SELECT cnpj, ano_mes, CASE WHEN idx <= floor(n * CAST(0.7 AS DOUBLE)) THEN 'train'
                           WHEN idx <= floor(n * CAST(0.9 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY ano_mes NULLS FIRST, cnpj) AS idx, count(*) OVER () AS n
      FROM (SELECT 'K' || cnpj AS cnpj, CASE WHEN cnpj % 10 <> 0 THEN ano_mes END AS ano_mes FROM panel) p) s""")
    columns = ["uf", "cnae_fiscal_principal", "porte_empresa"]
    q["frequency_index"] = with_panel("\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, {c} AS value, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS INTEGER) AS code "
        f"FROM combos WHERE {c} IS NOT NULL GROUP BY {c}" for c in columns),
        f"combos AS (SELECT DISTINCT {', '.join(columns)} FROM panel)")
    w = "PARTITION BY cnpj ORDER BY ano_mes"
    names = [*(f"situacao_cadastral_lag_{k}" for k in (1, 2, 3, 6, 12)),
             *(f"situacao_cadastral_rolling_{what}_{n}" for n in (3, 6, 12) for what in ("mean", "std")), "houve_mudanca",
             "num_mudancas_anteriores", "meses_desde_ultima_mudanca", "posicao_temporal", "taxa_mudanca_empresa"]
    lags = ", ".join(f"CAST(lag(situacao_cadastral, {k}) OVER ({w}) AS DOUBLE) AS situacao_cadastral_lag_{k}" for k in (1, 2, 3, 6, 12))
    rolls = ", ".join(
        f"coalesce(round({fn}(situacao_cadastral) OVER ({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), 6), 0) "
        f"AS situacao_cadastral_rolling_{what}_{n}" for n in (3, 6, 12) for what, fn in (("mean", "avg"), ("std", "stddev_samp")))
    q["stateful_features"] = with_panel(f"""
SELECT cnpj, ano_mes, CAST(situacao_cadastral AS DOUBLE) AS situacao_cadastral, {", ".join(names)}, false AS atrasada FROM done
UNION ALL
SELECT cnpj, ano_mes, CAST(situacao_cadastral AS DOUBLE), {", ".join("NULL" for _ in names)}, true FROM panel
WHERE cnpj % 7 = 0 AND ano_mes < (SELECT min(ano_mes) + INTERVAL 24 MONTH FROM panel)""", f"""
one AS (
  SELECT *, CAST(row_number() OVER ({w}) AS BIGINT) AS rn, {lags}, {rolls},
         CAST(coalesce(situacao_cadastral <> lag(situacao_cadastral) OVER ({w}), false) AS BIGINT) AS houve_mudanca FROM panel),
done AS (
  SELECT *, CAST(sum(houve_mudanca) OVER ({w}) AS BIGINT) AS num_mudancas_anteriores, rn - 1 AS posicao_temporal,
         rn - coalesce(max(CASE WHEN houve_mudanca = 1 THEN rn END) OVER ({w}), 0) AS meses_desde_ultima_mudanca,
         round(sum(houve_mudanca) OVER ({w}) / rn, 6) AS taxa_mudanca_empresa FROM one)""")
    month = "SELECT cnpj, strftime(ano_mes, '%Y-%m') AS ano_mes, situacao_cadastral"
    q["snapshot_loads"] = with_panel(f"""
{month}, 'antes' AS versao FROM panel
UNION ALL {month}, 'depois' FROM panel WHERE ano_mes < (SELECT max(ano_mes) FROM panel) OR cnpj % 2 = 0""")
    q["changed_files"] = with_panel("""
SELECT year(ano_mes) || '.csv' AS arquivo, cnpj, ano_mes,
       CASE WHEN cnpj % 2 = 0 AND year(ano_mes) = (SELECT max(year(ano_mes)) FROM panel) THEN 8
            ELSE situacao_cadastral END AS situacao_cadastral FROM panel""")
    q["triggered_load"] = with_panel(f"""
SELECT 'estabelecimentos' AS tipo, strftime(ano_mes, '%Y-%m') AS ano_mes, {_BASICO} AS cnpj_basico FROM panel
UNION ALL SELECT 'empresas', strftime(ano_mes, '%Y-%m'), {_BASICO} FROM panel""")
    q["message_status"] = with_panel("""
SELECT * FROM (VALUES ('todos', 'WRITE_APPEND', 'ok', 2 * (SELECT count(*) FROM panel)),
                      ('empresas', 'WRITE_TRUNCATE', 'ok', (SELECT count(*) FROM panel)),
                      ('ultimo', 'WRITE_TRUNCATE', 'ok',
                       (SELECT count(*) FROM panel WHERE ano_mes = (SELECT max(ano_mes) FROM panel))),
                      ('sem-pasta', 'WRITE_APPEND', 'no_files', 0), ('tipo-ruim', 'WRITE_APPEND', 'bad_data_type', 0),
                      ('modo-ruim', 'WRITE_SOMETIMES', 'bad_mode', 0), ('texto-ruim', 'WRITE_APPEND', 'bad_message', 0)
             ) v(id, mode, status, "rows")""")
    return q


LANDED_ORACLE = build()
