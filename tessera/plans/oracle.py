"""Independent DuckDB SQL for every SQL-expressible registered query.

Written directly against the driver tables (``plans/oracle_panel.py`` holds
the panel definition); none of it goes through the Spark code.  Column names
match ``plans/queries.py``; integer widths are cast to match Spark's types
and doubles are rounded with the same digits.
"""

from __future__ import annotations

from ..constants import (CONFIDENCE_BANDS, DEBT_COLUMNS, DEBT_LAG_COLUMNS, MODEL_FEATURES, STATUS_CODES,
                         STATUS_LABELS, STATUS_LAGS)
from . import frames as fr
from .oracle_landed import LANDED_ORACLE
from .oracle_panel import with_panel
from .queries import PLANTED_LINKS

#: An attribute's name and value, as SQL text.
_ATTR = r"""'([^\s"''>/=]+)(?:\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+))?'"""

MACRO_COLS = ["selic_meta_mensal_t_minus_1", "ipca_mensal_t_minus_1", "taxa_desemprego_t_minus_1"]
PANEL_DOUBLES = ["capital_social", "tempo_atividade_anos", *DEBT_LAG_COLUMNS, *MACRO_COLS]
PANEL_COLUMNS = ["cnpj", "ano_mes", "situacao_cadastral", "cnae_fiscal_principal", "uf", "porte_empresa",
                 "capital_social", "tempo_atividade_anos", "situacao_cadastral_t_minus_1", *DEBT_LAG_COLUMNS,
                 *MACRO_COLS]
W = "PARTITION BY cnpj ORDER BY ano_mes"


def pct(num: str, den: str, digits: int = 4) -> str:
    return f"round(100 * coalesce(CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0), 0), {digits})"


def ratio(num: str, den: str) -> str:
    return f"coalesce(CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0), 0)"


def label(c: str) -> str:
    cases = " ".join(f"WHEN {k} THEN '{v}'" for k, v in STATUS_LABELS.items())
    return f"(CASE {c} {cases} END)"


def union_all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


CHG = f"""
chg0 AS (SELECT *, lag(situacao_cadastral) OVER ({W}) AS situacao_anterior FROM panel),
chg AS (SELECT *, CAST(CASE WHEN situacao_anterior IS NOT NULL
                             AND situacao_cadastral IS DISTINCT FROM situacao_anterior THEN 1 ELSE 0 END
                        AS INTEGER) AS houve_mudanca FROM chg0)"""

PRED = """
pred AS (
  SELECT cnpj, ano_mes, situacao_cadastral AS y_true, situacao_cadastral_t_minus_1 AS y_pred,
         CAST((cnpj * 37 + month(ano_mes) * 11) % 101 AS DOUBLE) / 100 AS prob_max,
         situacao_cadastral <> situacao_cadastral_t_minus_1 AS erro,
         situacao_cadastral = situacao_cadastral_t_minus_1 AS acerto
  FROM panel WHERE situacao_cadastral_t_minus_1 IS NOT NULL)"""

CM = PRED + """,
labels AS (SELECT DISTINCT l FROM (SELECT y_true AS l FROM pred UNION ALL SELECT y_pred FROM pred) u
           WHERE l IS NOT NULL),
cnt AS (SELECT y_true, y_pred, count(*) AS count FROM pred GROUP BY y_true, y_pred),
cm AS (SELECT a.l AS y_true, b.l AS y_pred, coalesce(cnt.count, 0) AS count
       FROM labels a CROSS JOIN labels b
       LEFT JOIN cnt ON cnt.y_true = a.l AND cnt.y_pred = b.l),
pc0 AS (SELECT y_true AS label, sum(CASE WHEN y_true = y_pred THEN count ELSE 0 END) AS tp, sum(count) AS support
        FROM cm GROUP BY y_true),
pc1 AS (SELECT y_pred AS label, sum(count) AS predicted FROM cm GROUP BY y_pred),
pc2 AS (SELECT pc0.label, tp, support, predicted, """ + ratio("tp", "predicted") + " AS precision, " + \
    ratio("tp", "support") + """ AS recall FROM pc0 JOIN pc1 ON pc0.label = pc1.label),
pc AS (SELECT *, """ + ratio("2 * precision * recall", "precision + recall") + " AS f1 FROM pc2)"

FAIL = CHG + f""",
dyn AS (SELECT * FROM chg WHERE cnpj IN (SELECT cnpj FROM chg WHERE houve_mudanca = 1)),
nxt AS (SELECT *, CAST(coalesce(lead(houve_mudanca) OVER ({W}), 0) AS INTEGER) AS vai_mudar,
               lead(situacao_cadastral) OVER ({W}) AS proxima_situacao,
               CAST(coalesce(lead(situacao_cadastral) OVER ({W}) = 8, false) AS INTEGER) AS vai_quebrar
        FROM dyn),
hist0 AS (SELECT *, row_number() OVER ({W}) AS rn FROM nxt),
hist AS (SELECT *, CAST(sum(houve_mudanca) OVER u AS BIGINT) AS num_mudancas_anteriores,
                CAST(rn - coalesce(max(CASE WHEN houve_mudanca = 1 THEN rn END) OVER u, 0) AS BIGINT)
                  AS meses_desde_ultima_mudanca
         FROM hist0 WINDOW u AS ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
fpred0 AS (SELECT *, CAST((cnpj * 37 + month(ano_mes) * 11) % 101 AS DOUBLE) / 100 AS prob FROM hist),
fpred AS (SELECT cnpj, ano_mes, situacao_cadastral, tempo_atividade_anos, num_mudancas_anteriores,
                 meses_desde_ultima_mudanca, vai_quebrar AS y_true,
                 CASE WHEN prob > CAST(0.5 AS DOUBLE) THEN 1 ELSE 0 END AS y_pred, prob AS prob_quebra
          FROM fpred0)"""


def _rolling(col: str, w: int, fn: str) -> str:
    return f"coalesce(round({fn}({col}) OVER ({W} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW), 6), 0)"


def _feature_select() -> str:
    lags = ", ".join(f"lag(situacao_cadastral, {k}) OVER ({W}) AS situacao_cadastral_lag_{k}" for k in STATUS_LAGS)
    rolls = ", ".join(
        f"{_rolling('situacao_cadastral', w, 'avg')} AS situacao_cadastral_rolling_mean_{w}, "
        f"{_rolling('situacao_cadastral', w, 'stddev_samp')} AS situacao_cadastral_rolling_std_{w}"
        for w in (3, 6, 12))
    return f"""
feat AS (
  SELECT p.*,
         CAST(year(ano_mes) AS INTEGER) AS ano, CAST(month(ano_mes) AS INTEGER) AS mes,
         CAST(quarter(ano_mes) AS INTEGER) AS trimestre,
         CASE WHEN month(ano_mes) <= 6 THEN 1 ELSE 2 END AS semestre,
         round(sin(2 * pi() * month(ano_mes) / 12), 6) + 0.0 AS mes_sin,
         round(cos(2 * pi() * month(ano_mes) / 12), 6) + 0.0 AS mes_cos,
         CAST((year(ano_mes) - year(s.m)) * 12 + (month(ano_mes) - month(s.m)) AS INTEGER) AS meses_desde_inicio,
         {lags}, {rolls},
         round(avg(situacao_cadastral) OVER (PARTITION BY cnpj), 6) AS situacao_cadastral_mean_empresa,
         round(stddev_samp(situacao_cadastral) OVER (PARTITION BY cnpj), 6) AS situacao_cadastral_std_empresa,
         row_number() OVER ({W}) - 1 AS posicao_temporal,
         count(*) OVER (PARTITION BY cnpj) AS total_registros_empresa
  FROM panel p, (SELECT min(ano_mes) AS m FROM panel) s),
feat2 AS (SELECT *, round(posicao_temporal / total_registros_empresa, 6) AS posicao_relativa FROM feat)"""


def _complete_rows() -> str:
    feat_cols = ["ano", "mes", "trimestre", "semestre", "mes_sin", "mes_cos", "meses_desde_inicio",
                 *[f"situacao_cadastral_lag_{k}" for k in STATUS_LAGS],
                 *[f"situacao_cadastral_rolling_{s}_{w}" for s in ("mean", "std") for w in (3, 6, 12)],
                 "situacao_cadastral_mean_empresa", "situacao_cadastral_std_empresa", "posicao_relativa"]
    have = set(PANEL_COLUMNS) | set(feat_cols)
    wanted = [c for c in MODEL_FEATURES if c in have]
    doubles = set(PANEL_DOUBLES) | {"mes_sin", "mes_cos", "posicao_relativa", "situacao_cadastral_mean_empresa",
                                    "situacao_cadastral_std_empresa"} | {c for c in feat_cols if "rolling" in c}
    conds = " AND ".join(f"{c} IS NOT NULL" + (f" AND NOT isnan({c})" if c in doubles else "") for c in wanted)
    cols = ", ".join(wanted + ["situacao_cadastral", "cnpj", "ano_mes"])
    return with_panel(f"SELECT {cols} FROM feat2 WHERE {conds}", _feature_select())


def _split(order: str, fractions: list[float], names: list[str], extra: str = "") -> str:
    cases = " ".join(f"WHEN idx <= floor(n * CAST({f} AS DOUBLE)) THEN '{nm}'" for f, nm in zip(fractions, names))
    return (f"SELECT cnpj, ano_mes{extra}, CASE {cases} ELSE '{names[-1]}' END AS split FROM "
            f"(SELECT *, row_number() OVER (ORDER BY {order}) AS idx, count(*) OVER () AS n FROM panel) s")


def _event_means(unit_expr: str) -> str:
    return (f"em AS (SELECT {unit_expr} AS periodo, event_type AS serie, round(avg(value), 6) AS valor "
            f"FROM events GROUP BY 1, 2)")


def _wide() -> str:
    cols = ", ".join(f"max(valor) FILTER (WHERE serie = '{t}') AS \"{t}\"" for t in fr.EVENT_TYPES)
    return f"wide AS (SELECT periodo, {cols} FROM em GROUP BY periodo)"


def _work_list_ctes() -> str:
    types = ", ".join(f"('{t}')" for t in ("Nao_Previdenciario", "FGTS", "Previdenciario"))
    return f"""WITH y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders),
q AS (SELECT CAST(range AS INTEGER) AS trimestre FROM range(1, 5)),
t AS (SELECT * FROM (VALUES {types}) v(tipo)),
work AS (SELECT ano, trimestre, tipo, printf('%04d/%dtrimestre/%s', ano, trimestre, tipo) AS caminho,
                printf('%04d_trimestre_%02d/Dados_abertos_%s.zip', ano, trimestre, tipo) AS arquivo
         FROM y, q, t)"""


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    status_freq = (f"SELECT situacao_cadastral, count(*) AS count, "
                   f"{pct('count(*)', 'sum(count(*)) OVER ()')} AS pct, "
                   f"coalesce({label('situacao_cadastral')}, 'Desconhecida (' || CAST(situacao_cadastral AS VARCHAR)"
                   f" || ')') AS label FROM panel GROUP BY situacao_cadastral")

    q["panel_overview"] = with_panel('SELECT count(*) AS "rows", count(DISTINCT cnpj) AS entities, '
                                     'min(ano_mes) AS min_period, max(ano_mes) AS max_period FROM panel')
    q["status_distribution"] = with_panel(status_freq)
    q["minority_statuses"] = with_panel(f"SELECT * FROM ({status_freq}) f WHERE count < (SELECT max(count) FROM ({status_freq}) g)")
    q["top_categories"] = with_panel("SELECT uf, count(*) AS count FROM panel GROUP BY uf "
                                     "ORDER BY count DESC, uf LIMIT 10")
    q["distinct_per_column"] = with_panel(union_all([
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM panel"
        for c in ["cnpj", "ano_mes", "situacao_cadastral", "cnae_fiscal_principal", "uf", "porte_empresa",
                  "capital_social"]]))
    q["distinct_by_sketch"] = with_panel(union_all([
        f"SELECT '{name}' AS periodos, '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, true AS dentro_do_erro "
        f"FROM panel WHERE {where}" for name, where in (("todos", "true"), ("ate_1995", "ano_mes <= DATE '1995-12-31'"))
        for c in ["cnpj", "ano_mes", "situacao_cadastral", "cnae_fiscal_principal", "uf", "porte_empresa",
                  "capital_social"]]))
    q["status_by_month"] = with_panel(
        "SELECT CAST(year(ano_mes) AS INTEGER) AS ano, CAST(month(ano_mes) AS INTEGER) AS mes, situacao_cadastral,"
        " count(*) AS count FROM panel GROUP BY 1, 2, 3")
    pivot = ", ".join([*(f"count(*) FILTER (WHERE situacao_cadastral = {c}) AS status_{c}" for c in STATUS_CODES),
                       "count(*) FILTER (WHERE coalesce(situacao_cadastral NOT IN (1, 2, 3, 4, 8), true)) AS status_outras"])
    q["status_pivot"] = with_panel(f"SELECT ano_mes, {pivot} FROM panel GROUP BY ano_mes")
    cells = [f"status_{c}" for c in (*STATUS_CODES, "outras")]
    total = " + ".join(cells)
    q["status_pivot_percent"] = with_panel(
        "SELECT ano_mes, " + ", ".join(f"{pct(c, total)} AS {c}" for c in cells) +
        f" FROM (SELECT ano_mes, {pivot} FROM panel GROUP BY ano_mes) sp")
    q["category_pivot"] = with_panel(
        "SELECT ano_mes, count(*) FILTER (WHERE cnae_fiscal_principal = 'BUILDING') AS \"cnae_BUILDING\", "
        "count(*) FILTER (WHERE cnae_fiscal_principal = 'MACHINERY') AS \"cnae_MACHINERY\", "
        "count(*) FILTER (WHERE cnae_fiscal_principal NOT IN ('BUILDING', 'MACHINERY')) AS cnae_outras FROM panel GROUP BY 1")
    miss = union_all([
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL"
        + (f" OR isnan({c})" if c in PANEL_DOUBLES else "") + ") AS missing, count(*) AS n FROM panel"
        for c in PANEL_COLUMNS])
    q["missing_profile"] = with_panel(
        f"SELECT column_name, missing, {pct('missing', 'n')} AS pct FROM ({miss}) m WHERE missing > 0")

    def stats(c):
        x = f"CAST({c} AS DOUBLE)"
        return (f"SELECT '{c}' AS column_name, count({x}) AS count, round(avg({x}), 6) AS mean, "
                f"round(stddev_samp({x}), 6) AS std, round(min({x}), 6) AS min, "
                f"round(quantile_cont({x}, 0.25), 6) AS q25, round(quantile_cont({x}, 0.5), 6) AS q50, "
                f"round(quantile_cont({x}, 0.75), 6) AS q75, round(max({x}), 6) AS max FROM panel")
    q["describe_numeric"] = with_panel(union_all([stats(c) for c in fr.NUMERIC_PROFILE]))
    q["histogram_50"] = with_panel("""
SELECT g.bin, round(r.lo + (r.hi - r.lo) * g.bin / 50, 6) AS bin_lo,
       round(r.lo + (r.hi - r.lo) * (g.bin + 1) / 50, 6) AS bin_hi, coalesce(c.count, 0) AS count
FROM g CROSS JOIN r LEFT JOIN c ON c.bin = g.bin""", """
r AS (SELECT CAST(min(capital_social) AS DOUBLE) AS lo, CAST(max(capital_social) AS DOUBLE) AS hi FROM panel),
b AS (SELECT CAST(least(floor(coalesce((capital_social - r.lo) / nullif(r.hi - r.lo, 0), 0.0) * 50), 49) AS BIGINT)
             AS bin FROM panel, r WHERE capital_social IS NOT NULL),
c AS (SELECT bin, count(*) AS count FROM b GROUP BY bin),
g AS (SELECT range AS bin FROM range(50))""")

    cols = list(dict.fromkeys(fr.CORR_COLUMNS))
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            v = f"round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6)"
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {v} AS corr FROM panel")
            if a != b:
                parts.append(f"SELECT '{b}' AS col_a, '{a}' AS col_b, {v} AS corr FROM panel")
    q["correlation_matrix"] = with_panel(union_all(parts))
    q["correlation_with_target"] = with_panel(union_all([
        f"SELECT '{c}' AS column_name, round(corr(CAST({c} AS DOUBLE), CAST(situacao_cadastral AS DOUBLE)), 6) "
        f"AS corr FROM panel" for c in cols if c != "situacao_cadastral"]))
    lags = ", ".join(f"lag(situacao_cadastral, {k}) OVER ({W}) AS situacao_cadastral_lag_{k}" for k in STATUS_LAGS)
    q["lag_correlation"] = with_panel(union_all([
        f"SELECT 'situacao_cadastral_lag_{k}' AS column_name, round(corr(CAST(situacao_cadastral_lag_{k} AS DOUBLE),"
        f" CAST(situacao_cadastral AS DOUBLE)), 6) AS corr FROM lagged" for k in STATUS_LAGS]),
        f"lagged AS (SELECT *, {lags} FROM panel)")

    q["macro_by_month"] = with_panel(
        "SELECT ano_mes, " + ", ".join(f"round(avg({c}), 6) AS {c}" for c in MACRO_COLS) +
        " FROM panel GROUP BY ano_mes")
    q["series_daily_means"] = ("SELECT CAST(ts AS DATE) AS periodo, event_type AS serie, round(avg(value), 6) AS valor"
                               " FROM events GROUP BY 1, 2")
    first, second = fr.EVENT_TYPES[:2]
    q["macro_unlisted"] = (
        f"WITH {_event_means('CAST(ts AS DATE)')} SELECT periodo, max(valor) FILTER (WHERE serie = '{first}') AS \"{first}\", "
        f"max(valor) FILTER (WHERE serie = '{second}') AS \"{second}\", "
        f"count(*) FILTER (WHERE serie NOT IN ('{first}', '{second}')) AS fora_da_lista FROM em GROUP BY periodo")
    hourly = _event_means("date_trunc('hour', ts)")
    q["macro_wide_outer"] = f"WITH {hourly}, {_wide()} SELECT * FROM wide"
    fills = ", ".join(f'round(coalesce("{t}", (SELECT avg("{t}") FROM wide)), 6) AS "{t}"' for t in fr.EVENT_TYPES)
    q["macro_silver_fill"] = f"WITH {hourly}, {_wide()} SELECT periodo, {fills} FROM wide"

    q["temporal_features"] = with_panel("""
SELECT cnpj, ano_mes, CAST(year(ano_mes) AS INTEGER) AS ano, CAST(month(ano_mes) AS INTEGER) AS mes,
       CAST(quarter(ano_mes) AS INTEGER) AS trimestre, CASE WHEN month(ano_mes) <= 6 THEN 1 ELSE 2 END AS semestre,
       round(sin(2 * pi() * month(ano_mes) / 12), 6) + 0.0 AS mes_sin,
       round(cos(2 * pi() * month(ano_mes) / 12), 6) + 0.0 AS mes_cos,
       CAST((year(ano_mes) - year(s.m)) * 12 + (month(ano_mes) - month(s.m)) AS INTEGER) AS meses_desde_inicio
FROM panel, (SELECT min(ano_mes) AS m FROM panel) s""")
    q["lag_features"] = with_panel(f"SELECT cnpj, ano_mes, situacao_cadastral, {lags} FROM panel")
    dl = ", ".join(f"lag({c}, {k}) OVER ({W}) AS {c}_lag_{k}" for c in DEBT_LAG_COLUMNS for k in (1, 2, 3))
    q["debt_lags"] = with_panel(f"SELECT cnpj, ano_mes, {dl} FROM panel")
    rolls = ", ".join(
        f"{_rolling('situacao_cadastral', w, 'avg')} AS situacao_cadastral_rolling_mean_{w}, "
        f"{_rolling('situacao_cadastral', w, 'stddev_samp')} AS situacao_cadastral_rolling_std_{w}"
        for w in (3, 6, 12))
    q["rolling_mean_std"] = with_panel(f"SELECT cnpj, ano_mes, situacao_cadastral, {rolls} FROM panel")
    rs = ", ".join(f"round(sum({c}) OVER ({W} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW), 2) "
                   f"AS {c}_rolling_sum_{w}" for c in DEBT_COLUMNS for w in (3, 6))
    q["rolling_sum"] = with_panel(f"SELECT cnpj, ano_mes, {rs} FROM panel")
    q["entity_stats"] = with_panel("""
SELECT cnpj, ano_mes,
       round(avg(situacao_cadastral) OVER e, 6) AS situacao_cadastral_mean_empresa,
       round(stddev_samp(situacao_cadastral) OVER e, 6) AS situacao_cadastral_std_empresa,
       min(situacao_cadastral) OVER e AS situacao_cadastral_min_empresa,
       max(situacao_cadastral) OVER e AS situacao_cadastral_max_empresa,
       count(situacao_cadastral) OVER e AS situacao_cadastral_count_empresa,
       first_value(tempo_atividade_anos IGNORE NULLS) OVER f AS tempo_atividade_anos_first,
       first_value(capital_social IGNORE NULLS) OVER f AS capital_social_first
FROM panel
WINDOW e AS (PARTITION BY cnpj),
       f AS (PARTITION BY cnpj ORDER BY ano_mes ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
    ds_ = ", ".join(f"round(avg({c}), 6) AS {c}_mean, round(max({c}), 2) AS {c}_max, round(sum({c}), 2) AS {c}_sum"
                    for c in DEBT_COLUMNS)
    q["entity_debt_stats"] = with_panel(
        "SELECT p.cnpj, p.ano_mes, s.* EXCLUDE (cnpj) FROM panel p JOIN s ON s.cnpj = p.cnpj",
        f"s AS (SELECT cnpj, {ds_} FROM panel GROUP BY cnpj)")
    q["relative_position"] = with_panel(f"""
SELECT cnpj, ano_mes, posicao_temporal, total_registros_empresa,
       round(posicao_temporal / total_registros_empresa, 6) AS posicao_relativa
FROM (SELECT cnpj, ano_mes, row_number() OVER ({W}) - 1 AS posicao_temporal,
             count(*) OVER (PARTITION BY cnpj) AS total_registros_empresa FROM panel) r""")

    predictor = ["ano", "mes", "trimestre", "semestre", "mes_sin", "mes_cos", "meses_desde_inicio", "cnae_fiscal_principal",
                 "uf", "tempo_atividade_anos", *DEBT_LAG_COLUMNS, "situacao_cadastral_t_minus_1",
                 *(f"situacao_cadastral_lag_{k}" for k in (1, 2, 3, 6)),
                 *(f"situacao_cadastral_rolling_mean_{k}" for k in (3, 6, 12)),
                 *(f"situacao_cadastral_rolling_std_{k}" for k in (3, 6)), "posicao_relativa",
                 "situacao_cadastral_mean_empresa", "situacao_cadastral_std_empresa"]
    q["predictor_features"] = with_panel(
        f"SELECT cnpj, ano_mes, situacao_cadastral, {', '.join(predictor)}, {dl}, {rs} FROM feat2", _feature_select())
    failure = ["ano", "mes", "trimestre", "semestre", "mes_sin", "mes_cos", "meses_desde_inicio", "cnae_fiscal_principal",
               "uf", "situacao_cadastral", "situacao_cadastral_t_minus_1", "tempo_atividade_anos", *DEBT_LAG_COLUMNS,
               *(f"situacao_cadastral_lag_{k}" for k in (1, 2, 3)), "situacao_cadastral_rolling_mean_3",
               "situacao_cadastral_rolling_mean_6", "situacao_cadastral_rolling_std_3", "num_mudancas_anteriores",
               "meses_desde_ultima_mudanca", "taxa_mudanca_empresa", *(f"{c}_variacao" for c in DEBT_COLUMNS), "vai_quebrar"]
    diffs = ", ".join(f"round({c} - lag({c}) OVER ({W}), 2) AS {c}_variacao" for c in DEBT_COLUMNS)
    q["failure_features"] = with_panel(
        f"SELECT cnpj, ano_mes, {', '.join(failure)} FROM train WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in failure),
        _feature_select() + f""",
fch0 AS (SELECT *, lag(situacao_cadastral) OVER ({W}) AS anterior FROM feat2),
fch AS (SELECT *, CASE WHEN anterior IS NOT NULL AND anterior <> situacao_cadastral THEN 1 ELSE 0 END AS mudou,
               row_number() OVER ({W}) AS rn,
               CAST(coalesce(lead(situacao_cadastral) OVER ({W}) = 8, false) AS INTEGER) AS vai_quebrar, {diffs} FROM fch0),
train AS (SELECT *, CAST(sum(mudou) OVER u AS BIGINT) AS num_mudancas_anteriores,
                 CAST(rn - coalesce(max(CASE WHEN mudou = 1 THEN rn END) OVER u, 0) AS BIGINT) AS meses_desde_ultima_mudanca,
                 round(sum(mudou) OVER u / rn, 6) AS taxa_mudanca_empresa
          FROM fch WHERE cnpj IN (SELECT cnpj FROM fch WHERE mudou = 1)
          WINDOW u AS ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""")
    q["binary_metrics"] = with_panel(f"""
SELECT round({ratio('hits', 'n')}, 6) AS accuracy, round({ratio('tp', 'said')}, 6) AS precision,
       round({ratio('tp', 'pos')}, 6) AS recall, round({ratio('2 * tp', 'said + pos')}, 6) AS f1
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE y_true = y_pred) AS hits, count(*) FILTER (WHERE y_true = 1) AS pos,
             count(*) FILTER (WHERE y_pred = 1) AS said, count(*) FILTER (WHERE y_true = 1 AND y_pred = 1) AS tp FROM fpred) m""", FAIL)

    q["status_changes"] = with_panel(
        "SELECT cnpj, ano_mes, situacao_cadastral, situacao_anterior, houve_mudanca FROM chg", CHG)
    q["change_totals"] = with_panel(f"""
SELECT total_registros, registros_com_mudanca, empresas_totais, empresas_com_mudanca,
       {pct('registros_com_mudanca', 'total_registros')} AS pct_registros,
       {pct('empresas_com_mudanca', 'empresas_totais')} AS pct_empresas
FROM (SELECT count(*) AS total_registros, CAST(sum(houve_mudanca) AS BIGINT) AS registros_com_mudanca,
             count(DISTINCT cnpj) AS empresas_totais,
             count(DISTINCT CASE WHEN houve_mudanca = 1 THEN cnpj END) AS empresas_com_mudanca FROM chg) t""", CHG)
    q["transition_counts"] = with_panel(f"""
SELECT {label('situacao_anterior')} || ' → ' || {label('situacao_cadastral')} AS transicao_nome,
       CAST(situacao_anterior AS VARCHAR) || ' → ' || CAST(situacao_cadastral AS VARCHAR) AS transicao,
       count(*) AS count
FROM chg
WHERE houve_mudanca = 1 AND {label('situacao_anterior')} IS NOT NULL AND {label('situacao_cadastral')} IS NOT NULL
GROUP BY 1, 2 ORDER BY count DESC, transicao_nome LIMIT 15""", CHG)
    q["origin_of_status"] = with_panel(f"""
SELECT {label('situacao_anterior')} AS origem, count(*) AS count,
       {pct('count(*)', 'sum(count(*)) OVER ()')} AS pct
FROM chg WHERE houve_mudanca = 1 AND situacao_cadastral = 8 GROUP BY 1""", CHG)
    q["entries_by_month"] = with_panel(
        "SELECT ano_mes, count(*) AS count FROM chg WHERE houve_mudanca = 1 AND situacao_cadastral = 8 "
        "GROUP BY ano_mes", CHG)
    q["dynamic_entities"] = with_panel(
        "SELECT cnpj, ano_mes, situacao_cadastral, houve_mudanca FROM chg "
        "WHERE cnpj IN (SELECT cnpj FROM chg WHERE houve_mudanca = 1)", CHG)
    q["sample_histories"] = with_panel(
        "SELECT cnpj, ano_mes, situacao_cadastral FROM panel "
        "WHERE cnpj IN (SELECT DISTINCT cnpj FROM panel ORDER BY cnpj LIMIT 9)")
    q["next_period_targets"] = with_panel(f"""
SELECT cnpj, ano_mes, situacao_cadastral, CAST(coalesce(lead(houve_mudanca) OVER ({W}), 0) AS INTEGER) AS vai_mudar,
       lead(situacao_cadastral) OVER ({W}) AS proxima_situacao,
       CAST(coalesce(lead(situacao_cadastral) OVER ({W}) = 8, false) AS INTEGER) AS vai_quebrar
FROM chg""", CHG)
    q["change_history_features"] = with_panel(f"""
SELECT cnpj, ano_mes, houve_mudanca, CAST(sum(houve_mudanca) OVER u AS BIGINT) AS num_mudancas_anteriores,
       CAST(rn - coalesce(max(CASE WHEN houve_mudanca = 1 THEN rn END) OVER u, 0) AS BIGINT)
         AS meses_desde_ultima_mudanca,
       round(sum(houve_mudanca) OVER u / rn, 6) AS taxa_mudanca_empresa
FROM (SELECT *, row_number() OVER ({W}) AS rn FROM chg) h
WINDOW u AS ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", CHG)
    dd = ", ".join(f"round({c} - lag({c}) OVER ({W}), 2) AS {c}_variacao" for c in DEBT_COLUMNS)
    q["debt_diff"] = with_panel(f"SELECT cnpj, ano_mes, {dd} FROM panel")

    q["complete_rows"] = _complete_rows()
    q["ordered_split"] = with_panel(_split("ano_mes, cnpj", [0.7, 0.9], ["train", "val", "test"]))
    q["entity_order_split"] = with_panel(_split("cnpj, ano_mes", [0.8], ["train", "test"]))
    q["date_split"] = with_panel(
        f"SELECT cnpj, ano_mes, CASE WHEN ano_mes < DATE '{fr.SPLIT_DATE}' THEN 'train' ELSE 'test' END AS split "
        f"FROM panel")
    q["split_distribution"] = with_panel(f"""
SELECT split, situacao_cadastral, count, CAST(sum(count) OVER (PARTITION BY split) AS BIGINT) AS split_rows,
       {pct('sum(count) OVER (PARTITION BY split)', 'sum(count) OVER ()')} AS split_pct
FROM (SELECT split, situacao_cadastral, count(*) AS count FROM sp GROUP BY 1, 2) c""",
        "sp AS (" + _split("ano_mes, cnpj", [0.7, 0.9], ["train", "val", "test"], extra=", situacao_cadastral") + ")")
    enc = ", ".join(f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INTEGER) AS {c}_encoded" for c in fr.ENCODED)
    q["label_encode"] = with_panel(f"SELECT cnpj, ano_mes, {enc} FROM panel")
    q["encode_unseen_zero"] = with_panel(f"""
SELECT p.cnpj, p.ano_mes, p.uf, coalesce(m.code, 0) AS uf_encoded
FROM panel p LEFT JOIN m ON m.value = p.uf """, f"""
m AS (SELECT uf AS value, CAST(dense_rank() OVER (ORDER BY uf) - 1 AS INTEGER) AS code
      FROM (SELECT DISTINCT uf FROM panel WHERE ano_mes < DATE '{fr.SPLIT_DATE}' AND uf IS NOT NULL) d)""")
    q["class_weights"] = with_panel("""
SELECT situacao_cadastral, count,
       round(CAST((SELECT sum(count) FROM cw) AS DOUBLE) / ((SELECT count(*) FROM cw) * count), 6) AS weight
FROM cw""", "cw AS (SELECT situacao_cadastral, count(*) AS count FROM panel GROUP BY 1)")

    q["asof_latest"] = with_panel(
        f"SELECT * FROM panel WHERE ano_mes <= DATE '{fr.AS_OF}' "
        "QUALIFY row_number() OVER (PARTITION BY cnpj ORDER BY ano_mes DESC) = 1")
    lnn = ", ".join(f"max_by({c}, ano_mes) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in PANEL_COLUMNS if c != "cnpj")
    q["asof_last_non_null"] = with_panel(
        f"SELECT cnpj, {lnn} FROM panel WHERE ano_mes <= DATE '{fr.AS_OF}' GROUP BY cnpj")
    q["panel_macro_join"] = with_panel("SELECT * FROM panel")

    q["confusion_matrix"] = with_panel("SELECT y_true, y_pred, count FROM cm", CM)
    q["confusion_normalised"] = with_panel(
        f"SELECT y_true, y_pred, count, round({ratio('count', 'sum(count) OVER (PARTITION BY y_true)')}, 6) AS share "
        f"FROM cm", CM)
    q["class_report"] = with_panel(f"""
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM (
  SELECT CAST(label AS VARCHAR) AS label, precision, recall, f1, CAST(support AS BIGINT) AS support FROM pc
  UNION ALL
  SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM pc
  UNION ALL
  SELECT 'weighted avg', {ratio('sum(precision * support)', 'sum(support)')},
         {ratio('sum(recall * support)', 'sum(support)')}, {ratio('sum(f1 * support)', 'sum(support)')},
         CAST(sum(support) AS BIGINT) FROM pc) r""", CM)
    q["overall_metrics"] = with_panel(f"""
SELECT round({ratio('sum(tp)', 'sum(support)')}, 6) AS accuracy, round(avg(precision), 6) AS precision_macro,
       round(avg(recall), 6) AS recall_macro, round(avg(f1), 6) AS f1_macro,
       round({ratio('sum(f1 * support)', 'sum(support)')}, 6) AS f1_weighted
FROM pc""", CM)
    q["errors_by_class"] = with_panel("""
SELECT y_true, CAST(sum(CAST(erro AS INTEGER)) AS BIGINT) AS total_erros,
       round(avg(CAST(erro AS INTEGER)), 4) AS taxa_erro, count(*) AS total_registros,
       round(1.0 - round(avg(CAST(erro AS INTEGER)), 4), 4) AS taxa_acerto
FROM pred GROUP BY y_true""", PRED)
    q["overall_errors"] = with_panel(f"""
SELECT total, acertos, erros, {pct('acertos', 'total')} AS pct_acertos, {pct('erros', 'total')} AS pct_erros
FROM (SELECT count(*) AS total, count(*) FILTER (WHERE acerto) AS acertos, count(*) FILTER (WHERE erro) AS erros
      FROM pred) t""", PRED)
    q["confidence_stats"] = with_panel(
        "SELECT round(avg(prob_max), 6) AS mean, round(median(prob_max), 6) AS median, "
        "round(min(prob_max), 6) AS min, round(max(prob_max), 6) AS max FROM pred", PRED)
    bands = ", ".join(f"({i}, '{lbl}', CAST({lo} AS DOUBLE), CAST({hi} AS DOUBLE))"
                      for i, (lo, hi, lbl) in enumerate(CONFIDENCE_BANDS))
    q["confidence_bands"] = with_panel("""
SELECT b.band_order, b.band, coalesce(s.total, 0) AS total, coalesce(s.acertos, 0) AS acertos, s.taxa_acerto
FROM bands b LEFT JOIN s ON s.band = b.band""", PRED + f""",
bands AS (SELECT * FROM (VALUES {bands}) v(band_order, band, lo, hi)),
s AS (SELECT b.band, count(*) AS total, count(*) FILTER (WHERE acerto) AS acertos,
             round(avg(CAST(acerto AS DOUBLE)) * 100, 4) AS taxa_acerto
      FROM pred JOIN bands b ON prob_max > b.lo AND prob_max <= b.hi GROUP BY b.band)""")
    q["high_risk_top"] = with_panel("""
SELECT cnpj, ano_mes, prob_quebra, situacao_cadastral, tempo_atividade_anos, num_mudancas_anteriores, y_true
FROM fpred WHERE prob_quebra > CAST(0.7 AS DOUBLE) ORDER BY prob_quebra DESC, cnpj, ano_mes LIMIT 15""", FAIL)
    q["risk_by_status"] = with_panel("""
SELECT situacao_cadastral, count(*) AS count, round(avg(prob_quebra), 6) AS mean_prob
FROM fpred WHERE prob_quebra > CAST(0.7 AS DOUBLE) GROUP BY situacao_cadastral""", FAIL)
    q["positive_profile"] = with_panel("""
SELECT count(*) AS "rows", count(DISTINCT cnpj) AS entities, CAST(sum(y_pred) AS BIGINT) AS detected,
       round(avg(CAST(y_pred AS DOUBLE)) * 100, 6) AS detection_pct, round(avg(prob_quebra), 6) AS mean_prob,
       round(avg(tempo_atividade_anos), 6) AS mean_age, round(avg(num_mudancas_anteriores), 6) AS mean_changes
FROM fpred WHERE y_true = 1""", FAIL)

    q["clean_list_strings"] = with_panel("""
SELECT cnpj, ano_mes, uf_lista, trim(regexp_replace(uf_lista, '[\\[\\]'']', '', 'g')) AS uf_limpo
FROM (SELECT cnpj, ano_mes, '[''' || uf || ''']' AS uf_lista FROM panel) l""")
    q["lenient_numeric"] = """
SELECT event_id, k_texto, TRY_CAST(k_texto AS DOUBLE) AS k
FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a' ELSE json_extract_string(props, '$.k') END
             AS k_texto FROM events) e"""
    q["json_props"] = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       event_type IN ('view', 'click', 'purchase', 'signup') AS tipo_valido
FROM events"""
    q["dedup_keep_first"] = """
SELECT o_custkey, mes, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, strftime(o_orderdate, '%Y-%m') AS mes,
         row_number() OVER (PARTITION BY o_custkey, strftime(o_orderdate, '%Y-%m')
                            ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders) o WHERE rn = 1"""
    q["scalar_functions"] = """
SELECT o_orderkey, periodo,
       CAST(strptime(periodo, '%Y-%m') AS DATE) AS mes_data,
       CAST(strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS dia,
       CAST(o_orderdate AS TIMESTAMP) AS momento,
       make_date(year(o_orderdate), month(o_orderdate), 1) AS mes_partes,
       CAST(year(o_orderdate) AS VARCHAR) || '-' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS rotulo,
       CAST(o_orderkey AS VARCHAR) AS chave_texto,
       CAST(o_orderkey AS VARCHAR) || ' → ' || periodo AS seta,
       periodo AS periodo_do_caminho,
       replace(periodo, '-', '_') AS periodo_sublinhado,
       split_part(periodo, '-', 1) AS ano_texto,
       'estabelecimentos/' || periodo || '/K3241.D' || CAST(o_orderkey AS VARCHAR) || '.ESTABELE' AS sem_prefixo,
       'K3241.D' || CAST(o_orderkey AS VARCHAR) || '.ESTABELE' AS arquivo,
       'K3241.D' || CAST(o_orderkey AS VARCHAR) AS radical
FROM (SELECT *, strftime(o_orderdate, '%Y-%m') AS periodo FROM orders) o"""
    q["work_list"] = _work_list_ctes() + "\nSELECT * FROM work"
    q["pending_work"] = _work_list_ctes() + """
SELECT * FROM work w WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE year(o.o_orderdate) = w.ano AND quarter(o.o_orderdate) = w.trimestre)"""
    q["period_filter"] = """
SELECT periodo FROM (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS periodo FROM orders) p
WHERE periodo >= '1996-03' AND periodo <= '1998-11' AND CAST(substr(periodo, 6, 2) AS INTEGER) IN (1, 2, 3, 6, 12)"""
    q["row_positions"] = with_panel(
        "SELECT cnpj, ano_mes, row_number() OVER (ORDER BY ano_mes NULLS FIRST, cnpj NULLS FIRST) AS row_index FROM panel")
    planted = "'" + PLANTED_LINKS.replace("'", "''") + "'"
    unescaped = "h"
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''"), ("&#47;", "/"), ("&#x2e;", "."),
                         ("&#39;", "''"), ("&amp;", "&")):  # the numbers that occur
        unescaped = f"replace({unescaped}, '{entity}', '{sign}')"
    q["page_links"] = f"""
WITH named AS (SELECT page_id, html || replace({planted}, '{{}}', (['Estabelecimentos', 'Empresa', 'lucro_real_', 'Socios'])[page_id % 4 + 1]
                  || page_id) AS html FROM pages),
plain AS (SELECT page_id, regexp_replace(html, '(?is)<!--.*?(?:-->|$)|<script\\b[^>]*>.*?(?:</script\\s*>|$)|<style\\b[^>]*>.*?(?:</style\\s*>|$)'
                 || '|<textarea\\b[^>]*>.*?(?:</textarea\\s*>|$)|<title\\b[^>]*>.*?(?:</title\\s*>|$)', '', 'g') AS html FROM named),
tags AS (SELECT page_id, unnest(range(0, len(t))) AS p, unnest(t) AS tag
         FROM (SELECT page_id, regexp_extract_all(html, '(?is)<a([\\s/](?:[^>"'']|"[^"]*"|''[^'']*'')*)>', 1) AS t FROM plain)),
attributes AS (SELECT page_id, p, list_transform(regexp_extract_all(tag, {_ATTR}, 1), lambda x: lower(x)) AS k,
                      regexp_extract_all(tag, {_ATTR}, 2) AS v FROM tags),
hrefs AS (SELECT page_id, p, regexp_replace(v[list_position(k, 'href')], '^["'']|["'']$', '', 'g') AS h
          FROM attributes WHERE list_contains(k, 'href')),
x AS (SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY p) - 1 AS INTEGER) AS pos,
             {unescaped} AS link FROM hrefs),
y AS (SELECT *, regexp_extract(link, '([^/]*)/?$', 1) AS arquivo FROM x)
SELECT page_id, pos, link, arquivo,
       regexp_matches(arquivo, '(?i)^Estabelecimentos?\\d+\\.zip') AS is_estabelecimentos,
       regexp_matches(arquivo, '(?i)^Empresas?\\d+\\.zip') AS is_empresas,
       ends_with(lower(arquivo), '.zip') AND regexp_matches(lower(arquivo), '(?i)(lucro|imunes|isentas)') AS is_regime
FROM y"""
    return q


ORACLE = build() | LANDED_ORACLE
