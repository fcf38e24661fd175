"""Values that must equal the source system's for results to line up.

Everything here is a FIXED VALUE taken from the public data layouts the
engine reads (registry status codes, macro series, panel column names);
it is stated plainly, in natural order, and nowhere else.
"""

# --- Fixed values: registration status code -> label -------------------------
STATUS_LABELS = {1: "NULA", 2: "ATIVA", 3: "SUSPENSA", 4: "INAPTA", 8: "BAIXADA"}
STATUS_CODES = [1, 2, 3, 4, 8]
CLOSED_STATUS = 8

# --- Fixed values: monthly macro indicator series (code -> column name) ------
MACRO_SERIES = {
    4390: "selic_meta_mensal",
    433: "ipca_acumulado_12m",
    13522: "ipca_mensal",
    21082: "inadimplencia_pj_livre",
    20542: "volume_credito_pj_total",
    20714: "spread_credito_pj",
    10813: "cambio_dolar_media_mensal",
    24363: "ibc_br_dessazonalizado",
    4394: "icei",
    7341: "nivel_utilizacao_capacidade",
    24369: "taxa_desemprego",
}

# --- Fixed values: panel key, target and column names -------------------------
ENTITY = "cnpj"
PERIOD = "ano_mes"
TARGET = "situacao_cadastral"

MACRO_T1_COLUMNS = [
    "selic_meta_mensal_t_minus_1",
    "ipca_acumulado_12m_t_minus_1",
    "ipca_mensal_t_minus_1",
    "cambio_dolar_media_mensal_t_minus_1",
    "taxa_desemprego_t_minus_1",
]
DEBT_COLUMNS = [
    "pgfn_fgts_valor_acumulado_t_minus_1",
    "pgfn_naoprev_valor_acumulado_t_minus_1",
    "pgfn_prev_valor_acumulado_t_minus_1",
]
DEBT_LAG_COLUMNS = DEBT_COLUMNS + ["pgfn_fgts_ajuizados_t_minus_1"]

# --- Fixed values: feature-engineering parameters ------------------------------
STATUS_LAGS = [1, 2, 3, 6, 12]
DEBT_LAGS = [1, 2, 3]
ROLLING_WINDOWS = [3, 6, 12]
DEBT_ROLLING_WINDOWS = [3, 6]
SPLIT_FRACTIONS = (0.7, 0.9)

# Feature list of the multi-class status model, in the order it is assembled.
MODEL_FEATURES = [
    "ano", "mes", "trimestre", "semestre", "mes_sin", "mes_cos", "meses_desde_inicio",
    "cnae_fiscal_principal", "uf", "natureza_juridica", "porte_empresa",
    "tempo_atividade_anos", "situacao_cadastral_t_minus_1",
    "selic_meta_mensal_t_minus_1", "ipca_acumulado_12m_t_minus_1", "ipca_mensal_t_minus_1",
    "cambio_dolar_media_mensal_t_minus_1", "taxa_desemprego_t_minus_1",
    "capital_social",
    "pgfn_fgts_valor_acumulado_t_minus_1", "pgfn_naoprev_valor_acumulado_t_minus_1",
    "pgfn_prev_valor_acumulado_t_minus_1", "pgfn_fgts_ajuizados_t_minus_1",
    "situacao_cadastral_lag_1", "situacao_cadastral_lag_2", "situacao_cadastral_lag_3",
    "situacao_cadastral_lag_6",
    "situacao_cadastral_rolling_mean_3", "situacao_cadastral_rolling_mean_6",
    "situacao_cadastral_rolling_mean_12", "situacao_cadastral_rolling_std_3",
    "situacao_cadastral_rolling_std_6",
    "posicao_relativa", "situacao_cadastral_mean_empresa", "situacao_cadastral_std_empresa",
]

# Feature list of the status predictor, in order; debt lags and rolling sums follow it.
PREDICTOR_FEATURES = [
    "ano", "mes", "trimestre", "semestre", "mes_sin", "mes_cos", "meses_desde_inicio",
    "cnae_fiscal_principal", "uf", "tempo_atividade_anos",
    "pgfn_fgts_valor_acumulado_t_minus_1", "pgfn_naoprev_valor_acumulado_t_minus_1",
    "pgfn_prev_valor_acumulado_t_minus_1", "pgfn_fgts_ajuizados_t_minus_1", "situacao_cadastral_t_minus_1",
    "situacao_cadastral_lag_1", "situacao_cadastral_lag_2", "situacao_cadastral_lag_3", "situacao_cadastral_lag_6",
    "situacao_cadastral_rolling_mean_3", "situacao_cadastral_rolling_mean_6", "situacao_cadastral_rolling_mean_12",
    "situacao_cadastral_rolling_std_3", "situacao_cadastral_rolling_std_6",
    "posicao_relativa", "situacao_cadastral_mean_empresa", "situacao_cadastral_std_empresa",
]
# Feature list of the failure model, in order.
FAILURE_FEATURES = [
    "ano", "mes", "trimestre", "semestre", "mes_sin", "mes_cos", "meses_desde_inicio",
    "cnae_fiscal_principal", "uf", "situacao_cadastral", "situacao_cadastral_t_minus_1", "tempo_atividade_anos",
    "pgfn_fgts_valor_acumulado_t_minus_1", "pgfn_naoprev_valor_acumulado_t_minus_1",
    "pgfn_prev_valor_acumulado_t_minus_1", "pgfn_fgts_ajuizados_t_minus_1",
    "situacao_cadastral_lag_1", "situacao_cadastral_lag_2", "situacao_cadastral_lag_3",
    "situacao_cadastral_rolling_mean_3", "situacao_cadastral_rolling_mean_6", "situacao_cadastral_rolling_std_3",
    "num_mudancas_anteriores", "meses_desde_ultima_mudanca", "taxa_mudanca_empresa",
    "pgfn_fgts_valor_acumulado_t_minus_1_variacao", "pgfn_naoprev_valor_acumulado_t_minus_1_variacao",
    "pgfn_prev_valor_acumulado_t_minus_1_variacao",
]
# Importance families: listed features, or (marked *) every feature with the word in its name; they overlap.
FEATURE_FAMILIES = {
    "Temporais": ["ano", "mes", "trimestre", "semestre", "mes_sin", "mes_cos", "meses_desde_inicio"],
    "Categóricas": ["*_encoded"],
    "Macroeconômicas": MACRO_T1_COLUMNS,
    "PGFN": DEBT_LAG_COLUMNS,
    "Lag": ["*lag"],
    "Rolling": ["*rolling"],
    "Empresa": ["tempo_atividade_anos", "capital_social", "situacao_cadastral_t_minus_1"],
    "Agregadas": ["*empresa", "*posicao"],
}

# --- Fixed values: confidence bands (right-closed; 0 falls in no band) --------
CONFIDENCE_BANDS = [
    (0.0, 0.5, "Baixa (0-50%)"),
    (0.5, 0.7, "Média (50-70%)"),
    (0.7, 0.9, "Alta (70-90%)"),
    (0.9, 1.0, "Muito Alta (90-100%)"),
]
HIGH_RISK_THRESHOLD = 0.7
MINORITY_CLASS_MAX = 100

# --- Fixed values: landed-file name patterns -----------------------------------
ESTABLISHMENT_ZIP_PATTERN = r"(?i)^Estabelecimentos?\d+\.zip"
COMPANY_ZIP_PATTERN = r"(?i)^Empresas?\d+\.zip"
REGIME_KEYWORDS = ["lucro", "imunes", "isentas"]
DEBT_TYPES = ["Nao_Previdenciario", "FGTS", "Previdenciario"]
# Debt type of the files -> the word its panel columns use.
DEBT_KINDS = {"FGTS": "fgts", "Nao_Previdenciario": "naoprev", "Previdenciario": "prev"}
ALL_TYPES = "all"
# Bad rows a load takes before it is rejected.
BAD_ROW_BUDGET = {"registry": 10_000, "debts": 1_000}
# Where a period stands in a path: the folder that holds the file, else anywhere.
PERIOD_IN_FOLDER = r"(\d{4}-\d{2})/?$"
PERIOD_ANYWHERE = r"(\d{4}-\d{2})"
REGISTRY_DATA_TYPES = ["estabelecimentos", "empresas"]
WRITE_MODES = ["WRITE_TRUNCATE", "WRITE_APPEND"]
