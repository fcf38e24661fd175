"""Declared schemas.  Nothing in the engine infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# Establishment file layout (30 string columns, headerless).
ESTABLISHMENT_COLUMNS = [
    "cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial", "nome_fantasia",
    "situacao_cadastral", "data_situacao_cadastral", "motivo_situacao_cadastral",
    "nome_cidade_exterior", "pais", "data_inicio_atividade", "cnae_fiscal_principal",
    "cnae_fiscal_secundaria", "tipo_logradouro", "logradouro", "numero", "complemento", "bairro",
    "cep", "uf", "municipio", "ddd_1", "telefone_1", "ddd_2", "telefone_2", "ddd_fax", "fax",
    "correio_eletronico", "situacao_especial", "data_situacao_especial",
]
# Company file layout (7 string columns, headerless).
COMPANY_COLUMNS = [
    "cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel",
    "capital_social", "porte_empresa", "ente_federativo_responsavel",
]
# Debt file layout (13 string columns, one header row).
DEBT_FILE_COLUMNS = [
    "cpf_cnpj", "tipo_pessoa", "tipo_devedor", "nome_devedor", "uf_devedor", "unidade_responsavel",
    "numero_inscricao", "tipo_situacao_inscricao", "situacao_inscricao", "receita_principal",
    "data_inscricao", "indicador_ajuizado", "valor_consolidado",
]

ESTABLISHMENTS = _strings(ESTABLISHMENT_COLUMNS)
COMPANIES = _strings(COMPANY_COLUMNS)
DEBTS = _strings(DEBT_FILE_COLUMNS)

TAX_REGIME = T.StructType([
    T.StructField("ano", T.IntegerType(), True),
    T.StructField("cnpj", T.StringType(), True),
    T.StructField("cnpj_da_scp", T.StringType(), True),
    T.StructField("forma_de_tributacao", T.StringType(), True),
    T.StructField("quantidade_de_escrituracoes", T.IntegerType(), True),
])

SERIES_POINTS = "array<struct<data:string,valor:string>>"

PANEL = T.StructType([
    T.StructField("cnpj", T.StringType(), True),
    T.StructField("ano_mes", T.StringType(), True),
    T.StructField("situacao_cadastral", T.IntegerType(), True),
    T.StructField("cnae_fiscal_principal", T.StringType(), True),
    T.StructField("uf", T.StringType(), True),
    T.StructField("natureza_juridica", T.StringType(), True),
    T.StructField("porte_empresa", T.StringType(), True),
    T.StructField("tempo_atividade_anos", T.DoubleType(), True),
    T.StructField("situacao_cadastral_t_minus_1", T.IntegerType(), True),
    T.StructField("selic_meta_mensal_t_minus_1", T.DoubleType(), True),
    T.StructField("ipca_acumulado_12m_t_minus_1", T.DoubleType(), True),
    T.StructField("ipca_mensal_t_minus_1", T.DoubleType(), True),
    T.StructField("cambio_dolar_media_mensal_t_minus_1", T.DoubleType(), True),
    T.StructField("taxa_desemprego_t_minus_1", T.DoubleType(), True),
    T.StructField("capital_social", T.DoubleType(), True),
    T.StructField("pgfn_fgts_valor_acumulado_t_minus_1", T.DoubleType(), True),
    T.StructField("pgfn_naoprev_valor_acumulado_t_minus_1", T.DoubleType(), True),
    T.StructField("pgfn_prev_valor_acumulado_t_minus_1", T.DoubleType(), True),
    T.StructField("pgfn_fgts_ajuizados_t_minus_1", T.DoubleType(), True),
])


def macro_schema(names: list[str]) -> T.StructType:
    """Wide monthly indicator table: ``ano_mes`` required + one double per series."""
    return T.StructType([T.StructField("ano_mes", T.StringType(), False)] +
                        [T.StructField(n, T.DoubleType(), True) for n in names])
