"""Stand-in frames derived from the driver tables, shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import FAILURE_FEATURES
from ..operators import features as fe
from ..operators import transitions as tr
from ..operators.clean import drop_incomplete, existing
from .panel import panel

NUMERIC_PROFILE = ["situacao_cadastral", "capital_social", "tempo_atividade_anos",
                   "pgfn_fgts_valor_acumulado_t_minus_1", "selic_meta_mensal_t_minus_1"]
CORR_COLUMNS = ["situacao_cadastral", "situacao_cadastral_t_minus_1", "capital_social", "tempo_atividade_anos",
                "pgfn_fgts_valor_acumulado_t_minus_1", "selic_meta_mensal_t_minus_1"]
ENCODED = ["uf", "cnae_fiscal_principal", "porte_empresa"]
EVENT_TYPES = ["view", "signup", "error", "click", "purchase"]
AS_OF = "1999-06-01"
SPLIT_DATE = "1999-01-01"


def rule_probability(entity="cnpj", period="ano_mes"):
    """Deterministic stand-in score in [0, 1]: ((entity*37 + month*11) % 101) / 100."""
    return ((F.col(entity) * 37 + F.month(period) * 11) % 101).cast("double") / 100


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.status_changes(panel(spark, sf_dir))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-class stand-in: predict the previous status; rows with a previous status only."""
    p = panel(spark, sf_dir).where(F.col("situacao_cadastral_t_minus_1").isNotNull())
    hit = F.col("situacao_cadastral") == F.col("situacao_cadastral_t_minus_1")
    return p.select("cnpj", "ano_mes", F.col("situacao_cadastral").alias("y_true"),
                    F.col("situacao_cadastral_t_minus_1").alias("y_pred"),
                    rule_probability().alias("prob_max"), (~hit).alias("erro"), hit.alias("acerto"))


def failure_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary "will close next period" frame over entities that ever changed (M7 inputs)."""
    return (changes(spark, sf_dir).transform(tr.dynamic_entities).transform(tr.next_period_targets)
            .transform(tr.change_history))


def failure_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = failure_frame(spark, sf_dir)
    prob = rule_probability()
    return f.select("cnpj", "ano_mes", "situacao_cadastral", "tempo_atividade_anos", "num_mudancas_anteriores",
                    "meses_desde_ultima_mudanca", F.col("vai_quebrar").alias("y_true"),
                    F.when(prob > 0.5, F.lit(1)).otherwise(F.lit(0)).alias("y_pred"), prob.alias("prob_quebra"))


def failure_training(spark: SparkSession, sf_dir: str, digits: int | None = None,
                     debt_digits: int | None = None) -> DataFrame:
    """M7 training rows: the feature chain, change history and debt differences of entities that
    ever changed, without rows that miss a listed feature."""
    frame = (fe.feature_frame(panel(spark, sf_dir), digits).transform(tr.status_changes).transform(tr.dynamic_entities)
             .transform(tr.next_period_targets).transform(tr.change_history, digits=digits)
             .transform(tr.debt_differences, digits=debt_digits))
    wanted = existing(frame, FAILURE_FEATURES)
    return drop_incomplete(frame.select("cnpj", "ano_mes", *wanted, "vai_quebrar"), [*wanted, "vai_quebrar"])
