"""Time-series features per entity.

All windows share one spec, ``partitionBy(entity).orderBy(period)``, so a
chain of these operators costs one shuffle and one sort.  Per-entity
statistics are window aggregates over the same partitioning instead of a
``groupBy`` joined back (which would shuffle twice more).  A panel entity has
at most one row per period, so these partitions cannot be skewed by one hot
entity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import (DEBT_COLUMNS, DEBT_LAG_COLUMNS, DEBT_LAGS, DEBT_ROLLING_WINDOWS, PREDICTOR_FEATURES,
                         ROLLING_WINDOWS, STATUS_LAGS)
from ..functions.dates import calendar_parts, months_between_starts
from ..functions.scores import rounded
from .clean import existing

ENTITY, PERIOD, TARGET = "cnpj", "ano_mes", "situacao_cadastral"


def ordered(entity: str = ENTITY, period: str = PERIOD):
    return Window.partitionBy(entity).orderBy(period)


def temporal_features(df: DataFrame, period: str = PERIOD, digits: int | None = None) -> DataFrame:
    """F4-F6 + W14: calendar parts, cyclic month, months since the dataset's first period.

    The dataset minimum is a scalar subquery (no collect mid-plan, no join).
    """
    parts = calendar_parts(period)
    for c in ("mes_sin", "mes_cos"):  # "+ 0.0" turns a rounded -0.0 into 0.0
        parts[c] = rounded(parts[c], digits) + F.lit(0.0)
    start = df.agg(F.min(period)).scalar()
    parts["meses_desde_inicio"] = months_between_starts(F.col(period), start)
    return df.withColumns(parts)


def lag_features(df: DataFrame, col: str = TARGET, lags=STATUS_LAGS, entity: str = ENTITY,
                 period: str = PERIOD) -> DataFrame:
    """``<col>_lag_<k>`` = value k rows earlier in the entity's history."""
    w = ordered(entity, period)
    return df.withColumns({f"{col}_lag_{k}": F.lag(col, k).over(w) for k in lags})


def debt_lag_features(df: DataFrame, cols=DEBT_LAG_COLUMNS, lags=DEBT_LAGS) -> DataFrame:
    """Lags of the debt columns that exist."""
    w = ordered()
    return df.withColumns({f"{c}_lag_{k}": F.lag(c, k).over(w) for c in existing(df, cols) for k in lags})


def rolling_features(df: DataFrame, col: str = TARGET, windows=ROLLING_WINDOWS, fill: float | None = 0.0,
                     digits: int | None = None, exclude_current: bool = False, entity: str = ENTITY,
                     period: str = PERIOD) -> DataFrame:
    """W3 (+P7): rolling mean / sample std over the last ``w`` rows, current row
    included (short windows allowed); missing -> ``fill``.  ``exclude_current``
    shifts the frame one row back so the target does not leak into its feature."""
    base = ordered(entity, period)
    end = -1 if exclude_current else 0
    out = {}
    for w in windows:
        frame = base.rowsBetween(-w + end + 1, end)
        mean = rounded(F.avg(col).over(frame), digits)
        std = rounded(F.stddev_samp(col).over(frame), digits)
        if fill is not None:
            mean, std = F.coalesce(mean, F.lit(fill)), F.coalesce(std, F.lit(fill))
        out[f"{col}_rolling_mean_{w}"] = mean
        out[f"{col}_rolling_std_{w}"] = std
    return df.withColumns(out)


def rolling_sums(df: DataFrame, cols=DEBT_COLUMNS, windows=DEBT_ROLLING_WINDOWS, digits: int | None = None) -> DataFrame:
    """Rolling sum of each debt column over the last ``w`` rows."""
    base = ordered()
    return df.withColumns({f"{c}_rolling_sum_{w}": rounded(F.sum(c).over(base.rowsBetween(-w + 1, 0)), digits)
                           for c in existing(df, cols) for w in windows})


def entity_stats(df: DataFrame, col: str = TARGET, firsts=("tempo_atividade_anos", "capital_social"),
                 digits: int | None = None, entity: str = ENTITY, period: str = PERIOD) -> DataFrame:
    """A10 + J2: per-entity mean / std (n-1) / min / max / count of ``col`` and the
    first non-null value (by period) of a few attributes, attached to every row."""
    whole = Window.partitionBy(entity)
    out = {
        f"{col}_mean_empresa": rounded(F.avg(col).over(whole), digits),
        f"{col}_std_empresa": rounded(F.stddev_samp(col).over(whole), digits),
        f"{col}_min_empresa": F.min(col).over(whole),
        f"{col}_max_empresa": F.max(col).over(whole),
        f"{col}_count_empresa": F.count(col).over(whole),
    }
    for c in existing(df, list(firsts)):
        out[f"{c}_first"] = F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(period))).over(whole)
    return df.withColumns(out)


def relative_position(df: DataFrame, digits: int | None = None, entity: str = ENTITY, period: str = PERIOD) -> DataFrame:
    """W5 + A12: 0-based position in the history, rows per entity, position / rows."""
    pos = (F.row_number().over(ordered(entity, period)) - 1).cast("bigint")
    total = F.count(F.lit(1)).over(Window.partitionBy(entity))
    return (df.withColumns({"posicao_temporal": pos, "total_registros_empresa": total})
            .withColumn("posicao_relativa",
                        rounded(F.col("posicao_temporal") / F.col("total_registros_empresa"), digits)))


def entity_debt_stats(df: DataFrame, cols=DEBT_COLUMNS, digits: int | None = None, mean_digits: int | None = None,
                      entity: str = ENTITY) -> DataFrame:
    """Per-entity mean / max / sum of each debt column (one row per entity)."""
    aggs = []
    for c in existing(df, cols):
        aggs += [rounded(F.avg(c), mean_digits).alias(f"{c}_mean"), rounded(F.max(c), digits).alias(f"{c}_max"),
                 rounded(F.sum(c), digits).alias(f"{c}_sum")]
    return df.groupBy(entity).agg(*aggs)


def join_entity_stats(df: DataFrame, stats: DataFrame, entity: str = ENTITY, suffix: str = "_empresa") -> DataFrame:
    """Inner join of per-entity aggregates; colliding names get ``suffix``."""
    clash = [c for c in stats.columns if c != entity and c in df.columns]
    stats = stats.withColumnsRenamed({c: c + suffix for c in clash})
    return df.join(stats, entity, "inner")


def feature_frame(df: DataFrame, digits: int | None = None) -> DataFrame:
    """The full feature chain of the status model on one window spec."""
    return (df.transform(temporal_features, digits=digits)
            .transform(lag_features)
            .transform(rolling_features, digits=digits)
            .transform(entity_stats, digits=digits)
            .transform(relative_position, digits=digits))


def predictor_frame(df: DataFrame, digits: int | None = None, sum_digits: int | None = None) -> DataFrame:
    """The status predictor's frame: the feature chain with debt lags (W2) and rolling debt sums (W4),
    its listed features first, then those of the debts."""
    full = df.transform(feature_frame, digits=digits).transform(debt_lag_features).transform(
        rolling_sums, digits=sum_digits)
    debts = [c for c in full.columns if c.startswith("pgfn") and ("_lag_" in c or "_rolling_" in c)]
    return full.select(*dict.fromkeys([ENTITY, PERIOD, TARGET, *existing(full, PREDICTOR_FEATURES), *debts]))
