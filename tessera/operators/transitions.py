"""Status-change history.

All per-entity columns use the single ``(entity, period)`` window spec.
"Rows since the last change" (W10) is computed as the row number minus the
row number of the latest change row - a running max on the same frame, so
no second partitioning or per-entity loop is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import CLOSED_STATUS, DEBT_COLUMNS, STATUS_LABELS
from ..functions.scores import percent, rounded
from ..functions.text import arrow_concat
from .clean import existing
from .profile import label_of

ENTITY, PERIOD, TARGET = "cnpj", "ano_mes", "situacao_cadastral"


def _w(entity=ENTITY, period=PERIOD):
    return Window.partitionBy(entity).orderBy(period)


def changed(cur: Column, prev: Column) -> Column:
    """W6 flag: differs from the previous value and a previous value exists (NULL-safe)."""
    return (prev.isNotNull() & ~cur.eqNullSafe(prev)).cast("int")


def status_changes(df: DataFrame, col: str = TARGET, entity: str = ENTITY, period: str = PERIOD) -> DataFrame:
    """``situacao_anterior`` and ``houve_mudanca``."""
    prev = F.lag(col, 1).over(_w(entity, period))
    return (df.withColumn("situacao_anterior", prev)
            .withColumn("houve_mudanca", changed(F.col(col), F.col("situacao_anterior"))))


def next_period_targets(df: DataFrame, col: str = TARGET, closed: int = CLOSED_STATUS,
                        entering_only: bool = False) -> DataFrame:
    """``vai_mudar`` (next row is a change, else 0), ``proxima_situacao`` and
    ``vai_quebrar`` (next status is ``closed``; also 1 for an entity that stays closed
    unless ``entering_only``)."""
    w = _w()
    nxt = F.lead(col, 1).over(w)
    quebra = nxt == closed
    if entering_only:
        quebra = quebra & (F.col(col) != closed)
    return df.withColumns({
        "vai_mudar": F.coalesce(F.lead("houve_mudanca", 1).over(w), F.lit(0)),
        "proxima_situacao": nxt,
        "vai_quebrar": F.coalesce(quebra, F.lit(False)).cast("int"),
    })


def change_history(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Cumulative changes (current row included), rows since the last change
    (0 on a change row, 1, 2, ... before any change), and change rate."""
    w = _w()
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    last_change = F.max(F.when(F.col("houve_mudanca") == 1, F.col("_rn"))).over(upto)
    return (df.withColumn("_rn", F.row_number().over(w))
            .withColumns({
                "num_mudancas_anteriores": F.sum("houve_mudanca").over(upto),
                "meses_desde_ultima_mudanca": (F.col("_rn") - F.coalesce(last_change, F.lit(0))).cast("bigint"),
            })
            .withColumn("taxa_mudanca_empresa", rounded(F.col("num_mudancas_anteriores") / F.col("_rn"), digits))
            .drop("_rn"))


def debt_differences(df: DataFrame, cols=DEBT_COLUMNS, digits: int | None = None) -> DataFrame:
    """First difference of each debt column within the entity."""
    w = _w()
    return df.withColumns({f"{c}_variacao": rounded(F.col(c) - F.lag(c, 1).over(w), digits)
                           for c in existing(df, cols)})


def dynamic_entities(df: DataFrame, entity: str = ENTITY) -> DataFrame:
    """All rows of entities with at least one change (window max, no join)."""
    return (df.withColumn("_any", F.max("houve_mudanca").over(Window.partitionBy(entity)))
            .where(F.col("_any") == 1).drop("_any"))


def change_totals(df: DataFrame, entity: str = ENTITY, digits: int = 4) -> DataFrame:
    """Changed rows and entities, with shares, in one aggregate."""
    row = df.agg(F.count(F.lit(1)).alias("total_registros"),
                 F.sum("houve_mudanca").cast("bigint").alias("registros_com_mudanca"),
                 F.count_distinct(entity).alias("empresas_totais"),
                 F.count_distinct(F.when(F.col("houve_mudanca") == 1, F.col(entity))).alias("empresas_com_mudanca"))
    return row.withColumns({
        "pct_registros": percent("registros_com_mudanca", "total_registros", digits),
        "pct_empresas": percent("empresas_com_mudanca", "empresas_totais", digits),
    })


def transition_counts(df: DataFrame, n: int = 15, col: str = TARGET, labels: dict = STATUS_LABELS) -> DataFrame:
    """A19 + F11: ``'ATIVA → BAIXADA'`` counts, most frequent first (ties by name)."""
    moves = df.where(F.col("houve_mudanca") == 1)
    named = moves.select(
        arrow_concat(F.col("situacao_anterior").cast("int"), F.col(col).cast("int")).alias("transicao"),
        arrow_concat(label_of("situacao_anterior", labels, None), label_of(col, labels, None)).alias("transicao_nome"),
        label_of("situacao_anterior", labels, None).isNotNull().alias("_a"),
        label_of(col, labels, None).isNotNull().alias("_b"))
    return (named.where("_a AND _b").groupBy("transicao_nome", "transicao")
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "transicao_nome").limit(n))


def origin_of_status(df: DataFrame, into: int = CLOSED_STATUS, col: str = TARGET, digits: int = 4) -> DataFrame:
    """Where moves into ``into`` came from, with percent of those moves."""
    moves = df.where((F.col("houve_mudanca") == 1) & (F.col(col) == into))
    counts = (moves.groupBy(label_of("situacao_anterior", STATUS_LABELS, None).alias("origem"))
              .agg(F.count(F.lit(1)).alias("count")))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("pct", percent(F.col("count"), total, digits))


def entries_by_month(df: DataFrame, into: int = CLOSED_STATUS, col: str = TARGET, period: str = PERIOD) -> DataFrame:
    """Number of moves into ``into`` per period."""
    return (df.where((F.col("houve_mudanca") == 1) & (F.col(col) == into))
            .groupBy(period).agg(F.count(F.lit(1)).alias("count")))
