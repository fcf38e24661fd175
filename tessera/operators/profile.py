"""Profiling aggregates.

Every profile is one pass: all columns' statistics go into a single
aggregate row, which is then unpivoted to one row per column.  Shares of a
total use a scalar subquery over the already-grouped frame, never a global
window over data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import MINORITY_CLASS_MAX, STATUS_LABELS
from ..functions.scores import percent
from .quantiles import exact_quantiles


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label_of(c, labels: dict = STATUS_LABELS, unknown: str | None = "Desconhecida") -> Column:
    """Code -> label through a literal map; unknown -> ``'Desconhecida (<n>)'`` or NULL."""
    m = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), F.lit(v))])
    hit = m[_c(c)]
    if unknown is None:
        return hit
    return F.coalesce(hit, F.concat(F.lit(unknown + " ("), _c(c).cast("string"), F.lit(")")))


def overview(df: DataFrame, entity: str = "cnpj", period: str = "ano_mes") -> DataFrame:
    """A1: rows, distinct entities, first and last period, in one aggregate."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(entity).alias("entities"),
                  F.min(period).alias("min_period"), F.max(period).alias("max_period"))


def frequency(df: DataFrame, col: str, labels: dict | None = None, digits: int = 4) -> DataFrame:
    """A2: count per value and percent of all rows (+ J7 label when ``labels`` is given)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    out = counts.withColumn("pct", percent(F.col("count"), total, digits))
    if labels is not None:
        out = out.withColumn("label", label_of(col, labels))
    return out


def minority(freq: DataFrame, max_count: int = MINORITY_CLASS_MAX) -> DataFrame:
    """Groups with fewer than ``max_count`` rows (a HAVING filter)."""
    return freq.where(F.col("count") < max_count)


def top_values(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """A3: most frequent values, ties broken by the value (total order)."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(col)).limit(n))


def distinct_counts(df: DataFrame, cols: list[str], approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """A4: distinct values per column.  ``approx`` uses HyperLogLog++ (one pass, no Expand)."""
    fn = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.count_distinct
    row = df.agg(*[fn(c).alias(c) for c in cols])
    return row.unpivot([], cols, "column_name", "n_distinct")


def sketch_error(lg_k: int) -> float:
    """Relative error that a count from joined sketches stays within, at three standard deviations."""
    return 3 * 1.04 / 2 ** (lg_k / 2)


def period_sketches(df: DataFrame, cols: list[str], period: str = "ano_mes", lg_k: int = 14) -> DataFrame:
    """A1/A4: one row per period with a distinct-count sketch of each column (NULL is no value), to be kept with the panel.

    Sketches have a bounded size (at most ``2 ** lg_k`` bytes each) and are made before the shuffle; a new period adds a
    row and leaves the others as they are.
    """
    return df.groupBy(period).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), lg_k).alias(f"{c}_sketch") for c in cols])


def distinct_from_sketches(sketches: DataFrame, cols: list[str], period: str = "ano_mes", first=None, last=None) -> DataFrame:
    """Distinct values of each column over the periods from ``first`` to ``last``, within ``sketch_error``; no row is read again."""
    inside = F.lit(True)
    if first is not None:
        inside = inside & (F.col(period) >= F.lit(first))
    if last is not None:
        inside = inside & (F.col(period) <= F.lit(last))
    row = sketches.where(inside).agg(
        *[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")), F.lit(0)).alias(c) for c in cols])
    return row.unpivot([], cols, "column_name", "n_distinct")


def counts_by_year_month(df: DataFrame, period: str = "ano_mes", target: str = "situacao_cadastral") -> DataFrame:
    """A5: rows per (year, month, status)."""
    return (df.groupBy(F.year(period).alias("ano"), F.month(period).alias("mes"), F.col(target))
            .agg(F.count(F.lit(1)).alias("count")))


def pivot_counts(df: DataFrame, key: str, pivot_col: str, values: list, prefix: str, other: str = "outras") -> DataFrame:
    """Key x value count matrix with an explicit value list (no extra job); missing -> 0.
    Rows of any other value, or of none, are counted in ``<prefix><other>``."""
    counts = [F.count_if(F.col(pivot_col) == v).alias(f"{prefix}{v}") for v in values]
    rest = F.count_if(~F.coalesce(F.col(pivot_col).isin(values), F.lit(False)))
    return df.groupBy(key).agg(*counts, rest.alias(f"{prefix}{other}"))


def row_percent(df: DataFrame, cols: list[str], digits: int = 4) -> DataFrame:
    """Each cell as percent of its row total; ``cols`` are all cells of the row."""
    total = sum((F.col(c) for c in cols[1:]), F.col(cols[0]))
    return df.withColumns({c: percent(F.col(c), total, digits) for c in cols})


def group_means(df: DataFrame, key: str, cols: list[str], digits: int = 6) -> DataFrame:
    """Mean of each column per key."""
    return df.groupBy(key).agg(*[F.round(F.avg(c), digits).alias(c) for c in cols])


def _is_missing(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return F.col(c).isNull() | F.isnan(c)
    return F.col(c).isNull()


def missing_profile(df: DataFrame, cols: list[str] | None = None, digits: int = 4) -> DataFrame:
    """Missing count and percent per column, only columns with any, in one pass."""
    cols = cols or df.columns
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(_is_missing(df, c)).alias(c) for c in cols])
    long = row.unpivot(["_rows"], cols, "column_name", "missing")
    return (long.where(F.col("missing") > 0)
            .select("column_name", "missing", percent(F.col("missing"), F.col("_rows"), digits).alias("pct")))


def describe(df: DataFrame, cols: list[str], exact: bool = True, digits: int = 6,
             accuracy: int = 100_000) -> DataFrame:
    """Count, mean, std (n-1), min, 25/50/75 %, max per column, in one pass.

    ``exact`` uses linearly interpolated percentiles (pandas' ``describe``), found by
    distributed selection (``quantiles``); else a sketch of bounded size gives them.
    """
    probs = [0.25, 0.5, 0.75]
    found = exact_quantiles(df, cols, probs) if exact else {}

    def stats(c):
        x = F.col(c).cast("double")
        q = ([F.lit(v).cast("double") for v in found[c]] if exact
             else [F.percentile_approx(x, probs, accuracy)[k] for k in range(3)])
        return F.struct(F.count(x).alias("count"), F.round(F.avg(x), digits).alias("mean"),
                        F.round(F.stddev_samp(x), digits).alias("std"), F.round(F.min(x), digits).alias("min"),
                        F.round(q[0], digits).alias("q25"), F.round(q[1], digits).alias("q50"),
                        F.round(q[2], digits).alias("q75"), F.round(F.max(x), digits).alias("max")).alias(c)

    row = df.agg(*[stats(c) for c in cols])
    return row.unpivot([], cols, "column_name", "s").select("column_name", "s.*")


def histogram(df: DataFrame, col: str, bins: int = 50, digits: int = 6) -> DataFrame:
    """``bins`` equal-width bins over [min, max], empty bins listed with 0."""
    spark = df.sparkSession
    rng = df.agg(F.struct(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi"))).scalar()
    lo, hi = rng["lo"], rng["hi"]
    idx = F.least(F.floor(F.coalesce(F.try_divide(F.col(col) - lo, hi - lo), F.lit(0.0)) * F.lit(bins)),
                  F.lit(bins - 1))
    counts = (df.where(F.col(col).isNotNull()).groupBy(idx.cast("bigint").alias("bin"))
              .agg(F.count(F.lit(1)).alias("count")))
    # Both sides hold at most ``bins`` rows.
    grid = spark.range(bins).withColumnRenamed("id", "bin")
    width = hi - lo
    return (grid.join(F.broadcast(counts), "bin", "left")
            .select("bin",
                    F.round(lo + width * F.col("bin") / F.lit(bins), digits).alias("bin_lo"),
                    F.round(lo + width * (F.col("bin") + 1) / F.lit(bins), digits).alias("bin_hi"),
                    F.coalesce("count", F.lit(0)).alias("count")))


def correlation_matrix(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every ordered pair (pairwise-complete rows), one pass."""
    cols = list(dict.fromkeys(cols))
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"p{k}")
                   for k, (a, b) in enumerate(pairs)])
    cells = []
    for k, (a, b) in enumerate(pairs):
        v = F.round(F.col(f"p{k}"), digits)
        cells.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), v.alias("corr")))
        if a != b:
            cells.append(F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"), v.alias("corr")))
    return row.select(F.inline(F.array(*cells)))


def correlation_with(df: DataFrame, target: str, cols: list[str], digits: int = 6) -> DataFrame:
    """Correlation of each column with the target, highest first (target de-duplicated)."""
    cols = [c for c in dict.fromkeys(cols) if c != target]
    row = df.agg(*[F.round(F.corr(F.col(c).cast("double"), F.col(target).cast("double")), digits).alias(c)
                   for c in cols])
    return row.unpivot([], cols, "column_name", "corr").orderBy(F.desc_nulls_last("corr"), "column_name")


def sample_histories(df: DataFrame, n: int = 9, entity: str = "cnpj") -> DataFrame:
    """The first ``n`` entities (by key) with their whole history."""
    first = df.select(entity).distinct().orderBy(entity).limit(n)
    return df.join(F.broadcast(first), entity, "left_semi")  # at most n rows
