"""Indicator series: per-period means, wide table, mean fill.

A long table ``(series, ts, value)`` is reduced to one mean per (period,
series) with partial aggregation, then pivoted with an explicit series list
- equivalent to a chain of full outer joins on the period,
but one shuffle instead of N-1 joins.  Aggregating before the pivot also
avoids the daily fan-out of the oldest script.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scores import rounded
from .clean import fill_mean


def period_of(ts_col: str, unit: str = "month"):
    """Period key of a timestamp: ``'yyyy-MM'`` for months, a date for days, else the
    timestamp truncated to ``unit`` (e.g. ``'hour'``)."""
    if unit == "month":
        return F.date_format(ts_col, "yyyy-MM")
    if unit == "day":
        return F.to_date(ts_col)
    return F.date_trunc(unit, F.col(ts_col)).cast("timestamp_ntz")  # wall-clock, zone-free


def series_means(long: DataFrame, series: str, ts: str, value: str, unit: str = "month",
                 period: str = "ano_mes", digits: int | None = None) -> DataFrame:
    """Mean value per (period, series); unparsable values (NULL) are ignored."""
    return (long.groupBy(period_of(ts, unit).alias(period), F.col(series).alias("serie"))
            .agg(rounded(F.avg(value), digits).alias("valor")))


def wide(means: DataFrame, names: list[str], period: str = "ano_mes", unlisted: str | None = None) -> DataFrame:
    """One row per period, one column per series (NULL where a series has no value).

    ``names`` is the explicit series list (saves the distinct-values job and
    fixes the column order); the result has one row per period.  ``unlisted`` names a
    column with the number of the period's values of series that are not listed, so
    that none is left out unseen; a NULL series counts as unlisted.
    """
    picked = [F.first(F.when(F.col("serie") == n, F.col("valor")), ignorenulls=True).cast("double").alias(n) for n in names]
    if unlisted:
        picked.append(F.count_if(~F.coalesce(F.col("serie").isin(names), F.lit(False))).alias(unlisted))
    return means.groupBy(period).agg(*picked)


def silver(wide_df: DataFrame, period: str = "ano_mes") -> DataFrame:
    """Bronze -> silver, every numeric column's NULLs filled with its whole-period mean."""
    cols = [c for c in wide_df.columns if c != period]
    return fill_mean(wide_df, cols)
