"""Projection, null handling and dedup (P2-P8, O3, F10 applied)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_list_string

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns (absent names are ignored)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def existing(df: DataFrame, wanted: list[str]) -> list[str]:
    """The listed columns that exist, in the listed order."""
    have = set(df.columns)
    return [c for c in wanted if c in have]


def columns_containing(df: DataFrame, fragment: str) -> list[str]:
    """Columns whose name contains ``fragment``."""
    return [c for c in df.columns if fragment in c]


def select_existing(df: DataFrame, wanted: list[str], keep: list[str] | None = None) -> DataFrame:
    """Project the listed columns that exist, plus ``keep`` columns."""
    cols = existing(df, wanted)
    extra = [c for c in (keep or []) if c in df.columns and c not in cols]
    return df.select(*cols, *extra)


def add_missing_as_zero(df: DataFrame, expected: list[str], keep: list[str] | None = None) -> DataFrame:
    """P5: add absent expected columns as 0 and order columns as expected."""
    have = set(df.columns)
    cols = [F.col(c) if c in have else F.lit(0).alias(c) for c in expected]
    return df.select(*(keep or []), *cols)


def numeric_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    skip = set(exclude or [])
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in skip]


def drop_incomplete(df: DataFrame, subset: list[str]) -> DataFrame:
    """Drop rows with NULL (or NaN) in any listed column that exists."""
    cols = existing(df, subset)
    return df.dropna(how="any", subset=cols) if cols else df


def fill_zero(df: DataFrame, subset: list[str]) -> DataFrame:
    """NULL -> 0 on the listed columns that exist."""
    cols = existing(df, subset)
    return df.fillna(0, subset=cols) if cols else df


def fill_mean(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL -> column mean over the whole frame (numeric columns by default).

    The means are one aggregate row, attached as a single scalar subquery:
    no join, no collect, one extra pass.
    """
    cols = columns if columns is not None else numeric_columns(df)
    if not cols:
        return df
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in cols]).alias("m")).scalar()
    return df.withColumns({c: F.coalesce(F.col(c), means[c].cast(df.schema[c].dataType)) for c in cols})


def dedup_keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """O3: one row per key, the first by an explicit total order (not ``dropDuplicates``,
    which keeps an arbitrary row).

    ``min_by`` over the whole row is an aggregate with map-side combine: every
    task reduces a hot key to one row before the shuffle, so no task ever holds
    a whole group (a ``row_number`` window would).
    """
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_first"))
    return first.select(*keys, "_first.*")


def clean_list_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """F10 applied once, before features: ``"['SP']"`` -> ``'SP'``."""
    return df.withColumns({c: clean_list_string(c) for c in existing(df, columns)})
