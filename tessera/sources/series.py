"""Indicator-series files: one JSON array of ``{"data": "dd/MM/yyyy", "valor": "..."}`` per series."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parse_day
from ..functions.paths import file_path
from ..functions.text import lenient_double
from ..schemas import SERIES_POINTS


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON series -> long rows (serie, data, valor).

    Each file is one row (``wholetext``; a series file is a few MB), parsed with a
    declared array schema and exploded on the executors.  Unparsable dates or
    values become NULL; an empty array yields no rows.  The series name comes
    from the file (or its ``serie=<name>`` folder).
    """
    raw = spark.read.option("wholetext", "true").text(path).select("value", file_path().alias("_path"))
    name = F.coalesce(F.nullif(F.regexp_extract("_path", r"serie=([^/]+)/", 1), F.lit("")),
                      F.regexp_extract("_path", r"([^/]+?)(?:\.json)?$", 1))
    points = raw.select(name.alias("serie"), F.inline_outer(F.from_json("value", SERIES_POINTS)))
    return (points.where(F.col("data").isNotNull() | F.col("valor").isNotNull())
            .select("serie", parse_day("data").alias("data"), lenient_double("valor").alias("valor")))


def land_series(long: DataFrame, path: str, series: str = "serie", day: str = "data", value: str = "valor") -> str:
    """Write each series as one JSON array file under ``serie=<name>/`` (values as text, dates dd/MM/yyyy).

    One group per series: its size is the number of points of one time series.
    """
    points = F.sort_array(F.collect_list(F.struct(
        F.col(day).alias("k"), F.date_format(day, "dd/MM/yyyy").alias("data"),
        F.col(value).cast("string").alias("valor"))))
    arr = long.groupBy(series).agg(
        F.to_json(F.transform(points, lambda p: F.struct(p["data"].alias("data"), p["valor"].alias("valor"))))
        .alias("value"))
    arr.write.mode("overwrite").partitionBy(series).text(path)
    return path


def to_distributed(spark: SparkSession, pdf: pd.DataFrame, schema: str) -> DataFrame:
    """A small local frame (lookup tables only) -> distributed frame with a declared schema."""
    return spark.createDataFrame(pdf, schema=schema)
