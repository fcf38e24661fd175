"""Path expressions: period extraction and path templates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import PERIOD_ANYWHERE, PERIOD_IN_FOLDER


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_path() -> Column:
    """Full path of the file a row came from (hidden metadata column)."""
    return F.col("_metadata.file_path")


def parent_folder(c) -> Column:
    """Directory part of a path, without trailing slash."""
    return F.regexp_extract(_c(c), r"^(.*)/[^/]*$", 1)


def period_of_path(c) -> Column:
    """``yyyy-MM`` from the folder holding the file; falls back to anywhere in the path."""
    folder = F.regexp_extract(parent_folder(c), PERIOD_IN_FOLDER, 1)
    anywhere = F.regexp_extract(_c(c), PERIOD_ANYWHERE, 1)
    return F.when(folder != "", folder).when(anywhere != "", anywhere)


def segment_after(c, pattern: str) -> Column:
    """First group of ``pattern`` in a path, NULL when absent."""
    v = F.regexp_extract(_c(c), pattern, 1)
    return F.when(v != "", v)


def debt_path(year, quarter, data_type) -> Column:
    """``<year>/<q>trimestre/<type>`` relative folder of a debt file set."""
    return F.format_string("%04d/%dtrimestre/%s", _c(year), _c(quarter), _c(data_type))


def debt_file_name(year, quarter, data_type) -> Column:
    """archive of a debt type under its year and zero-padded quarter, e.g.
    ``2024_trimestre_02/Dados_abertos_FGTS.zip``."""
    return F.format_string("%04d_trimestre_%02d/Dados_abertos_%s.zip", _c(year), _c(quarter), _c(data_type))
