"""String expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_double(c) -> Column:
    """F8: numeric parse where anything unparsable becomes NULL (ANSI-safe)."""
    return _c(c).try_cast("double")


def as_string(c) -> Column:
    """number -> string."""
    return _c(c).cast("string")


def clean_list_string(c) -> Column:
    """``"['SP']"`` -> ``'SP'``: drop brackets and single quotes, trim."""
    return F.trim(F.regexp_replace(_c(c), r"[\[\]']", ""))


def arrow_concat(*cols) -> Column:
    """join parts with ``' → '``."""
    return F.concat_ws(" → ", *[_c(c).cast("string") for c in cols])


def dashes_to_underscores(c) -> Column:
    """``2024-03`` -> ``2024_03``."""
    return F.replace(_c(c), F.lit("-"), F.lit("_"))


def strip_slashes(c) -> Column:
    """drop trailing ``/``."""
    return F.regexp_replace(_c(c), r"/+$", "")


def strip_prefix(c, prefix: str) -> Column:
    """drop a literal prefix when present."""
    return F.regexp_replace(_c(c), "^" + re.escape(prefix), "")


def split_on(c, sep: str = "-") -> Column:
    """split into an array."""
    return F.split(_c(c), re.escape(sep))


def base_name(c) -> Column:
    """last path segment."""
    return F.regexp_extract(_c(c), r"([^/]*)/?$", 1)


def stem(c) -> Column:
    """base name without its last extension."""
    return F.regexp_extract(base_name(c), r"^(.+?)(\.[^.]*)?$", 1)


def contains_any(c, words: list[str]) -> Column:
    """F16: case-insensitive contains-any of literal words."""
    pattern = "(?i)(" + "|".join(re.escape(w) for w in words) + ")"
    return _c(c).rlike(pattern)
