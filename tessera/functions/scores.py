"""Score expressions: ratios, probabilities, bands."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import CONFIDENCE_BANDS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num, den) -> Column:
    """num / den as double, 0 when the denominator is 0 or NULL (ANSI-safe)."""
    return F.coalesce(F.try_divide(_c(num).cast("double"), _c(den).cast("double")), F.lit(0.0))


def rounded(c, digits: int | None) -> Column:
    """The value rounded to ``digits``, or as it is for None."""
    return _c(c) if digits is None else F.round(_c(c), digits)


def percent(num, den, digits: int | None = None) -> Column:
    """100 * num / den."""
    return rounded(F.lit(100.0) * ratio(num, den), digits)


def max_probability(prob_col) -> Column:
    """top class probability of a probability vector."""
    return F.array_max(vector_to_array(_c(prob_col)))


def class_probability(prob_col, index: int) -> Column:
    """probability of the class at ``index`` (0-based)."""
    return vector_to_array(_c(prob_col))[index]


def confidence_band(c, bands=CONFIDENCE_BANDS) -> Column:
    """label of the right-closed band ``(lo, hi]`` holding the value; NULL outside."""
    expr = None
    for lo, hi, label in bands:
        cond = (_c(c) > F.lit(lo)) & (_c(c) <= F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr
