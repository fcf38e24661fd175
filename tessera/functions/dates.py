"""Date and calendar expressions (F1-F7, W14 helper)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_month(c, lenient: bool = False) -> Column:
    """``'yyyy-MM'`` string -> first day of that month (date)."""
    return F.try_to_date(_c(c), "yyyy-MM") if lenient else F.to_date(_c(c), "yyyy-MM")


def parse_day(c, fmt: str = "dd/MM/yyyy", lenient: bool = True) -> Column:
    """``'dd/MM/yyyy'`` string -> date; unparsable -> NULL when lenient."""
    return F.try_to_date(_c(c), fmt) if lenient else F.to_date(_c(c), fmt)


def month_key(c) -> Column:
    """date/timestamp -> ``'yyyy-MM'`` string."""
    return F.date_format(_c(c), "yyyy-MM")


def month_start(c) -> Column:
    """First day of the month of a date or timestamp, as a date."""
    return F.trunc(F.to_date(_c(c)), "month")


def parse_timestamp(c) -> Column:
    """default-format date-time parse to a wall-clock (zone-free) timestamp, NULL when
    unparsable.  Parsing goes straight to ``timestamp_ntz``: a detour through the session
    time zone would shift local times that fall in a daylight-saving gap."""
    return _c(c).try_cast("timestamp_ntz")


def calendar_parts(c) -> dict[str, Column]:
    """Year, month, quarter, semester (H1=1, H2=2), cyclic month."""
    m = F.month(_c(c))
    return {
        "ano": F.year(_c(c)),
        "mes": m,
        "trimestre": F.quarter(_c(c)),
        "semestre": F.when(m <= 6, F.lit(1)).otherwise(F.lit(2)),
        "mes_sin": F.sin(F.lit(2 * math.pi) * m / F.lit(12)),
        "mes_cos": F.cos(F.lit(2 * math.pi) * m / F.lit(12)),
    }


def month_from_parts(year, month) -> Column:
    """first of month from year + month numbers."""
    return F.make_date(_c(year), _c(month), F.lit(1))


def month_label_from_parts(year, month) -> Column:
    """``'yyyy-MM'`` with the month zero-padded."""
    return F.concat_ws("-", _c(year).cast("string"), F.lpad(_c(month).cast("string"), 2, "0"))


def months_between_starts(later, earlier) -> Column:
    """Whole months from ``earlier`` to ``later`` via (y-y0)*12 + (m-m0)."""
    return (F.year(_c(later)) - F.year(_c(earlier))) * 12 + (F.month(_c(later)) - F.month(_c(earlier)))
