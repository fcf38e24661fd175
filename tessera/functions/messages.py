"""Trigger-message decoding (F17) and parameter validation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import ALL_TYPES, REGISTRY_DATA_TYPES, WRITE_MODES

MESSAGE_SCHEMA = "period string, data_type string, mode string, write_mode string"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_message(data_col, default_mode: str = "WRITE_APPEND") -> Column:
    """base64 payload -> struct(valid, period, data_type, mode).

    Broken base64 or JSON gives ``valid = false``; missing keys take
    defaults (no period = all periods, no type = all types).  Both ``mode``
    and ``write_mode`` are accepted for the disposition.
    """
    raw = F.try_to_binary(_c(data_col), F.lit("base64"))
    text = F.when(raw.isNotNull(), raw.cast("string"))
    parsed = F.from_json(text, MESSAGE_SCHEMA, {"mode": "PERMISSIVE"})
    looks_like_object = F.coalesce(F.trim(text).startswith("{") & F.trim(text).endswith("}"), F.lit(False))
    valid = looks_like_object & F.coalesce(F.try_parse_json(text).isNotNull(), F.lit(False))
    return F.struct(
        valid.alias("valid"),
        parsed["period"].alias("period"),
        F.lower(parsed["data_type"]).alias("data_type"),
        F.upper(F.coalesce(parsed["mode"], parsed["write_mode"], F.lit(default_mode))).alias("mode"),
    )


def validate_choice(c, allowed: list[str]) -> Column:
    """NULL (meaning "all") passes, a listed value passes, anything else fails."""
    return _c(c).isNull() | _c(c).isin(allowed)


def message_status(msg) -> Column:
    """Status of a decoded message: ``ok`` / ``bad_message`` / ``bad_data_type`` / ``bad_mode``.

    ``all`` (or no type) means every registry type."""
    m = _c(msg)
    return (F.when(~m["valid"], F.lit("bad_message"))
            .when(~validate_choice(m["data_type"], [*REGISTRY_DATA_TYPES, ALL_TYPES]), F.lit("bad_data_type"))
            .when(~validate_choice(m["mode"], WRITE_MODES), F.lit("bad_mode"))
            .otherwise(F.lit("ok")))
