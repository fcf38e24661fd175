"""Scalar column expressions.  All JVM-side built-ins; no Python UDFs."""

from . import dates, messages, paths, scores, text  # noqa: F401
