"""Column builders (scalar and aggregate), all JVM-side expressions."""

from . import classify, derive, metrics, parse

__all__ = ["classify", "derive", "metrics", "parse"]
