"""Relational operators composed from the DataFrame API."""

from . import aggregate, calendar, columns, dedup, joins, profile, quality, union

__all__ = ["aggregate", "calendar", "columns", "dedup", "joins", "profile", "quality", "union"]
