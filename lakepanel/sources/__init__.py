"""Sources and sinks."""

from . import files, sinks, tables

__all__ = ["files", "sinks", "tables"]
