"""File loading, event routing and admission as Spark DataFrame jobs."""

from .options import parse_schema, parse_separator
from .plans.load import LoadSpec, run_load
from .session import build_session, configure
from .sinks.table import TableSpec, read_table

__all__ = [
    "LoadSpec",
    "TableSpec",
    "build_session",
    "configure",
    "parse_schema",
    "parse_separator",
    "read_table",
    "run_load",
]
