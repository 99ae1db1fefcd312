"""All registered queries."""

from . import (  # noqa: F401
    queries_columns, queries_files, queries_filters, queries_reports, queries_scalars, queries_tables)
from .queries_filters import role_profile
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "role_profile"]
