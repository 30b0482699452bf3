"""Named queries over the shared tables, each with its SQL counterpart where one exists."""

from __future__ import annotations

from terrella.catalog import (  # noqa: F401
    aggregates,
    columns,
    files,
    functions,
    joins,
    learning,
    metrics,
    plans,
    windows,
)
from terrella.catalog.registry import oracle_sql, queries

__all__ = ["queries", "oracle_sql"]
