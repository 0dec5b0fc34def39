"""All registered queries of the page-snapshot engine, with their SQL."""

from __future__ import annotations

from .plans import audits as _audits  # noqa: F401  adds its queries
from .plans import function_queries as _functions  # noqa: F401
from .plans import page_queries as _pages  # noqa: F401
from .plans import record_queries as _records  # noqa: F401
from .plans import store_queries as _stores  # noqa: F401
from .plans.queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
