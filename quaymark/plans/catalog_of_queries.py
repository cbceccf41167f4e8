"""All registered queries of the core and the SQL of those that SQL can express."""

from __future__ import annotations

from quaymark.plans import problems, reference, vendor

_MODULES = (reference, vendor, problems)


def queries() -> dict:
    return {name: f for m in _MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
