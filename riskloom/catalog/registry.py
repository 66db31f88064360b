"""All registered queries and their SQL."""

from __future__ import annotations

from riskloom.catalog import cleaning, features, mining, modelling, profiling, scoring

MODULES = (profiling, cleaning, features, mining, scoring, modelling)


def queries() -> dict:
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
