"""Registered queries and their SQL twins."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from outpulse.catalog.sqlviews import VIEWS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with the SQL that gives the same rows, if SQL can."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = with_views(sql)
        return fn

    return add


def with_views(sql: str) -> str:
    """SQL text with the definitions of all views it names, directly or through another view."""
    needed: set[str] = set()
    open_texts = [sql]
    while open_texts:
        words = set(re.findall(r"\bv_\w+", open_texts.pop()))
        for name in words & VIEWS.keys() - needed:
            needed.add(name)
            open_texts.append(VIEWS[name])
    parts = [f"{name} AS ({text})" for name, text in VIEWS.items() if name in needed]
    body = sql.strip()
    if not parts:
        return body
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
