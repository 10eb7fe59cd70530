"""A table of queries and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable


def registry() -> tuple[dict[str, Callable], dict[str, str], Callable]:
    """Empty tables and the decorator that fills them."""
    queries: dict[str, Callable] = {}
    oracle: dict[str, str] = {}

    def query(name: str, sql: str | None = None):
        def add(fn):
            queries[name] = fn
            if sql is not None:
                oracle[name] = sql
            return fn

        return add

    return queries, oracle, query
