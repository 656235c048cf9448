"""Named queries: a Spark function and, where SQL can express it, the equivalent text."""
from __future__ import annotations

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register
