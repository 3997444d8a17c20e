"""Queries of this subpackage and their checking SQL."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def register(function):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register
