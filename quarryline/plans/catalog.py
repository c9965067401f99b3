"""Where each core query and its SQL are written down together."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function of (session, folder) as a query, with the SQL that gives the same rows where there is any."""

    def keep(function: Callable) -> Callable:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return keep
