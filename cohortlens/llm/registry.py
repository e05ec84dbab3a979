"""Queries of this subpackage: name -> Spark plan, and oracle SQL where SQL can express it."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    from cohortlens.llm import queries  # noqa: F401
