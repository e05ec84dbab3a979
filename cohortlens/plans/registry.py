"""Registry of driver-table queries: name -> (Spark plan, DuckDB oracle SQL).

Each Spark plan takes (spark, sf_dir) and returns a lazy DataFrame over the
whole driver tables; the oracle is the same result in plain SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from cohortlens.plans import (q_summary, q_dashboard, q_clean_profile,  # noqa: F401
                                  q_cohort, q_enrich, q_pairs, q_evaluate, q_model,
                                  q_resample, q_files)
