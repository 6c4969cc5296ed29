"""Query catalogue: every registered query is a function (spark, sf_dir) ->
DataFrame over the driver tables, optionally paired with a DuckDB SQL oracle
that computes the same columns (same names) on the same Parquet tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn
    return deco


def _load_all() -> None:
    # importing the modules registers their queries
    from lexis.plans import q_text, q_profile, q_labels, q_chunk, q_split, q_features  # noqa: F401
    from lexis.plans import q_metrics, q_logs, q_models, q_io  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)
