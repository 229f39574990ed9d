"""Registry of the queries that exercise each operator on the driver's tables.

Each entry is ``name -> (spark_fn(spark, sf_dir) -> DataFrame, oracle_sql)``.
The oracle is plain SQL (DuckDB dialect) over the same parquet tables; it is
written from the operator's *specification* (``NOT EXISTS``, ``CASE``,
``strptime`` ...), not from our Spark code, so it is an independent check.
Every query reads whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, oracle: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = (fn, oracle)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def queries() -> dict[str, QueryFn]:
    _load()
    return {k: v[0] for k, v in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in _REGISTRY.items() if v[1]}


def _load() -> None:
    # importing the modules registers their queries
    from . import q_documents, q_flows, q_loads, q_merge, q_models, q_reloads, q_scalar, q_sources  # noqa: F401
