"""Registry of named queries.

Every entry pairs a DataFrame builder (``GoldModel -> DataFrame``) with the
body of an independent DuckDB query over the same gold relations (see
``oracle.py``).  ``__spark_entry__`` exposes both; ``bench.py`` times a
subset.  Names are the operator ids of SURVEY §2 in lower case plus a short
description.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from .gold import GoldModel
from .oracle import with_gold


@dataclass
class Query:
    name: str
    build: Callable[[GoldModel], DataFrame]
    sql: str | None = None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql)
        return fn
    return deco


def add(name: str, build: Callable[[GoldModel], DataFrame], sql: str | None = None) -> None:
    if name in REGISTRY:
        raise ValueError(f"duplicate query {name}")
    REGISTRY[name] = Query(name, build, sql)


def _load_all() -> None:
    # importing the modules registers their queries
    from . import queries_core, queries_dq, queries_kpi, queries_mag, queries_more, queries_quality, queries_src  # noqa: F401


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()

    def bind(q: Query):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return q.build(GoldModel.from_driver(spark, sf_dir))
        run.__name__ = q.name
        return run

    return {name: bind(q) for name, q in REGISTRY.items()}


def oracle_queries() -> dict[str, str]:
    _load_all()
    return {name: with_gold(q.sql) for name, q in REGISTRY.items() if q.sql}
