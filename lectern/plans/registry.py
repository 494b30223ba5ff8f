"""Where queries and their SQL counterparts are registered."""

from __future__ import annotations

from importlib import import_module
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from .corpus import Tables

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a plan over the given tables and, where SQL can say it, its SQL."""

    def add(plan: Callable[[Tables], DataFrame]):
        QUERIES[name] = plan
        if sql is not None:
            ORACLE[name] = sql
        return plan

    return add


def load_all() -> None:
    for module in ("text", "retrieval", "graph", "joins", "checks", "sources", "tools"):
        import_module(f"{__package__}.q_{module}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load_all()

    def bind(plan):
        return lambda spark, folder: plan(Tables(spark, folder))

    return {name: bind(plan) for name, plan in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE)
