"""Query registry: every entry is a Spark builder plus (when the query has an
SQL meaning) an independent DuckDB oracle statement over the same tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from mercato.sources.tables import DEMAND_SQL, TRACKING_SQL


@dataclass(frozen=True)
class Query:
    key: str
    survey_id: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    check: str  # "SQL" (oracle), "ROWS" (rows-only + unit test)


REGISTRY: dict[str, Query] = {}


def with_views(sql: str) -> str:
    """Prefix the bound views the statement mentions as CTEs."""
    ctes = []
    low = sql.lower()
    if "tracking" in low:
        ctes.append(TRACKING_SQL)
    if "demand" in low:
        ctes.append(DEMAND_SQL)
    body = sql.strip()
    if not ctes:
        return body
    if body.lower().startswith("with recursive "):
        return "WITH RECURSIVE " + ",\n".join(ctes) + ",\n" + body[15:]
    if body.lower().startswith("with "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def register(key: str, survey_id: str, sql: str | None = None):
    """Decorator: ``@register("seller_features", "E1", sql=...)``."""

    def deco(fn):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Query(key, survey_id, fn, with_views(sql) if sql else None,
                              "SQL" if sql else "ROWS")
        return fn

    return deco


def load_all() -> dict[str, Query]:
    """Import every plan module so their decorators run."""
    from mercato.plans import (  # noqa: F401
        aggregation, cleaning, joins, landing, ml_jobs, scans, series, setops, sinks_plans, statistics,
        streaming_plans, text_plans, web,
    )
    return REGISTRY
