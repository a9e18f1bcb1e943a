"""Registry of the operator queries: name -> (Spark plan, oracle SQL or None).

Every query reads the benchmark tables (or tables Spark derives from them)
in full. Names start with the SURVEY §2 operator IDs they cover.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    plan: Plan
    sql: str | None
    note: str = ""


_REGISTRY: dict[str, Query] = {}
_MODULES = ["mart_queries", "landing_queries", "catalog_queries", "write_queries"]


def register(name: str, sql: str | None, note: str = "") -> Callable[[Plan], Plan]:
    def deco(fn: Plan) -> Plan:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        _REGISTRY[name] = Query(fn, sql, note)
        return fn

    return deco


def all_queries() -> dict[str, Query]:
    # Importing the modules fills the registry.
    import importlib

    for mod in _MODULES:
        importlib.import_module(f"gaugeflow.plans.{mod}")

    return dict(_REGISTRY)
