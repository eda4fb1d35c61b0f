"""Registry of bound queries: name -> (spark callable, DuckDB SQL or None)."""

from __future__ import annotations

import importlib
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}

# plan modules, in inventory order
MODULES = [
    "flagship", "bind_sources", "bind_sinks", "bind_relational", "bind_aggregates",
    "bind_windows", "bind_setops", "bind_reshape", "bind_scalar", "bind_history",
    "bind_hierarchy", "bind_worktime", "bind_recon", "bind_quality",
    "bind_selection",
]


def register(name: str, sql: str | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` with its DuckDB twin."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def load_all() -> dict[str, tuple[QueryFn, str | None]]:
    for m in MODULES:
        importlib.import_module(f"dossier.plans.{m}")
    return REGISTRY
