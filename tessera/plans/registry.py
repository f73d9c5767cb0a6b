"""Query registry: one Spark query (and, where SQL can say it, one DuckDB
oracle) per operator of the inventory. Query modules register themselves via
the ``query`` decorator; ``load()`` imports them all."""

from __future__ import annotations

import importlib
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}

MODULES = ["q_flagship", "q_scalars", "q_spans", "q_joins", "q_eval", "q_analysis",
           "q_splits", "q_vectors", "q_graph", "q_sequence", "q_sources", "q_ml"]


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load() -> None:
    for m in MODULES:
        try:
            importlib.import_module(f"tessera.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"tessera.plans.{m}":
                raise
