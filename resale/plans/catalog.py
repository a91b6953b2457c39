"""All registered queries (importing the query modules fills the registry)."""

from __future__ import annotations

import importlib

from resale.plans.registry import ORACLES, QUERIES

_MODULES = [
    "q_sources", "q_splits", "q_features", "q_encoders", "q_quality", "q_eda", "q_metrics", "q_residuals",
    "q_models", "q_compare", "q_monitor", "q_streaming",
]
_loaded = False


def load() -> None:
    global _loaded
    if _loaded:
        return
    for m in _MODULES:
        try:
            importlib.import_module(f"resale.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"resale.plans.{m}":
                raise
    _loaded = True


def queries():
    load()
    return dict(QUERIES)


def oracle_sql():
    load()
    return dict(ORACLES)
