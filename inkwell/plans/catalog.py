"""All registered queries and their DuckDB oracles."""

from __future__ import annotations

import importlib

_MODULES = [
    "inkwell.plans.market_q",
    "inkwell.plans.documents_q",
    "inkwell.plans.metrics_q",
    "inkwell.plans.company_q",
    "inkwell.plans.rules_q",
    "inkwell.plans.indicators_q",
]


def _collect(attr: str) -> dict:
    out: dict = {}
    for name in _MODULES:
        mod = importlib.import_module(name)
        for k, v in getattr(mod, attr, {}).items():
            if k in out:
                raise ValueError(f"duplicate query name {k}")
            out[k] = v
    return out


def queries() -> dict:
    return _collect("QUERIES")


def oracle_sql() -> dict:
    return _collect("ORACLE")
