"""All registered queries and their oracle SQL, gathered from the plan modules."""

from __future__ import annotations

import importlib

MODULES = ["documents", "graph", "search", "algorithms"]


def _modules():
    return [importlib.import_module(f"triad.plans.{m}") for m in MODULES]


def queries() -> dict:
    out: dict = {}
    for m in _modules():
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict:
    out: dict = {}
    for m in _modules():
        out.update(m.ORACLE)
    return out
