"""Registered queries: every operator bound to the driver's tables."""

from __future__ import annotations

import importlib

from .registry import ORACLE, QUERIES

_MODULES = ["aggregations", "sequences", "joins", "sorts", "text", "graph", "hierarchy", "streaming", "grid"]

for _m in _MODULES:
    importlib.import_module(f"{__name__}.{_m}")

__all__ = ["ORACLE", "QUERIES"]
