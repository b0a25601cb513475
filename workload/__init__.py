"""The operators applied to the benchmark tables, each with an SQL twin."""

from __future__ import annotations

import importlib

MODULES = [
    "materialization",
    "reporting",
    "dimensions",
    "ingest",
    "happenings",
    "windows",
    "detections",
    "scalars",
]


def all_queries():
    """Every registered query by name."""
    from workload.registry import QUERIES

    for module in MODULES:
        importlib.import_module(f"workload.{module}")
    return QUERIES
