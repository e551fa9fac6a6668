"""Queries: every operator applied to the supplied tables, with its SQL."""

from __future__ import annotations

import importlib

#: Modules that register queries.
MODULES = [
    "interval_queries",
    "scalar_queries",
    "text_queries",
    "join_queries",
    "report_queries",
    "io_queries",
    "cover_queries",
    "more_queries",
    "evidence_queries",
]


def load() -> None:
    for name in MODULES:
        importlib.import_module(f"lapwing.plans.{name}")
