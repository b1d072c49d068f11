"""Every operator as a query over the standard tables, each with its SQL twin."""

from __future__ import annotations

import importlib

from plantpulse.queries.registry import QUERIES, Query

_MODULES = [
    "sources", "filters", "joins", "aggregates", "windows", "sorting", "scalars",
    "alarms", "machines", "weights", "metrics", "reports", "streams",
]


def all_queries() -> dict[str, Query]:
    for name in _MODULES:
        importlib.import_module(f"plantpulse.queries.{name}")
    return dict(QUERIES)
