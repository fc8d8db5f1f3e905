"""The registered queries, grouped by the table they work on."""

from __future__ import annotations

import importlib

from foliospark.queries.registry import REGISTRY, Query

# The modules that register queries.
GROUPS = ["publications", "runs", "stats", "monitoring", "features", "models", "sources", "streams"]


def load() -> dict[str, Query]:
    for group in GROUPS:
        importlib.import_module(f"foliospark.queries.{group}")
    return dict(REGISTRY)
