"""Registered queries: each runs operators over the given tables."""

from __future__ import annotations

from importlib import import_module

MODULES = ["feature_queries", "metric_queries", "daily_queries", "tier_queries", "dispersion_queries", "io_queries", "stream_queries", "model_queries"]


def load_all() -> None:
    for m in MODULES:
        import_module(f"airq.plans.{m}")
