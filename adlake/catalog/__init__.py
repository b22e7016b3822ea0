"""Registered queries over the given tables, each with its DuckDB twin where SQL can express it."""

from __future__ import annotations

import importlib

from adlake.catalog.registry import ORACLES, QUERIES

_MODULES = (
    "scans",
    "features",
    "binning",
    "aggregates",
    "joins",
    "experiments",
    "timeseries",
    "similarity",
    "quality",
    "embeddings",
    "training",
    "bids",
)

for _name in _MODULES:
    importlib.import_module(f"adlake.catalog.{_name}")

__all__ = ["ORACLES", "QUERIES"]
