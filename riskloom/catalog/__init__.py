"""Registered queries and the SQL each one is checked against."""

from __future__ import annotations

import importlib

from riskloom.catalog.base import QUERIES, SQL

for _area in ("profiling", "cleaning", "features", "labels", "evaluation", "scoring"):
    importlib.import_module(f"riskloom.catalog.{_area}")

__all__ = ["QUERIES", "SQL"]
