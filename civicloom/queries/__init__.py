"""Queries on the shared test tables, each with the SQL it must agree with."""

from __future__ import annotations

from importlib import import_module

from civicloom.queries.registry import QUERIES, Query

for _area in (
    "sources",
    "cleaning",
    "joining",
    "reshaping",
    "measuring",
    "modelling",
    "mapping",
    "townships",
    "schooling",
    "living",
    "cleaned",
):
    import_module(f"civicloom.queries.{_area}")

__all__ = ["QUERIES", "Query"]
