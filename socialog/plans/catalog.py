"""Registry of runnable queries and their oracle SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from socialog.plans.fixture_sql import with_views

Build = Callable[[SparkSession, str], DataFrame]

GROUPS = ("tables", "state", "analyses", "lookups", "operations", "streams", "messages", "upkeep", "storage")


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None


_CATALOG: dict[str, Query] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Build], Build]:
    """Register a query under ``name``; ``sql`` reads the named fixture views."""

    def add(build: Build) -> Build:
        if name in _CATALOG:
            raise ValueError(f"{name} is registered twice")
        _CATALOG[name] = Query(build, None if sql is None else with_views(sql, *views))
        return build

    return add


def catalog() -> dict[str, Query]:
    for group in GROUPS:
        importlib.import_module(f"socialog.plans.{group}")
    return dict(_CATALOG)
