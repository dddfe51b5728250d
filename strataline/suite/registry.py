"""Registered queries: a Spark callable and its SQL oracle under one name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .ctes import query

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, needs: str = "", sql: str | None = None) -> Callable[[Builder], Builder]:
    """Register a query; ``needs`` names the CTEs its oracle text builds on."""
    def wrap(build: Builder) -> Builder:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = query(needs, sql)
        return build

    return wrap
