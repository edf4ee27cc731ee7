"""Registered queries: a name, a function of (session, data folder), and where possible the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Build] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def add(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build
    return add
