"""Registered queries over the test tables, each with an optional DuckDB oracle.

A query is ``fn(spark, sf_dir) -> DataFrame``; its oracle is ANSI SQL over the
views ``region nation customer supplier part orders lineitem events documents
embeddings pages benchmark labels conversations``. Column names match.
"""

from __future__ import annotations

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _register_all():
    from tessera.catalog import (  # noqa: F401
        trips, relational, aggregation, windows, text, stats, explore, quality, spatial, html, changes, io, scalars,
    )


def all_queries() -> dict:
    _register_all()
    return dict(QUERIES)


def all_oracles() -> dict:
    _register_all()
    return dict(ORACLE)
