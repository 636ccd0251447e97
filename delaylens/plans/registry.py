"""Query registry: each entry is a callable (spark, sf_dir) -> DataFrame
and, where the result is SQL-expressible, the DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def q(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    # importing registers
    from delaylens.plans import q_composite, q_eval, q_ml, q_reports, q_rows, q_sources, q_stats  # noqa: F401
