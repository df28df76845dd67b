"""Registry of named queries and their oracle SQL."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Optional

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: Optional[str]
    operators: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(name: str, operators: tuple[str, ...] | str, sql: Optional[str] = None):
    """Decorator: register ``fn(spark, sf_dir)`` under ``name`` with its oracle."""
    ops = (operators,) if isinstance(operators, str) else tuple(operators)

    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql.strip() if sql else None, ops)
        return fn
    return deco


def r6(col: str) -> str:
    """SQL: round a double to 6 decimals (both sides round the same way)."""
    return f"round({col}, 6)"
