"""Import every plan module so its queries register, and expose the registry."""

from __future__ import annotations

from . import aggregates, charts, jobs, merge, presets, quality, recommend, regress, sources, stats, streaming, survey, warehouse  # noqa: F401
from .registry import REGISTRY


def all_queries():
    return {name: q.build for name, q in REGISTRY.items()}


def all_oracles():
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}
