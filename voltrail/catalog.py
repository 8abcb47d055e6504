"""Public query catalogue: ``queries()`` and ``oracle_sql()`` for the driver."""

from __future__ import annotations

from voltrail.plans import q_ingest, q_kpi, q_scan, q_store, q_stream  # noqa: F401  (register queries)
from voltrail.plans.registry import REGISTRY, Builder


def build(name: str) -> Builder:
    return REGISTRY[name].build


def all_queries() -> dict[str, Builder]:
    return {k: e.build for k, e in REGISTRY.items()}


def all_oracles() -> dict[str, str]:
    return {k: e.oracle for k, e in REGISTRY.items() if e.oracle is not None}
