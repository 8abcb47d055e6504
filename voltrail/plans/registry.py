"""Registry of named queries: Spark builder + DuckDB oracle SQL per key."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from voltrail.session import utc_session

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    build: Builder
    oracle: str | None
    survey_ids: tuple[str, ...]


REGISTRY: dict[str, Entry] = {}


def register(name: str, oracle: str | None, *survey_ids: str):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, lambda spark, sf_dir: fn(utc_session(spark), sf_dir), oracle, survey_ids)
        return fn
    return deco
