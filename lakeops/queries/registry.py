"""The collection of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeops.plans.layers import Layers, layers
from lakeops.session import pin_semantics

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def add(name: str, build: Callable[[Layers], DataFrame], sql: str | None = None) -> None:
    """Register a query built from the layers of a directory, and its checking SQL."""
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(layers(pin_semantics(spark), sf_dir))

    QUERIES[name] = run
    if sql:
        ORACLES[name] = sql
