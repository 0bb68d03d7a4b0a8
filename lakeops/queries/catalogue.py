"""All query modules together."""

from __future__ import annotations

from lakeops.queries import bronze, gold, learning, modelling, ranking, registry, silver, storage  # noqa: F401  (importing registers)


def queries() -> dict[str, registry.Query]:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.ORACLES)
