"""All registered queries."""

from __future__ import annotations

from marketlake.catalog import layers, records, registry, windows  # noqa: F401


def queries() -> dict[str, registry.Query]:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.SQL)
