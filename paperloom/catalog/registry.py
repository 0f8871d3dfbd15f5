"""Registry of catalog queries: a name, a DataFrame builder, and its SQL twin where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paperloom.catalog.fixtures import with_ctes

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, uses: tuple[str, ...] = ()) -> Callable[[Builder], Builder]:
    """Register a builder; ``uses`` names the fixtures its SQL reads."""

    def register(build: Builder) -> Builder:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = with_ctes(uses, sql)
        return build

    return register
