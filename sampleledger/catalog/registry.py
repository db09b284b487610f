"""The registry of queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from sampleledger.catalog.inputs import Inputs


@dataclass(frozen=True)
class Entry:
    build: Callable[[Inputs], DataFrame]
    sql: str


ENTRIES: dict[str, Entry] = {}


def query(key: str, sql: str):
    """Register a query under ``key`` with the SQL that must give the same rows."""

    def add(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        if key in ENTRIES:
            raise ValueError(f"{key} is registered twice")
        ENTRIES[key] = Entry(build, sql)
        return build

    return add
