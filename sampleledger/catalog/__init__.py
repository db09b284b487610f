"""Registered queries: every operator over the driver tables, with equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sampleledger.catalog.inputs import Inputs, inputs_of, oracle_text
from sampleledger.catalog.registry import ENTRIES


def _load() -> None:
    from sampleledger.catalog import (  # noqa: F401
        audits,
        links,
        listings,
        lookups,
        manifests,
        plans,
        reconciling,
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bound(build: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(inputs_of(spark, sf_dir))

    return {key: bound(entry.build) for key, entry in sorted(ENTRIES.items())}


def oracle_sql() -> dict[str, str]:
    _load()
    return {key: oracle_text(entry.sql) for key, entry in sorted(ENTRIES.items()) if entry.sql}
