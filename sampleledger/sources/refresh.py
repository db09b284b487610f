"""Which record snapshots are stale.

A policy row is ``(tbl, force, months, days)``: ``force`` decides alone where it is set, else the
snapshot is stale when its time plus the period is before ``now``.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def refresh_policy(tables: DataFrame, overrides: DataFrame, months: int = 1, days: int = 0) -> DataFrame:
    """Policy of every table: its override, else the default period (one month)."""
    chosen = overrides.withColumn("_given", F.lit(True))
    given = F.coalesce(F.col("_given"), F.lit(False))
    return tables.join(chosen, "tbl", "left").select(
        "tbl",
        "force",
        F.when(given, F.col("months")).otherwise(months).alias("months"),
        F.when(given, F.col("days")).otherwise(days).alias("days"),
    )


def uniform_policy(
    tables: DataFrame, force: bool | None = None, months: int | None = None, days: int | None = None
) -> DataFrame:
    """One decision or period for every table."""
    return tables.select(
        "tbl",
        F.lit(force).cast("boolean").alias("force"),
        F.lit(months).cast("int").alias("months"),
        F.lit(days).cast("int").alias("days"),
    )


def stale_snapshots(policy: DataFrame, snapshots: DataFrame, now: datetime.datetime | Column) -> DataFrame:
    """``(tbl, update)`` for every table. A table without a snapshot is stale whatever its policy.

    Month addition keeps to the end of the month; the comparison is strict.
    """
    period = F.make_interval(
        months=F.coalesce("months", F.lit(0)), days=F.coalesce("days", F.lit(0))
    )
    at = now if isinstance(now, Column) else F.lit(now)
    stale = F.coalesce(F.col("force"), F.col("mod") + period < at)
    return policy.join(snapshots.select("tbl", "mod"), "tbl", "left").select(
        "tbl", F.when(F.col("mod").isNull(), True).otherwise(stale).alias("update")
    )
