"""Regrouping and naming of functional abundance tables.

The arithmetic (sums, the ``UNGROUPED`` row, the label of unnamed groups) follows the public
behaviour of the external programs that do this per file; here all samples are one long table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleledger.fixed import UNGROUPED, UNINTEGRATED, UNMAPPED, UNNAMED
from sampleledger.operators.joins import matched


def regroup(table: DataFrame, groups: DataFrame) -> DataFrame:
    """``(sample, grp, taxon, value)`` sums of ``(sample, feature, value)`` rows.

    ``feature`` may carry a taxon after ``|``. ``groups`` is ``(feature, grp)``; a feature of several
    groups counts in each, one of none in UNGROUPED, and UNMAPPED stays itself.
    Rows are summed per feature before the join and per group after it, both on the map side.
    """
    parts = F.split("feature", r"\|", 2)
    summed = (
        table.select("sample", parts[0].alias("feature"), F.get(parts, F.lit(1)).alias("taxon"), "value")
        .groupBy("sample", "feature", "taxon")
        .agg(F.sum("value").alias("value"))
    )
    grouped = F.when(F.col("feature") == UNMAPPED, UNMAPPED).otherwise(F.coalesce("grp", F.lit(UNGROUPED)))
    return (
        matched(summed, groups.distinct(), "feature", "left")
        .groupBy("sample", grouped.alias("grp"), "taxon")
        .agg(F.sum("value").alias("value"))
    )


def name_groups(table: DataFrame, names: DataFrame) -> DataFrame:
    """Group ids with their display name after a colon; special rows stay as they are."""
    label = F.concat("grp", F.lit(": "), F.coalesce("name", F.lit(UNNAMED)))
    special = F.col("grp").isin(UNMAPPED, UNGROUPED, UNINTEGRATED)
    return (
        matched(table, names, "grp", "left").withColumn("grp", F.when(special, F.col("grp")).otherwise(label)).drop("name")
    )
