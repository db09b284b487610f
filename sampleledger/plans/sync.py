"""Sync plan between two listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def relative_path(path: Column, root: str) -> Column:
    """``path`` below ``root``, which is cut at the start alone; any other path stays whole but for
    leading slashes."""
    top = root.rstrip("/")
    below = F.when(F.startswith(path, F.lit(top + "/")), F.substring(path, F.lit(len(top) + 1), F.length(path)))
    return F.regexp_replace(F.coalesce(below, path), "^/+", "")


def sync_plan(source: DataFrame, destination: DataFrame, exact_time: bool = True) -> DataFrame:
    """Objects to copy: absent at the destination, or of another size or (exact) time.

    Both sides have ``rel, size, mod``. A size or time that one side does not know differs from one
    that the other knows.
    """
    there = destination.select("rel", F.col("size").alias("_size"), F.col("mod").alias("_mod"), F.lit(True).alias("_there"))
    reason = F.when(F.col("_there").isNull(), "absent").when(~F.col("size").eqNullSafe(F.col("_size")), "size")
    if exact_time:
        reason = reason.when(~F.col("mod").eqNullSafe(F.col("_mod")), "time")
    return (
        source.join(there, "rel", "left").withColumn("reason", reason).filter(F.col("reason").isNotNull()).select("rel", "size", "reason")
    )
