"""Records stored for look-ups: one layout in ranges of ids, one in ranges of (table, uid).

A file holds a range of its keys, in order, so the bounds of its row groups rule out nearly all
others, and a Bloom filter per row group rules out keys that fall inside the bounds and are not
there. A look-up is a filter that Spark pushes to the scan; no index has to be kept in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sampleledger.operators import lookups

RECORD = "tbl string, id string, uid string, fields variant"
_BY_ID, _BY_UID = "by_id", "by_uid"


def write_stored(records: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    """Write ``(tbl, id, uid, fields)`` records in both layouts. Records without uid are in both too."""
    root = folder.rstrip("/")
    for name, keys in ((_BY_ID, ("id",)), (_BY_UID, ("tbl", "uid"))):
        laid = records.select("tbl", "id", "uid", "fields").repartitionByRange(*keys).sortWithinPartitions(*keys)
        laid.write.option(f"parquet.bloom.filter.enabled#{keys[-1]}", "true").mode(mode).parquet(f"{root}/{name}")


def _layout(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(RECORD).parquet(f"{folder.rstrip('/')}/{name}")


def read_stored(spark: SparkSession, folder: str) -> DataFrame:
    """All records, in ranges of ids."""
    return _layout(spark, folder, _BY_ID)


def stored_by_id(spark: SparkSession, folder: str, record_id: str) -> DataFrame:
    return lookups.by_id(_layout(spark, folder, _BY_ID), record_id)


def stored_by_uid(spark: SparkSession, folder: str, table: str, uid: str) -> DataFrame:
    return lookups.by_uid(_layout(spark, folder, _BY_UID), table, uid)
