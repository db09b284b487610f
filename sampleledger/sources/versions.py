"""Versions of a record table, and what changed between two.

A version is a folder of its own beside the older ones. A new one counts from the moment its
marker, a small file named by its number, stands in the folder of markers. Nothing that readers
use is ever written over: until then they see the old version, and a run that fails before leaves
data that no marker names.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleledger.schemas import STORED_RECORD
from sampleledger.sources.records import with_identity

_MARKERS, _DATA = "_versions", "data"


class VersionConflict(RuntimeError):
    """Another writer published a version after the one that this is based on."""


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def published(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of the versions there are, in order; a folder without any has none."""
    place, fs = _place(spark, f"{folder.rstrip('/')}/{_MARKERS}")
    if not fs.exists(place):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(place)]
    return sorted(int(name) for name in names if name.isdecimal())


def _data_of(spark: SparkSession, folder: str, version: int) -> str:
    marker = f"{folder.rstrip('/')}/{_MARKERS}/{version}"
    return f"{folder.rstrip('/')}/{_DATA}/{spark.read.text(marker).first()['value']}"


def _publish_marker(spark: SparkSession, markers: str, name: str, version: int) -> None:
    """The marker is written under another name and renamed, so it is there whole or not at all."""
    hadoop, context = spark._jvm.org.apache.hadoop.fs, spark.sparkContext
    (written, fs), (final, _) = _place(spark, f"{markers}/.{name}"), _place(spark, f"{markers}/{version}")
    out = fs.create(written, False)
    out.write(bytearray(f"{name}\n", "utf-8"))
    out.close()
    files = hadoop.FileContext.getFileContext(written.toUri(), spark._jsc.hadoopConfiguration())
    try:
        files.rename(written, final, context._gateway.new_array(getattr(hadoop, "Options$Rename"), 0))
    except Exception as error:
        fs.delete(written, False)
        if fs.exists(final):
            raise VersionConflict(f"version {version} was published meanwhile") from error
        raise


def publish(records: DataFrame, folder: str, based_on: int | None = None) -> int:
    """Store ``records`` as the next version and return its number.

    The data is written first, to a folder that no one else uses. The marker is then renamed to its
    number, which fails where that is taken: of two writers one gets a :class:`VersionConflict`, on a
    file system whose rename is atomic and never replaces (HDFS). So does a writer whose ``based_on``
    is no longer the last version.
    """
    spark, name, root = records.sparkSession, uuid4().hex, folder.rstrip("/")
    versions = published(spark, folder)
    last = versions[-1] if versions else 0
    if based_on is not None and based_on != last:
        raise VersionConflict(f"version {last} was published after version {based_on}")
    records.select("id", "fields").write.parquet(f"{root}/{_DATA}/{name}")
    _publish_marker(spark, f"{root}/{_MARKERS}", name, last + 1)
    return last + 1


def read_version(
    spark: SparkSession, folder: str, table: str, version: int | None = None, fallback: str | None = None
) -> DataFrame:
    """The records of a version, of the last one by default. What is read stays the same when a newer
    version is published."""
    versions = published(spark, folder)
    if not versions or version is not None and version not in versions:
        raise FileNotFoundError(f"{folder} has no version {version or ''}".rstrip())
    data = _data_of(spark, folder, versions[-1] if version is None else version)
    return with_identity(spark.read.schema(STORED_RECORD).parquet(data), table, fallback)


def _cells() -> Column:
    """The fields of a record as JSON texts, which compare by value: the order of an object's names
    does not count, and a field that is null differs from one that is not there."""
    return F.transform_values(F.col("fields").cast("map<string, variant>"), lambda _, v: F.to_json(v))


def snapshot_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """``(tbl, id, change, field, old_value, new_value)`` between two snapshots of records.

    ``change`` is ``added`` or ``removed`` for a record, with no field, and ``changed`` for every
    field of a record in both whose value differs; values are JSON, NULL where the field is not
    there. Ids are unique in a snapshot. One join by id; a record without changes yields no row.
    """
    before = old.select("tbl", "id", F.lit(True).alias("_was"), _cells().alias("_old"))
    after = new.select("tbl", "id", F.lit(True).alias("_is"), _cells().alias("_new"))
    both = before.join(after, ["tbl", "id"], "full")
    empty = F.create_map().cast("map<string, string>")
    had, has = F.coalesce("_old", empty), F.coalesce("_new", empty)
    fields = F.filter(
        F.array_union(F.map_keys(had), F.map_keys(has)),
        lambda k: ~F.try_element_at(had, k).eqNullSafe(F.try_element_at(has, k)),
    )

    def row(change: str, field: Column, was: Column, now: Column) -> Column:
        return F.struct(F.lit(change).alias("change"), field.alias("field"), was.alias("old_value"), now.alias("new_value"))

    none = F.lit(None).cast("string")
    whole = F.when(F.col("_was").isNull(), F.array(row("added", none, none, none))).when(
        F.col("_is").isNull(), F.array(row("removed", none, none, none))
    )
    rows = whole.otherwise(
        F.transform(fields, lambda k: row("changed", k, F.try_element_at(had, k), F.try_element_at(has, k)))
    )
    return both.select("tbl", "id", F.explode(rows).alias("c")).select("tbl", "id", "c.*")


def apply_changes(old: DataFrame, changes: DataFrame, added: DataFrame) -> DataFrame:
    """The newer snapshot from the older one and its changes; ``added`` has the records that
    ``changes`` calls added. Records without changes are passed through the join as they are."""
    per_record = changes.filter("change <> 'added'").groupBy("tbl", "id").agg(
        F.bool_or(F.col("change") == "removed").alias("_gone"),
        F.map_from_entries(F.collect_list(F.when(F.col("change") == "changed", F.struct("field", "new_value")))).alias("_new"),
    )
    joined = old.join(per_record, ["tbl", "id"], "left").filter(~F.coalesce("_gone", F.lit(False)))
    cells = F.map_filter(_cells(), lambda k, _: ~F.array_contains(F.map_keys("_new"), k))
    merged = F.map_concat(cells, F.map_filter("_new", lambda _, v: v.isNotNull()))
    pairs = F.transform(
        F.map_entries(merged), lambda e: F.concat(F.to_json(F.array(e["key"])).substr(F.lit(2), F.length(F.to_json(F.array(e["key"]))) - 2), F.lit(":"), e["value"])
    )
    rebuilt = F.parse_json(F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}")))
    fields = F.when(F.col("_new").isNull() | (F.size("_new") == 0), F.col("fields")).otherwise(rebuilt)
    return joined.select("tbl", "id", "uid", fields.alias("fields")).unionByName(added.select("tbl", "id", "uid", "fields"))
