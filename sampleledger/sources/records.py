"""Record snapshots: reading, typing, uniting and writing record tables.

Snapshots arrive as a JSON array of ``{id, fields}`` objects. Such a file is one unsplittable unit,
so :func:`import_snapshot` writes it once as JSON lines or parquet, which all readers take.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleledger.fixed import RECORD_TABLES, SNAPSHOT_FILE_PREFIX
from sampleledger.schemas import RECORD_FIELDS, STORED_RECORD


def snapshot_name(table: str) -> str:
    return f"{SNAPSHOT_FILE_PREFIX}{table.replace(' ', '').lower()}.json"


def uid_of(fields: Column, fallback: str | None = None) -> Column:
    """``uid`` of a record, or the named fallback field where it has none."""
    uid = F.try_variant_get(fields, "$.uid", "string")
    return uid if fallback is None else F.coalesce(uid, F.try_variant_get(fields, f"$.{fallback}", "string"))


def with_identity(stored: DataFrame, table: str, fallback: str | None = None) -> DataFrame:
    """``(tbl, id, uid, fields)`` of stored records."""
    return stored.select(F.lit(table).alias("tbl"), "id", uid_of(F.col("fields"), fallback).alias("uid"), "fields")


class RecordError(ValueError):
    """Stored lines that are no records."""


def _record(line: str) -> Column:
    return F.try_variant_get(F.try_parse_json(line), "$.id", "string")


def rejected_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Lines that are no ``{id, fields}`` object; blank lines are none and are not rejected."""
    return lines.filter((F.trim(line) != "") & _record(line).isNull())


def parse_records(
    lines: DataFrame, table: str, line: str = "value", fallback: str | None = None, check: bool = False
) -> DataFrame:
    """Records from JSON lines. Lines that are no records are left out and are the table of
    :func:`rejected_lines`; with ``check`` any such line is an error."""
    if check and not rejected_lines(lines, line).isEmpty():
        raise RecordError(f"{table} has lines that are no records")
    parsed = lines.select(F.try_parse_json(line).alias("r"))
    stored = parsed.select(
        F.try_variant_get("r", "$.id", "string").alias("id"), F.try_variant_get("r", "$.fields", "variant").alias("fields")
    ).filter(F.col("id").isNotNull())
    return with_identity(stored, table, fallback)


def base_of(
    lines: Mapping[str, DataFrame], fallbacks: Mapping[str, str] | None = None, check: bool = False
) -> dict[str, DataFrame]:
    """All record tables from the lines of each; a table without lines is empty."""
    named, spark = fallbacks or {}, next(iter(lines.values())).sparkSession
    empty = spark.createDataFrame([], "value string")
    return {t: parse_records(lines.get(t, empty), t, fallback=named.get(t), check=check) for t in RECORD_TABLES}


def snapshot_lines(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.text(f"{folder.rstrip('/')}/{snapshot_name(table)}")


def read_table(
    spark: SparkSession, folder: str, table: str, fallback: str | None = None, fmt: str = "lines", check: bool = True
) -> DataFrame:
    """One record table from its snapshot: JSON ``lines``, ``parquet`` or a JSON ``array``.

    Lines and parquet are read by many tasks. An array is one unsplittable unit, so it is for
    import alone (:func:`import_snapshot`). With ``check`` anything malformed is an error.
    """
    if fmt == "lines":
        return parse_records(snapshot_lines(spark, folder, table), table, fallback=fallback, check=check)
    path = f"{folder.rstrip('/')}/{snapshot_name(table)}"
    reader = spark.read.schema(STORED_RECORD)
    if fmt == "array":
        stored = reader.json(path, multiLine=True, mode="FAILFAST" if check else "PERMISSIVE")
    else:
        stored = reader.parquet(path)
    return with_identity(stored.filter(F.col("id").isNotNull()) if not check else stored, table, fallback)


def read_base(
    spark: SparkSession, folder: str, fallbacks: Mapping[str, str] | None = None, fmt: str = "lines", check: bool = True
) -> dict[str, DataFrame]:
    """All record tables of a folder of snapshots."""
    named = fallbacks or {}
    if fmt == "lines":
        return base_of({t: snapshot_lines(spark, folder, t) for t in RECORD_TABLES}, named, check)
    return {t: read_table(spark, folder, t, named.get(t), fmt, check) for t in RECORD_TABLES}


def import_snapshot(spark: SparkSession, source: str, folder: str, table: str, fmt: str = "lines") -> None:
    """Write a JSON array snapshot once as ``lines`` or ``parquet``; its records may hold anything,
    but a malformed file is an error."""
    write_snapshot(read_table(spark, source, table, fmt="array"), f"{folder.rstrip('/')}/{snapshot_name(table)}", fmt)


def all_records(base: Mapping[str, DataFrame]) -> DataFrame:
    """Every record of the base in one frame, keyed by ``tbl`` and ``id``."""
    first, *rest = base.values()
    for other in rest:
        first = first.unionByName(other)
    return first


def typed(records: DataFrame, table: str, schema: T.StructType | None = None) -> DataFrame:
    """Named, typed columns of one table's records; a field of another type reads as NULL.

    A flag or ``keep`` may be stored as a number or a boolean.
    """
    return records.select("id", *_typed_columns(schema or RECORD_FIELDS[table]))


def _typed_columns(schema: T.StructType) -> list[Column]:
    columns = []
    for field in schema.fields:
        path = f"$.{field.name}"
        value = F.try_variant_get("fields", path, field.dataType.simpleString())
        if isinstance(field.dataType, (T.IntegerType, T.BooleanType)):
            other = "boolean" if isinstance(field.dataType, T.IntegerType) else "int"
            value = F.coalesce(value, F.try_variant_get("fields", path, other).cast(field.dataType))
        if field.name == "uid":
            value = F.col("uid")
        columns.append(value.alias(field.name))
    return columns


#: Columns that walks add or join by; a field of such a name, in any case of letters, is read as ``<name>_field``.
WALK_COLUMNS = ("id", "tbl", "fields", "parent_id", "project", "subject", "biospecimen", "s_well")
_SCALAR = r"BIGINT|BOOLEAN|STRING|FLOAT|DOUBLE|DATE|TIMESTAMP|TIMESTAMP_NTZ|BINARY|DECIMAL\(\d+,\s?\d+\)"
_TYPED = rf"^(ARRAY<)?({_SCALAR})>?$"


def merged_fields(records: DataFrame) -> DataFrame:
    """``(tbl, field, n, kind, kinds)``: every field of each table, in how many records, the type that
    fits all its values and the sorted outer types there are. ``VARIANT`` in ``kind`` tells that no
    type does. Values are merged on the map side."""
    value = F.col("value")
    outer = F.regexp_extract(F.schema_of_variant(value), r"^\w+", 0)
    pairs = records.select("tbl", F.explode(F.col("fields").cast("map<string, variant>")).alias("field", "value"))
    return pairs.groupBy("tbl", "field").agg(
        F.count(F.lit(1)).alias("n"), F.schema_of_variant_agg(value).alias("kind"),
        F.array_sort(F.collect_set(F.when(outer != "VOID", outer))).alias("kinds"),
    )


def mixed_fields(records: DataFrame) -> DataFrame:
    """Fields whose values are of several types that no one type fits."""
    return merged_fields(records).filter(F.contains("kind", F.lit("VARIANT")))


def all_typed(records: DataFrame, table: str) -> DataFrame:
    """:func:`typed` with a column for every other field that any record has, in order of name.

    A field has the type that fits all its values; one of several types, or of objects, stays a
    variant, one without values is text. A name that differs from an earlier one in case alone, or
    that walks use themselves, gets ``_field`` after it. The fields are read from the records now:
    a row per field comes to the driver.
    """
    schema = RECORD_FIELDS.get(table, T.StructType([T.StructField("uid", T.StringType())]))
    known = schema.fieldNames()
    found = merged_fields(records).filter(~F.col("field").isin(known)).select("field", "kind").collect()
    taken = {c.lower() for c in (*known, *WALK_COLUMNS)}
    cells = F.col("fields").cast("map<string, variant>")
    columns = []
    for field, kind in sorted((r["field"], r["kind"]) for r in found):
        name = field
        while name.lower() in taken:
            name += "_field"
        taken.add(name.lower())
        value = F.try_element_at(cells, F.lit(field))
        if kind == "VOID":
            value = F.lit(None).cast("string")
        elif re.match(_TYPED, kind):
            value = F.try_variant_get(value, "$", kind)
        columns.append(value.alias(name))
    return records.select("id", *_typed_columns(schema), *columns)


def field_names(records: DataFrame) -> DataFrame:
    """Distinct field names over the records of each table."""
    keys = F.map_keys(F.col("fields").cast("map<string, variant>"))
    return records.select("tbl", F.explode(keys).alias("field")).distinct()


def write_snapshot(records: DataFrame, path: str, fmt: str = "lines", mode: str = "errorifexists") -> None:
    """Write a record table as ``{id, fields}`` JSON ``lines`` or ``parquet``."""
    records.select("id", "fields").write.format("parquet" if fmt == "parquet" else "json").mode(mode).save(path)
