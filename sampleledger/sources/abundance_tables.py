"""Profile and functional tables as the profiling programs write them, read as one long table.

A file has comment lines, one of which names its columns, and then rows; of a functional table the
columns are named after samples, of a profile they are fixed and the file is named after its sample.
Large files are split, so most of their rows are read by tasks that never see the header. The
headers of all files are a small table, a row per file, which the rows join by file name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleledger.fixed import (
    ABUNDANCE_COLUMN_PATTERN,
    DATABASE_LINE_PATTERN,
    PROFILE_COLUMNS_START,
    PROFILE_FILE_SUFFIX,
    PROFILE_VALUE_COLUMN,
    TABLE_COLUMNS_PATTERN,
)
from sampleledger.functions.names import database_name
from sampleledger.operators.joins import attach


def table_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(file, value)`` of every line that is not blank."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), "value")
    return lines.filter(F.trim("value") != "")


def _is_comment() -> Column:
    return F.startswith(F.col("value"), F.lit("#"))


def table_headers(lines: DataFrame) -> DataFrame:
    """``(file, columns, samples, place, database)`` of each file with one line that names its columns;
    ``place`` counts the cells before the values. A file that repeats that line has one header."""
    line = F.col("value")
    names_columns = F.startswith(line, F.lit(PROFILE_COLUMNS_START)) | line.rlike(TABLE_COLUMNS_PATTERN)
    named = F.when(names_columns, line)
    heads = lines.filter(_is_comment()).groupBy("file").agg(
        F.min(named).alias("head"), F.max(named).alias("other"), F.min(F.when(line.rlike(DATABASE_LINE_PATTERN), database_name(line))).alias("database")
    )
    columns = F.split("head", "\t")
    is_profile = F.startswith(F.col("head"), F.lit(PROFILE_COLUMNS_START))
    base_name = F.regexp_extract("file", r"([^/]*)$", 1)
    of_file = F.regexp_replace(base_name, f"{PROFILE_FILE_SUFFIX}$", "")
    of_columns = F.transform(F.slice(columns, 2, F.size(columns) - 1), lambda c: F.regexp_replace(c, ABUNDANCE_COLUMN_PATTERN, ""))
    place = F.when(is_profile, F.array_position(columns, PROFILE_VALUE_COLUMN) - 1).otherwise(1).cast("int")
    return heads.filter(F.col("head") == F.col("other")).select(
        "file", columns.alias("columns"), F.when(is_profile, F.array(of_file)).otherwise(of_columns).alias("samples"), place.alias("place"), "database"
    ).filter(F.col("place") > 0)


def _rows(lines: DataFrame) -> DataFrame:
    """Every row with its file's header and the ``reason`` why it cannot be read, if there is one.
    A profile's row may leave out cells after the value; any other has a cell per column."""
    rows = attach(lines.filter(~_is_comment()), table_headers(lines), "file", spread_by=["value"])
    cells, many = F.split("value", "\t"), F.size("samples")
    rows = rows.withColumns({"cells": cells, "values": F.slice(cells, F.col("place") + 1, many)})
    wrong = (F.size("cells") > F.size("columns")) | (F.size("cells") < F.col("place") + many)
    no_number = F.exists("values", lambda v: v.try_cast("double").isNull())
    reason = F.when(F.col("columns").isNull(), "header").when(wrong, "cells").when(no_number, "value")
    return rows.withColumn("reason", reason)


def abundances(lines: DataFrame) -> DataFrame:
    """``(file, sample, feature, value, database)`` of all tables in ``(file, value)`` lines, a row per
    value. ``feature`` is the first cell, a taxon after ``|`` included; ``database`` is the one that a
    comment names. Rows that cannot be read are in :func:`rejected_rows`."""
    good = _rows(lines).filter("reason IS NULL")
    pairs = F.arrays_zip("samples", "values")
    out = good.select("file", F.col("cells")[0].alias("feature"), "database", F.explode(pairs).alias("x"))
    return out.select("file", F.col("x.samples").alias("sample"), "feature", F.col("x.values").cast("double").alias("value"), "database")


def rejected_rows(lines: DataFrame) -> DataFrame:
    """``(file, value, reason)``: rows of files without one header (``header``), with too few or too
    many ``cells``, or a ``value`` that is no number."""
    return _rows(lines).filter("reason IS NOT NULL").select("file", "value", "reason")
