"""File listings: from a file system, from saved object-store listings, and first lines of files."""

from __future__ import annotations

import fnmatch
import itertools
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleledger.fixed import LISTING_ZONE
from sampleledger.functions.names import dir_of, file_of, with_name_parts


def list_files(spark: SparkSession, root: str, mode: str = "disk", levels: int = 8) -> DataFrame:
    """Recursive listing, with modification time and size, of a file system every worker mounts.

    Lists every file, also empty ones and names that start with ``_`` or ``.``, which Spark's file
    sources leave out (:func:`list_data_files`); hence the small Python step. Each of ``levels``
    passes turns directories into their entries and spreads those again. Folders deeper than that
    are listed whole as well, each by the task that met it, so ``levels`` should be about the depth of
    the tree. Sizes and times are then read by all tasks.
    """

    def entries_of(folder: str, whole: bool) -> Iterator[tuple[str, bool]]:
        pending = [folder]
        while pending:
            with os.scandir(pending.pop()) as entries:
                for entry in entries:
                    if not entry.is_dir():
                        yield entry.path, False
                    elif not entry.is_symlink():
                        if whole:
                            pending.append(entry.path)
                        else:
                            yield entry.path, True

    def expand(batches: Iterator[pd.DataFrame], whole: bool) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[~batch["is_dir"]]
            for folder in batch.loc[batch["is_dir"], "path"]:
                found = entries_of(folder, whole)
                while some := list(itertools.islice(found, 10000)):
                    yield pd.DataFrame(some, columns=["path", "is_dir"])

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path in batch["path"]:
                try:
                    status = os.stat(path)
                    rows.append((path, status.st_size, status.st_mtime_ns // 1000))
                except FileNotFoundError:  # a link to nothing
                    rows.append((path, 0, 0))
            yield pd.DataFrame(rows, columns=["path", "size", "micros"]).astype({"size": "int64", "micros": "int64"})

    # A stated number of partitions: adaptive execution would merge so few bytes into one task.
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    entries = spark.createDataFrame([(root.rstrip("/") or "/", True)], "path string, is_dir boolean")
    for step in range(levels + 1):
        whole = step == levels
        entries = entries.mapInPandas(lambda b, whole=whole: expand(b, whole), entries.schema).repartition(tasks, "path")
    found = entries.select("path").mapInPandas(measure, "path string, size bigint, micros bigint")
    return _with_place(found.select(F.timestamp_micros("micros").alias("mod"), "size", "path"), mode)


def list_data_files(spark: SparkSession, root: str, mode: str = "disk") -> DataFrame:
    """Recursive listing of any file system Spark reads; contents are not read.

    Spark leaves out empty files and names that start with ``_`` or ``.``. For very many files a
    stored inventory in the same columns is the better input.
    """
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select(
            F.col("modificationTime").alias("mod"),
            F.col("length").alias("size"),
            F.regexp_replace("path", "^file:/+", "/").alias("path"),
        )
    )
    return _with_place(found, mode)


def _with_place(listing: DataFrame, mode: str) -> DataFrame:
    placed = listing.withColumns({"dir": dir_of(F.col("path")), "file": file_of(F.col("path"))})
    return with_name_parts(placed, mode=mode)


def parse_store_lines(
    lines: DataFrame, bucket: str, line: str = "value", zone: str = LISTING_ZONE
) -> DataFrame:
    """Listing rows of ``date time size key`` lines; lines with other than four words are dropped.

    Times are read in ``zone`` and kept as instants, whatever the session's zone. A line of four
    words whose time or size cannot be read is no row; :func:`rejected_store_lines` has it.
    """
    found = _store_rows(lines, line, zone).filter(F.col("mod").isNotNull() & F.col("size").isNotNull())
    return _with_place(found.select("mod", "size", F.concat(F.lit(f"s3://{bucket}/"), "key").alias("path")), "store")


def rejected_store_lines(lines: DataFrame, line: str = "value", zone: str = LISTING_ZONE) -> DataFrame:
    """Lines of four words whose time or size cannot be read."""
    return _store_rows(lines, line, zone).filter(F.col("mod").isNull() | F.col("size").isNull()).select("line")


def _store_rows(lines: DataFrame, line: str, zone: str) -> DataFrame:
    words = F.col("_words")
    stamped = F.concat(words[0], F.lit(" "), words[1], F.lit(f" {zone}"))
    return (
        lines.select(F.col(line).alias("line"), F.split(F.trim(F.regexp_replace(line, r"\s+", " ")), " ").alias("_words"))
        .filter(F.size(words) == 4)
        .select(
            "line",
            F.try_to_timestamp(stamped, F.lit("yyyy-MM-dd HH:mm:ss VV")).alias("mod"),
            words[2].try_cast("bigint").alias("size"),
            words[3].alias("key"),
        )
    )


def read_store_listing(spark: SparkSession, path: str, bucket: str, zone: str = LISTING_ZONE) -> DataFrame:
    """A saved object-store listing."""
    return parse_store_lines(spark.read.text(path), bucket, zone=zone)


def first_lines(spark: SparkSession, root: str, name_glob: str = "*") -> DataFrame:
    """First line of each file below ``root``, on a file system every worker mounts, whose name fits
    the glob. No more than the line is read of a file. Empty files have no row.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path in batch["path"]:
                with open(path, "rb") as file:
                    line = file.readline()
                if line:
                    rows.append((path, line.decode("utf-8", "replace").rstrip("\r\n")))
            yield pd.DataFrame(rows, columns=["path", "first_line"])

    wanted = list_files(spark, root).filter(F.rlike("file", F.lit(fnmatch.translate(name_glob))))
    lines = wanted.filter("size > 0").select("path").mapInPandas(read, "path string, first_line string")
    return lines.withColumns({"dir": dir_of(F.col("path")), "file": file_of(F.col("path"))})


def first_lines_of_store(spark: SparkSession, root: str, name_glob: str) -> DataFrame:
    """:func:`first_lines` of any file system Spark reads. All of the files' text is scanned, so the
    glob has to choose few or small ones.

    Right for files that are split: only rows of a file's first block count, in their order.
    """
    rows = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name_glob)
        .text(root)
        .select("value", "_metadata.file_path", "_metadata.file_block_start")
        .filter(F.col("file_block_start") == 0)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    named = rows.withColumn("path", F.regexp_replace("file_path", "^file:/+", "/"))
    return first_of_each(named, "path", "value", "_at").withColumns(
        {"dir": dir_of(F.col("path")), "file": file_of(F.col("path"))}
    )


def first_of_each(lines: DataFrame, path: str, line: str, order: str) -> DataFrame:
    """``(path, first_line)``: the line of each path that comes first in the order."""
    return lines.groupBy(F.col(path).alias("path")).agg(F.min_by(line, order).alias("first_line"))


def matching_lines(lines: DataFrame, pattern: str, line: str = "value") -> DataFrame:
    """Lines in which the pattern is found."""
    return lines.filter(F.rlike(F.col(line), F.lit(pattern)))
