"""Id lists, id mappings and CSV results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header, every column as text."""
    return spark.read.csv(path, header=True, inferSchema=False)


def clean_mapping(rows: DataFrame) -> DataFrame:
    """``old_id, new_id``: rows with a blank side dropped, whitespace removed from ``new_id``."""
    return rows.filter((F.length("old_id") > 0) & (F.length("new_id") > 0)).select(
        "old_id", F.regexp_replace("new_id", r"\s", "").alias("new_id")
    )


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """An id-mapping CSV; its first line is a header and its columns go by place."""
    return clean_mapping(spark.read.csv(path, header=True, inferSchema=False).toDF("old_id", "new_id"))


def sample_list(lines: DataFrame, line: str = "value") -> DataFrame:
    """Distinct samples of a list with one per line, trimmed, blank lines dropped."""
    sample = F.regexp_replace(line, r"^\s+|\s+$", "")
    return lines.select(sample.alias("sample")).filter(F.length("sample") > 0).distinct()


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    return sample_list(spark.read.text(path))


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Result as CSV part files with headers."""
    df.write.mode(mode).csv(path, header=True)
