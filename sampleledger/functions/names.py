"""Functions over file names, paths and header lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleledger.fixed import (
    CLEANED_PAIR_PATTERN,
    DISK_NAME_PATTERN,
    PROFILE_VERSION_PATTERN,
    RECORD_ID_PATTERN,
    SEQUENCING_PREFIX,
    STORE_NAME_PATTERN,
    VISIT_ID_PATTERN,
)

# NUL cannot occur in a file name, so it can separate the parts of one.
_NUL = "\x00"

# What is matched around a name pattern so that a replacement leaves only its groups. The lazy
# head keeps the leftmost match, as a search for an unanchored pattern would find it.
_NAME_MODES = {
    "disk": DISK_NAME_PATTERN + r"[\s\S]*$",
    "store": r"^[\s\S]*?" + STORE_NAME_PATTERN + r"[\s\S]*$",
}


def _or_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def with_name_parts(listing: DataFrame, file: str = "file", mode: str = "disk") -> DataFrame:
    """Add ``seqprep``, ``s_well`` and ``suffix`` parsed from the file name, NULL when it does not
    parse. One regex pass gives all three: it leaves a NUL before each part.

    The parts are a generated row, so what later steps ask of them (a part that is not NULL, keys of
    a join) is asked of the parts. It is not pushed below, where each condition would be one more
    pass over every name, and before a listing is made distinct over more names than there are."""
    marked = F.regexp_replace(file, _NAME_MODES[mode], "".join(f"{_NUL}${i}" for i in (1, 2, 3)))
    names = ("seqprep", "s_well", "suffix")
    # A name that does not parse stays whole, at place 0: there is no place 1.
    parts = {name: F.get("_parts", F.lit(i)) for i, name in enumerate(names, 1)}
    return listing.withColumn("_parts", F.explode(F.array(F.split(marked, _NUL)))).withColumns(parts).drop("_parts")


def file_of(path: Column) -> Column:
    """Last part of a path."""
    return F.substring_index(path, "/", -1)


def dir_of(path: Column) -> Column:
    """Everything before the last part of a path, without a trailing slash."""
    head = F.left(path, F.length(path) - F.length(file_of(path)) - 1)
    return F.when(F.startswith(path, F.lit("/")) & (head == ""), F.lit("/")).otherwise(head)


def tool_of(directory: Column, root: str) -> Column:
    """First part of a directory below the analysis root."""
    below = F.replace(directory, F.lit(root), F.lit(""))
    return F.substring_index(F.ltrim(below, F.lit("/")), "/", 1)


def is_record_id(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit(RECORD_ID_PATTERN)), F.lit(False))


def is_sequencing_name(name: Column) -> Column:
    return F.startswith(name, F.lit(SEQUENCING_PREFIX))


def swap_separators(name: Column) -> Column:
    """``_`` and ``-`` exchanged."""
    return F.translate(name, "_-", "-_")


def visit_id(text: Column) -> Column:
    """``struct(subject, timepoint, metadata.mother_child)`` of a visit id, NULL when invalid."""

    def group(n: int) -> Column:
        return F.regexp_extract(text, VISIT_ID_PATTERN, n)

    subject = group(2).try_cast("bigint")
    who = F.when(group(1) == "SD", "C").otherwise("M")
    value = F.struct(
        subject.alias("subject"),
        (F.ascii(group(3)) - F.ascii(F.lit("A")) + 1).alias("timepoint"),
        F.struct(who.alias("mother_child")).alias("metadata"),
    )
    return F.when(subject.isNotNull(), value)


def visit_reject(text: Column) -> Column:
    """Why a text is no visit id: ``missing``, ``pattern``, or ``subject`` (a number beyond 64 bits);
    NULL for a visit id."""
    subject = F.regexp_extract(text, VISIT_ID_PATTERN, 2)
    return (
        F.when(text.isNull(), "missing")
        .when(~F.rlike(text, F.lit(VISIT_ID_PATTERN)), "pattern")
        .when(subject.try_cast("bigint").isNull(), "subject")
    )


def subject_of(visit: Column) -> Column:
    return visit["subject"]


def timepoint_of(visit: Column) -> Column:
    return visit["timepoint"]


def metadata_of(visit: Column) -> Column:
    return visit["metadata"]


def profile_version(first_line: Column) -> Column:
    """Database version digits in the first line of a taxonomic profile."""
    return _or_null(F.regexp_extract(first_line, PROFILE_VERSION_PATTERN, 1))


def database_name(first_line: Column) -> Column:
    """Database name in the first line of a profile: no ``#``, no whitespace; NULL when empty."""
    return _or_null(F.regexp_replace(first_line, r"[#\s]", ""))


def cleaned_pairs(lines: DataFrame, line: str = "value") -> DataFrame:
    """Two rows (mates 1 and 2) per listing line that names cleaned paired reads."""
    biospecimen = F.regexp_extract(line, CLEANED_PAIR_PATTERN, 1)
    well = F.regexp_extract(line, CLEANED_PAIR_PATTERN, 2)
    return (
        lines.filter(F.rlike(F.col(line), F.lit(CLEANED_PAIR_PATTERN)))
        .select(
            biospecimen.alias("biospecimen"),
            well.alias("s_well"),
            F.explode(F.array(F.lit("1"), F.lit("2"))).alias("mate"),
        )
        .select(
            "biospecimen",
            "s_well",
            F.concat(
                "biospecimen", F.lit("_"), "s_well", F.lit("_kneaddata_paired_"), "mate", F.lit(".fastq.gz")
            ).alias("file"),
        )
    )


def distinct_prefixes(names: DataFrame, limiter: str, name: str = "file") -> DataFrame:
    """Distinct text before the first ``limiter`` of the names that hold it, sorted."""
    return (
        names.filter(F.contains(F.col(name), F.lit(limiter)))
        .select(F.substring_index(name, limiter, 1).alias("prefix"))
        .distinct()
        .orderBy("prefix")
    )


def replace_id(name: Column, old: Column, new: Column) -> Column:
    """Every occurrence of ``old`` in a name replaced."""
    return F.replace(name, old, new)
