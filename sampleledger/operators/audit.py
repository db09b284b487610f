"""Audit of a file listing against the sequencing records.

A listing has ``path, file, seqprep, s_well, suffix`` (see :mod:`sampleledger.functions.names`).
The listing is the large side and any sample may own a large part of it, so it is reduced to
distinct (sample, well) rows on the map side before it is shuffled, and every per-sample decision is
made on those. Only outputs that list files go back to the listing, with one join.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleledger.fixed import ARTEFACT_FLAGS, COMPLETION_RULES, KNOWN_SUFFIXES, TOOLS
from sampleledger.operators.joins import attach, distinct_keys
from sampleledger.session import kept

PROBLEM_FLAGS = ("s_well_ambiguity", "bad_suffix", "bad_uid")


def bad_suffix(suffix: Column, known: Sequence[str] = KNOWN_SUFFIXES) -> Column:
    """Suffix missing or not a known one."""
    return F.coalesce(~suffix.isin(list(known)), F.lit(True))


def _any(flag: Column) -> Column:
    return F.coalesce(F.bool_or(flag), F.lit(False))


def _with_completion(df: DataFrame, rules: Mapping[str, Iterable[str]]) -> DataFrame:
    def every(names: Iterable[str]) -> Column:
        first, *rest = [F.col(n) for n in names]
        for c in rest:
            first = first & c
        return first

    return df.withColumns({name: every(needed) for name, needed in rules.items()})


def sample_evidence(
    listing: DataFrame,
    known: Sequence[str] = KNOWN_SUFFIXES,
    artefacts: Mapping[str, str] = ARTEFACT_FLAGS,
) -> DataFrame:
    """One row per sample (a NULL sample is one): its wells, file counts and artefact flags.

    The first grouping, on (sample, well), holds only counters and booleans: it runs as a hash
    aggregate and combines on the map side, so a sample with a third of all files leaves each task
    as a few rows. The second sees one row per (sample, well). A NULL well counts as one well.
    """
    # A file with an unknown suffix is not a good one, so it proves nothing.
    proof = {flag: (F.col("suffix") == s) if s in known else F.lit(False) for flag, s in artefacts.items()}
    by_well = listing.groupBy("seqprep", "s_well").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.count_if(bad_suffix(F.col("suffix"), known)).alias("n_bad_suffix"),
        *[_any(has).alias(flag) for flag, has in proof.items()],
    )
    return by_well.groupBy("seqprep").agg(
        F.count(F.lit(1)).alias("n_wells"),
        F.min("s_well").alias("s_well"),
        F.sum("n_files").alias("n_files"),
        F.sum("n_bad_suffix").alias("n_bad_suffix"),
        *[F.bool_or(flag).alias(flag) for flag in artefacts],
    )


def verdicts(evidence: DataFrame, remote_seq: DataFrame, uid: str = "uid") -> DataFrame:
    """Per-sample evidence with ``s_well_ambiguity`` and ``bad_uid``."""
    known = distinct_keys(remote_seq, uid).withColumn("_known", F.lit(True))
    # One row per sample: the NULL sample is a single row, nothing to scatter. Its key equals no
    # uid but is not NULL, so no null check (which would parse every name twice) is pushed down.
    key = F.coalesce("seqprep", F.lit("\x00"))
    joined = evidence.join(known, key == known[uid], "left")
    return joined.withColumns(
        {"s_well_ambiguity": F.col("n_wells") != 1, "bad_uid": F.col("_known").isNull()}
    ).drop("_known", uid)


def flag_files(
    listing: DataFrame, remote_seq: DataFrame, known: Sequence[str] = KNOWN_SUFFIXES
) -> DataFrame:
    """Every file with its three problem flags."""
    return _flag_by(listing, verdicts(sample_evidence(listing, known, {}), remote_seq), known)


def _flag_by(listing: DataFrame, decided: DataFrame, known: Sequence[str]) -> DataFrame:
    per_sample = decided.select("seqprep", "s_well_ambiguity", "bad_uid")
    return attach(listing, per_sample, "seqprep", spread_by=["path"], null_safe=True, hashed=True).withColumn(
        "bad_suffix", bad_suffix(F.col("suffix"), known)
    )


def well_ambiguity(listing: DataFrame) -> DataFrame:
    """Every file with ``s_well_ambiguity``: does its sample have other than one well."""
    wells = sample_evidence(listing, KNOWN_SUFFIXES, {}).select(
        "seqprep", (F.col("n_wells") != 1).alias("s_well_ambiguity")
    )
    return attach(listing, wells, "seqprep", spread_by=["path"], null_safe=True, hashed=True)


def unknown_uids(listing: DataFrame, remote_seq: DataFrame, uid: str = "uid") -> DataFrame:
    """Every file with ``bad_uid``: sample missing or not among the remote ones."""
    known = distinct_keys(remote_seq, uid).withColumn("_known", F.lit(True))
    return (
        attach(listing, known, {"seqprep": uid}, spread_by=["path"])
        .withColumn("bad_uid", F.col("_known").isNull())
        .drop("_known")
    )


def is_problem() -> Column:
    return F.col("s_well_ambiguity") | F.col("bad_suffix") | F.col("bad_uid")


def problem_files(flagged: DataFrame) -> DataFrame:
    return flagged.filter(is_problem())


def good_files(flagged: DataFrame) -> DataFrame:
    return flagged.filter(~is_problem())


def suffix_problems(listing: DataFrame, known: Sequence[str] = KNOWN_SUFFIXES) -> DataFrame:
    """Files whose suffix is missing or unknown."""
    return listing.filter(bad_suffix(F.col("suffix"), known))


def remote_status(seqpreps: DataFrame) -> DataFrame:
    """Sequencing records that have a batch; a missing tool flag is false."""
    return seqpreps.filter(F.col("sequencing_batch").isNotNull()).withColumns(
        {tool: F.coalesce(F.col(tool), F.lit(False)) for tool in TOOLS}
    )


def tool_flags(
    files: DataFrame,
    group_col: str = "seqprep",
    artefacts: Mapping[str, str] = ARTEFACT_FLAGS,
    rules: Mapping[str, Iterable[str]] = COMPLETION_RULES,
) -> DataFrame:
    """Artefact and completion flags per group, over any listing.

    The well is the smallest one of the group (the files of an audited group have a single well).
    """
    by_well = files.groupBy(group_col, "s_well").agg(
        *[_any(F.col("suffix") == s).alias(flag) for flag, s in artefacts.items()]
    )
    flags = by_well.groupBy(group_col).agg(
        F.min("s_well").alias("s_well"), *[F.bool_or(flag).alias(flag) for flag in artefacts]
    )
    return _with_completion(flags, rules)


def local_status(
    listing: DataFrame, remote_seq: DataFrame, known: Sequence[str] = KNOWN_SUFFIXES
) -> DataFrame:
    """Which samples are complete, per tool: :func:`tool_flags` of the good files.

    Equal to ``tool_flags(good_files(flag_files(...)))`` without going back to the files: a sample
    has good files exactly when it is known, has one well and has a file with a known suffix.
    """
    return _status_of(verdicts(sample_evidence(listing, known), remote_seq))


def _status_of(decided: DataFrame) -> DataFrame:
    sound = decided.filter(
        ~F.col("s_well_ambiguity") & ~F.col("bad_uid") & (F.col("n_files") > F.col("n_bad_suffix"))
    )
    return _with_completion(sound.select("seqprep", "s_well", *ARTEFACT_FLAGS), COMPLETION_RULES)


@dataclass(frozen=True)
class Audit:
    """The four tables of an audit, all lazy, plus the per-sample verdicts behind them."""

    remote_seq: DataFrame
    local_seq: DataFrame
    good_files: DataFrame
    problem_files: DataFrame
    verdicts: DataFrame


def audit_listing(
    listing: DataFrame, seqpreps: DataFrame, known: Sequence[str] = KNOWN_SUFFIXES, keep: bool = False
) -> Audit:
    """Audit a parsed listing. With ``keep`` the per-sample evidence is computed now and checkpointed
    in the folder that ``spark.checkpoint.dir`` names, so that the tables and reports made of it do
    not read the listing again for it. Without it nothing runs."""
    remote = remote_status(seqpreps)
    evidence = sample_evidence(listing, known)
    decided = verdicts(kept(evidence) if keep else evidence, remote)
    flagged = _flag_by(listing, decided, known)
    return Audit(
        remote_seq=remote,
        local_seq=_status_of(decided),
        good_files=good_files(flagged),
        problem_files=problem_files(flagged),
        verdicts=decided,
    )


def write_split(flagged: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Good and problem files in one pass: parquet parted by ``kind``, ``good`` or ``problem``."""
    kind = F.when(is_problem(), "problem").otherwise("good")
    flagged.withColumn("kind", kind).write.mode(mode).partitionBy("kind").parquet(path)
