"""Report tables over an audit, and the data checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleledger.fixed import TOOLS
from sampleledger.functions.names import is_sequencing_name
from sampleledger.operators.joins import attach


def problem_report(problem_files: DataFrame) -> DataFrame:
    """Per sample, which checks any of its problem files fails."""
    return problem_files.groupBy("seqprep").agg(
        F.bool_or("s_well_ambiguity").alias("check_s_well"),
        F.bool_or("bad_suffix").alias("check_suffices"),
        F.bool_or("bad_uid").alias("check_uid"),
    )


def problem_report_of(verdicts: DataFrame) -> DataFrame:
    """:func:`problem_report` from the per-sample verdicts, without touching files again."""
    return verdicts.select(
        "seqprep",
        F.col("s_well_ambiguity").alias("check_s_well"),
        (F.col("n_bad_suffix") > 0).alias("check_suffices"),
        F.col("bad_uid").alias("check_uid"),
    ).filter("check_s_well OR check_suffices OR check_uid")


def problem_count(report: DataFrame) -> DataFrame:
    """Number of distinct problem samples; the missing sample counts as one."""
    return report.select("seqprep").distinct().agg(F.count(F.lit(1)).alias("n_problem_ids"))


def _side_counts(df: DataFrame, side: str, flags: dict[str, str]) -> DataFrame:
    counted = df.agg(
        F.count(F.lit(1)).alias("sequences"),
        *[F.count_if(F.col(c)).alias(tool) for tool, c in flags.items()],
    )
    long = F.explode(
        F.array(*[F.struct(F.lit(t).alias("thing"), F.col(t).alias("n")) for t in ("sequences", *flags)])
    )
    return counted.select(long.alias("r")).select("r.thing", F.col("r.n").alias(side))


def compare_counts(local_seq: DataFrame, remote_seq: DataFrame) -> DataFrame:
    """Local and remote numbers of sequences and of complete samples per tool."""
    local = _side_counts(local_seq, "n_local", {t: f"{t}_complete" for t in TOOLS})
    remote = _side_counts(remote_seq, "n_remote", {t: t for t in TOOLS})
    return local.join(remote, "thing").withColumn("diff", F.col("n_local") - F.col("n_remote"))


def discrepancies(local_seq: DataFrame, remote_seq: DataFrame) -> DataFrame:
    """Per tool, how many distinct ids are complete on one side only.

    Both sides are stacked and grouped by id once, for all tools and both directions.
    """
    sides = {f"{side}_{t}": F.bool_or(f"{side}_{t}") for side in ("loc", "rem") for t in TOOLS}
    local = local_seq.select(
        F.col("seqprep").alias("uid"),
        *[F.col(f"{t}_complete").alias(f"loc_{t}") for t in TOOLS],
        *[F.lit(False).alias(f"rem_{t}") for t in TOOLS],
    )
    remote = remote_seq.select(
        "uid", *[F.lit(False).alias(f"loc_{t}") for t in TOOLS], *[F.col(t).alias(f"rem_{t}") for t in TOOLS]
    )
    per_id = local.unionByName(remote).groupBy("uid").agg(*[v.alias(k) for k, v in sides.items()])

    def only(a: str, b: str, tool: str) -> Column:
        return F.count_if(F.col(f"{a}_{tool}") & ~F.col(f"{b}_{tool}"))

    directions = (("Local, not remote", "loc", "rem"), ("Remote, not local", "rem", "loc"))
    totals = per_id.agg(
        *[
            F.struct(F.lit(label).alias("thing"), *[only(a, b, t).alias(t) for t in TOOLS]).alias(f"d{i}")
            for i, (label, a, b) in enumerate(directions)
        ]
    )
    return totals.select(F.explode(F.array("d0", "d1")).alias("r")).select("r.*")


def audit_report(audit) -> dict[str, DataFrame]:
    """The three report tables of an audit."""
    return {
        "counts": compare_counts(audit.local_seq, audit.remote_seq),
        "discrepancies": discrepancies(audit.local_seq, audit.remote_seq),
        "problems": problem_report_of(audit.verdicts),
    }


def sample_kinds(listing: DataFrame) -> DataFrame:
    """Number of sample groups, and of distinct sequencing and other samples.

    The missing sample is one group but neither kind.
    """
    samples = listing.select("seqprep").distinct()
    named = is_sequencing_name(F.col("seqprep"))
    return samples.agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.count_if(named).alias("n_sequencing"),
        F.count_if(~named).alias("n_other"),
    )


def completion_totals(flags: DataFrame) -> DataFrame:
    """How many samples have each result."""
    columns = {
        "kneaddata": "kneaddata_complete",
        "metaphlan": "metaphlan_complete",
        "taxprofile": "has_taxprofile",
        "humann_basic": "humann_basic_complete",
        "humann_grprn": "humann_complete",
    }
    return flags.agg(*[F.count_if(F.col(c)).alias(f"n_{name}") for name, c in columns.items()])


def data_checks(evidence: DataFrame, lines: DataFrame, line_pattern: str, keep: str, line: str = "value") -> DataFrame:
    """One row per check with the number of failing rows.

    ``evidence`` is per sample (see :func:`sampleledger.operators.audit.sample_evidence`): files
    that do not parse are those of the missing sample. Lines that hold ``keep`` must match
    ``line_pattern``.
    """
    from_samples = evidence.agg(
        F.coalesce(F.sum(F.when(F.col("seqprep").isNull(), F.col("n_files"))), F.lit(0)).alias("unparsed_files"),
        F.count_if(F.col("n_wells") != 1).alias("ambiguous_samples"),
    )
    long = from_samples.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("check"), F.col(c).cast("bigint").alias("n_failing"))
                    for c in ("unparsed_files", "ambiguous_samples")
                ]
            )
        ).alias("r")
    ).select("r.*")
    bad_lines = lines.filter(
        F.contains(F.col(line), F.lit(keep)) & ~F.rlike(F.col(line), F.lit(line_pattern))
    ).agg(F.lit("unmatched_lines").alias("check"), F.count(F.lit(1)).alias("n_failing"))
    return long.unionByName(bad_lines)


def repeated_groups(df: DataFrame, group: str, counted: str = "n_rows") -> DataFrame:
    """Rows of the groups that have more than one row, with the group size on every row.

    Grouped and joined back: a window would bring a whole group into one task.
    """
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias(counted)).filter(F.col(counted) > 1)
    return attach(df, sizes, group, how="inner", null_safe=True)


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in a stated order; each task keeps its own first ``n``."""
    return df.orderBy(*order).limit(n)


def old_name_files(listing: DataFrame, sample: str = "sample") -> DataFrame:
    """Files whose sample is present and does not have a sequencing name."""
    return listing.filter(F.col(sample).isNotNull() & ~is_sequencing_name(F.col(sample)))


def concatenate(*listings: DataFrame) -> DataFrame:
    """Listings one after another, columns united."""
    first, *rest = listings
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
