"""Local, remote and object-store status brought together; old names resolved to sequencing preps."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleledger.fixed import TOOLS
from sampleledger.functions.names import is_sequencing_name, swap_separators
from sampleledger.operators.joins import attach, matched, settled


class ReconcileError(ValueError):
    """Local and remote status that cannot be merged."""


# --- old sample names ---------------------------------------------------------------------


def prep_choices(biospecimens: DataFrame, prep_links: DataFrame, seqpreps: DataFrame) -> DataFrame:
    """``(biospecimen, pos, prep, prep_well)``: every sequencing prep of every biospecimen uid."""
    parents = biospecimens.select(F.col("id").alias("parent_id"), F.col("uid").alias("biospecimen"))
    linked = prep_links.join(parents, "parent_id").select("biospecimen", "pos", F.col("child_id").alias("id"))
    preps = seqpreps.select("id", F.col("uid").alias("prep"), F.col("s_well").alias("prep_well"))
    return linked.join(preps, "id").drop("id")


def resolve_samples(listing: DataFrame, choices: DataFrame) -> DataFrame:
    """Keep the parsed name as ``sample`` and set ``seqprep`` to the sequencing prep it stands for.

    A sequencing name stands for itself. Else it is a biospecimen: with one prep, that prep
    whatever the well; with several, the first (by link place) whose well is the file's; else none.
    Files that did not parse are left out.

    The names are resolved once per (sample, well), which combine on the map side, and the listing
    is joined to the answers once, on both columns.
    """
    by_well = choices.groupBy("biospecimen", F.col("prep_well").alias("s_well")).agg(
        F.count(F.lit(1)).alias("_n"), F.min_by("prep", "pos").alias("_by_well")
    )
    by_well = settled(by_well)
    counted = by_well.groupBy("biospecimen").agg(F.sum("_n").alias("_n"), F.min("_by_well").alias("_only"))
    single = counted.filter("_n = 1").select("biospecimen", "_only")
    by_well = by_well.filter("s_well IS NOT NULL").drop("_n")
    samples = listing.filter(F.col("seqprep").isNotNull()).withColumnRenamed("seqprep", "sample")
    asked = samples.filter(~is_sequencing_name(F.col("sample"))).select(F.col("sample").alias("biospecimen"), "s_well").distinct()
    answers = (
        asked.join(single, "biospecimen", "left").join(by_well, ["biospecimen", "s_well"], "left")
        .select("biospecimen", F.coalesce("s_well", F.lit("")).alias("_well"), F.coalesce("_only", "_by_well").alias("_prep"))
        .filter(F.col("_prep").isNotNull())
    )
    found = attach(
        samples.withColumn("_well", F.coalesce("s_well", F.lit(""))), answers, {"sample": "biospecimen", "_well": "_well"}, spread_by=["path"], both_grow=True
    )
    named = F.when(is_sequencing_name(F.col("sample")), F.col("sample")).otherwise(F.col("_prep"))
    return found.withColumn("seqprep", named).drop("_well", "_prep")


def spellings(biospecimen_uids: DataFrame) -> DataFrame:
    """``(spelled, specimen)``: every uid under its own name and with ``_`` and ``-`` exchanged, one
    row per name; the own name goes before an exchanged one."""
    uid = F.col("uid")
    swapped = swap_separators(uid)
    other = F.when(swapped != uid, F.struct(swapped.alias("spelled"), F.lit(1).alias("rank")))
    both = F.array_compact(F.array(F.struct(uid.alias("spelled"), F.lit(0).alias("rank")), other))
    rows = biospecimen_uids.filter(uid.isNotNull()).select(uid.alias("specimen"), F.explode(both).alias("s"))
    return rows.groupBy("s.spelled").agg(F.min(F.struct("s.rank", "specimen")).alias("best")).select("spelled", "best.specimen")


def resolve_by_name_well(files: DataFrame, choices: DataFrame, biospecimen_uids: DataFrame) -> DataFrame:
    """``seqid`` and ``remote_well`` of files by the wells that occur as ``_<well>_`` in the name.

    The biospecimen is the one named ``sample``, else the one named with ``_`` and ``-`` exchanged.
    Exactly one prep of it must have its well in the name. ``files`` has ``path, file, sample``;
    a well holds no ``_``, so a well in a name is an inner word between underscores.

    The answer depends on (sample, file) alone, so pairs are resolved and the files joined to the
    answers once; a path that is listed twice is answered twice. Its words meet the wells twice too,
    so the preps of a pair are not summed: they are one where its wells are one and that has one.
    """
    files = settled(files)
    words = F.col("_words")
    inner = F.when(F.size(words) > 2, F.array_distinct(F.slice(words, F.lit(2), F.size(words) - 2)))
    asked = files.filter(F.col("sample").isNotNull()).select("sample", "file", F.split("file", "_").alias("_words"))
    # one row per (sample, file, inner word), so one sample's many files are no single row
    named = asked.select("sample", "file", F.explode(inner).alias("_well"))
    specimens = spellings(biospecimen_uids)
    per_well = choices.filter(F.col("prep_well").isNotNull()).groupBy(
        F.col("biospecimen").alias("specimen"), F.col("prep_well").alias("_well")
    ).agg(F.count(F.lit(1)).alias("_n"), F.min("prep").alias("_prep"))
    by_name = specimens.join(per_well, "specimen").select(F.col("spelled").alias("sample"), "_well", "_n", "_prep")
    hits = (
        matched(named, by_name, ["sample", "_well"], both_grow=True)
        .groupBy("sample", "file")
        .agg(F.max("_n").alias("_n"), F.min("_prep").alias("seqid"), F.min("_well").alias("remote_well"), F.max("_well").alias("_last"))
        .filter("_n = 1 AND remote_well = _last")
        .drop("_n", "_last")
    )
    return attach(files, hits, {"file": "file", "sample": "sample"}, spread_by=["path"], both_grow=True)


# --- local against remote -----------------------------------------------------------------


def _single_rows(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per key with its row count; only keys with one row carry values that mean anything."""
    return df.groupBy(F.col(key).alias("uid")).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.any_value(c).alias(c) for c in columns]
    )


def _paired(local_seq: DataFrame, remote_seq: DataFrame) -> DataFrame:
    """Local and remote status side by side per local uid; duplicated keys do not multiply."""
    local = _single_rows(
        local_seq.select("seqprep", F.col("s_well").alias("local_well"), *[F.col(f"{t}_complete").alias(f"local_{t}") for t in TOOLS]),
        "seqprep",
        ["local_well", *[f"local_{t}" for t in TOOLS]],
    ).withColumnRenamed("_rows", "_local_rows")
    remote = _single_rows(
        remote_seq.select(
            "uid", "id", F.col("s_well").alias("remote_well"), *[F.coalesce(F.col(t), F.lit(False)).alias(f"remote_{t}") for t in TOOLS]
        ),
        "uid",
        ["id", "remote_well", *[f"remote_{t}" for t in TOOLS]],
    ).withColumnRenamed("_rows", "_remote_rows")
    return local.join(remote, "uid", "left")


def _violation() -> Column:
    """What is wrong with a local uid, NULL when nothing is."""
    return (
        F.when(F.col("_remote_rows").isNull(), "absent remotely")
        .when((F.col("_local_rows") > 1) | (F.col("_remote_rows") > 1), "multiple entries")
        .when(F.col("remote_well").isNotNull() & ~F.col("remote_well").eqNullSafe(F.col("local_well")), "well mismatch")
    )


@dataclass(frozen=True)
class Reconciliation:
    """Patches for the remote records, what stands against them and what changes, all lazy."""

    patches: DataFrame
    violations: DataFrame
    alerts: DataFrame

    def checked(self) -> "Reconciliation":
        """Itself, or an error when any violation exists."""
        if not self.violations.isEmpty():
            raise ReconcileError("some local samples cannot be merged; see violations")
        return self


def reconcile(local_seq: DataFrame, remote_seq: DataFrame) -> Reconciliation:
    """Merge local completion into remote status.

    A merged flag is remote OR local; the well is the local one. A patch is made for every uid
    without a violation that has a true merged flag or no remote well, changed or not. Any
    violation should stop an update: call ``checked()`` before acting on the patches.
    """
    paired = _paired(local_seq, remote_seq).withColumn("violation", _violation())
    sound = paired.filter(F.col("violation").isNull())
    merged = {t: F.col(f"remote_{t}") | F.col(f"local_{t}") for t in TOOLS}
    patches = (
        sound.withColumns(merged)
        .filter(F.col("kneaddata") | F.col("metaphlan") | F.col("humann") | F.col("remote_well").isNull())
        .select("id", "uid", F.col("local_well").alias("s_well"), *TOOLS)
    )
    cases = [
        F.when(F.col(f"local_{t}") & ~F.col(f"remote_{t}"), F.struct(F.lit(t).alias("tool"), F.lit("planned update").alias("alert")))
        .when(F.col(f"remote_{t}") & ~F.col(f"local_{t}"), F.struct(F.lit(t).alias("tool"), F.lit("missing locally").alias("alert")))
        for t in TOOLS
    ]
    alerts = (
        sound.select("uid", F.explode(F.array_compact(F.array(*cases))).alias("a")).select("uid", "a.tool", "a.alert")
    )
    return Reconciliation(
        patches=patches, violations=paired.filter(F.col("violation").isNotNull()).select("uid", "violation"), alerts=alerts
    )


def three_way_status(remote_seq: DataFrame, local_seq: DataFrame, store_seq: DataFrame) -> DataFrame:
    """Samples whose remote, local and object-store completion are not all equal, per tool.

    Rows without sample or well do not take part; a sample absent locally or in the store counts
    as incomplete there.
    """

    def side(df: DataFrame, key: str, flags: dict[str, str]) -> DataFrame:
        return df.filter(F.col(key).isNotNull() & F.col("s_well").isNotNull()).select(
            F.col(key).alias("seqprep"), "s_well", *[F.col(c).alias(name) for name, c in flags.items()]
        )

    joined = (
        side(remote_seq, "uid", {f"rem_{t}": t for t in TOOLS})
        .join(side(local_seq, "seqprep", {f"loc_{t}": f"{t}_complete" for t in TOOLS}), ["seqprep", "s_well"], "left")
        .join(side(store_seq, "seqprep", {f"sto_{t}": f"{t}_complete" for t in TOOLS}), ["seqprep", "s_well"], "left")
    )

    def unequal(tool: str) -> Column:
        values = [F.coalesce(F.col(f"{s}_{tool}"), F.lit(False)) for s in ("rem", "loc", "sto")]
        return F.greatest(*values) != F.least(*values)

    checks = {f"check_{t}": unequal(t) for t in TOOLS}
    return (
        joined.withColumns(checks)
        .filter("check_kneaddata OR check_metaphlan OR check_humann")
        .select("seqprep", "s_well", *checks)
    )


# --- old-version sets ---------------------------------------------------------------------


def in_old_version_set(files: DataFrame, old_ids: DataFrame, column: str = "biospecimen", id_column: str = "biospecimen") -> DataFrame:
    """Files whose id, or whose id with ``_`` and ``-`` exchanged, is in the set; ids of kind FE left out.

    The set carries both spellings, so this stays one semi-join on equality.
    """
    spellings = (
        old_ids.select(F.explode(F.array(F.col(id_column), swap_separators(F.col(id_column)))).alias("_id"))
        .filter(F.col("_id").isNotNull())
        .distinct()
    )
    kept = files.filter(~F.startswith(F.col(column), F.lit("FE")))
    return matched(kept, spellings.withColumnRenamed("_id", column), column, "left_semi")


def attach_samples(files: DataFrame, listing: DataFrame) -> DataFrame:
    """The sample of each distinct file by (biospecimen, well); files without one are dropped.

    Where the listing has several samples for a key, the smallest is taken.
    """
    samples = (
        listing.filter(F.col("biospecimen").isNotNull() & F.col("s_well").isNotNull())
        .groupBy("biospecimen", "s_well")
        .agg(F.min("sample").alias("sample"))
    )
    # a file listed twice is found twice and becomes one row below
    wanted = files.select("biospecimen", "s_well", "file")
    attached = matched(wanted, samples, ["biospecimen", "s_well"], both_grow=True).filter(F.col("sample").isNotNull())
    one = attached.groupBy("file").agg(F.min(F.struct("biospecimen", "s_well", "sample")).alias("r"))
    return one.select("file", "r.*")
