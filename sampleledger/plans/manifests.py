"""Per-sample manifests over one listing and a whole sample list."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleledger.fixed import (
    CLEANUP_WORDS,
    EXPECTED_ARTEFACTS,
    FASTQ_PATTERN,
    FUNCTION_VERSION_TAG,
    OLDER_STAGE_INPUTS,
    OLDER_STAGE_MARKERS,
    PROFILE_DATABASE,
    STAGE_INPUTS,
    STAGE_MARKERS,
)
from sampleledger.operators.joins import contained

RAW_ROLES = ("paired_1", "paired_2", "unpaired")
CLEANED_ROLES = ("paired_1", "paired_2", "unmatched_1", "unmatched_2", "single")


def _per_sample(candidates: DataFrame, samples: DataFrame, roles: Sequence[str]) -> DataFrame:
    """Wide manifest from ``(sample, role, path)``: a path and a count per role, for every sample."""
    found = candidates.groupBy("sample").agg(
        *[F.max(F.when(F.col("role") == r, F.col("path"))).alias(r) for r in roles],
        *[F.count_if(F.col("role") == r).alias(f"n_{r}") for r in roles],
    )
    counts = {f"n_{r}": F.coalesce(F.col(f"n_{r}"), F.lit(0)) for r in roles}
    return samples.select("sample").distinct().join(found, "sample", "left").withColumns(counts)


def _status(roles: Sequence[str], none_is_error: bool) -> Column:
    repeated = F.greatest(*[F.col(f"n_{r}") for r in roles]) > 1
    one_mate = F.col("paired_1").isNull() != F.col("paired_2").isNull()
    status = F.when(repeated, "duplicate").when(one_mate, "single_mate")
    if none_is_error:
        status = status.when(F.coalesce(*roles).isNull(), "none")
    return status.otherwise("ok")


def raw_inputs(files: DataFrame, samples: DataFrame) -> DataFrame:
    """Raw reads of every sample: mates and orphan, with ``status`` ok, duplicate, single_mate or none.

    A name gives its sample by what precedes the role and the ending, so ``SRR1`` does not take the
    files of ``SRR10``. ``X_1.fastq`` is mate 1 of ``X`` and the orphan of a sample called ``X_1``.
    """
    stem = F.regexp_replace("file", FASTQ_PATTERN, "")
    mate = F.substring(stem, -2, 2)
    head = F.left(stem, F.length(stem) - 2)

    def role(sample: Column, name: str) -> Column:
        return F.struct(sample.alias("sample"), F.lit(name).alias("role"))

    roles = F.array_compact(
        F.array(
            role(stem, "unpaired"),
            F.when(mate == "_1", role(head, "paired_1")),
            F.when(mate == "_2", role(head, "paired_2")),
        )
    )
    candidates = (
        files.filter(F.rlike(F.col("file"), F.lit(FASTQ_PATTERN)))
        .select("path", F.explode(roles).alias("r"))
        .select("path", "r.sample", "r.role")
    )
    return _per_sample(candidates, samples, RAW_ROLES).withColumn("status", _status(RAW_ROLES, True))


def pairing(manifest: DataFrame) -> DataFrame:
    """``has_pair`` and ``has_orphan`` of a raw manifest."""
    return manifest.withColumns(
        {
            "has_pair": F.col("paired_1").isNotNull() & F.col("paired_2").isNotNull(),
            "has_orphan": F.col("unpaired").isNotNull(),
        }
    )


def cleaned_outputs(files: DataFrame, samples: DataFrame) -> DataFrame:
    """Cleaned reads of every sample in five roles; finding none is not an error here.

    A name gives a sample before each ``_kneaddata`` in it, mostly one. Case is ignored but in the
    sample and in the words that exclude a single-run file.
    """
    name = F.lower("file")
    at = F.filter(
        F.sequence(F.lit(1), F.length("file")), lambda p: F.substring(name, p, F.lit(10)) == "_kneaddata"
    )
    heads = F.transform(
        at, lambda p: F.struct(F.left(F.col("file"), p - 1).alias("sample"), F.substring(name, p + 10, F.length(name)).alias("rest"))
    )
    rest = F.col("h.rest")
    ending = r"\.(fastq|fq)(\.gz)?$"
    matched = {r: F.rlike(rest, F.lit(rf"{r}.*{ending}")) for r in CLEANED_ROLES[:4]}
    matched["single"] = F.rlike(rest, F.lit(rf"_single.*{ending}")) & ~F.rlike(
        F.col("file"), F.lit(r"(paired|unmatched)_[12]")
    )
    roles = F.array_compact(F.array(*[F.when(hit, F.lit(r)) for r, hit in matched.items()]))
    candidates = (
        files.filter(F.rlike(F.col("file"), F.lit(FASTQ_PATTERN)) & F.contains(name, F.lit("_kneaddata")))
        .select("path", "file", F.explode(heads).alias("h"))
        .select("path", F.col("h.sample").alias("sample"), F.explode(roles).alias("role"))
    )
    return _per_sample(candidates, samples, CLEANED_ROLES).withColumn("status", _status(CLEANED_ROLES, False))


def concat_plan(cleaned: DataFrame, existing: DataFrame, target_dir: str) -> DataFrame:
    """Concatenation plan: the cleaned files present, in role order, into one joined file.

    Action ``error`` when the manifest is not ok or has no file, ``skip`` when the target exists
    (a ``path`` of ``existing``), else ``concat``.
    """
    target = F.concat(F.lit(target_dir.rstrip("/") + "/"), "sample", F.lit(".joined.fastq.gz"))
    inputs = F.array_compact(F.array(*CLEANED_ROLES))
    have = existing.select(F.col("path").alias("target"), F.lit(True).alias("_exists")).distinct()
    action = (
        F.when((F.col("status") != "ok") | (F.size("inputs") == 0), "error").when(F.col("_exists"), "skip").otherwise("concat")
    )
    return (
        cleaned.withColumns({"target": target, "inputs": inputs})
        .join(have, "target", "left")
        .select("sample", "inputs", "target", action.alias("action"))
    )


def cleanup_plan(files: DataFrame, samples: DataFrame, words: Sequence[str] = CLEANUP_WORDS) -> DataFrame:
    """Intermediate files of the samples' cleaning runs, each once.

    A file belongs here when its name holds ``<sample>_kneaddata`` and any of the words.
    """
    named = files.filter(F.rlike(F.col("file"), F.lit("|".join(words))) & F.contains(F.col("file"), F.lit("_kneaddata")))
    prefixes = samples.select(F.concat("sample", F.lit("_kneaddata")).alias("prefix")).distinct()
    return contained(named.select("path", "file"), "file", prefixes, "prefix").select("path").distinct()


def compression_plan(files: DataFrame, samples: DataFrame) -> DataFrame:
    """Uncompressed reads: names that hold a sample and, some character later, ``fastq``."""
    named = files.filter(F.contains(F.col("file"), F.lit("fastq")) & ~F.endswith(F.col("file"), F.lit(".gz")))
    hits = contained(named.select("path", "file"), "file", samples.select("sample").distinct(), "sample")
    # The first place of the sample leaves the most room behind it.
    behind = F.substring("file", F.instr("file", F.col("sample")) + F.length("sample"), F.length("file"))
    return hits.filter(F.rlike(behind, F.lit(".fastq"))).select("path").distinct()


def matching_files(files: DataFrame, samples: DataFrame) -> DataFrame:
    """Per sample, how many file names hold its id."""
    wanted = samples.select("sample").distinct()
    counted = contained(files.select("file"), "file", wanted, "sample").groupBy("sample").agg(
        F.count(F.lit(1)).alias("n_files")
    )
    return wanted.join(counted, "sample", "left").select("sample", F.coalesce("n_files", F.lit(0)).alias("n_files"))


def input_pair_errors(files: DataFrame, samples: DataFrame) -> DataFrame:
    """Samples that do not have exactly two input files."""
    return matching_files(files, samples).filter("n_files <> 2")


# --- stages -------------------------------------------------------------------------------


def _endings(markers: Mapping[str, Sequence[str]], tag: str = "") -> list[tuple[str, str]]:
    return [
        (f"marker_{k}_{i}", name.format(sample="", tag=tag))
        for k, names in enumerate(markers.values())
        for i, name in enumerate(names)
    ]


def _per_database(markers: Mapping[str, Sequence[str]], dbs: Sequence[str]) -> dict[str, list[str]]:
    """The markers with every stage that names a database once per database, as ``stage:database``
    where there are several."""
    out: dict[str, list[str]] = {}
    for stage, names in markers.items():
        if not any("{db}" in name for name in names):
            out[stage] = list(names)
            continue
        for db in dbs:
            out[stage if len(dbs) == 1 else f"{stage}:{db}"] = [name.replace("{db}", db) for name in names]
    return out


def _markers_found(files: DataFrame, samples: DataFrame, endings: list[tuple[str, str]]) -> DataFrame:
    """Per sample, which marker files exist.

    A marker is a sample followed by a fixed ending, so a name tells its sample: the listing is
    filtered by ending and grouped once, for all stages.
    """
    name = F.col("file")
    cases = [
        F.when(
            F.endswith(name, F.lit(ending)),
            F.struct(F.left(name, F.length(name) - len(ending)).alias("sample"), F.lit(marker).alias("marker")),
        )
        for marker, ending in endings
    ]
    any_ending = F.lit(False)
    for _, ending in endings:
        any_ending = any_ending | F.endswith(name, F.lit(ending))
    found = (
        files.filter(any_ending)
        .select(F.explode(F.array_compact(F.array(*cases))).alias("m"))
        .select("m.sample", "m.marker")
        .groupBy("sample")
        .agg(*[F.bool_or(F.col("marker") == m).alias(m) for m, _ in endings])
    )
    flags = {m: F.coalesce(F.col(m), F.lit(False)) for m, _ in endings}
    return samples.select("sample").distinct().join(found, "sample", "left").withColumns(flags)


def _long(wide: DataFrame, status: Mapping[str, Column]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(s).alias("stage"), c.alias("status")) for s, c in status.items()])
    return wide.select("sample", F.explode(rows).alias("r")).select("sample", "r.stage", "r.status")


def _done(markers: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    done = {}
    for k, (stage, names) in enumerate(markers.items()):
        first, *rest = [F.col(f"marker_{k}_{i}") for i in range(len(names))]
        for c in rest:
            first = first & c
        done[stage] = first
    return done


def stage_plan(
    files: DataFrame,
    samples: DataFrame,
    raw: DataFrame | None = None,
    dbs: Sequence[str] = (PROFILE_DATABASE,),
    tag: str = FUNCTION_VERSION_TAG,
) -> DataFrame:
    """``(sample, stage, status)`` of the current pipeline.

    A stage is done when its marker files exist. Samples are profiled with each of ``dbs``; of
    several, the stages that name a database come once for each, as ``stage:database``. The joined
    file is deleted at the end of a run, so concatenation is pending only while a profile of any
    database or gene families, which read it, are. Regrouping
    has no marker: it runs every time. With a raw manifest, cleaning of reads that a sample does
    not have is ``not_needed``.
    """
    wide, done, needed = _current_stages(files, samples, raw, dbs, tag)
    status = {stage: F.when(flag, "done").otherwise("pending") for stage, flag in done.items()}
    for stage, flag in needed.items():
        status[stage] = F.when(~flag, "not_needed").otherwise(status[stage])
    return _long(wide, status)


def _current_stages(
    files: DataFrame, samples: DataFrame, raw: DataFrame | None, dbs: Sequence[str], tag: str
) -> tuple[DataFrame, dict[str, Column], dict[str, Column]]:
    """Marker columns per sample, whether each stage is done, and whether cleaning is needed.

    With a raw manifest ``raw_status`` is its status, NULL for a sample it does not have.
    """
    markers = _per_database(STAGE_MARKERS, dbs)
    wide = _markers_found(files, samples, _endings(markers, tag))
    done = _done(markers)
    readers = done["genefamilies"]
    for stage, flag in done.items():
        if stage.split(":")[0] == "relab_profile":
            readers = readers & flag
    done["concat"] = done["concat"] | readers
    done["regroup_rename"] = F.lit(False)
    if raw is None:
        return wide, done, {}
    reads = pairing(raw).select("sample", "has_pair", "has_orphan", F.col("status").alias("raw_status"))
    needed = {"clean_paired": "has_pair", "clean_single": "has_orphan"}
    return wide.join(reads, "sample", "left"), done, {s: F.coalesce(c, F.lit(False)) for s, c in needed.items()}


def _inputs_per_database(stages: Sequence[str], dbs: Sequence[str]) -> dict[str, list[str]]:
    """What each of ``stages`` reads. A stage of a database reads what the same database gave; any
    other reads the profile of the first."""
    out = {}
    for stage in stages:
        name, _, db = stage.partition(":")
        out[stage] = [
            source if source in stages or source == "raw" else f"{source}:{db or dbs[0]}" for source in STAGE_INPUTS[name]
        ]
    return out


def _with_states(
    wide: DataFrame, done: Mapping[str, Column], unneeded: Mapping[str, Column], raw_there: Column, inputs: Mapping[str, Sequence[str]]
) -> DataFrame:
    """``(sample, stage, state, missing)``. What a sample has is a set of bits, raw reads first and then
    the stages in order; what a stage lacks is the closure of its inputs over all that is not there."""
    stages = list(inputs)
    bit = {name: F.lit(1 << k).cast("long") for k, name in enumerate(["raw", *stages])}
    skipped = {s: unneeded.get(s, F.lit(False)) & raw_there for s in stages}
    have = F.when(raw_there, bit["raw"]).otherwise(0)
    for stage in stages:
        have = have.bitwiseOR(F.when(done[stage] | skipped[stage], bit[stage]).otherwise(0))
    wide = wide.withColumn("_have", have)
    lacks: dict[str, Column] = {"raw": F.lit(0).cast("long")}
    for k, stage in enumerate(stages):
        lack = F.lit(0).cast("long")
        for source in inputs[stage]:
            there = F.col("_have").bitwiseAND(bit[source]) != 0
            lack = lack.bitwiseOR(F.when(there, F.lit(0)).otherwise(bit[source].bitwiseOR(lacks[source])))
        wide, lacks[stage] = wide.withColumn(f"_lack_{k}", lack), F.col(f"_lack_{k}")
    rows = []
    for stage in stages:
        state = F.when(skipped[stage], "not_needed").when(done[stage], "done").when(lacks[stage] == 0, "ready").otherwise("blocked")
        first = F.coalesce(*[F.when(lacks[stage].bitwiseAND(b) != 0, name) for name, b in bit.items()])
        rows.append(F.struct(F.lit(stage).alias("stage"), state.alias("state"), F.when(state == "blocked", first).alias("missing")))
    return wide.select("sample", F.explode(F.array(*rows)).alias("r")).select("sample", "r.*")


def ready_stages(
    files: DataFrame,
    samples: DataFrame,
    raw: DataFrame | None = None,
    dbs: Sequence[str] = (PROFILE_DATABASE,),
    tag: str = FUNCTION_VERSION_TAG,
) -> DataFrame:
    """``(sample, stage, state, missing)``: what can run now.

    A stage that is not done is ``ready`` when all that it reads is there, else ``blocked``, and
    ``missing`` is the first thing to make, back along the stages that are not done: a stage that
    is ready itself, or ``raw``. With a raw manifest raw reads are there when its status is ok, and
    cleaning of reads that such a sample does not have is ``not_needed``; without one raw reads
    count as there. Everything comes from the one grouping of :func:`stage_plan`.
    """
    wide, done, needed = _current_stages(files, samples, raw, dbs, tag)
    there = F.lit(True) if raw is None else F.coalesce(F.col("raw_status") == "ok", F.lit(False))
    ordered = [s for name in STAGE_INPUTS for s in done if s.split(":")[0] == name]
    return _with_states(wide, done, {s: ~c for s, c in needed.items()}, there, _inputs_per_database(ordered, dbs))


def older_ready_stages(files: DataFrame, samples: DataFrame) -> DataFrame:
    """:func:`ready_stages` of the older pipeline, raw reads taken as there."""
    wide = _markers_found(files, samples, _endings(OLDER_STAGE_MARKERS))
    return _with_states(wide, _done(OLDER_STAGE_MARKERS), {}, F.lit(True), OLDER_STAGE_INPUTS)


def older_stage_plan(files: DataFrame, samples: DataFrame) -> DataFrame:
    """``(sample, stage, status)`` of the older pipeline: one marker file per stage."""
    wide = _markers_found(files, samples, _endings(OLDER_STAGE_MARKERS))
    return _long(wide, {s: F.when(d, "done").otherwise("pending") for s, d in _done(OLDER_STAGE_MARKERS).items()})


def older_join_inputs(files: DataFrame, samples: DataFrame, profiles: DataFrame) -> DataFrame:
    """``(sample, path)`` of the cleaned reads that the older pipeline joins: names that hold the
    sample and a paired or unmatched mate. Samples whose profile stands in ``profiles`` have none."""
    done = profiles.filter(F.endswith("file", F.lit("_profile.tsv"))).select(F.regexp_replace("file", "_profile\\.tsv$", "").alias("sample"))
    todo = samples.select("sample").distinct().join(done.distinct(), "sample", "left_anti")
    reads = files.filter(F.rlike("file", F.lit("(?:paired|unmatched)_[12]"))).select("file", "path")
    return contained(reads, "file", todo, "sample").select("sample", "path").distinct()


def expected_artefacts(
    samples: DataFrame, databases: Sequence[str] = (PROFILE_DATABASE,), tags: Sequence[str] = (FUNCTION_VERSION_TAG,)
) -> DataFrame:
    """Names of the artefacts each sample should have, per database and version tag."""
    rows = []
    for kind, template in EXPECTED_ARTEFACTS.items():
        versions = databases if "{db}" in template else tags
        for version in versions:
            ending = template.format(sample="", db=version, tag=version)
            rows.append(
                F.struct(
                    F.lit(kind).alias("kind"), F.lit(version).alias("version"), F.concat("sample", F.lit(ending)).alias("file")
                )
            )
    return samples.select("sample", F.explode(F.array(*rows)).alias("r")).select("sample", "r.*")
