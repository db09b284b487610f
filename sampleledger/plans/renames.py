"""Rename, move and copy plans.

Every plan is made against a snapshot of the listing: whether a target exists is asked of the
listing, not of the plan's own earlier actions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleledger.fixed import OLD_NAME_PATTERN, OUTPUT_PREFIX_PATTERN
from sampleledger.functions.names import database_name, is_sequencing_name, replace_id
from sampleledger.operators.joins import absent, attach, contained, distinct_keys, matched, settled
from sampleledger.operators.reports import old_name_files


def parse_old_names(listing: DataFrame, pattern: str = OLD_NAME_PATTERN) -> DataFrame:
    """Files named ``<old id>_<well>_…`` with ``oldname`` and ``s_well``."""
    whole = rf"^({pattern})_(S\d+)_"
    columns = {
        "oldname": F.nullif(F.regexp_extract("file", whole, 1), F.lit("")),
        "s_well": F.nullif(F.regexp_extract("file", whole, 2), F.lit("")),
    }
    # settled: the names are parsed once, not again in every condition on a part
    return settled(listing.withColumns(columns)).filter(F.col("oldname").isNotNull())


def renamed_by_map(listing: DataFrame, names: DataFrame, pattern: str = OLD_NAME_PATTERN) -> DataFrame:
    """Files with an old name that has a new one: ``oldname, newname, s_well, path, newpath``.

    ``names`` is ``(oldname, newname)`` with one row per old name, see :func:`one_name_each`.
    """
    files = parse_old_names(listing, pattern).select("oldname", "s_well", "dir", "file", "path")
    newfile = replace_id(F.col("file"), F.col("oldname"), F.col("newname"))
    return (
        matched(files, names, "oldname", both_grow=True)
        .withColumn("newpath", F.concat("dir", F.lit("/"), newfile))
        .select("oldname", "newname", "s_well", "path", "newpath")
    )


def unnamed_files(listing: DataFrame, names: DataFrame, pattern: str = OLD_NAME_PATTERN) -> DataFrame:
    """Files with an old name that has no new one."""
    files = parse_old_names(listing, pattern).select("oldname", "path")
    return matched(files, names.select("oldname"), "oldname", "left_anti")


def one_name_each(rename_map: DataFrame) -> DataFrame:
    """``(oldname, newname)`` with the smallest prep where a biospecimen has several, so that the
    answer does not depend on row order."""
    return rename_map.groupBy("oldname").agg(F.min("seqname").alias("newname"))


def _first_takes(plan: DataFrame, act: str) -> DataFrame:
    """Of several files that would ``act`` on one ``newpath`` the first by path does; the others
    become ``clash``, for each would overwrite the one before. The first is found by grouping, and
    only targets that several paths want go back to the files."""
    plan = settled(plan)
    wanted = plan.filter(F.col("action") == act).groupBy("newpath").agg(F.min("path").alias("_first"), F.max("path").alias("_last"))
    first = wanted.filter("_first <> _last").drop("_last")
    marked = attach(plan, first, "newpath", spread_by=["path"], both_grow=True)
    late = (F.col("action") == act) & (F.col("path") != F.col("_first"))
    return marked.withColumn("action", F.when(late, "clash").otherwise(F.col("action"))).drop("_first")


def _takes_free_path(plan: DataFrame, listing: DataFrame, act: str, taken: str) -> DataFrame:
    """``act`` becomes ``taken`` where the ``newpath`` is in the listing, else ``clash`` for all but
    the first path that wants it. A target is decided once, and only targets that are taken or that
    several paths want go back to the files."""
    plan = settled(plan)
    have = listing.select(F.col("path").alias("newpath"), F.lit(None).cast("string").alias("path"), F.lit(True).alias("_there"))
    wanted = plan.filter(F.col("action") == act).select("newpath", "path", F.lit(False).alias("_there"))
    targets = wanted.union(have).filter("newpath IS NOT NULL").groupBy("newpath").agg(
        F.min("path").alias("_first"), F.max("path").alias("_last"),
        F.bool_or("_there").alias("_exists"), F.bool_and("_there").alias("_unwanted"),
    )
    held = targets.filter("NOT _unwanted AND (_exists OR _first <> _last)").select("newpath", "_first", "_exists")
    marked = attach(plan, held, "newpath", spread_by=["path"], both_grow=True)
    action = F.when(F.col("_exists"), taken).when(F.col("path") != F.col("_first"), "clash").otherwise(F.col("action"))
    return marked.withColumn("action", F.when(F.col("action") == act, action).otherwise(F.col("action"))).drop("_first", "_exists")


def rename_unambiguous(renamed: DataFrame, listing: DataFrame) -> DataFrame:
    """Rename plan: ``ambiguous`` (old names whose files have more than one well), ``exists``,
    ``clash`` or ``rename``.

    ``renamed`` is from :func:`renamed_by_map`, ``listing`` what is there already. The wells are
    counted on distinct (name, well) rows.
    """
    renamed = settled(renamed)
    several = (
        renamed.select("oldname", "s_well").distinct().groupBy("oldname").agg((F.count(F.lit(1)) > 1).alias("_several"))
    )
    plan = matched(renamed, several, "oldname", both_grow=True).select(
        "path", "newpath", "oldname", "s_well", F.when(F.col("_several"), "ambiguous").otherwise("rename").alias("action")
    )
    return _takes_free_path(plan, listing, "rename", "exists").select("path", "newpath", "oldname", "s_well", "action")


def _with_target(resolved: DataFrame) -> DataFrame:
    return resolved.withColumn("newfile", replace_id(F.col("file"), F.col("sample"), F.col("seqprep")))


def _target_exists(plan: DataFrame, names: DataFrame) -> DataFrame:
    have = distinct_keys(names, "file").withColumn("_exists", F.lit(True))
    return attach(plan, have, {"newfile": "file"}, spread_by=["path"], both_grow=True).withColumn(
        "_exists", F.coalesce("_exists", F.lit(False))
    )


def _moves(resolved: DataFrame, existing: DataFrame, newdir: Column) -> DataFrame:
    targets = existing.filter(is_sequencing_name(F.col("file")))
    plan = _target_exists(_with_target(old_name_files(resolved)), targets)
    action = (
        F.when(F.col("seqprep").isNull(), "unresolved").when(F.col("_exists"), "exists").otherwise("move")
    )
    moves = plan.select("path", F.concat(newdir, "newfile").alias("newpath"), action.alias("action"))
    return _first_takes(moves, "move").select("path", "newpath", "action")


def move_old_names(resolved: DataFrame, existing: DataFrame) -> DataFrame:
    """Move plan for files under old names: ``unresolved``, ``exists``, ``clash`` or ``move``.

    ``resolved`` is from :func:`sampleledger.operators.reconcile.resolve_samples`; ``existing`` is
    the listing whose sequencing-named files count as existing.
    """
    return _moves(resolved, existing, F.concat("dir", F.lit("/")))


def move_across(
    resolved: DataFrame, existing: DataFrame, target_prefix: str, prefix_pattern: str = OUTPUT_PREFIX_PATTERN
) -> DataFrame:
    """:func:`move_old_names` into another bucket: everything through the last output folder of
    the directory becomes ``target_prefix``."""
    return _moves(resolved, existing, F.regexp_replace(F.concat("dir", F.lit("/")), prefix_pattern, target_prefix))


def replace_or_move(resolved: DataFrame, existing: DataFrame, id_column: str = "seqid") -> DataFrame:
    """Files with a resolved id: the old file is removed where the target exists, else moved; of
    several with one target the first is moved and the others ``clash``."""
    chosen = resolved.filter(F.col(id_column).isNotNull()).withColumn(
        "newfile", replace_id(F.col("file"), F.col("sample"), F.col(id_column))
    )
    plan = _target_exists(chosen, existing).select(
        "path",
        F.concat("dir", F.lit("/"), "newfile").alias("newpath"),
        F.when(F.col("_exists"), "remove").otherwise("move").alias("action"),
    )
    return _first_takes(plan, "move").select("path", "newpath", "action")


def rename_substring(files: DataFrame, find: str, replacement: str) -> DataFrame:
    """Rename plan for every file whose name holds ``find``: ``rename``, ``exists`` or ``clash``.

    Within a directory, a target that exists is left alone, and of several files with one target
    the first by name gets it. The first is found by grouping, not by ordering a group in one task.
    """
    changed = (
        files.filter(F.contains(F.col("file"), F.lit(find)))
        .select("dir", "file", "path", F.replace(F.col("file"), F.lit(find), F.lit(replacement)).alias("newfile"))
        .filter(F.col("newfile") != F.col("file"))
        .withColumn("newpath", F.concat("dir", F.lit("/"), "newfile"))
    )
    first = changed.groupBy("newpath").agg(F.min("file").alias("_first"))
    have = files.select(F.col("path").alias("newpath"), F.lit(True).alias("_exists")).distinct()
    action = (
        F.when(F.col("_exists"), "exists").when(F.col("file") == F.col("_first"), "rename").otherwise("clash")
    )
    # Targets are decided first, one row each; the files join that once.
    targets = first.join(have, "newpath", "left")
    return matched(changed, targets, "newpath").select("path", "newpath", action.alias("action"))


def rename_by_mapping(files: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rename plan by an ``(old_id, new_id)`` mapping for files whose name holds an old id.

    One mapping applies per file, the one with the longest old id (then the first); ``n_mappings``
    tells how many apply. Action ``conflict`` marks targets that exist, ``clash`` all but the first
    of several files with one target. A path that is listed twice counts once.
    """
    renames = mapping.groupBy("old_id").agg(F.min("new_id").alias("new_id"))
    # names alone are searched, each once; the files join what was found
    hits = contained(files.select("file").distinct(), "file", renames, "old_id")
    rank = F.struct(F.length("old_id").alias("n"), "old_id")
    chosen = hits.groupBy("file").agg(
        F.max_by(F.struct("old_id", "new_id"), rank).alias("m"),
        F.count(F.lit(1)).alias("n_mappings"),
    )
    targeted = matched(files.select("dir", "file", "path").distinct(), chosen, "file", both_grow=True).select(
        "path", "n_mappings", "m.old_id", "m.new_id",
        F.concat("dir", F.lit("/"), replace_id(F.col("file"), F.col("m.old_id"), F.col("m.new_id"))).alias("newpath"),
    )
    columns = ["path", "newpath", "old_id", "new_id", "n_mappings"]
    plan = targeted.withColumn("action", F.lit("rename"))
    return _takes_free_path(plan, files, "rename", "conflict").select(*columns, "action")


def unmatched_ids(files: DataFrame, mapping: DataFrame) -> DataFrame:
    """Old ids of a mapping that no file name holds."""
    return absent(mapping.select("old_id").distinct(), "old_id", files, "file")


def insert_database(files: DataFrame, first_lines: DataFrame) -> DataFrame:
    """Rename plan that puts the database name after the sample prefix of a profile.

    Each profile (``dir, file, first_line``) gives a prefix, its name before ``_profile.tsv``, for
    all files of its directory that start with it. The longest prefix wins; ``tied`` marks files
    for which it comes with several databases. Names that already hold the database stay.
    """
    profiles = (
        first_lines.filter(F.endswith(F.col("file"), F.lit("_profile.tsv")))
        .select(
            F.concat("dir", F.lit("/"), F.regexp_replace("file", r"_profile\.tsv$", "")).alias("prefix"),
            database_name(F.col("first_line")).alias("db"),
        )
        .filter(F.col("db").isNotNull())
        .groupBy("prefix")
        .agg(F.min("db").alias("db"), (F.min("db") != F.max("db")).alias("tied"))
    )
    hits = contained(files.select("path"), "path", profiles, "prefix", anchored=True)
    best = hits.groupBy("path").agg(
        F.max_by(F.struct("prefix", "db", "tied"), F.length("prefix")).alias("m")
    ).select("path", "m.*")
    rest = F.substring("path", F.length("prefix") + 1, F.length("path"))
    return best.filter(~F.contains(F.col("path"), F.concat(F.lit("_"), "db"))).select(
        "path", F.concat("prefix", F.lit("_"), "db", rest).alias("newpath"), "db", "tied"
    )


def copy_page(files: DataFrame, source: str, target: str, first: int, last: int, order: str = "file") -> DataFrame:
    """Copy plan for rows ``first`` to ``last`` (from 1) by name, to another prefix and name."""
    page = files.select(order, "newfile").orderBy(order).offset(first - 1).limit(last - first + 1)
    return page.select(
        F.concat(F.lit(source), F.col(order)).alias("path"), F.concat(F.lit(target), "newfile").alias("newpath")
    )


def rename_pairs(listing: DataFrame, pairs: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Rename plan for given ``(sample, s_well, seqprep)`` rows, exact on both, at any depth:
    ``exists``, ``clash`` or ``rename``.

    ``listing`` is parsed; its ``seqprep`` is the sample of the name. ``existing`` is what is there
    already, the listing itself when not given; it need not be parsed.
    """
    files = listing.select(F.col("seqprep").alias("sample"), "s_well", "path")
    newpath = replace_id(F.col("path"), F.col("sample"), F.col("seqprep"))
    named = matched(files, pairs, ["sample", "s_well"], both_grow=True).select("path", newpath.alias("newpath"), "seqprep")
    plan = named.withColumn("action", F.lit("rename"))
    there = listing if existing is None else existing
    return _takes_free_path(plan, there, "rename", "exists").select("path", "newpath", "seqprep", "action")
