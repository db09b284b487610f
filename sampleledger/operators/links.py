"""Links between records.

A link is an edge ``(parent_id, pos, child_id)``. Edges come from the link array of the parent
(:func:`edges`) or, better where a parent may have very many children, from the short back-reference
array of the child (:func:`back_edges`): no parent's children are ever gathered into one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleledger.operators.joins import attach, matched


class LinkError(ValueError):
    """Link cells that strict resolution does not allow."""


def edges(records: DataFrame, field: str, key: str = "id") -> DataFrame:
    """Edges of a link array; records without it have none."""
    return records.select(F.col(key).alias("parent_id"), F.posexplode(field).alias("pos", "child_id"))


def back_edges(records: DataFrame, field: str, key: str = "id") -> DataFrame:
    """Edges from each child's back-reference array."""
    return records.select(F.explode(field).alias("parent_id"), F.col(key).alias("child_id"))


# --- resolving the links of a column ------------------------------------------------------


def as_links(df: DataFrame, column: str) -> Column:
    """The link cell as an array: a plain id is an array of one, a missing id stays missing."""
    if dict(df.dtypes)[column].startswith("array"):
        return F.col(column)
    return F.when(F.col(column).isNotNull(), F.array(column))


def multiple_links(df: DataFrame, column: str) -> DataFrame:
    """Rows whose link array does not have exactly one element (an empty one too)."""
    return df.filter(F.size(as_links(df, column)) != 1)


def unknown_links(links: DataFrame, targets: DataFrame, child: str = "child_id") -> DataFrame:
    """Edges to records that do not exist."""
    return matched(
        links.filter(F.col(child).isNotNull()), targets.select(F.col("id").alias(child)), child, "left_anti"
    )


def _resolve(df: DataFrame, link: Column, targets: DataFrame, spread_by: list[str] | None) -> DataFrame:
    return attach(df.withColumn("_link", link), targets, {"_link": "id"}, spread_by=spread_by).drop("_link")


def resolve_strict(
    df: DataFrame, column: str, targets: DataFrame, spread_by: list[str] | None = None, check: bool = False
) -> DataFrame:
    """Join the record a one-element link, or a plain id, names; a missing link stays missing.

    ``targets`` has ``id`` and the columns to add. With ``check``, cells with other than one link
    and links to no record are errors; otherwise see :func:`multiple_links`, :func:`unknown_links`.
    """
    if check:
        if not multiple_links(df, column).isEmpty():
            raise LinkError(f"some cells of {column} hold several links or an empty array")
        named = df.select(F.try_element_at(as_links(df, column), F.lit(1)).alias("child_id"))
        if not unknown_links(named, targets).isEmpty():
            raise LinkError(f"some links in {column} lead to no record")
    cell = as_links(df, column)
    return _resolve(df, F.when(F.size(cell) == 1, F.try_element_at(cell, F.lit(1))), targets, spread_by)


def resolve_first(df: DataFrame, column: str, targets: DataFrame, spread_by: list[str] | None = None) -> DataFrame:
    """Join the record of the first link, or of a plain id; no link, no record."""
    return _resolve(df, F.try_element_at(as_links(df, column), F.lit(1)), targets, spread_by)


def resolve_flat(df: DataFrame, column: str, targets: DataFrame) -> DataFrame:
    """One row per link, with its place and record."""
    flat = df.select("*", F.posexplode(column).alias("pos", "_link")).drop(column)
    return matched(flat, targets.withColumnRenamed("id", "_link"), "_link", "left").drop("_link")


def resolve_all(df: DataFrame, column: str, targets: DataFrame, key: str, into: str = "linked") -> DataFrame:
    """Per row, the array of linked records in link order (as long as the row's link array).

    ``key`` has to be unique, as a record id is: the arrays of rows that share it would be one.
    """
    flat = df.select(key, F.posexplode_outer(column).alias("pos", "_link"))
    record = F.struct(*[F.col(c) for c in targets.columns if c != "id"])
    targeted = targets.select(F.col("id").alias("_target"), record.alias("_record"))
    joined = attach(flat, targeted, {"_link": "_target"}, spread_by=[key])
    entry = F.when(F.col("pos").isNotNull(), F.struct("pos", "_record"))
    gathered = joined.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("_all"))
    return gathered.select(key, F.transform("_all", lambda e: e["_record"]).alias(into))


def resolve_links(
    df: DataFrame, column: str, targets: DataFrame, unpack=None, strict: bool = True, spread_by: list[str] | None = None
) -> DataFrame:
    """Join linked records as the ``unpack`` of the link array chooses.

    ``unpack`` maps the array column to an id column, or to an array column to get one row per
    link; it is built from Spark expressions. By default strict resolution, or the first link.
    """
    if unpack is None:
        if strict:
            return resolve_strict(df, column, targets, spread_by, check=True)
        return resolve_first(df, column, targets, spread_by)
    chosen = df.withColumn("_chosen", unpack(F.col(column)))
    if dict(chosen.dtypes)["_chosen"].startswith("array"):
        return resolve_flat(chosen, "_chosen", targets)
    return _resolve(chosen, F.col("_chosen"), targets, spread_by).drop("_chosen")


# --- from projects to sequencing preps ----------------------------------------------------


def _kept(strict: bool, keep: str = "keep") -> Column:
    """Strict leaves out ``keep = 0`` alone: a missing ``keep`` stays."""
    return ~F.col(keep).cast("int").eqNullSafe(F.lit(0)) if strict else F.lit(True)


def with_parents(records: DataFrame, field: str) -> DataFrame:
    """One row per parent a record names in its back-reference array, as ``parent_id``. The edge is
    in the row already, so this joins nothing."""
    return records.select("*", F.explode(field).alias("parent_id")).drop(field)


def with_parents_by_links(edge_rows: DataFrame, records: DataFrame) -> DataFrame:
    """The same by ``(parent_id, child_id)`` edges of the parents' link arrays."""
    rows = edge_rows.select("parent_id", F.col("child_id").alias("id"))
    return rows.join(records.drop("parent_id"), "id")


def _below(children: DataFrame, parents: DataFrame) -> DataFrame:
    """Children whose parent is there, with the parent's columns but its id. The parents' key is
    unique and neither side is grouped, so adaptive execution can split a parent with very many."""
    return children.join(parents.withColumnRenamed("id", "parent_id"), "parent_id").drop("parent_id")


def project_subjects(projects: DataFrame, subjects: DataFrame, project: str | None = None, strict: bool = True) -> DataFrame:
    """Subjects of one project, or of every project (a subject of two appears twice).

    ``subjects`` has a row per parent, see :func:`with_parents`; so have the other children here.
    """
    return _members(projects, subjects, project).filter(_kept(strict))


def _members(projects: DataFrame, subjects: DataFrame, project: str | None) -> DataFrame:
    chosen = projects if project is None else projects.filter(F.col("uid") == project)
    return _below(subjects.drop("project"), chosen.select("id", F.col("uid").alias("project")))


def project_biospecimens(
    projects: DataFrame, subjects: DataFrame, biospecimens: DataFrame, project: str | None = None, strict: bool = True
) -> DataFrame:
    """Biospecimens of the subjects of a project.

    Strict looks at the biospecimen's ``keep``, not at the subject's. Nothing is deduplicated.
    """
    people = subjects.select("id", "parent_id", F.col("uid").alias("subject"))
    members = _members(projects, people, project).select("id", "project", "subject")
    return _below(biospecimens.drop("project", "subject"), members).filter(_kept(strict))


def biospecimen_seqpreps(biospecimens: DataFrame, seqpreps: DataFrame, strict: bool = True) -> DataFrame:
    """Sequencing preps of biospecimens; ``biospecimen`` is the parent's uid."""
    parents = biospecimens.select("id", "project", F.col("uid").alias("biospecimen"))
    return _below(seqpreps.drop("project", "biospecimen"), parents).filter(_kept(strict))


def visit_flags(
    subjects: DataFrame, subject_links: DataFrame, visit_links: DataFrame, visits: DataFrame, codes: dict[str, str]
) -> DataFrame:
    """Per subject, 0/1 columns: has it a biospecimen with the visit ``code``.

    ``subject_links`` go subject → biospecimen, ``visit_links`` biospecimen → visit; flags combine
    on the map side.
    """
    visited = visit_links.select(F.col("parent_id").alias("_specimen"), F.col("child_id").alias("_visit"))
    wanted = visits.select(F.col("id").alias("_visit"), F.col("uid").alias("_code"))
    coded = matched(visited, wanted.filter(F.col("_code").isin(*codes.values())), "_visit").drop("_visit")
    owned = subject_links.select(F.col("parent_id").alias("id"), F.col("child_id").alias("_specimen"))
    at_visit = (
        matched(owned, coded, "_specimen")
        .groupBy("id")
        .agg(*[F.bool_or(F.col("_code") == code).alias(name) for name, code in codes.items()])
    )
    flags = {name: F.coalesce(F.col(name).cast("int"), F.lit(0)) for name in codes}
    return subjects.join(at_visit, "id", "left").withColumns(flags)


def attach_flags(
    ids: DataFrame, flags: DataFrame, id_column: str, flag_key: str, columns: list[str], check: bool = False
) -> DataFrame:
    """Flags of an outside id list, 0 where the id is unknown; the list keeps its rows.

    Of a flag key that comes more than once each flag is the largest of its rows.
    :func:`repeated_flag_keys` lists such keys, and with ``check`` any of them is an error.
    """
    if check and not repeated_flag_keys(flags, flag_key).isEmpty():
        raise LinkError(f"some values of {flag_key} have several rows of flags")
    wanted = flags.groupBy(F.col(flag_key).alias("_flag_key")).agg(*[F.max(c).alias(c) for c in columns])
    joined = attach(ids, wanted, {id_column: "_flag_key"})
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in columns})


def repeated_flag_keys(flags: DataFrame, flag_key: str) -> DataFrame:
    return flags.groupBy(flag_key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def rename_map(biospecimens: DataFrame, prep_links: DataFrame, seqpreps: DataFrame) -> DataFrame:
    """``(oldname, seqname)``: each biospecimen uid with each of its sequencing prep uids."""
    parents = biospecimens.select(F.col("id").alias("parent_id"), F.col("uid").alias("oldname"))
    linked = prep_links.join(parents, "parent_id").select("oldname", F.col("child_id").alias("id"))
    return linked.join(seqpreps.select("id", F.col("uid").alias("seqname")), "id").select("oldname", "seqname")


def listing_biospecimens(listing: DataFrame, seqpreps: DataFrame, biospecimens: DataFrame) -> DataFrame:
    """Each listing row with the uid of its sample's biospecimen.

    ``seqpreps`` has ``uid`` and a ``biospecimen`` link. The records are joined first, so the listing
    is shuffled at most once. Of a uid that several preps share the smallest biospecimen is taken, so
    the listing keeps its rows.
    """
    named = resolve_strict(
        seqpreps.select(F.col("uid").alias("_prep"), "biospecimen"),
        "biospecimen",
        biospecimens.select("id", F.col("uid").alias("_biospecimen")),
        spread_by=["_prep"],
    )
    lookup = named.groupBy("_prep").agg(F.min("_biospecimen").alias("biospecimen"))
    return attach(listing, lookup, {"seqprep": "_prep"}, spread_by=["path"])
