"""Plans whose steps depend on one another: moves that free each other's targets, and mappings that
are applied one after the other.

Other plans ask a snapshot of the listing whether a target exists. Here it is asked as of the moment
of the step. Both functions run jobs when called: their rounds follow chains of steps, by pointer
doubling for moves and one step a round for mappings, and every round's table is a checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleledger.functions.names import replace_id
from sampleledger.operators.joins import attach, contained, matched
from sampleledger.session import kept


def order_moves(moves: DataFrame, listing: DataFrame) -> DataFrame:
    """``path, newpath, action, step`` for wanted moves, so that played by step none overwrites a file.

    ``move`` has a ``step`` from 1: a target that another move frees is free one step after it, and
    moves of one step do not touch each other. Without a step stay ``same`` (the target is the path),
    ``clash`` (all but the first by path with one target), ``exists`` (the target is there and stays,
    itself or because its own move is held up) and ``cycle`` (moves that wait for one another; one of
    them needs a name in between). ``listing`` has the ``path`` of every file, moved or not; a path is
    moved to one place only, the smallest if there are several.

    A target has one mover and a path one target, so moves form chains and cycles. Each round every
    move learns what the move at twice the distance knows; a round that settles nothing has cycles
    alone left.
    """
    wanted = moves.groupBy("path").agg(F.min("newpath").alias("newpath"))
    going = wanted.filter("path <> newpath")
    first = going.groupBy("newpath").agg(F.min("path").alias("_first"))
    chosen = kept(attach(going, first, "newpath", spread_by=["path"], both_grow=True).withColumn("clash", F.col("path") != F.col("_first")).drop("_first"))
    movers = chosen.filter(~F.col("clash")).select("path", "newpath")
    next_ = movers.select(F.col("path").alias("newpath"), F.lit(True).alias("_moves"))
    have = listing.select(F.col("path").alias("newpath"), F.lit(True).alias("_exists")).distinct()
    ends = movers.join(next_, "newpath", "left").join(have, "newpath", "left")
    # waits: the move that has to be made before; blocked: known once nothing is waited for
    state = kept(
        ends.select(
            "path", "newpath", F.when(F.col("_moves"), F.col("newpath")).alias("waits"), F.lit(1).alias("step"),
            (F.col("_moves").isNull() & F.coalesce("_exists", F.lit(False))).alias("blocked"),
        )
    )
    open_ = state.filter("waits IS NOT NULL").count()
    while open_:
        ahead = state.select(F.col("path").alias("waits"), F.col("waits").alias("_waits"), F.col("step").alias("_step"), F.col("blocked").alias("_blocked"))
        state = kept(
            state.join(ahead, "waits", "left").select(
                "path", "newpath", F.col("_waits").alias("waits"), (F.col("step") + F.coalesce("_step", F.lit(0))).alias("step"),
                F.coalesce("_blocked", "blocked").alias("blocked"),
            )
        )
        open_, before = state.filter("waits IS NOT NULL").count(), open_
        if open_ == before:
            break
    action = F.when(F.col("waits").isNotNull(), "cycle").when(F.col("blocked"), "exists").otherwise("move")
    decided = state.select("path", "newpath", action.alias("action"), F.when(action == "move", F.col("step")).alias("step"))
    none = F.lit(None).cast("int").alias("step")
    late = chosen.filter("clash").select("path", "newpath", F.lit("clash").alias("action"), none)
    same = wanted.filter("path = newpath").select("path", "newpath", F.lit("same").alias("action"), none)
    return decided.union(late).union(same)


_START = -(1 << 63)


def rename_in_order(files: DataFrame, mapping: DataFrame) -> DataFrame:
    """``path, seq, old_id, new_id, name, newname, action``: every rename of a run that applies the
    mappings ``(seq, old_id, new_id)`` one after the other in each directory of ``files``.

    A mapping renames the files whose name at that time holds its old id, in order of name, so a
    renamed file can be renamed again by a later mapping, but not twice by one. The first rename
    whose target is there at that moment is a ``conflict`` and ends the run in its directory: earlier
    ones are ``rename``, later ones ``stopped``, with the names they would have had. Mappings with a
    blank id are left out, white space in new ids is dropped, and a ``seq`` stands for one mapping.

    A round takes each file one rename further, to the smallest later mapping whose old id its name
    holds; there are as many rounds as the longest chain has renames.
    """
    rules = mapping.select("seq", "old_id", F.regexp_replace("new_id", r"\s", "").alias("new_id")).filter("old_id <> '' AND new_id <> ''")
    state = files.select("dir", "path", F.col("file").alias("name"), F.lit(_START).alias("seq")).distinct()
    first_names, steps = state, None
    while True:
        held = contained(state.select("name", F.col("seq").alias("last")).distinct(), "name", rules, "old_id").filter("seq > last")
        following = held.groupBy("name", "last").agg(F.min(F.struct("seq", "old_id", "new_id")).alias("rule"))
        named = matched(state.withColumnRenamed("seq", "last"), following, ["name", "last"], both_grow=True)
        newname = replace_id(F.col("name"), F.col("rule.old_id"), F.col("rule.new_id"))
        made = kept(named.select("dir", "path", "name", "last", "rule.*", newname.alias("newname")))
        if made.isEmpty():
            break
        steps = made if steps is None else steps.union(made)
        state = made.select("dir", "path", F.col("newname").alias("name"), "seq")
    if steps is None:
        return made.select("path", "seq", "old_id", "new_id", "name", "newname", F.lit("rename").alias("action"))
    at = F.struct("seq", "name")
    steps = steps.withColumn("at", at)
    marked = attach(steps, _stops(first_names, steps), "dir", spread_by=["path"])
    action = F.when(F.col("stop").isNull() | (F.col("at") < F.col("stop")), "rename").when(F.col("at") == F.col("stop"), "conflict").otherwise("stopped")
    return marked.select("path", "seq", "old_id", "new_id", "name", "newname", action.alias("action"))


def _stops(first_names: DataFrame, steps: DataFrame) -> DataFrame:
    """(dir, stop): the first rename of each directory whose target is held by a file at that time.

    A name is held from the rename that gave it until the one that takes it away. Of a name's
    holders the earliest is looked at first: whoever arrives before it leaves is in conflict, and
    those who arrive later are a round of their own. No holders of a name are compared in pairs.
    """
    beginning = F.struct(F.lit(_START).alias("seq"), "name")
    leaving = steps.select("path", F.col("last").alias("seq"), F.col("at").alias("until"))
    holders = first_names.select("dir", "path", "name", beginning.alias("at"), "seq").unionByName(
        steps.select("dir", "path", F.col("newname").alias("name"), "at", "seq")
    )
    # whether a file leaves a name is told by its next rename, which carries the seq of the one before
    holders = matched(holders, leaving, ["path", "seq"], "left", both_grow=True).withColumn("slot", F.concat("dir", F.lit("/"), "name"))
    left = kept(holders.select("slot", "dir", "at", "until"))
    own = steps.filter("name = newname").select("dir", "at")
    found = own
    while not left.isEmpty():
        heads = left.groupBy("slot").agg(F.min(F.struct("at", "until")).alias("head"))
        later = matched(left, heads, "slot", both_grow=True).filter(F.col("at") > F.col("head.at"))
        late = kept(later.select("slot", "dir", "at", "until", (F.col("head.until").isNull() | (F.col("at") < F.col("head.until"))).alias("held")))
        found = found.union(late.filter("held").select("dir", "at"))
        left = late.filter("NOT held").drop("held")
    return found.groupBy("dir").agg(F.min("at").alias("stop"))
