"""Join helpers shared by the operators.

No side is broadcast by hint. Sides below ``spark.sql.autoBroadcastJoinThreshold`` (by statistics
or, at run time, by measured shuffle size) become broadcast joins by themselves; beyond it the same
plan runs as a sort-merge join, and adaptive execution splits the partitions of a skewed key.
Statistics know nothing of rows that an explode makes or of names built from a number, and call a
side small that is a hundred times its estimate. Where both sides grow with the listing, joins ask
for the sort-merge join (``both_grow``): no side of them is collected to be broadcast. Where the
right side has a row per key and only a few narrow columns, :func:`attach` can ask for the shuffled
hash join instead (``hashed``): each task makes a hash table of its keys, and the listing, whose ids
often begin alike and are slow to compare, is not sorted.

Two things need help. Adaptive execution splits a join only where each side has a shuffle of its
own, which a side that was just grouped by the key has not: :func:`matched` and :func:`attach` join
on fresh key expressions, so the small side is shuffled once more and the large one can be split.
And rows with a NULL key, which never match, would all meet in one partition: :func:`attach`
scatters them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How many pseudo-keys take the rows whose key is NULL. They start with NUL, so no id equals one.
NULL_SPREAD = 1024
_NUL = "\x00"


def _scattered(key: Column, spread_by: Sequence[str]) -> Column:
    bucket = F.pmod(F.xxhash64(*spread_by), F.lit(NULL_SPREAD))
    return F.coalesce(key, F.concat(F.lit(_NUL), bucket.cast("string")))


def _fresh(key: Column) -> Column:
    """The same text as a new expression, which no earlier partitioning is known to fit."""
    return F.concat(key, F.lit(""))


def settled(df: DataFrame) -> DataFrame:
    """The same rows as generated ones, for a table that one plan uses several times.

    What the uses need and ask of the rows (columns, conditions, keys that are not NULL) stays above
    them. So the plans below are equal, and Spark makes their shuffles once for all uses.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


def _shuffled(df: DataFrame, both_grow: bool) -> DataFrame:
    return df.hint("merge") if both_grow else df


def matched(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner", both_grow: bool = False
) -> DataFrame:
    """Equi-join on string columns both sides have, splittable when a key is skewed.

    For inner, left, semi and anti joins; for left joins whose key may be NULL see :func:`attach`.
    With ``both_grow`` neither side goes through the driver, see the head of this module.
    """
    first, *rest = [on] if isinstance(on, str) else on
    lefts = left.withColumn("_l0", _fresh(F.col(first)))
    names = {c: f"_r{i}" for i, c in enumerate(rest, 1)}
    rights = (
        right.withColumn("_r0", _fresh(F.col(first)))
        .withColumns({new: F.col(old) for old, new in names.items()})
        .drop(first, *rest)
    )
    condition = F.col("_l0") == F.col("_r0")
    for old, new in names.items():
        condition = condition & (lefts[old] == F.col(new))
    return lefts.join(_shuffled(rights, both_grow), condition, how).drop("_l0", "_r0", *names.values())


def _hashable(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]


def attach(
    left: DataFrame,
    right: DataFrame,
    on: str | dict[str, str],
    spread_by: Sequence[str] | None = None,
    how: str = "left",
    null_safe: bool = False,
    both_grow: bool = False,
    hashed: bool = False,
) -> DataFrame:
    """Join ``right`` to ``left`` on the string columns ``{left column: right column}``.

    Left rows with a NULL first key are scattered over many pseudo-keys by a hash of ``spread_by``
    (all columns that can be hashed when not given) in place of meeting in one partition. With ``null_safe`` the right row with a NULL key
    (at most one) answers them: it is repeated once per pseudo-key. ``hashed`` is for a ``right`` of
    one row per key: a partition's share of its rows has to fit in the memory of a task.
    The right key columns are dropped from the result.
    """
    pairs = {on: on} if isinstance(on, str) else dict(on)
    first, *rest = pairs
    lefts = left.withColumn("_k0", _scattered(F.col(first), spread_by or _hashable(left)))
    right_key = F.col(pairs[first])
    if null_safe:
        pseudo = F.transform(
            F.sequence(F.lit(0), F.lit(NULL_SPREAD - 1)), lambda i: F.concat(F.lit(_NUL), i.cast("string"))
        )
        keys = F.when(right_key.isNull(), pseudo).otherwise(F.array(right_key))
        rights = right.withColumn("_r0", F.explode(keys))
    else:
        rights = right.withColumn("_r0", _fresh(right_key))
    names = {pairs[c]: f"_r{i}" for i, c in enumerate(rest, 1)}
    rights = rights.withColumns({new: F.col(old) for old, new in names.items()}).drop(*pairs.values())
    condition = F.col("_k0") == F.col("_r0")
    for i, c in enumerate(rest, 1):
        condition = condition & (lefts[c] == F.col(f"_r{i}"))
    rights = rights.hint("shuffle_hash") if hashed else _shuffled(rights, both_grow)
    joined = lefts.join(rights, condition, how)
    return joined.drop("_k0", "_r0", *names.values())


# Needles are sorted into this many classes by their first characters.
_CLASSES = 256


def _class_of(head: Column) -> Column:
    return F.pmod(F.xxhash64(head), F.lit(_CLASSES)).cast("int")


def _needle_shapes(needles: DataFrame, needle: str) -> DataFrame:
    """One row: the head length ``k`` (1 to 3) and, per class of heads, the needle lengths there are.

    A fixed number of classes with sets of small integers, however many needles there are.
    """
    size, word = F.length(needle), F.col(needle)
    heads = F.transform(
        F.sequence(F.lit(1), F.least(size, F.lit(3))),
        lambda k: F.struct(k.alias("k"), _class_of(F.left(word, k)).alias("c"), size.alias("n")),
    )
    seen = needles.select(F.explode(heads).alias("h")).agg(F.collect_set("h").alias("all"))
    # The shortest needle has heads up to k, and so has every other.
    k = F.least(F.array_min(F.transform("all", lambda h: h["n"])), F.lit(3))
    lengths = F.transform(
        F.sequence(F.lit(0), F.lit(_CLASSES - 1)),
        lambda c: F.transform(
            F.filter("all", lambda h: (h["k"] == F.col("k")) & (h["c"] == c)), lambda h: h["n"]
        ),
    )
    return seen.withColumn("k", k).select(F.struct("k", lengths.alias("lengths")).alias("shapes"))


def _cut(texts: DataFrame, text: str, shapes: DataFrame, anchored: bool) -> DataFrame:
    """Each text row with every distinct ``_piece`` of it that a needle could equal, by length and
    first characters.

    Places and lengths become rows, which compiled code makes and drops again without storing them.
    A piece that stands in a text several times is taken where it stands first.
    """
    whole, place = F.col(text), F.col("_place")
    k, size = F.col("_shapes.k"), F.length(whole)
    places = F.array(F.lit(1)) if anchored else F.sequence(F.lit(1), size - k + 1)
    windows = texts.withColumn("_shapes", shapes.scalar()).filter(size >= k).withColumn("_place", F.explode(places))
    fitting = F.get(F.col("_shapes.lengths"), _class_of(F.substring(whole, place, k)))
    pieces = (
        windows.withColumn("_size", F.explode(fitting))
        .filter(place + F.col("_size") - 1 <= size)
        .withColumn("_piece", F.substring(whole, place, F.col("_size")))
    )
    if not anchored:
        pieces = pieces.filter(F.position("_piece", whole) == place)
    return pieces.drop("_shapes", "_place", "_size")


def contained(
    texts: DataFrame, text: str, needles: DataFrame, needle: str, anchored: bool = False
) -> DataFrame:
    """Every (text row, needle row) where the needle occurs in the text (or begins it).

    An equi-join: each text gives the pieces that are as long as some needle and start like one,
    and nothing is compared pair by pair. What a needle can look like is one small scalar, see
    :func:`_needle_shapes`; a needle that occurs in very many texts is split like any skewed key.
    """
    usable = needles.filter(F.length(needle) > 0)
    cut = _cut(texts, text, _needle_shapes(usable, needle), anchored)
    return matched(cut, usable.withColumn("_piece", F.col(needle)), "_piece", both_grow=True).drop("_piece")


def absent(needles: DataFrame, needle: str, texts: DataFrame, text: str) -> DataFrame:
    """The needle rows that occur in no text; a needle is looked for once, however many hold it."""
    shapes = _needle_shapes(needles.filter(F.length(needle) > 0), needle)
    found = _cut(texts.select(text), text, shapes, False).select(F.col("_piece").alias(needle)).distinct()
    return matched(needles, found, needle, "left_anti", both_grow=True)


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).filter(F.col(key).isNotNull()).distinct()
