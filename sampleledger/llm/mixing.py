"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source is dealt into small blocks of documents by a hash. Its target of words is a number of
whole passes over its blocks, a part of one more pass in a permuted order of blocks, and a last
block that is filled document by document. So each source owns an exact number of block draws, its
quota. A binary tree over the output shards splits all quotas at once: the left half of a node
takes a multivariate-hypergeometric draw, as if its share were drawn blindly from the node's
shuffled draws. A shard then takes its numbers of permuted draws, disjoint from all others, and
orders their documents by a hash of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampleledger.llm.common import cut, quoted, stored, word_count

WEIGHTS = (3, 1, 2)
RATIO, LIMIT = 1.5, 2.0
#: Documents in a block, on average.
BLOCK_DOCS = 256
SHARDS = 8
#: Blocks in a span, on average: what one task puts in order.
SPAN_BLOCKS = 4096
#: Copies in a piece of a shard, on average.
PIECE_COPIES = 1 << 14
#: Columns that the mixture adds.
ADDED = ("size", "source_size", "target", "copies", "taken", "shards")


def targets(sizes: DataFrame, ratio: float = RATIO, limit: float = LIMIT, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sizes`` (key, docs, source_size) with each source's ``target``.

    Sources in order of ``key`` take the weights in turn and share ``ratio`` times all words. A
    target stops at ``limit`` times the source's own words, and the excess is shared again by
    weight: with the sources in order of limit over weight, the stopped ones come first, and the
    others all have the same share per weight. One row per source goes through one task.
    """
    every = Window.orderBy("key")
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(every) - 1, F.lit(len(weights))) + 1)
    rows = sizes.withColumns({"weight": weight, "most": F.col("source_size") * F.lit(limit)})
    order = Window.orderBy(F.col("most") / F.col("weight"), "key")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    goal = F.sum("source_size").over(whole) * F.lit(ratio)
    stopped = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    share = (goal - stopped) / rest
    free = F.when(share * F.col("weight") < F.col("most"), F.struct((F.col("most") / F.col("weight")).alias("at"), "key", share.alias("share")))
    rows = rows.withColumn("free", free).withColumn("free", F.min("free").over(whole))
    before = F.struct((F.col("most") / F.col("weight")).alias("at"), "key") < F.struct("free.at", "free.key")
    target = F.when(F.col("free").isNull() | before, F.col("most")).otherwise(F.col("free.share") * F.col("weight"))
    return rows.withColumn("target", target).drop("weight", "most", "free")


def _split(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Draws of each source (rows) that each shard (columns) takes: exact sums both ways."""
    total = int(quotas.sum())
    room = np.diff(np.arange(shards + 1) * total // shards)
    out = np.zeros((len(quotas), shards), np.int64)
    todo = [(0, shards, quotas)]
    while todo:
        first, last, have = todo.pop()
        if last - first == 1:
            out[:, first] = have
            continue
        middle = (first + last) // 2
        left = np.random.default_rng([seed, first, last]).multivariate_hypergeometric(have, int(room[first:middle].sum()), method="marginals")
        todo += [(first, middle, left), (middle, last, have - left)]
    return out


def _tree(shards: int, seed: int):
    def run(_: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("key")
        split = _split(frame["draws"].to_numpy(np.int64), shards, seed)
        return pd.DataFrame({"key": frame["key"].to_numpy(), "ends": list(np.cumsum(split, axis=1)), "first": frame["first"].to_numpy()})

    return run


def _fill(_: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """Of a source's last block the largest documents that still fit, down to the smallest."""
    frame = frame.sort_values(["words", "_h"], ascending=[False, True])
    left, chosen = float(frame["left"].iloc[0]), []
    for h, words in zip(frame["_h"], frame["words"]):
        if 0 < words <= left:
            chosen.append(h)
            left -= words
    return pd.DataFrame({"_key": frame["_key"].iloc[:1].to_numpy(), "_block": frame["_block"].iloc[:1].to_numpy(), "chosen": [chosen]})


def _ranked(draws: DataFrame) -> DataFrame:
    """``draws`` (_key, pass, spans, at, _block, words, …) with ``rank`` and the words ``ahead`` in the
    order of ``at`` in each pass of a source.

    The order is cut into spans of about SPAN_BLOCKS blocks. A span is counted for itself and the
    counts of the spans before it are added, so no task takes a whole source.
    """
    span = F.floor((F.col("at") / F.lit(2.0**64) + 0.5) * F.col("spans"))
    draws = draws.withColumn("span", F.least(span, F.col("spans") - 1)).drop("spans")
    inside = Window.partitionBy("_key", "pass", "span").orderBy("at", "_block")
    spans = draws.groupBy("_key", "pass", "span").agg(F.count("*").alias("n"), F.sum("words").alias("w"))
    before = Window.partitionBy("_key", "pass").orderBy("span")
    spans = spans.select(
        "_key", "pass", "span", (F.sum("n").over(before) - F.col("n")).alias("n_before"), (F.sum("w").over(before) - F.col("w")).alias("w_before")
    )
    local = draws.withColumns({"rank": F.row_number().over(inside) - 1, "ahead": F.sum("words").over(inside) - F.col("words")})
    return local.join(spans, ["_key", "pass", "span"]).withColumns(
        {"rank": F.col("rank") + F.col("n_before"), "ahead": F.col("ahead") + F.col("w_before")}
    ).drop("span", "n_before", "w_before")


def _dealt(slim: DataFrame, ratio: float, limit: float, weights: tuple[int, ...], shards: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The sources, and per block of documents the draws that the shards take of it:
    ``draws`` (pass, shard, whole) and, where a draw is not whole, the hashes it takes (``chosen``).

    ``slim`` is (_key, _h, size) of every document. A draw exists because some shard was dealt its
    number by the tree, and nothing else decides what is taken.
    """
    sizes = slim.groupBy(F.col("_key").alias("key")).agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    sources = targets(sizes, ratio, limit, weights).withColumns(
        {
            "blocks": F.ceil(F.col("docs") / BLOCK_DOCS).cast("long"),
            "passes": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(1).cast("int"),
        }
    )
    sources = stored(sources.withColumn("part", F.col("target") - F.col("passes") * F.col("source_size")).withColumnRenamed("key", "_key"))

    known = sources.select("_key", "passes", "part", "blocks")
    blocks = slim.join(known, "_key").groupBy("_key", _block().alias("_block")).agg(F.sum("size").alias("words"))
    # whole passes over the blocks, each in an order of its own, and the part of one more
    every = blocks.join(known, "_key").select(
        "_key", "_block", "words", "passes", "part", F.ceil(F.col("blocks") / SPAN_BLOCKS).alias("spans"),
        F.explode(F.sequence(F.lit(0), F.col("passes"))).alias("pass"),
    )
    ranked = _ranked(every.withColumn("at", F.xxhash64(F.lit(seed), "pass", "_key", "_block")))
    left = F.when(F.col("pass") == F.col("passes"), F.col("part") - F.col("ahead"))
    ranked = cut(ranked.withColumn("left", left).filter("left IS NULL OR left > 0").drop("passes", "part", "ahead"))

    # an empty hash block has no document and no draw
    passes = ranked.groupBy("_key", "pass").agg(F.count("*").alias("n"))
    quotas = passes.groupBy(F.col("_key").alias("key")).agg(F.sum("n").alias("draws"), F.max(F.when(F.col("pass") == 0, F.col("n"))).alias("first"))
    ends = stored(quotas.groupBy(F.lit(0).alias("all")).applyInPandas(_tree(shards, seed), "key string, ends array<long>, first long"))
    # every whole pass draws each block, as the first one does, so a pass starts where the others end
    number = F.col("pass") * F.col("first") + F.col("rank")
    shard = F.size(F.filter("ends", lambda end: end <= number)).cast("int")
    dealt = ranked.join(ends.withColumnRenamed("key", "_key"), "_key").select(
        "_key", "_block", "left", F.struct("pass", shard.alias("shard"), F.coalesce(F.col("words") <= F.col("left"), F.lit(True)).alias("whole")).alias("draw")
    )
    by_block = dealt.groupBy("_key", "_block").agg(F.array_sort(F.collect_list("draw")).alias("draws"))

    last = dealt.filter("NOT draw.whole").select("_key", "_block", "left")
    members = slim.join(sources.select("_key", "blocks"), "_key").select("_key", _block().alias("_block"), "_h", "size")
    alike = members.join(last, ["_key", "_block"]).groupBy("_key", "_block", "_h").agg(F.sum("size").alias("words"), F.first("left").alias("left"))
    filled = alike.groupBy("_key").applyInPandas(_fill, "_key string, _block long, chosen array<long>")
    return sources, stored(by_block.join(filled, ["_key", "_block"], "left"))


def _block() -> Column:
    return F.pmod(F.col("_h"), F.col("blocks"))


def mixture(
    docs: DataFrame, ratio: float = RATIO, limit: float = LIMIT, weights: tuple[int, ...] = WEIGHTS, shards: int = SHARDS, seed: int = 0
) -> DataFrame:
    """Every document with ``size`` (words), ``source_size``, ``target`` (its source's, in words),
    ``copies`` (0 to 2 times), ``taken`` (words taken, repeats counted) and ``shards`` (the output
    shard of each copy). Columns of these names are replaced, others stay.

    What is taken are the draws that the tree dealt to the shards. A source misses its target by
    less than the smallest document left out of its last block (equal rows stay or go together
    there). A null source is a source of its own and last in order. Documents without words are
    taken with their block and add nothing. Draws depend on the rows and the seed alone, so reruns
    agree. An empty table gives no rows. The quota table has one row per source; the tree takes it
    in one task, and it counts up to a thousand million block draws.
    """
    # columns travel under numbers, so that none can clash with those made here
    kept = {f"_{i}": c for i, c in enumerate(c for c in docs.columns if c not in ADDED)}
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("~"))
    h = F.xxhash64(F.lit(seed), "doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    marked = docs.select(*[F.col(quoted(c)).alias(n) for n, c in kept.items()], word_count(F.col("text")).alias("size"), key.alias("_key"), h.alias("_h"))
    sources, by_block = _dealt(cut(marked.select("_key", "_h", "size")), ratio, limit, weights, shards, seed)

    rows = marked.join(sources.select("_key", "source_size", "target", "blocks"), "_key").withColumn("_block", _block())
    rows = rows.join(by_block, ["_key", "_block"], "left")
    taken = F.filter("draws", lambda d: d["whole"] | F.coalesce(F.array_contains("chosen", F.col("_h")), F.lit(False)))
    rows = rows.withColumn("shards", F.coalesce(F.transform(taken, lambda d: d["shard"]), F.array().cast("array<int>")))
    rows = rows.withColumn("copies", F.size("shards")).withColumn("taken", F.col("size") * F.col("copies"))
    return rows.select(*[F.col(n).alias(c) for n, c in kept.items()], *ADDED)


def mixed(docs: DataFrame, seed: int = 0, **how) -> DataFrame:
    """The mixed corpus: a row for every copy, with ``shard`` and the place ``order_key`` inside
    it. Sorting a shard by (order_key, doc_id, copy) shuffles it locally. Columns of these names
    are replaced."""
    out = mixture(docs, seed=seed, **how)
    rows = out.select(*[quoted(c) for c in out.columns if c not in ("shards", "copy", "shard", "order_key")], F.posexplode("shards").alias("copy", "shard"))
    return rows.withColumn("order_key", F.xxhash64(F.lit(seed), "shard", "doc_id", "copy"))


def resampled(docs: DataFrame, seed: int = 0, **how) -> DataFrame:
    """``docs`` with each row as often as the mixture takes it, all columns as they are. Rows are laid
    out by shard and, inside it, in the order of their keys: a shard's keys are cut into pieces, a
    piece is in one task, and pieces of a task follow one another."""
    others = [c for c in docs.columns if c not in ("doc_id", "text", "source")]
    packed = docs.select("doc_id", "text", "source", F.struct(F.lit(0).alias("_"), *map(quoted, others)).alias("_others"))
    rows = mixed(packed, seed, **how).select("doc_id", "text", "source", "_others", "copy", "shard", "order_key")
    shards = how.get("shards", SHARDS)
    pieces = max(1, round(docs.select("doc_id").count() * how.get("ratio", RATIO) / shards / PIECE_COPIES))
    piece = F.floor((F.col("order_key") / F.lit(2.0**64) + 0.5) * pieces)
    laid = rows.withColumn("piece", piece).repartition("shard", "piece").sortWithinPartitions("shard", "piece", "order_key", "doc_id", "copy")
    return laid.select("doc_id", "text", "source", *[F.col("_others").getField(c).alias(c) for c in others]).select(*map(quoted, docs.columns))
