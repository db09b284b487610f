"""How the sources of a language differ in their words, by Gustavson row accumulation.

Each (lang, source) group gives every kept term a smoothed share per thousand million, in whole
numbers; two groups differ by the sum of the absolute differences over all kept terms. That is
the product of the sparse matrix groups x terms with its own transpose, under |p - q| in place of
p * q. It is computed as Gustavson does it, row by row: a group walks its terms through the
term-major index and scatters what each posting changes into a dense accumulator with a place per
peer. Pairs of postings exist only inside the accumulator.

Most groups lack most terms, and a term that is lacking still has the share of count zero, the
baseline. An accumulator therefore starts from what it would hold if the two groups had no term
in common, which needs only the group's sorted shares and the peers' baselines, and each common
term corrects it.

The index is cut into blocks of whole terms, by a hash of the term. A block yields a number per
pair of groups, and the sums over the blocks are the result. All numbers are integers, so neither
the cut nor the order changes a result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampleledger.llm.common import pieces, stored

SCALE, SMOOTHING = 1_000_000_000, 5
MIN_DOCS, TOP_TERMS = 30, 50

#: Bytes of UTF-8 that make up terms once A-Z are lower-cased: ASCII letters and all of other characters.
TERM = re.compile(rb"[a-z\x80-\xff]+")
BREAK = re.compile(rb"[^a-z\x80-\xff]")

#: Entries a task counts before it hands them on.
HELD = 300_000
#: Postings of a block: at least the first, and up to the second where groups are many, so that
#: what blocks yield (a number per pair of groups) stays below what they read.
BLOCK, LARGEST_BLOCK = 1 << 17, 1 << 22

_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])
_PARTS = pa.schema([("lang", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("part", pa.int64())])


def _rows(tally: dict) -> pa.RecordBatch:
    flat = [(*key, t, n, docs[t]) for key, (counts, docs) in tally.items() for t, n in counts.items()]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*flat), _COUNTS)], schema=_COUNTS)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term in each group, added up within the task."""
    tally: dict = {}
    for batch in batches:
        for at, (lang, source) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())):
            counts, docs = tally.setdefault((lang, source), (Counter(), Counter()))
            seen: set = set()
            for piece in pieces(batch.column("data")[at].as_py().lower(), BREAK):
                found = TERM.findall(piece)
                counts.update(found)
                seen.update(found)
            docs.update(seen)
            if at % 64 == 63 and sum(len(c) for c, _ in tally.values()) > HELD:
                yield _rows(tally)
                tally = {}
    if any(c for c, _ in tally.values()):
        yield _rows(tally)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): a row per term of each group, from whole texts. Null text, lang
    and source are read as empty."""
    read = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")), F.coalesce("text", F.lit("")).cast("binary").alias("data"))
    counted = read.mapInArrow(_counted, "lang string, source string, term binary, n long, docs long")
    counted = counted.select("lang", "source", F.col("term").cast("string").alias("term"), "n", "docs")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + SMOOTHING) / (total + SMOOTHING * kept)), exact for any counts."""
    top = (n + SMOOTHING).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    whole = (total + SMOOTHING * kept).cast("decimal(20,0)")
    return 1 + F.call_function("div", top, whole)


def _accumulated(left: pa.Table, right: pa.Table) -> pa.Table:
    """One block: what its terms add to each pair of groups of its language."""
    right = right.sort_by("gid")
    zero, lang = right["zero"].to_numpy().astype(np.int64), right["lang"][0].as_py()
    term = pc.dictionary_encode(left["term"].combine_chunks()).indices.to_numpy() if len(left) else np.zeros(0, np.int64)
    gid, p = left["gid"].to_numpy().astype(np.int64), left["p"].to_numpy().astype(np.int64)
    order = np.lexsort((gid, term))  # the term-major index: a term's postings side by side, in order of group
    term, gid, p = term[order], gid[order], p[order]
    terms = int(term[-1]) + 1 if len(term) else 0
    end = np.searchsorted(term, term, side="right")
    rows = np.argsort(gid, kind="stable")
    bounds = np.searchsorted(gid[rows], np.arange(len(zero) + 1))
    peers, out = np.arange(len(zero), dtype=np.int32), []
    for g in range(len(zero)):
        mine = rows[bounds[g]:bounds[g + 1]]
        own = np.sort(p[mine])
        total = np.concatenate([[0], np.cumsum(own)])
        below = np.searchsorted(own, zero)
        apart = np.abs(zero[g] - zero)
        # no term in common: each own share against the peer's baseline, the rest baseline to baseline
        row = zero * (2 * below - len(own)) + total[-1] - 2 * total[below] - len(own) * apart
        row[g + 1:] += terms * apart[g + 1:]
        # common terms, each pair once: postings of the same term in later groups
        count = end[mine] - mine - 1
        at = np.repeat(mine + 1 - np.cumsum(count) + count, count) + np.arange(count.sum())
        peer, q, own = gid[at], p[at], np.repeat(p[mine], count)
        np.add.at(row, peer, np.abs(own - q) - np.abs(own - zero[peer]) - np.abs(q - zero[g]) + apart[peer])
        others = np.delete(peers, g)
        out.append((np.minimum(others, g), np.maximum(others, g), np.delete(row, g)))
    a, b, part = (np.concatenate(c) for c in zip(*out))
    return pa.table([pa.array([lang] * len(a), pa.string()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(part, pa.int64())], schema=_PARTS)


def divergences(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): per group its distance to each other source of its
    language (part ``pair``, largest first), and the ``top`` kept terms it has more of than the
    whole language (part ``term``). Ties go by item in UTF-8 order.

    Kept are terms in ``min_docs`` documents of their language. Null text, lang and source are read
    as empty, so rows without a source are a group; a group without terms has distances like any
    other, and none but zeros where its language keeps no term. Repeated rows count as often as
    they occur. A language of one source has no pairs; an empty table gives no rows. Other columns
    are not read.

    A dense row per group and block is held, so a language may have as many sources as fit a
    task's memory; the result itself has a row per pair of them.
    """
    per_term = Window.partitionBy("lang", "term")  # at most a row per source
    counts = term_counts(docs).withColumns({"all_docs": F.sum("docs").over(per_term), "all_n": F.sum("n").over(per_term)})
    kept = stored(counts.filter(F.col("all_docs") >= min_docs).select("lang", "source", "term", "n", "all_n"))

    every = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count("*").alias("terms"))
    languages = kept.groupBy("lang", "term").agg(F.first("all_n").alias("all_n")).groupBy("lang").agg(F.count("*").alias("kept"), F.sum("all_n").alias("all"))
    per_lang = Window.partitionBy("lang")
    groups = every.join(sizes, ["lang", "source"], "left").join(languages, "lang", "left").fillna(0)
    groups = groups.withColumns({"gid": F.row_number().over(per_lang.orderBy("source")) - 1, "groups": F.count("*").over(per_lang), "postings": F.sum("terms").over(per_lang)})
    room = F.greatest(F.lit(BLOCK), F.least(F.col("groups") * F.col("groups"), F.lit(LARGEST_BLOCK)))
    groups = groups.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("postings") / room)).cast("int"))
    zero = F.when(F.col("kept") > 0, _share(F.lit(0), F.col("size"), F.col("kept"))).otherwise(0)
    groups = stored(groups.withColumn("zero", zero))

    known = groups.select("lang", "source", "gid", "size", "kept", "all", "blocks")
    placed = kept.join(known, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("size"), F.col("kept")))
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")
    index = placed.select("lang", block, "term", "gid", "p")
    peers = groups.select("lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("gid").alias("gid"), "zero")
    parts = index.groupBy("lang", "block").cogroup(peers.groupBy("lang", "block")).applyInArrow(_accumulated, "lang string, a int, b int, part long")
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("part").alias("value"))
    both = sums.select("lang", F.expr("inline(array(struct(a AS gid, b AS peer), struct(b AS gid, a AS peer)))"), "value")
    named = both.join(groups.select("lang", "gid", "source"), ["lang", "gid"])
    pairs = named.join(groups.select("lang", F.col("gid").alias("peer"), F.col("source").alias("item")), ["lang", "peer"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    above = F.col("p") - _share(F.col("all_n"), F.col("all"), F.col("kept"))
    terms = placed.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), above.alias("value")).filter("value > 0")
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).unionByName(terms.withColumn("rank", rank).filter(F.col("rank") <= top))
