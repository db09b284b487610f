"""Grouping of spelling variants by Bloom-guided neighbourhoods.

Two words are near if one inserted, deleted or replaced character turns one into the other. The
edits of every word are generated and each is probed against a blocked Bloom filter of the
vocabulary, sharded by word length and broadcast. Nearly all edits are no words and end there; the
few positives go through an exact join with the vocabulary, which removes the filter's mistakes.

An insertion is a deletion seen from the other word, and a replacement by a smaller character is
one by a larger seen from the other word; so only deletions and replacements by larger characters
are generated, and links are mirrored after the join.

A word is a row of one-byte characters, its hash a polynomial in an odd base modulo 2 ** 64. The
hash of an edit follows from the word's by one multiplication, so edits are probed as arrays and
only positives become strings.

The filter has a bounded size. A vocabulary that needs more is cut into slices by hash, each with
a filter of its own, and every edit is probed against each: more slices take more time, the
broadcast stays the same.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from math import ceil, log2
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleledger.llm.common import pieces, stored

#: Which characters make a word (A-Z lower-cased before), shortest word, fewest
#: occurrences, how much more frequent a form is, and which share of the runs loses a character.
LETTERS = "a-zÀ-ÿ"
LENGTH, OCCURRENCES, FACTOR, SLIP = 6, 5, 5, 199

#: Distinct words a task holds before it hands them on.
HELD = 400_000
#: Filter bits per word, and 64-bit blocks of a filter at most (32 MB).
BITS, MAX_BLOCKS = 32, 1 << 22
#: Bits that a word sets in its block.
SET = 5
#: Characters of words that are probed at once.
PROBED = 1 << 17

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_WORDS = pa.schema([("word", pa.string()), ("n", pa.int64())])
_EDITS = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string())])


def _slipped(word: str, h: int) -> str:
    at = h % len(word)
    return word[:at] + word[at + 1:]


def _counting(length: int, slip: int) -> Callable:
    long_run, gap = re.compile(f"[{LETTERS}]{{{length},}}"), re.compile(f"[^{LETTERS}]")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: Counter = Counter()
        for batch in batches:
            for id_, data in zip(batch.column("id").to_pylist(), batch.column("data")):
                start, here = crc32(f"{id_}:".encode()), Counter()
                for piece in pieces(data.as_py().lower().decode("utf-8", "replace"), gap):
                    here.update(long_run.findall(piece))  # shorter runs can only get shorter
                tally.update(here)
                for word, n in here.items():
                    h = crc32(word.encode(), start)
                    if h % slip == 0:
                        tally[word] -= n
                        tally[_slipped(word, h)] += n
                if len(tally) > HELD:
                    yield _counted(tally, length)
                    tally = Counter()
        if tally:
            yield _counted(tally, length)

    return run


def _counted(tally: Counter, length: int) -> pa.RecordBatch:
    rows = [(w, n) for w, n in tally.items() if n and len(w) >= length]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], _WORDS.types[i]) for i in (0, 1)], schema=_WORDS)


def vocabulary(docs: DataFrame, length: int = LENGTH, occurrences: int = OCCURRENCES, slip: int = SLIP) -> DataFrame:
    """(word, n): words of whole texts, lower-cased in A-Z alone, as they stand once each run whose
    hash with its document's id is a multiple of ``slip`` has lost a character."""
    read = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.coalesce("text", F.lit("")).cast("binary").alias("data"))
    counted = read.mapInArrow(_counting(length, slip), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= occurrences)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``h``: blocks and bits are taken from it."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class _Batch:
    """Words as flat arrays: for each character its code, its word, its place and the hash before it."""

    def __init__(self, words: list[str]):
        data = [w.encode("latin-1") for w in words]
        self.lengths = np.array([len(d) for d in data], np.int64)
        self.codes = np.frombuffer(b"".join(data), np.uint8).astype(np.uint64)
        ends = np.cumsum(self.lengths)
        self.word = np.repeat(np.arange(len(data)), self.lengths)
        self.place = np.arange(len(self.codes)) - np.repeat(ends - self.lengths, self.lengths)
        powers = np.full(int(self.lengths.max()), _BASE, np.uint64)
        powers[0] = 1
        self.power = np.cumprod(powers, dtype=np.uint64)[self.place]
        through = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.codes * self.power, dtype=np.uint64)])
        first = through[ends - self.lengths]
        self.hashes = through[ends] - first
        self.before = through[:-1] - first[self.word]


class Shards:
    """Where the filter of each word length lies in one array of blocks, and which slice it holds."""

    def __init__(self, counts: dict[int, int], slices: int):
        self.lengths = np.array(sorted(counts), np.int64)
        self.sizes = np.array([max(1, ceil(counts[n] * BITS / 64 / slices)) for n in sorted(counts)], np.uint64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.uint64)
        self.slices = slices

    @classmethod
    def of(cls, words: DataFrame) -> Shards:
        """A row per word length comes to the driver."""
        counts = {r["length"]: r["count"] for r in words.groupBy(F.length("word").alias("length")).count().collect()}
        return cls(counts, max(1, ceil(sum(counts.values()) * BITS / 64 / MAX_BLOCKS)))

    def at(self, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, size) of the shards; a length without words has size 0."""
        found = np.minimum(np.searchsorted(self.lengths, lengths), len(self.lengths) - 1)
        known = self.lengths[found] == lengths
        return self.starts[found], np.where(known, self.sizes[found], np.uint64(0))

    def slice_of(self, h: np.ndarray) -> np.ndarray:
        return _mixed(h ^ np.uint64(_BASE)) % np.uint64(self.slices)


def _block(h: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    return start + (((h >> np.uint64(32)) * size) >> np.uint64(32))


def _bit(h: np.ndarray, i: int) -> np.ndarray:
    return (h >> np.uint64(6 * i)) & np.uint64(63)


def _entering(shards: Shards) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                words = _Batch(batch.column("word").to_pylist())
                h, mask = _mixed(words.hashes), np.zeros(len(batch), np.uint64)
                for i in range(SET):
                    mask |= np.uint64(1) << _bit(h, i)
                block = _block(h, *shards.at(words.lengths))
                yield pa.RecordBatch.from_pydict({
                    "slice": shards.slice_of(words.hashes).astype(np.int32), "block": block.astype(np.int64), "mask": mask.view(np.int64),
                })

    return run


def filters(words: DataFrame, shards: Shards) -> Iterator[np.ndarray]:
    """The filter of each slice, at most MAX_BLOCKS blocks and one per word length. Tasks set their
    words' bits, blocks are joined by OR, and only blocks come to the driver, a slice at a time."""
    bits = words.select("word").mapInArrow(_entering(shards), "slice int, block long, mask long")
    bits = bits.groupBy("slice", "block").agg(F.bit_or("mask").alias("mask"))
    bits = stored(bits) if shards.slices > 1 else bits
    for n in range(shards.slices):
        found = bits.filter(F.col("slice") == n).select("block", "mask").toArrow()
        out = np.zeros(int(shards.sizes.sum()), np.uint64)
        out[found["block"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
        yield out


def _held(blocks: np.ndarray, shards: Shards, n: int, h: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices of the hashes that slice ``n`` may hold."""
    if shards.slices > 1:
        some = np.flatnonzero((size > 0) & (shards.slice_of(h) == n))
    else:
        some = np.flatnonzero(size)
    m = _mixed(h[some])
    block = blocks[_block(m, start[some], size[some]).astype(np.int64)]
    for i in range(SET):
        left = np.flatnonzero((block >> _bit(m, i)) & np.uint64(1))
        some, m, block = some[left], m[left], block[left]
    return some


def _edits(words: _Batch, names: list[str], blocks: np.ndarray, shards: Shards, n: int, letters: np.ndarray, length: int) -> Iterator[tuple[int, str]]:
    """(word, edit) for each edit that the filter may hold."""
    # deletions: of a run of equal characters the first, as all give one word
    codes = words.codes
    fresh = np.ones(len(codes), bool)
    fresh[1:] = (codes[1:] != codes[:-1]) | (words.place[1:] == 0)
    at = np.flatnonzero(fresh & (words.lengths[words.word] > length))
    after = words.hashes[words.word[at]] - words.before[at] - codes[at] * words.power[at]
    h = words.before[at] + after * _INVERSE
    for i in at[_held(blocks, shards, n, h, *shards.at(words.lengths[words.word[at]] - 1))]:
        name, j = names[words.word[i]], words.place[i]
        yield words.word[i], name[:j] + name[j + 1:]
    # replacements by a larger character: with the characters in order, those below one come first
    order = np.argsort(codes, kind="stable")
    sorted_codes, power, whole = codes[order], words.power[order], words.hashes[words.word[order]]
    start, size = shards.at(words.lengths[words.word[order]])
    for x in letters:
        k = int(np.searchsorted(sorted_codes, x))
        h = whole[:k] + (x - sorted_codes[:k]) * power[:k]
        for i in order[_held(blocks, shards, n, h, start[:k], size[:k])]:
            name, j = names[words.word[i]], words.place[i]
            yield words.word[i], name[:j] + chr(int(x)) + name[j + 1:]


def _probing(blocks, shards: Shards, n: int, letters: np.ndarray, length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, counts = batch.column("word").to_pylist(), batch.column("n").to_pylist()
            many = np.cumsum([len(w) for w in names]) // PROBED
            cuts = [0, *(np.flatnonzero(np.diff(many)) + 1).tolist(), len(names)]
            for a, b in zip(cuts, cuts[1:]):
                if a < b:
                    found = list(_edits(_Batch(names[a:b]), names[a:b], blocks.value, shards, n, letters, length))
                    rows = [[names[a + w] for w, _ in found], [counts[a + w] for w, _ in found], [e for _, e in found]]
                    yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, _EDITS.types)], schema=_EDITS)

    return run


def near_words(spark: SparkSession, words: DataFrame, length: int = LENGTH) -> DataFrame:
    """(word, n, near, near_n), both ways, for words (distinct, of characters up to U+00FF, stored) of
    ``length`` or more characters that differ by one inserted, deleted or replaced character."""
    shards = Shards.of(words)
    if not len(shards.lengths):
        return words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n"))
    # 256 characters at most
    letters = np.array(sorted(ord(r[0]) for r in words.select(F.explode(F.split("word", ""))).distinct().collect() if r[0]), np.uint64)
    found = None
    for n, blocks in enumerate(filters(words, shards)):
        edits = words.mapInArrow(_probing(spark.sparkContext.broadcast(blocks), shards, n, letters, length), "word string, n long, near string")
        found = edits if found is None else found.union(edits)
    exact = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    links = stored(found.join(exact, "near").select("word", "n", "near", "near_n"))
    return links.unionAll(links.select("near", "near_n", "word", "n"))


def grouped(docs: DataFrame, length: int = LENGTH, occurrences: int = OCCURRENCES, factor: int = FACTOR, slip: int = SLIP) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of the vocabulary.

    ``form`` is the most frequent near word (of several the first in order of code points) if it
    occurs ``factor`` times as often or more, else null; ``root`` is the last word that forms lead
    to, the word itself without one. Forms grow by ``factor``, so they form no circle, and the
    rounds that find the roots are the logarithm of the longest chain the counts allow.

    Null texts have no words, a null doc_id is written as nothing before the colon. Repeated rows
    count as often as they occur. Texts without words and empty tables give no rows. Columns other
    than doc_id and text are not read.
    """
    if factor < 2:
        raise ValueError("forms have to be more frequent than their words by a factor of 2 or more")
    words = stored(vocabulary(docs, length, occurrences, slip))
    near = near_words(docs.sparkSession, words, length)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    rows = words.join(best, "word", "left").withColumn("form_n", -F.col("best.less"))
    formed = F.col("form_n") >= factor * F.col("n")
    rows = rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("best.near")).alias("form"), F.when(formed, F.col("form_n")).alias("form_n"),
    )
    rows = stored(rows)
    most = rows.agg(F.max("n")).first()[0] or 1
    steps = stored(rows.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    longest = max(1.0, log2(most) / log2(factor))
    for _ in range(ceil(log2(longest)) + 1):
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = stored(steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    return rows.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
