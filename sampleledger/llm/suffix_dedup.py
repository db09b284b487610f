"""Exact repeats across documents by bucket-pointer refinement, spread over a cluster.

Every place of a text is in a bucket with all places that start alike. Buckets of 8 bytes are the
bytes themselves; a bucket of 16 is named by the buckets of 8 at a place and 8 further on, one of 25
by those of 16 at a place and 9 further on, one of 50 by those of 25 at a place and 25 further on:
each refinement orders by bucket names of later offsets and reuses the names just made. Names are
64-bit hashes of names under a key drawn for the run: no text can be written to share a name with
another, and two different places share one by chance with probability 2 ** -64. Equal names are
not compared with the bytes again.

A place of 50 bytes (a *window*) may be removed if its bucket has a place in a document of smaller
id. Comparing all windows of a corpus would shuffle many times its size, so buckets are refined only
while they still hold several documents:

1. The *anchor* of a window is the smallest of its 26 buckets of 25 bytes, which equal windows share.
   Neighbouring windows share anchors, so a text has one anchor for about 14 bytes. Anchors that
   only one document has end here, and with them most of the text.
2. The windows in a row with one anchor are a *run*. Runs in one anchor bucket are refined by the
   buckets of 50 bytes at their first and last window. A run that a smaller document has whole is
   removed whole; buckets of one kind of run are done.
3. Only runs of mixed buckets are refined window by window.

What travels are packed arrays of names and ids, one row for a bucket and a task. A task settles
among its own documents what it can and sends one entry per name, so a passage that a third of all
documents share is a few bytes per task, not a group of documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from secrets import randbits

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleledger.llm.common import bounded_batches, give_back, own_name, quoted, stored, utf8_length

WINDOW, ANCHOR = 50, 25
REACH = WINDOW - ANCHOR + 1
#: Bytes that one numpy pass names, and bytes of a long text in one piece.
SLICE, PIECE = 1 << 18, 1 << 20
#: Bytes of text whose anchors a task settles among themselves.
BATCH = 8 << 20
#: Bytes of text for one bucket of anchors and for one group of documents.
BUCKET_BYTES, GROUP_BYTES = 4 << 20, 4 << 20
RESOLVED, MIXED, OLDER = 1, 2, 3

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_32, _29 = np.uint64(32), np.uint64(29)
_LOW = np.uint64(0x7FFFFFFF)


def refined(here: np.ndarray, later: np.ndarray) -> np.ndarray:
    """The names of the buckets with these names at a place and at a later one."""
    return keyed(here, later, (_A, _B))


def keyed(here: np.ndarray, later: np.ndarray, key: tuple[np.uint64, np.uint64]) -> np.ndarray:
    out = here * key[0]
    out ^= out >> _32
    out += later
    out *= key[1]
    out ^= out >> _29
    return out


def fresh_key() -> tuple[np.uint64, np.uint64]:
    """Two secret odd factors. Names are made with them, so no text can be written to share a name
    with another; they go to the tasks with the functions, so a repeated task names alike."""
    return np.uint64(randbits(64) | 1), np.uint64(randbits(64) | 1)


class Runs:
    """The runs of a slice of pieces: ``anchor``, ``name``, ``piece``, ``start`` (in the piece),
    ``count`` (windows); ``place`` is a run's first window in ``windows``, the names of all."""

    def __init__(self, pieces: list[bytes], first: int, key: tuple):
        data = np.frombuffer(b"".join(pieces), np.uint8)
        sizes = np.array([len(p) for p in pieces])
        ends = np.cumsum(sizes)
        n = len(data) - WINDOW + 1
        x = data.astype(np.uint64)
        x = x[:-1] | x[1:] << np.uint64(8)
        x = x[:-2] | x[2:] << np.uint64(16)
        x = x[:-4] | x[4:] << _32
        x = keyed(x[:-8], x[8:], key)
        x = keyed(x[:-9], x[9:], key)
        self.windows = keyed(x[:-ANCHOR], x[ANCHOR:], key)
        for step in (1, 2, 4, 8, REACH - 16):
            x = np.minimum(x[:-step], x[step:])
        owner = np.repeat(np.arange(len(pieces)), sizes)[:n]
        whole = np.arange(WINDOW, n + WINDOW) <= ends[owner]
        new = np.ones(n, bool)
        new[1:] = (x[1:] != x[:-1]) | (owner[1:] != owner[:-1]) | (whole[1:] != whole[:-1])
        start = np.flatnonzero(new)
        count = np.diff(np.append(start, n))
        start, count = start[whole[start]], count[whole[start]]
        if (count > REACH).any():  # repetitive text; a run's two ends have to overlap
            parts = -(-count // REACH)
            nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            count = np.minimum(np.repeat(count, parts) - nth * REACH, REACH)
            start = np.repeat(start, parts) + nth * REACH
        self.place, self.count, self.anchor = start, count, x[start]
        self.name = keyed(keyed(self.windows[start], self.windows[start + count - 1], key), count.astype(np.uint64), key)
        self.piece, self.start = owner[start] + first, start - (ends - sizes)[owner[start]]

    def expanded(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(run, index into ``windows``) of every window of some runs."""
        count = self.count[some]
        run = np.repeat(some, count)
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return run, self.place[run] + nth


def runs_of(pieces: list[bytes], key: tuple) -> Iterator[Runs]:
    held, size, first = [], 0, 0
    for i, piece in enumerate(pieces):
        held.append(piece)
        size += len(piece)
        if size >= SLICE or i == len(pieces) - 1:
            if size >= WINDOW:
                yield Runs(held, first, key)
            held, size, first = [], 0, i + 1


def cut_up(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Pieces that have every window once, with each one's text and offset."""
    pieces, owner, offset = [], [], []
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - WINDOW + 1), PIECE):
            pieces.append(text[at : at + PIECE + WINDOW - 1])
            owner.append(i)
            offset.append(at)
    return pieces, np.array(owner, np.int64), np.array(offset, np.int64)


# --- packed rows -----------------------------------------------------------------------------------


def group_of(docs: np.ndarray, groups: int) -> np.ndarray:
    return ((refined(docs.view(np.uint64), _A) >> _32) % np.uint64(groups)).astype(np.int64)


def packed(at: np.ndarray, kind: int, *columns: np.ndarray) -> list[tuple]:
    """One row (at, kind, columns as bytes) for each value of ``at``; entries go by the first column."""
    order = np.lexsort((columns[0], at))
    at, columns = at[order], [c[order] for c in columns]
    edges = np.flatnonzero(np.r_[True, at[1:] != at[:-1], True]) if len(at) else []
    return [(int(at[a]), kind, *(c[a:b].tobytes() for c in columns)) for a, b in zip(edges[:-1], edges[1:])]


def framed(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["at", "kind", "docs", "names", "more"]).astype({"at": "int64", "kind": "int32"})


PACKED = "at long, kind int, docs binary, names binary, more binary"


def unpacked(frame: pd.DataFrame, kind: int | None, names: str = "<u8", more: str = "u1") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    some = frame if kind is None else frame[frame["kind"] == kind]
    return tuple(np.frombuffer(b"".join(some[c]), t) for c, t in (("docs", "<i8"), ("names", names), ("more", more)))


def firsts(*columns: np.ndarray) -> np.ndarray:
    """Marks the first row of each run of equal rows."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def per_group(new: np.ndarray, values: np.ndarray, how: np.ufunc) -> np.ndarray:
    """``how`` over each group, repeated for its rows; ``new`` marks where groups begin."""
    if not len(new):
        return values
    return how.reduceat(values, np.flatnonzero(new))[np.cumsum(new) - 1]


# --- 1: anchors ------------------------------------------------------------------------------------


def short(anchors: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """An anchor's bucket and 31 bits inside it. This only chooses what is looked at closer."""
    mixed = refined(anchors, _A)
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64), (mixed & _LOW).astype(np.uint32)


def long_name(bucket: np.ndarray, low: np.ndarray) -> np.ndarray:
    return bucket.astype(np.uint64) << np.uint64(31) | low.astype(np.uint64)


def send_anchors(buckets: int, key: tuple):
    def settle(anchors: list[np.ndarray], docs: list[np.ndarray]) -> pd.DataFrame:
        anchor, doc = np.concatenate(anchors), np.concatenate(docs)
        order = np.lexsort((doc, anchor))
        anchor, doc = anchor[order], doc[order]
        once = firsts(anchor, doc)
        anchor, doc = anchor[once], doc[once]
        new = firsts(anchor)
        several = per_group(new, np.ones(len(new), np.int64), np.add) > 1
        bucket, low = short(anchor, buckets)
        flagged = low | several.astype(np.uint32) << np.uint32(31)
        rows = packed(bucket[new], 0, doc[new], flagged[new], np.zeros(int(new.sum()), "u1"))
        known = long_name(bucket[several], low[several])
        return framed(rows + packed(group_of(doc[several], buckets), 1, doc[several], known, np.zeros(len(known), "u1")))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchors, docs, size = [], [], 0
        for frame in frames:
            ids = frame["doc_id"].to_numpy(np.int64)
            pieces, owner, _ = cut_up([t.encode("utf-8", "replace") for t in frame["text"]])
            for runs in runs_of(pieces, key):
                anchors.append(runs.anchor)
                docs.append(ids[owner[runs.piece]])
                size += len(runs.windows)
                if size >= BATCH:
                    yield settle(anchors, docs)
                    anchors, docs, size = [], [], 0
        if anchors:
            yield settle(anchors, docs)
        give_back()

    return run


def shared_anchors(groups: int):
    """Of one bucket: (document, anchor) for every anchor of several documents."""

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        doc, low, _ = unpacked(frame, 0, "<u4")
        order = np.lexsort((doc, low & np.uint32(_LOW)))
        doc, low = doc[order], low[order]
        flag, low = low >> np.uint32(31), low & np.uint32(_LOW)
        new = firsts(low)
        shared = (per_group(new, doc, np.minimum) != per_group(new, doc, np.maximum)) | (per_group(new, flag, np.maximum) > 0)
        more_docs, more_names, _ = unpacked(frame, 1)
        doc = np.concatenate([doc[shared], more_docs])
        name = np.concatenate([long_name(np.full(int(shared.sum()), key[0]), low[shared]), more_names])
        return framed(packed(group_of(doc, groups), 0, doc, name, np.zeros(len(doc), "u1")))

    return run


# --- 2: runs ---------------------------------------------------------------------------------------


def owner_names(owner: np.ndarray) -> np.ndarray:
    return refined(owner.astype(np.uint64), _B)


class Answers:
    """The (document, name) pairs of some answers. A table of low bits lets few names through to
    the search among all of them."""

    def __init__(self, docs: np.ndarray, names: np.ndarray):
        self.known = np.unique(refined(names, owner_names(docs)))
        bits = max(16, min(24, len(self.known).bit_length() + 4))
        self.mask = np.uint64((1 << bits) - 1)
        self.table = np.zeros(1 << bits, bool)
        self.table[(self.known & self.mask).view(np.int64)] = True

    def have(self, owner_names_: np.ndarray, names: np.ndarray) -> np.ndarray:
        """Which names their owners' answers hold."""
        keys = refined(names, owner_names_)
        found = np.zeros(len(keys), bool)
        near = np.flatnonzero(self.table[(keys & self.mask).view(np.int64)])
        if len(near):
            place = np.minimum(np.searchsorted(self.known, keys[near]), len(self.known) - 1)
            found[near] = self.known[place] == keys[near]
        return found


def candidates(buckets: int, key: tuple):
    """Of one group of documents: the stretches of text whose anchors are shared."""

    def run(at: tuple, texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = ["at", "doc_id", "tag", "data", "starts", "counts"]
        ids, tags = texts["doc_id"].to_numpy(np.int64), texts["tag"].to_numpy(np.int64)
        wanted, hashed = Answers(*unpacked(answers, None)[:2]), owner_names(ids)
        unzip = zstandard.ZstdDecompressor().decompress
        raw = [unzip(x) for x in texts["data"]]
        pieces, owner, offset = cut_up(raw)
        none = np.empty(0, np.int64)
        parts = [(none, none, none)]
        for runs in runs_of(pieces, key):
            mine = owner[runs.piece]
            good = wanted.have(hashed[mine], long_name(*short(runs.anchor, buckets)))
            if good.any():
                mine, start, count = mine[good], runs.start[good] + offset[runs.piece[good]], runs.count[good]
                # runs that follow on each other are one stretch
                new = np.ones(len(mine), bool)
                new[1:] = (mine[1:] != mine[:-1]) | (start[1:] != start[:-1] + count[:-1])
                parts.append((mine[new], start[new], np.add.reduceat(count, np.flatnonzero(new))))
        mine, start, count = (np.concatenate(c) for c in zip(*parts))
        # the bytes of all stretches, one after the other
        data = np.frombuffer(b"".join(raw), np.uint8)
        first = np.cumsum([0] + [len(x) for x in raw])[mine] + start
        size = count + WINDOW - 1
        ends = np.cumsum(size)
        bytes_ = data[np.repeat(first - (ends - size), size) + np.arange(size.sum())] if len(size) else data[:0]
        zip_ = zstandard.ZstdCompressor(level=1).compress
        rows = []
        for i in np.unique(mine).tolist():
            a, b = np.searchsorted(mine, [i, i + 1])
            some = bytes_[ends[a] - size[a] : ends[b - 1]].tobytes()
            rows.append((at[0], int(ids[i]), int(tags[i]), zip_(some), start[a:b].astype("<i8").tobytes(), count[a:b].astype("<i8").tobytes()))
        return pd.DataFrame(rows, columns=columns).astype({"at": "int64", "doc_id": "int64", "tag": "int64"})

    return run


STRETCHES = "at long, doc_id long, tag long, data binary, starts binary, counts binary"


def stretches_of(frame: pd.DataFrame) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The stretches as pieces, with each one's row in ``frame`` and offset in the document."""
    unzip = zstandard.ZstdDecompressor().decompress
    pieces, owner, offset = [], [], []
    for i, (data, starts, counts) in enumerate(zip(frame["data"], frame["starts"], frame["counts"])):
        data, at = unzip(data), 0
        for a, c in zip(np.frombuffer(starts, "<i8").tolist(), np.frombuffer(counts, "<i8").tolist()):
            for part in range(0, c, PIECE):
                pieces.append(data[at + part : at + min(c, part + PIECE) + WINDOW - 1])
                owner.append(i)
                offset.append(a + part)
            at += c + WINDOW - 1
    return pieces, np.array(owner, np.int64), np.array(offset, np.int64)


def send_runs(buckets: int, key: tuple):
    """Rows of kind 0 are open (anchor, name), of kind 1 known answers; a name of 0 tells that an
    anchor has several kinds of runs."""

    def settle(parts: list[tuple]) -> pd.DataFrame:
        anchor, name, doc = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((doc, name, anchor))
        anchor, name, doc = anchor[order], name[order], doc[order]
        once = firsts(anchor, name, doc)
        anchor, name, doc = anchor[once], name[once], doc[once]
        kind = firsts(anchor, name)
        of_anchor = firsts(anchor)
        smallest = per_group(kind, doc, np.minimum)
        mixed = per_group(of_anchor, kind.astype(np.int64), np.add) > 1
        resolved = doc > smallest
        explode = mixed & ~resolved
        open_ = ~mixed & ~resolved
        tells = mixed & of_anchor
        sent = np.concatenate([anchor[open_], anchor[tells]])
        names = np.concatenate([name[open_], np.zeros(int(tells.sum()), np.uint64)])
        docs = np.concatenate([doc[open_], doc[tells]])
        rows = packed(short(sent, buckets)[0], 0, docs, names, sent)
        for some, status in ((resolved, RESOLVED), (explode, MIXED)):
            rows += packed(group_of(doc[some], buckets), 1, doc[some], name[some], np.full(int(some.sum()), status, np.uint64))
        return framed(rows)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, size = [], 0
        for frame in frames:
            ids = frame["doc_id"].to_numpy(np.int64)
            pieces, owner, _ = stretches_of(frame)
            for runs in runs_of(pieces, key):
                parts.append((runs.anchor, runs.name, ids[owner[runs.piece]]))
                size += len(runs.windows)
                if size >= BATCH:
                    yield settle(parts)
                    parts, size = [], 0
        if parts:
            yield settle(parts)
        give_back()

    return run


def refined_runs(groups: int):
    """Of one bucket: (document, run, RESOLVED or MIXED) for runs that need no or more looking at."""

    def run(_: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        doc, name, anchor = unpacked(frame, 0, "<u8", "<u8")
        order = np.lexsort((doc, name, anchor))
        doc, name, anchor = doc[order], name[order], anchor[order]
        of_anchor, kind = firsts(anchor), firsts(anchor, name)
        mixed = per_group(of_anchor, kind.astype(np.int64), np.add) > 1
        mixed |= per_group(of_anchor, (name == 0).astype(np.int64), np.maximum) > 0
        resolved = doc > per_group(kind, doc, np.minimum)
        status = np.where(resolved, RESOLVED, np.where(mixed, MIXED, 0)).astype(np.uint64)
        tell = (status > 0) & (name != 0)
        known_docs, known_names, known = unpacked(frame, 1, "<u8", "<u8")
        doc, name = np.concatenate([doc[tell], known_docs]), np.concatenate([name[tell], known_names])
        return framed(packed(group_of(doc, groups), 0, doc, name, np.concatenate([status[tell], known]).astype("u1")))

    return run


# --- 3: windows ------------------------------------------------------------------------------------


def send_windows(buckets: int, key: tuple):
    def run(_: tuple, frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        ids = frame["doc_id"].to_numpy(np.int64)
        docs, names, status = unpacked(answers, 0)
        wanted = Answers(docs[status == MIXED], names[status == MIXED])
        found_names, found_docs = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        pieces, owner, _ = stretches_of(frame)
        for runs in runs_of(pieces, key):
            mine = ids[owner[runs.piece]]
            run_, window = runs.expanded(np.flatnonzero(wanted.have(owner_names(mine), runs.name)))
            found_names.append(runs.windows[window])
            found_docs.append(mine[run_])
        name, doc = np.concatenate(found_names), np.concatenate(found_docs)
        order = np.lexsort((doc, name))
        name, doc = name[order], doc[order]
        once = firsts(name, doc)
        name, doc = name[once], doc[once]
        first = firsts(name)
        rows = packed(short(name[first], buckets)[0], 0, doc[first], name[first], np.zeros(int(first.sum()), "u1"))
        rest = ~first
        return framed(rows + packed(group_of(doc[rest], buckets), 1, doc[rest], name[rest], np.zeros(int(rest.sum()), "u1")))

    return run


def older_windows(groups: int):
    def run(_: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        doc, name, _ = unpacked(frame, 0)
        order = np.lexsort((doc, name))
        doc, name = doc[order], name[order]
        older = doc > per_group(firsts(name), doc, np.minimum)
        known_docs, known_names, _ = unpacked(frame, 1)
        doc, name = np.concatenate([doc[older], known_docs]), np.concatenate([name[older], known_names])
        return framed(packed(group_of(doc, groups), 1, doc, name, np.full(len(doc), OLDER, "u1")))

    return run


# --- the result ------------------------------------------------------------------------------------


def removed(data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[int, int, bytes]:
    """(bytes removed, maximal runs of them, what is left) once the spans of bytes go."""
    if not len(starts):
        return 0, 0, data
    edge = np.bincount(starts, minlength=len(data) + 1) - np.bincount(ends, minlength=len(data) + 1)
    gone = np.cumsum(edge[: len(data)]) > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), runs, np.frombuffer(data, np.uint8)[~gone].tobytes()


def _results(with_text: bool, carried: bool, key: tuple):
    def run(_: tuple, frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        stretches = frame[frame["starts"].notna()].reset_index(drop=True)
        texts = frame[frame["starts"].isna()]
        docs, names, status = unpacked(answers, None)
        whole, mixed, older = (Answers(docs[status == k], names[status == k]) for k in (RESOLVED, MIXED, OLDER))
        ids, tags = stretches["doc_id"].to_numpy(np.int64), stretches["tag"].to_numpy(np.int64)
        hashed = owner_names(ids)
        none = np.empty(0, np.int64)
        spans = [(none, none, none)]
        pieces, owner, offset = stretches_of(stretches)
        for runs in runs_of(pieces, key):
            row = owner[runs.piece]
            first = runs.start + offset[runs.piece]
            some = whole.have(hashed[row], runs.name)
            run_, window = runs.expanded(np.flatnonzero(~some & mixed.have(hashed[row], runs.name)))
            hit = older.have(hashed[row[run_]], runs.windows[window])
            run_, window = run_[hit], window[hit]
            at = first[run_] + window - runs.place[run_]
            spans += [(row[some], first[some], (first + runs.count)[some]), (row[run_], at, at + 1)]
        row, start, end = (np.concatenate(c) for c in zip(*spans))
        order = np.argsort(row, kind="stable")
        row, start, end = row[order], start[order], end[order] + WINDOW - 1
        bounds = np.searchsorted(row, np.arange(len(ids) + 1))
        place = {(int(i), int(t)): k for k, (i, t) in enumerate(zip(ids, tags))}
        unzip = zstandard.ZstdDecompressor().decompress
        rows = []
        for id_, tag, data in zip(texts["doc_id"], texts["tag"], texts["data"]):
            data = unzip(data)
            k = place.get((int(id_), int(tag)))
            a, b = (bounds[k], bounds[k + 1]) if k is not None else (0, 0)
            n, runs_, kept = removed(data, start[a:b], end[a:b])
            rows.append((int(id_), len(data), n, runs_, sha256(kept).hexdigest(), kept if with_text else None))
        out = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
        out = out.astype({"doc_id": "int64", "n_bytes": "int64", "n_removed": "int64", "n_spans": "int64"})
        return out.assign(rest=texts["rest"].to_numpy()) if carried else out

    return run


def _zipped(groups: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            zip_ = zstandard.ZstdCompressor(level=1).compress
            data = [zip_(t.encode("utf-8", "replace")) for t in frame["text"]]
            yield frame.drop(columns="text").assign(at=group_of(frame["doc_id"].to_numpy(np.int64), groups), data=data)
        give_back()

    return run


def _fields(ddl: str) -> list[T.StructField]:
    return T.StructType.fromDDL(ddl).fields


def without_repeats(docs: DataFrame, with_text: bool = False, carry: list[str] | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept[, rest]): each text without the bytes
    covered by a 50-byte string that also starts in a document of smaller id.

    Strings are judged on the texts as they are; overlaps count, and nothing matches across two
    documents. ``kept`` holds the remaining bytes if ``with_text``, else null; ``rest`` the columns
    in ``carry`` as a struct. Null texts are empty. Texts under 50 bytes stay. Rows that share a
    doc_id do not remove each other. Rows without a doc_id have no order, so they stay whole and
    remove nothing. Of equal texts the one of smallest id keeps its bytes.
    """
    bounded_batches(docs.sparkSession)
    carry = carry or []
    rest, key = F.struct(*map(quoted, carry)).alias("rest"), fresh_key()
    text = F.coalesce("text", F.lit("")).alias("text")
    rows = docs.select("doc_id", text, F.xxhash64(text).alias("tag"), *([rest] if carry else []))
    rest_field = [rows.schema["rest"]] if carry else []
    named, nameless = rows.filter("doc_id IS NOT NULL"), rows.filter("doc_id IS NULL")
    total = named.agg(F.sum(utf8_length(F.col("text")))).first()[0] or 0
    buckets, groups = total // BUCKET_BYTES + 1, total // GROUP_BYTES + 1

    anchors = named.select("doc_id", "text").mapInPandas(send_anchors(buckets, key), PACKED)
    answers = anchors.groupBy("at").applyInPandas(shared_anchors(groups), PACKED)
    zipped = named.select("doc_id", "tag", "text").mapInPandas(_zipped(groups), "doc_id long, tag long, at long, data binary")
    stretches = stored(zipped.groupBy("at").cogroup(answers.groupBy("at")).applyInPandas(candidates(buckets, key), STRETCHES))

    runs = stretches.mapInPandas(send_runs(buckets, key), PACKED)
    judged = stored(runs.groupBy("at").applyInPandas(refined_runs(groups), PACKED))
    windows = stretches.groupBy("at").cogroup(judged.groupBy("at")).applyInPandas(send_windows(buckets, key), PACKED)
    older = windows.groupBy("at").applyInPandas(older_windows(groups), PACKED)

    texts = named.mapInPandas(_zipped(groups), T.StructType([*_fields("doc_id long, tag long"), *rest_field, *_fields("at long, data binary")]))
    blank = [F.lit(None).cast(t).alias(c) for c, t in (("starts", "binary"), ("counts", "binary"))]
    left = texts.select("*", *blank).unionByName(stretches, allowMissingColumns=True)
    kind = T.StructType([*_fields("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"), *rest_field])
    found = left.groupBy("at").cogroup(judged.unionByName(older).groupBy("at")).applyInPandas(_results(with_text, bool(carry), key), kind)

    data = F.col("text").cast("binary")
    whole = nameless.select(
        F.col("doc_id").cast("long").alias("doc_id"), utf8_length(F.col("text")).alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2(data, 256).alias("kept_sha256"), (data if with_text else F.lit(None).cast("binary")).alias("kept"),
        *(["rest"] if carry else []),
    )
    return found.unionByName(whole)


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeats taken out of ``text``; ``n_chars``, if there, counts what is left.

    Every row stays, emptied ones too. Bytes go where they repeat, so a character may be cut; what
    is left of it goes as well. Other columns stay as they are. Null texts stay null.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    null = own_name(docs, "_null")
    marked = docs.withColumn(null, F.col("text").isNull())
    found = without_repeats(marked, with_text=True, carry=[*others, null])

    @F.pandas_udf("string")
    def readable(kept: pd.Series) -> pd.Series:
        return pd.Series([bytes(x).decode("utf-8", "ignore") for x in kept])

    out = found.withColumn("text", F.when(~F.col("rest").getField(null), readable("kept")))
    out = out.select("doc_id", "text", *[F.col("rest").getField(c).alias(c) for c in others]).select(*map(quoted, docs.columns))
    return out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in others else out
