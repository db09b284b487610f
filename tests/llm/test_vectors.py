"""The operators on embeddings, on odd vectors and against plain versions."""

import numpy as np
import pytest

from sampleledger.llm import embedding_dedup, topk
from tests.llm.test_documents import plain_components

SCHEMA = "vec_id long, embedding array<float>, label int, v int, rep int, rank int, score int, block int, cell int"
EXTRA = (1,) * 7


def frame(spark, rows):
    return spark.createDataFrame([(i, v) + EXTRA for i, v in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    out = []
    for i in range(60):
        base = rng.normal(size=16)
        out.append(base)
        for _ in range(rng.integers(0, 5)):
            out.append((base + rng.normal(size=16) * rng.uniform(0.02, 0.12)) * rng.uniform(0.1, 30))
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(out)]
    same = rows[0][1]
    rows += [(1000 + i, same) for i in range(30)]  # copies
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [1.0, None] + [0.0] * 14), (2004, [float("nan")] + [1.0] * 15)]
    rows += [(2005, [float("inf")] + [1.0] * 15), (2006, [1.0, 2.0]), (2007, [2.0, 4.0]), (2008, [1e-30] * 16), (2009, [1e30] * 16)]
    rows += [(3, rows[3][1]), (None, same), (None, [5.0, -1.0])]  # a repeated row, rows without an id
    return rows


def good(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v)


def test_links_against_every_pair(spark, rows, monkeypatch):
    n = len(rows)
    close = []
    for i in range(n):
        for j in range(i):
            a, b = rows[i][1], rows[j][1]
            if good(a) and good(b) and len(a) == len(b) and any(a) and any(b):
                x, y = np.array(a) / max(map(abs, a)), np.array(b) / max(map(abs, b))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.95:
                    close.append((i, j))
    counts = np.zeros(n, int)
    for i, j in close:
        counts[i] += 1
        counts[j] += 1
    roots = plain_components([i for i, _ in rows], close)
    want = sorted(((i, int(c), r, i is not None and i == r) for (i, _), c, r in zip(rows, counts, roots)), key=str)
    for part in (2048, 20):
        monkeypatch.setattr(embedding_dedup, "PART", part)
        found = embedding_dedup.near_duplicates(frame(spark, rows).repartition(4))
        assert sorted(map(tuple, found.collect()), key=str) == want


def test_vectors_that_share_an_id_are_vectors_of_their_own(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(5, a), (5, b), (6, [1.0, 0.01, 0.0]), (7, [1.0, 0.02, 0.0]), (8, [0.0, 1.0, 0.01]), (4, [0.0, 1.0, 0.02])]
    found = embedding_dedup.near_duplicates(frame(spark, rows))
    want = [(4, 2, 4, True), (5, 2, 4, False), (5, 2, 5, True), (6, 2, 5, False), (7, 2, 5, False), (8, 2, 4, False)]
    assert sorted(map(tuple, found.collect())) == want


def test_a_pair_at_the_threshold_is_found():
    assert embedding_dedup.calibrated_count() == embedding_dedup.PROJECTIONS - 1
    rng = np.random.default_rng(9)
    units, n = [], 400
    for _ in range(n):
        a, b = np.linalg.qr(rng.normal(size=(32, 2)))[0].T
        units += [a, 0.9501 * a + np.sqrt(1 - 0.9501**2) * b]
    units = np.array(units)
    found = {(i, j) for a, b in embedding_dedup.linked(units, len(units), True, 0.95, 4 * np.sqrt(0.1), 23) for i, j in zip(a.tolist(), b.tolist())}
    assert {(2 * i, 2 * i + 1) for i in range(n)} <= found


def test_no_vectors(spark):
    assert embedding_dedup.near_duplicates(frame(spark, [])).count() == 0
    lonely = embedding_dedup.near_duplicates(frame(spark, [(1, None), (2, [0.0])]))
    assert sorted(map(tuple, lonely.collect())) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert topk.top_k(frame(spark, []), topk.F.col("vec_id") % 50 == 0).count() == 0


def plain_top(rows, k):
    known = {i: v for i, v in rows if i is not None and good(v)}
    out = []
    for q in (i for i in known if i % 7 == 0):
        scaled = {i: [int(np.floor(256 * float(np.float32(x)))) for x in v] for i, v in known.items() if len(v) == len(known[q])}
        ranked = sorted((-sum(a * b for a, b in zip(scaled[q], v)), i) for i, v in scaled.items() if i != q)
        out += [(q, r, i, -s) for r, (s, i) in enumerate(ranked[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [8192, 30])
def test_top_k_against_all(spark, rows, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES", max(block // 10, 3))
    usable = [(i, v) for i, v in rows if i not in (2008, 2009)]  # scores of these do not fit
    found = topk.top_k(frame(spark, usable), topk.F.col("vec_id") % 7 == 0)
    assert sorted(map(tuple, found.collect())) == plain_top(usable, 5)


def test_top_k_takes_every_vector_of_a_shared_id(spark):
    rows = [(7, [1.0, 0.0]), (1, [3.0, 0.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0]), (3, [0.5, 0.0])]
    found = topk.top_k(frame(spark, rows), topk.F.col("vec_id") % 7 == 0, 3)
    assert sorted(map(tuple, found.collect())) == [(7, 1, 1, 3 << 16), (7, 2, 1, 2 << 16), (7, 3, 2, 1 << 16)]


def test_the_walk_stops_early_and_is_exact():
    rng = np.random.default_rng(2)
    vectors = np.floor(rng.normal(size=(500, 4)) * 100).astype(np.int64)
    vectors[7] = vectors[3]
    ids = rng.permutation(500).astype(np.int64)
    queries = np.concatenate([vectors[:20], np.zeros((1, 4), np.int64), [[0, 3, 0, 0]]])
    own = np.concatenate([ids[:20], [-1, -1]])
    found = topk.best(vectors, ids, queries, own, 5)
    for row, query in enumerate(queries):
        ranked = sorted((-int(s), int(i)) for s, i in zip(vectors @ query, ids) if i != own[row])[:5]
        assert [(s, i) for r, i, s in found if r == row] == [(-s, i) for s, i in ranked]
