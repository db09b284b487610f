"""Divergence of sources, spelling variants and archives, on odd rows and against plain versions."""

import base64
import hashlib
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import pytest

from sampleledger.llm import divergence, spelling, warc
from tests.llm import odd

UPPER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def docs(spark):
    return odd.documents(spark).repartition(3).cache()


# 11: divergence of sources


def plain_divergences(rows, min_docs, top):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
        counts[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = []
    for lang in {g[0] for g in counts}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]

        def share(of):
            size = sum(of[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (of[t] + 5) // size for t in kept}

        sources = [s for x, s in counts if x == lang]
        shares = {s: share(counts[lang, s]) for s in sources}
        whole = share(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            far = sorted((-sum(abs(shares[s][t] - shares[o][t]) for t in kept), o.encode()) for o in sources if o != s)
            more = sorted((whole[t] - shares[s][t], t.encode()) for t in kept if counts[lang, s][t] and shares[s][t] > whole[t])[:top]
            for part, found in (("pair", far), ("term", more)):
                out += [(lang, s, part, item.decode(), -v, i) for i, (v, item) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [divergence.BLOCK, 3])
def test_divergences_against_a_plain_version(spark, docs, monkeypatch, block):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "LARGEST_BLOCK", block)
    monkeypatch.setattr(divergence, "HELD", 7)
    rng, vocabulary = random.Random(1), [odd.prose(i, 1) for i in range(25)] + ["É", "é", "日本", "Abc", "aBC"]
    rows = [tuple(r) for r in docs.select("lang", "source", "text").collect()]
    for _ in range(300):  # sources of very different sizes, so that a small one's baseline is above a large one's shares
        words = " ".join(rng.choices(vocabulary, k=rng.randint(0, 40)))
        rows.append((rng.choice(["en", "en", "xx", None]), rng.choice(["a", "a", "a", "b", "c", None, ""]), words))
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "lang string, source string, text string, n int, p int")
    found = sorted(map(tuple, divergence.divergences(frame, 5, 4).collect()))
    assert found == plain_divergences(rows, 5, 4)
    assert any(v > 0 for *_, v, _ in found)


def test_divergences_without_terms(spark, docs):
    assert divergence.divergences(odd.nothing(spark)).count() == 0
    found = divergence.divergences(docs, min_docs=1000).collect()
    assert found and all(r["value"] == 0 and r["part"] == "pair" for r in found)


# 12: spelling variants


def plain_variants(rows, length=6, occurrences=5, factor=5, slip=199):
    counts = Counter()
    for id_, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = crc32(f"{'' if id_ is None else id_}:{run}".encode())
            if h % slip == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= length and n >= occurrences}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        short, long = sorted((a, b), key=len)
        return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))

    form, out = {}, []
    for a, n in words.items():
        others = [b for b in words if near(a, b)]
        best = min(others, key=lambda b: (-words[b], b), default=None)
        form[a] = best if best and words[best] >= factor * n else None
        out.append((a, n, len(others)))
    rows = []
    for a, n, many in out:
        root = a
        while form[root]:
            root = form[root]
        rows.append((a, form[a], root, n, many, words[form[a]] if form[a] else None))
    return sorted(rows)


@pytest.mark.parametrize("blocks", [spelling.MAX_BLOCKS, 40])
def test_variants_against_a_plain_version(spark, docs, monkeypatch, blocks):
    monkeypatch.setattr(spelling, "MAX_BLOCKS", blocks)
    monkeypatch.setattr(spelling, "PROBED", 50)
    monkeypatch.setattr(spelling, "HELD", 30)
    rng, words = random.Random(2), []
    for n in range(60):
        word = "".join(rng.choice("aabÿÀ×e") for _ in range(rng.randint(6, 9)))
        for k in range(4):  # chains of ever rarer variants
            words += [word] * max(1, 300 // 6**k)
            at = rng.randrange(len(word))
            word = word[:at] + rng.choice(["", "b", "Àa", "é"]) + word[at + (k != 2):]
    rng.shuffle(words)
    rows = [(i % 90 or None, " ".join(words[i::400])) for i in range(400)] + [(7, "x" * 300 + " " + "X" * 300)] * 3 + [(8, "x" * 301)] * 5
    rows += [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    frame = spark.createDataFrame([(*r, 1, "w") for r in rows], "doc_id long, text string, n int, word string")
    found = sorted(map(tuple, spelling.grouped(frame, slip=7).collect()))
    assert found == plain_variants(rows, slip=7)
    assert any(form and root != form for _, form, root, *_ in found) and any(len(w) > 250 and n for w, *_, n, _ in found)


def test_variants_of_nothing(spark):
    assert spelling.grouped(odd.nothing(spark)).count() == 0
    with pytest.raises(ValueError):
        spelling.grouped(odd.nothing(spark), factor=1)


# 13: archives


def plain_archive(rows, at_least=0):
    first = {}
    for page, _, html in rows:
        first.setdefault(html or "", []).append(page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        known = [p for p in first[html or ""] if p is not None]
        of = max(known) if known else None
        again = len(data) >= at_least and page != of
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", of if again else None))
    return sorted(out, key=str)


def record(body, size=None):
    return f"{warc.MAGIC}WARC-Type: response\r\nContent-Length: {len(body) if size is None else size}\r\n\r\n{body}\r\n\r\n"


PAGES = [
    (1, "u", None), (2, "u", ""), (3, None, warc.MAGIC), (4, "x\r\nWARC-Type: evil", warc.MAGIC * 50), (5, "u", record("abc") * 3), (6, "u", record("abc", 10**6)),
    (None, "u", "same"), (7, "u", "same"), (7, "u", "same"), (8, "u", "same"), (9, "u", "é" * 3000 + record("é")), (10, "u", "W" * 100 + "WARC/1.1\r" + "\r\n\r\n" * 30),
    (11, "u", record("x" * 500) + "tail"), (12, "u", "a" * 20000 + record("q", 200000) + "b" * 20000 + warc.MAGIC + "c" * 9000), (None, "u", "only null"),
]


@pytest.fixture
def archive(spark, tmp_path):
    rng, rows = random.Random(5), list(PAGES)
    for i in range(20, 50):
        some = [rng.choice([warc.MAGIC, record("z" * rng.randint(0, 50)), record("y", rng.randint(0, 3000)), "WARC/1", "\r\n\r\n", "p" * rng.randint(0, 900)]) for _ in range(rng.randint(0, 9))]
        rows.append((i, f"http://x/{i}", "".join(some)))
    pages = spark.createDataFrame([(*r, 0, "f") for r in rows], "page_id long, url string, html string, block int, file string")
    return rows, pages, str(tmp_path / "archive")


@pytest.mark.parametrize("split, entries", [(128 << 20, warc.ENTRIES), (4099, 2), (997, warc.ENTRIES)])
def test_archives_are_read_back_whatever_the_splits(spark, archive, monkeypatch, split, entries):
    monkeypatch.setattr(warc, "ENTRIES", entries)
    rows, pages, folder = archive
    warc.write(pages.coalesce(2), folder)
    assert sorted(map(tuple, warc.page_records(spark, folder, split).collect()), key=str) == plain_archive(rows)


def test_short_payloads_are_not_revisited(spark, archive):
    rows, pages, folder = archive
    warc.write(pages, folder, at_least=5)
    assert sorted(map(tuple, warc.page_records(spark, folder).collect()), key=str) == plain_archive(rows, 5)


def test_headers_and_payloads_come_back(spark, archive):
    _, pages, folder = archive
    warc.write(pages.filter("page_id = 4"), folder)
    found = warc.records(spark, folder).collect()
    assert len(found) == 1 and bytes(found[0]["payload"]).decode() == warc.MAGIC * 50
    assert found[0]["headers"]["warc-target-uri"] == "x%0D%0AWARC-Type: evil" and found[0]["headers"]["warc-type"] == "response"


def test_a_file_cut_short_is_an_error(spark, archive, tmp_path):
    _, pages, folder = archive
    warc.write(pages.coalesce(1), folder)
    data = next(p for p in (tmp_path / "archive").glob("part-*") if p.stat().st_size).read_bytes()
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "a.warc").write_bytes(data[:-5000])
    with pytest.raises(ValueError, match="end of the file"):
        warc.records(spark, str(tmp_path / "cut"))


def test_archives_of_nothing(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(empty).count() == 0
