"""What several operators rest on: components, names of buckets, terms, columns that clash."""

import random

import pytest

from sampleledger.llm import components, simhash, suffix_dedup, toxicity
from tests.llm import odd


@pytest.mark.parametrize("seed", [None, 1])
def test_components_take_logarithmic_rounds(spark, monkeypatch, seed):
    n, cuts = 4096, []
    monkeypatch.setattr(components, "cut", lambda df, cut=components.cut: cuts.append(1) or cut(df))
    order = list(range(n))
    if seed:
        random.Random(seed).shuffle(order)
    links = spark.createDataFrame(list(zip(order, order[1:])), "a long, b long").coalesce(2)
    assert {r["root"] for r in components.components(links).collect()} == {0}
    assert (len(cuts) - 2) / 3 <= 24  # two cuts before the first round, three in each


def test_components_against_a_plain_version(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000, i) for i in range(301, 330)] + [(5, 5), (None, 3)]
    root = {i: i for pair in links if None not in pair and pair[0] != pair[1] for i in pair}
    for _ in root:
        for a, b in links:
            if a in root and b in root and a != b:
                root[a] = root[b] = min(root[a], root[b])
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == root and len(found) == len(root)


def test_texts_made_to_share_a_name_do_not(spark):
    """Two texts that differ in their first bytes, whose buckets once had one name."""
    rest = " is how the text goes on for a while long"
    docs = spark.createDataFrame([(1, "AD>EI;Q%A" + rest), (2, "ipc%#qbMy" + rest)], "doc_id long, text string")
    assert [r["n_removed"] for r in suffix_dedup.without_repeats(docs).collect()] == [0, 0]


def test_scripts_without_spaces_are_learned_from_labels(spark):
    rng = random.Random(4)
    signs = [chr(0x3042 + i) for i in range(80)]

    def text(toxic):
        found = "".join(rng.choices(signs, k=150))
        at = rng.randrange(100)
        return found[:at] + "馬鹿者め" * toxic + found[at:]

    rows = [(i, text(i % 4 == 0)) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    found = toxicity.scored(docs, toxicity.fit(docs, marks)).filter(toxicity.held_out(docs["doc_id"])).collect()
    assert sum(r["predicted"] == (r["doc_id"] % 4 == 0) for r in found) >= 0.95 * len(found)
    assert toxicity.words_of("日本語" * 30) == {"日本語", "本語日", "語日本"} and toxicity.words_of("a" * 40) == {"a" * 40}


def test_terms_without_a_cap(spark):
    docs, marks = odd.documents(spark), odd.labels(spark)
    assert toxicity.scored(docs, toxicity.fit(docs, marks, terms=None, mined=None)).count() == docs.count()


def test_columns_of_any_name_and_type_come_back(spark):
    docs = odd.documents(spark)
    for out in (suffix_dedup.deduplicated(docs), simhash.deduplicated(docs), toxicity.clean(docs, odd.labels(spark, []))):
        assert out.columns == docs.columns and dict(out.dtypes)["extra"] == "map<string,int>"
        rows = out.collect()
        assert rows and all(r["_null"] == r["_row"] == r["_toxic"] == r["my col"] == r["a.b"] == 7 and r["extra"] == {"k": 1} for r in rows)
