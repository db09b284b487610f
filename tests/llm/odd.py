"""Inputs with every oddity the operators have to bear."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

#: More columns than documents have, named as the operators name their own.
CLASH = ["size", "score", "rank", "shard", "slot", "n", "key", "h", "copies", "taken", "target", "tag", "kept", "at", "data", "words", "toxic", "fp", "blocks", "rest"]
CLASH += ["_null", "_row", "_toxic", "_label", "_letters", "_coded", "_others", "my col", "a.b"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in CLASH) + ", extra map<string,int>"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghilmnoprstuvé") for _ in range(rng.randint(2, 9))) for _ in range(words))


def documents(spark: SparkSession) -> DataFrame:
    long = prose(1, 40_000)  # longer than one piece, chunk or block
    passage = prose(2, 60)
    rows = [
        (1, prose(3, 120), "en", "a"), (2, None, "en", "a"), (3, "", None, None), (4, " \t\n ", "fr", "b"), (5, "x", "de", "b"),
        (6, long, "en", "a"), (7, long, "en", "c"), (8, prose(3, 120), None, "a"), (8, prose(3, 120), None, "a"), (None, passage, "en", None),
        (None, None, None, None), (9, f"{prose(4, 30)} {passage} {prose(5, 30)}", "es", "d"), (10, f"{prose(6, 3)} {passage}", "es", "d"),
        (11, "a" * 5000, "en", "d"), (12, "a" * 3000 + "b", "en", "d"), (13, "日本語の文章です。" * 40, "ja", "e"), (14, "…%%% 123 !!!", "en", "e"),
    ]
    return spark.createDataFrame([(i, t, lang, s, len(t or "")) + (7,) * len(CLASH) + ({"k": 1},) for i, t, lang, s in rows], SCHEMA)


def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def labels(spark: SparkSession, rows=((1, 0, 1), (1, 0, 0), (6, None, None), (None, 1, 1), (9, 1, 0))) -> DataFrame:
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def by_id(df: DataFrame) -> dict:
    return {r["doc_id"]: r for r in df.collect()}
