"""Toxicity by weak supervision.

Many voters each mark texts they find toxic: lexicons written down here, lexicons mined from the
labelled training texts (words and word beginnings that stand mostly in toxic texts), and patterns.
A generative label model, fitted by expectation maximisation to the counts of vote patterns over
all training documents, estimates each voter's accuracy, finds voters that stay correlated within
a class and models those jointly. Its posterior labels train a sparse linear classifier over words
and word beginnings, which scores every whole text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from sampleledger.llm.common import bounded_batches, bounded_sample, cut, give_back, id_crc32, stored

#: Labelled rows that lexicons and classifier are fitted on, and the most frequent terms they take
#: unless told otherwise.
SAMPLE_ROWS = 16_000
MAX_TERMS, MIN_TEXTS = 8192, 5
MINED_TERMS, MINED_TEXTS, MINED_VOTERS = 240, 5, 6
#: Characters of the longest word; longer ones, as of scripts without spaces, are cut into GRAM.
LONGEST, GRAM = 40, 3
PENALTY = 0.1
FOLDS, HELD_OUT = 5, 0
#: Characters of a text that are split at once.
CHUNK = 1 << 20
#: Characters of texts whose terms a task holds at once.
HELD = 1 << 19

# General English word lists, by kind.
LEXICONS = (
    "idiot idiots idiotic moron morons moronic imbecile dumb dumbass stupid fool foolish dimwit halfwit brainless dunce".split(),
    "loser losers worthless pathetic useless clown clowns trash garbage scum filth vermin parasite coward failure".split(),
    "disgusting vile repulsive gross ugly hideous sickening revolting nasty freak creep pig swine rat".split(),
    "damn bastard bitch asshole bullshit crap shit fuck fucking slut whore jerk".split(),
)
PATTERNS = (
    re.compile(r"\b(?:kill|hurt|destroy|beat|shoot|hang) (?:you|yourself|him|her|them|all)\b"),
    re.compile(r"\b(?:you|youre|you're|your) (?:are |a |an |such a )*(?:%s)\b" % "|".join(w for words in LEXICONS for w in words)),
    re.compile(r"\b(?:shut up|go away|get lost|drop dead|hate you)\b"),
)
STEMS = (4, 5, 6)
_SPACE = re.compile(r"\s")
_EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def words_of(text: str) -> set[str]:
    """Distinct lower-case words of a whole text, without digits and signs at their ends. A word of
    more than LONGEST characters, as texts without spaces have, gives its runs of GRAM characters."""
    found: set[str] = set()
    at = 0
    while at < len(text):
        space = _SPACE.search(text, at + CHUNK)
        end = space.start() if space else len(text)
        found.update(text[at:end].lower().split())
        at = end
    clean = (w if w.isalpha() else _EDGES.sub("", w) for w in found)
    out, long_ones = set(), []
    for w in clean:
        if len(w) > LONGEST:
            long_ones.append(w)
        elif len(w) > 1:
            out.add(w)
    out.update(w[i : i + GRAM] for w in long_ones for i in range(len(w) - GRAM + 1))
    return out


def terms_of(words: set[str]) -> set[str]:
    """The words themselves, and beginnings of longer words, marked by a dash."""
    return words | {f"{w[:n]}-" for w in words for n in STEMS if len(w) > n}


@dataclass(frozen=True)
class Voters:
    """Voter i sets bit i. The fixed lexicons come first, then the mined ones, then patterns."""

    mined: dict[str, int]

    @property
    def count(self) -> int:
        return len(LEXICONS) + MINED_VOTERS + len(PATTERNS)

    @staticmethod
    def pattern_bits(text: str) -> int:
        low = text.lower()
        return sum(1 << i for i, pattern in enumerate(PATTERNS) if pattern.search(low))

    def votes(self, terms: set[str], pattern_bits: int) -> int:
        bits = sum(1 << i for i, lexicon in enumerate(LEXICONS) if not terms.isdisjoint(lexicon))
        for voter in {self.mined[t] for t in terms & self.mined.keys()}:
            bits |= 1 << (len(LEXICONS) + voter)
        return bits | pattern_bits << (len(LEXICONS) + MINED_VOTERS)


@dataclass(frozen=True)
class Model:
    voters: Voters
    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        terms = terms_of(words_of(text or ""))
        votes = self.voters.votes(terms, self.voters.pattern_bits(text or ""))
        total = self.bias + sum(self.weights[t] for t in terms & self.weights.keys())
        total += sum(self.weights.get(f"#{i}", 0.0) for i in range(self.voters.count) if votes >> i & 1)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, total))))


# --- the label model -------------------------------------------------------------------------------


def _log_tables(config: np.ndarray, size: int, weight: np.ndarray) -> np.ndarray:
    counts = np.stack([np.bincount(config, weights=weight[:, y], minlength=size) + 0.5 for y in (0, 1)], axis=1)
    return np.log(counts / counts.sum(axis=0))


def label_model(patterns: np.ndarray, labels: np.ndarray, counts: np.ndarray, voters: int, rounds: int = 60) -> tuple[np.ndarray, list[list[int]]]:
    """Posterior P(toxic) of each (vote pattern, label) and the groups of voters modelled jointly.

    ``labels`` holds 1, 0 or -1 for none; a label is one more voter. The first fit takes voters as
    independent given the class; voters whose correlation within the classes stays above 0.3 are
    joined into groups of at most four, and the second fit has a table of all their joint votes. The
    classes are the labels where both kinds are there (a fitted class would take two like voters for
    the truth and find nothing left between them), else the first fit's.
    """
    votes = (patterns[:, None] >> np.arange(voters)) & 1
    start = np.where(labels >= 0, np.where(labels == 1, 0.95, 0.05), np.where(patterns > 0, 0.7, 0.05))
    groups = [[i] for i in range(voters)]
    post = start
    for fit in range(2):
        configs = [(votes[:, g] << np.arange(len(g))).sum(axis=1) for g in groups]
        post = start
        for _ in range(rounds):
            weight = counts[:, None] * np.stack([1 - post, post], axis=1)
            score = np.log((weight.sum(axis=0) + 1) / (weight.sum() + 2))[None, :] + np.zeros((len(patterns), 2))
            for g, config in zip(groups, configs):
                score += _log_tables(config, 1 << len(g), weight)[config]
            seen = labels >= 0
            if seen.any():
                score[seen] += _log_tables(labels[seen], 2, weight[seen])[labels[seen]]
            new = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -500, 500)))
            done = np.abs(new - post).max() < 1e-6
            post = new
            if done:
                break
        if fit == 0:
            known = {0, 1} <= set(labels.tolist())
            groups = _correlated(votes, counts * (labels >= 0) if known else counts, np.where(labels >= 0, labels, 0.0) if known else post, voters)
    return post, groups


def _correlated(votes: np.ndarray, counts: np.ndarray, post: np.ndarray, voters: int) -> list[list[int]]:
    """Voters joined by the strongest correlations that remain within the classes."""
    rest = np.zeros((voters, voters))
    for weight in (counts * post, counts * (1 - post)):
        total = max(weight.sum(), 1.0)
        mean = weight @ votes / total
        spread = (votes - mean).T @ ((votes - mean) * weight[:, None]) / total
        scale = np.sqrt(np.clip(np.diag(spread), 1e-6, None))
        rest = np.maximum(rest, np.abs(spread / scale[:, None] / scale[None, :]))
    groups = {i: [i] for i in range(voters)}
    for i, j in sorted(combinations(range(voters), 2), key=lambda p: -rest[p]):
        if rest[i, j] > 0.3 and groups[i] is not groups[j] and len(groups[i]) + len(groups[j]) <= 4:
            both = groups[i] + groups[j]
            groups.update({k: both for k in both})
    return list({id(g): g for g in groups.values()}.values())


# --- fitting and scoring ---------------------------------------------------------------------------


def held_out(id_):
    """Rows that nothing is learned from."""
    return id_crc32(id_) % FOLDS == HELD_OUT


def _terms(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns, rows, size = ["doc_id", "toxic", "mark", "patterns", "terms"], [], 0
    try:
        for frame in frames:
            for id_, text, toxic in zip(frame["doc_id"], frame["text"], frame["toxic"]):
                words = words_of(text or "")
                # copies have equal bytes, and one of them with each label is enough
                mark = xxh64_intdigest((text or "").encode("utf-8", "replace")) >> 1
                rows.append((int(id_), int(toxic), mark, Voters.pattern_bits(text or ""), sorted(terms_of(words))))
                size += len(text or "")
                if size > HELD:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=columns)
    finally:
        give_back()


def _mined(sample: DataFrame, most: int | None = MINED_TERMS) -> dict[str, int]:
    """Terms that stand far more often in toxic texts than chance allows, dealt to the voters."""
    base = sample.agg(F.avg("toxic").alias("p"), F.count("*").alias("n")).first()
    if not base["n"] or not 0 < base["p"] < 1:
        return {}
    counts = sample.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n"), F.avg("toxic").alias("p"))
    z = (F.col("p") - base["p"]) / F.sqrt(F.lit(base["p"] * (1 - base["p"])) / F.col("n"))
    best = counts.withColumn("z", z).filter(f"n >= {MINED_TEXTS} AND p >= 0.7 AND z >= 6").orderBy(F.desc("z"), "term")
    return {r["term"]: xxh64_intdigest(r["term"]) % MINED_VOTERS for r in (best if most is None else best.limit(most)).collect()}


def fit(
    docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, terms: int | None = MAX_TERMS, mined: int | None = MINED_TERMS
) -> Model:
    """A model learned from the rows of ``docs`` and ``labels`` outside the held-out fold.

    Lexicons and classifier take at most ``rows`` labelled rows, those of smallest hash, one of
    each set of equal texts with one label; the label model takes the votes on every training document. Only the
    text is ever an input. Null or repeated labels of a document: nulls do not count, and the
    largest does. The classifier weighs the ``terms`` terms of the most sample texts and the lexicons
    take the ``mined`` that tell most; with None all that stand in MIN_TEXTS (MINED_TEXTS) sample
    texts, whose number the bounded sample bounds. Without labelled rows of both kinds the fixed voters alone give the weights.
    """
    from pyspark.ml.classification import LogisticRegression  # only the driver needs these
    from pyspark.ml.feature import CountVectorizerModel

    bounded_batches(docs.sparkSession)
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = stored(bounded_sample(known, rows, 7))
    texts = docs.select("doc_id", "text").join(chosen, "doc_id")
    sample = stored(texts.mapInPandas(_terms, "doc_id long, toxic int, mark long, patterns int, terms array<string>"))
    # ids alone are shuffled; their table is no larger than the sample
    apart = stored(sample.groupBy("mark", "toxic").agg(F.min("doc_id").alias("doc_id")).select("doc_id"))
    sample = sample.join(apart, "doc_id")
    voters = Voters(_mined(sample) if mined == MINED_TERMS else _mined(sample, mined))

    @F.pandas_udf("int")
    def votes_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([voters.votes(terms_of(words_of(t or "")), voters.pattern_bits(t or "")) for t in batch], dtype="int32")
        give_back()

    training = docs.filter(~held_out(F.col("doc_id"))).select("doc_id", votes_of("text").alias("votes"))
    # at most three rows per pattern of the voters' bits, so a table of bounded size
    joined = cut(training).join(known, "doc_id", "left")
    seen = cut(joined.groupBy("votes", F.coalesce("toxic", F.lit(-1)).alias("label")).agg(F.count("*").alias("n"))).toPandas()
    fixed = {f"#{i}": 6.0 for i in range(len(LEXICONS))}
    if not len(seen) or not {0, 1} <= set(seen["label"]):
        return Model(voters, fixed, -3.0)
    post, _ = label_model(seen["votes"].to_numpy(np.int64), seen["label"].to_numpy(np.int64), seen["n"].to_numpy(float), voters.count)
    posterior = dict(zip(zip(seen["votes"].tolist(), seen["label"].tolist()), post.tolist()))

    @F.pandas_udf("votes array<string>, p double")
    def posterior_of(terms: pd.Series, toxic: pd.Series, patterns: pd.Series) -> pd.DataFrame:
        votes = [voters.votes(set(t), x) for t, x in zip(terms, patterns)]
        fired = [[f"#{i}" for i in range(voters.count) if v >> i & 1] for v in votes]
        return pd.DataFrame({"votes": fired, "p": [posterior.get((v, y), 0.5) for v, y in zip(votes, toxic)]})

    marked = sample.select("terms", posterior_of("terms", "toxic", "patterns").alias("x"))
    marked = stored(marked.select(F.concat("terms", "x.votes").alias("terms"), F.col("x.p").alias("p")))
    found_in = marked.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).filter(f"n >= {MIN_TEXTS}")
    found_in = found_in.orderBy(F.desc("n"), "term")
    vocabulary = [r["term"] for r in (found_in if terms is None else found_in.limit(terms)).collect()]
    if not vocabulary:
        return Model(voters, fixed, -3.0)
    space = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="terms", outputCol="features")
    space.setBinary(True)
    both = space.transform(marked).select(
        "features", F.explode(F.array(F.struct(F.lit(1.0).alias("y"), F.col("p").alias("w")), F.struct(F.lit(0.0).alias("y"), (1 - F.col("p")).alias("w")))).alias("x")
    ).select("features", F.col("x.y").alias("label"), F.col("x.w").alias("weight"))
    # the noise of a term's weight falls with the root of the sample, and so does the penalty
    penalty = PENALTY / math.sqrt(marked.count())
    linear = LogisticRegression(weightCol="weight", regParam=penalty, elasticNetParam=0.9, maxIter=60).fit(both)
    found = linear.coefficients.toArray()
    return Model(voters, {vocabulary[i]: float(found[i]) for i in np.flatnonzero(found)}, float(linear.intercept))


def _score(model: Model):
    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([model.score(t) for t in batch], dtype="float64")
        give_back()

    return run


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on). Whole texts; an empty or
    null text gets the score of a text without terms. Columns of these names are replaced."""
    bounded_batches(docs.sparkSession)
    out = docs.withColumn("score", _score(model)("text"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that a model fitted on them does not find toxic, all columns as they are. Null and
    empty texts are scored like any other without terms."""
    return docs.filter(_score(fit(docs, labels))("text") < 0.5)
