"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of UTF-8 bytes both ways, labels every position, and a document's
probabilities are the mean of its positions'. It is trained here, in numpy, by backpropagation
through time on a bounded sample of labelled windows, and then labels every byte of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleledger.llm.common import bounded_batches, bounded_sample, id_crc32

#: Labelled documents that train the network, and windows taken from each.
SAMPLE_ROWS, SAMPLE_WINDOWS = 6000, 3
#: Bytes of a window, units of each direction, windows that run side by side.
WINDOW, UNITS, BATCH = 64, 8, 4096
#: Passes over the sample, windows of a training step, and its largest step.
EPOCHS, STEP_WINDOWS, RATE = 6, 256, 0.02
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
PAD = 256


def held_out(id_: Column) -> Column:
    """Rows that nothing is learned from."""
    return id_crc32(id_) % FOLDS == HELD_OUT


@dataclass
class Network:
    """``read`` (2, 257, 3U) has the gates' inputs of a byte in each direction, ``turn`` (2, U, 3U)
    the recurrence, ``bias`` (2, U) that of the candidate's recurrent part, ``out`` and ``shift``
    the labels. Gates stand in the order update, reset, candidate."""

    classes: list[str]
    read: np.ndarray
    turn: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    shift: np.ndarray

    @staticmethod
    def fresh(classes: list[str], seed: int) -> Network:
        rng = np.random.default_rng(seed)
        scale = 1 / np.sqrt(UNITS)
        draw = lambda *shape: rng.uniform(-scale, scale, shape).astype(np.float32)
        return Network(
            classes, draw(2, PAD + 1, 3 * UNITS), draw(2, UNITS, 3 * UNITS), np.zeros((2, 1, UNITS), np.float32),
            draw(2 * UNITS, len(classes)), np.zeros(len(classes), np.float32),
        )

    def states(self, windows: np.ndarray, trace: list | None = None) -> np.ndarray:
        """(T, B, 2U): what both directions know at each position. A padded position is empty."""
        steps, many = windows.shape[1], len(windows)
        both = np.stack([windows.T, windows.T[::-1]])  # direction, step, window
        # with halved inputs a sigmoid is a tanh, which numpy has vectorised
        half = np.concatenate([np.full(2 * UNITS, 0.5), np.ones(UNITS)]).astype(np.float32)
        read, turn = self.read * half, self.turn * half
        hidden = np.zeros((2, many, UNITS), np.float32)
        out = np.empty((2, steps, many, UNITS), np.float32)
        x = np.empty((2, many, 3 * UNITS), np.float32)
        for t in range(steps):
            for d in (0, 1):
                np.take(read[d], both[d, t], axis=0, out=x[d])
            g = hidden @ turn
            gates = x[..., : 2 * UNITS] + g[..., : 2 * UNITS]
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            update, reset = gates[..., :UNITS], gates[..., UNITS:]
            inner = g[..., 2 * UNITS :] + self.bias
            new = reset * inner
            new += x[..., 2 * UNITS :]
            np.tanh(new, out=new)
            before = hidden
            hidden = before - new
            hidden *= update
            hidden += new
            real = (both[:, t] != PAD)[..., None]
            hidden *= real
            out[:, t] = hidden
            if trace is not None:
                trace.append((before, update, reset, inner, new, real))
        return np.concatenate([out[0], out[1, ::-1]], axis=2)

    def labels(self, states: np.ndarray) -> np.ndarray:
        """The probabilities of the classes at each position."""
        scores = states @ self.out + self.shift
        scores -= scores.max(axis=-1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=-1, keepdims=True)
        return scores

    def gradients(self, windows: np.ndarray, truth: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Of the weighted cross-entropy of all positions, back through time."""
        trace: list = []
        states = self.states(windows, trace)
        steps, many = windows.shape[1], len(windows)
        wrong = self.labels(states)
        wrong[:, np.arange(many), truth] -= 1
        real = (windows.T != PAD)[..., None]
        wrong *= real * (weight / max(1.0, float(real.sum())))[None, :, None]
        flat = states.reshape(-1, 2 * UNITS)
        d_out, d_shift = flat.T @ wrong.reshape(len(flat), -1), wrong.sum(axis=(0, 1))
        back = wrong @ self.out.T
        ahead = np.stack([back[..., :UNITS], back[::-1, :, UNITS:]])  # direction, step, window, unit
        d_turn, d_bias, d_read = np.zeros_like(self.turn), np.zeros_like(self.bias), np.zeros_like(self.read)
        both = np.stack([windows.T, windows.T[::-1]])
        carried = np.zeros((2, many, UNITS), np.float32)
        for t in reversed(range(steps)):
            before, update, reset, inner, new, here = trace[t]
            d = (ahead[:, t] + carried) * here
            d_new = d * (1 - update) * (1 - new * new)
            d_update = d * (before - new) * update * (1 - update)
            d_reset = d_new * inner * reset * (1 - reset)
            d_inner = d_new * reset
            to_turn = np.concatenate([d_update, d_reset, d_inner], axis=2)
            d_turn += before.transpose(0, 2, 1) @ to_turn
            d_bias += d_inner.sum(axis=1, keepdims=True)
            carried = d * update + to_turn @ self.turn.transpose(0, 2, 1)
            to_read = np.concatenate([d_update, d_reset, d_new], axis=2)
            for k in (0, 1):
                np.add.at(d_read[k], both[k, t], to_read[k])
        return [d_read, d_turn, d_bias, d_out, d_shift]

    def train(self, windows: np.ndarray, truth: np.ndarray, seed: int) -> None:
        """Adam with a step that falls to zero. Rarer classes weigh more, up to four times."""
        rng = np.random.default_rng(seed)
        counts = np.bincount(truth, minlength=len(self.classes))
        weight = np.clip(len(truth) / (len(counts) * np.maximum(counts, 1)), 0.25, 4).astype(np.float32)
        held = [self.read, self.turn, self.bias, self.out, self.shift]
        first, second = [np.zeros_like(p) for p in held], [np.zeros_like(p) for p in held]
        steps, done = EPOCHS * -(-len(windows) // STEP_WINDOWS), 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(windows))
            for at in range(0, len(windows), STEP_WINDOWS):
                some = order[at : at + STEP_WINDOWS]
                grads = self.gradients(windows[some], truth[some], weight[truth[some]])
                size = np.sqrt(sum(float((g * g).sum()) for g in grads))
                rate = RATE * (1 - done / steps) * min(1.0, (done + 1) / 20)
                done += 1
                for p, g, a, b in zip(held, grads, first, second):
                    g = g * min(1.0, 1.0 / max(size, 1e-9))
                    a += 0.1 * (g - a)
                    b += 0.01 * (g * g - b)
                    p -= rate * (a / (1 - 0.9**done)) / (np.sqrt(b / (1 - 0.99**done)) + 1e-8)

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """The mean probabilities of each text's positions; of an empty text, equal ones."""
        sums, counts = np.zeros((len(texts), len(self.classes))), np.zeros(len(texts))
        buffer, owner, filled = np.full((BATCH, WINDOW), PAD, np.int16), np.zeros(BATCH, np.int64), 0

        def flush() -> None:
            if filled:
                part = buffer[:filled]
                real = part != PAD
                probs = self.labels(self.states(part)) * real.T[..., None]
                np.add.at(sums, owner[:filled], probs.sum(axis=0))
                np.add.at(counts, owner[:filled], real.sum(axis=1))

        for i, text in enumerate(texts):
            data = np.frombuffer(text, np.uint8)
            at = 0
            while at < len(data):
                take = min(BATCH - filled, -(-(len(data) - at) // WINDOW))
                piece = data[at : at + take * WINDOW]
                rows = buffer[filled : filled + take].reshape(-1)
                rows[: len(piece)] = piece
                rows[len(piece) :] = PAD
                owner[filled : filled + take] = i
                filled += take
                at += take * WINDOW
                if filled == BATCH:
                    flush()
                    filled = 0
        flush()
        return np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], 1 / len(self.classes))


def sample_windows(docs: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, list[str]]:
    """At most ``rows`` * SAMPLE_WINDOWS windows of training documents, those of smallest hash, cut
    from places that another hash picks in the whole text. Only the windows reach the driver."""
    data = F.col("text").cast("binary")
    many = F.octet_length("text")
    starts = [F.when(many > WINDOW, F.pmod(F.xxhash64(F.lit(k), "doc_id"), many - WINDOW + 1)).otherwise(0).cast("int") for k in range(SAMPLE_WINDOWS)]
    usable = docs.filter("lang IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out(F.col("doc_id")))
    picked = usable.select("doc_id", "lang", F.array(*[F.substring(data, s + 1, WINDOW) for s in starts]).alias("cuts"))
    pieces = bounded_sample(picked, rows, 3).select("lang", F.explode("cuts").alias("piece"))
    found = sorted(pieces.filter(F.octet_length("piece") > 0).collect())
    windows = np.full((len(found), WINDOW), PAD, np.int16)
    for row, item in zip(windows, found):
        row[: len(item["piece"])] = np.frombuffer(bytes(item["piece"]), np.uint8)
    return windows, [item["lang"] for item in found]


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS, seed: int = 11) -> Network | None:
    """A network trained on documents outside the held-out fold, or None where none has a language."""
    windows, langs = sample_windows(docs, rows)
    classes = sorted(set(langs))
    if not classes:
        return None
    network = Network.fresh(classes, seed)
    network.train(windows, np.array([classes.index(x) for x in langs]), seed)
    return network


def predicted(docs: DataFrame, network: Network | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the pooled probability of that language.

    A text that is null or has no letter gets ``und`` and 0, and so does every text if there is no
    network. Every byte of every text is labelled. Columns of these names are replaced.
    """

    bounded_batches(docs.sparkSession)

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            probs = network.pooled([(t or "").encode("utf-8", "replace") for t in texts])
            best = probs.argmax(axis=1)
            yield pd.DataFrame({"lang_pred": [network.classes[k] for k in best], "score": probs.max(axis=1)})

    if network is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    out = docs.withColumn("_label", run(F.col("text"))).withColumn("_letters", letters)
    return out.withColumns(
        {"lang_pred": F.when(F.col("_letters"), F.col("_label.lang_pred")).otherwise(UNKNOWN), "score": F.when(F.col("_letters"), F.col("_label.score")).otherwise(0.0)}
    ).drop("_label", "_letters")
