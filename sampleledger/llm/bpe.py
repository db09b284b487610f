"""Byte-level BPE: encoding by a rank file and decoding to raw bytes."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleledger.llm.common import bounded_batches, give_back, own_name

#: A rank file is sent to every executor, so its size is bounded: 16 MiB hold a million tokens.
MAX_RANK_BYTES = 16 << 20
#: Characters after which a text is cut at the next safe place.
CHUNK = 1 << 16
#: No match of the split pattern holds white space after anything else, a letter beside a digit, or
#: punctuation after a letter, so every match ends there. Only characters that all versions of
#: Unicode class alike are used.
SAFE = regex.compile(r"(?<=[^\s\x1c-\x1f])(?=[ \n])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z\u4e00-\u9fa5])(?=[.,;:!?\u3001\u3002])")


def read_ranks(spark: SparkSession, path: str) -> bytes:
    """The rank file's bytes, read once on the driver. A larger file than the bound is an error."""
    if "://" in path:
        rows = spark.read.format("binaryFile").load(path).filter(F.col("length") <= MAX_RANK_BYTES).select("content").collect()
        content = bytes(rows[0][0]) if rows else b""
    else:
        with open(path, "rb") as file:
            content = file.read(MAX_RANK_BYTES + 1)
    if not 0 < len(content) <= MAX_RANK_BYTES:
        raise ValueError(f"{path} must hold 1 to {MAX_RANK_BYTES} bytes")
    return content


@lru_cache(maxsize=2)
def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    lines = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks={base64.b64decode(t): int(r) for t, r in lines}, special_tokens={})


def pieces(text: str, size: int = CHUNK) -> Iterator[str]:
    """``text`` in parts that encode as the whole does, each cut at the first safe place after
    ``size`` characters. A part is longer only where nothing is safe, as in one endless word."""
    start = 0
    while len(text) - start > size:
        found = SAFE.search(text, start + size)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def encode(coder: tiktoken.Encoding, text: str) -> np.ndarray:
    parts = [np.array(coder.encode_ordinary(part), "<u4") for part in pieces(text)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def tokens(spark: SparkSession, text: Column, ranks: bytes, pattern: str) -> Column:
    """The ids of each whole text as little-endian unsigned 32-bit integers (binary).

    Null and empty texts give no ids. The work is one row's alone, so there is no shuffle and a
    lost task is repeated by itself.
    """
    shared = spark.sparkContext.broadcast(ranks)

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = encoding(shared.value, pattern)
        for texts in batches:
            yield pd.Series([encode(coder, t or "").tobytes() for t in texts])

    return run(text)


def decoded(spark: SparkSession, ids: Column, ranks: bytes, pattern: str) -> Column:
    """The raw bytes of packed ids; no replacement of broken UTF-8. Null gives no bytes."""
    shared = spark.sparkContext.broadcast(ranks)

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = encoding(shared.value, pattern)
        for packed in batches:
            yield pd.Series([coder.decode_bytes(np.frombuffer(p or b"", "<u4").tolist()) for p in packed])

    return run(ids)


def round_trip(docs: DataFrame, path: str, pattern: str, digest: bool = False) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids`` (packed) and ``decoded`` (the bytes of the ids).

    With ``digest`` the last two are replaced by their SHA-256 in lower-case hex inside the same
    task, so that neither the ids nor the decoded text leave it. Columns of these names are
    replaced, others stay. A null text counts as empty.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    ranks = read_ranks(spark, path)
    if not digest:
        out = docs.withColumn("ids", tokens(spark, F.col("text"), ranks, pattern))
        return out.withColumns({"n_tokens": (F.octet_length("ids") / 4).cast("long"), "decoded": decoded(spark, F.col("ids"), ranks, pattern)})
    shared = spark.sparkContext.broadcast(ranks)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = encoding(shared.value, pattern)
        for texts in batches:
            rows = []
            for text in texts:
                ids = encode(coder, text or "")
                rows.append((len(ids), sha256(ids.tobytes()).hexdigest(), sha256(coder.decode_bytes(ids.tolist())).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
        del coder
        encoding.cache_clear()  # the tables of ranks are large, and the worker goes on to other stages
        give_back()

    coded = own_name(docs, "_coded")
    out = docs.withColumn(coded, run(F.col("text")))
    return out.withColumns({c: F.col(f"{coded}.{c}") for c in ("n_tokens", "ids_sha256", "decoded_sha256")}).drop(coded)
