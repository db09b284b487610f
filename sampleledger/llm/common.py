"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space: the blank and \t \n \v \f \r.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only a local session that names none gets one of its own;
    a cluster has to name one that all executors share."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or "/tmp/checkpoints")
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` as a reliable checkpoint: computed once, its lineage cut."""
    _shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, into: SparkSession | None = None) -> DataFrame:
    """``df`` written as a Parquet table to the checkpoint folder and read again, by the session
    ``into`` if that is another. Its columns are
    pruned when read, and the planner knows its true size, so a small one is broadcast and a large
    one is not. The table goes when the session ends."""
    path = fresh_folder(df.sparkSession, "table")
    df.write.parquet(path)
    return (into or df.sparkSession).read.schema(df.schema).parquet(path)


def fresh_folder(spark: SparkSession, kind: str) -> str:
    """The name of a new folder in the session's checkpoint folder. It goes when the session ends."""
    path = f"{_shared_folder(spark).rstrip('/')}/{kind}-{uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


#: Texts that go to Python at once.
BATCH_TEXTS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Sends texts to Python in Arrow batches of at most BATCH_TEXTS, for the rest of the session: a
    text may be long, and by default ten thousand of them would stand in a worker's memory at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_TEXTS:
        spark.conf.set(name, str(BATCH_TEXTS))


def bounded_sample(df: DataFrame, rows: int, seed: int, id_: str = "doc_id") -> DataFrame:
    """The ``rows`` rows of smallest hash of their id, or all of fewer. A share of the hashes that
    holds them with room to spare is filtered first, so what the last task gathers is bounded by
    ``rows`` and not by the number of tasks. Only the id column is counted."""
    h = F.xxhash64(F.lit(seed), F.col(id_))
    share = min(1.0, (1.2 * rows + 500) / max(1, df.select(id_).count()))
    some = df.filter(F.pmod(h, F.lit(1 << 40)) < int(share * (1 << 40)))
    return some.orderBy(F.pmod(h, F.lit(1 << 40)), id_).limit(rows)


def utf8_length(text: Column) -> Column:
    """Bytes of a text; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_crc32(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; a null text counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def id_crc32(id_: Column) -> Column:
    """CRC-32 of an id written as decimal text, the basis of the held-out folds."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary"))


def give_back() -> None:
    """Returns the memory that a task's batches took. Python workers are used again by later stages,
    and what one stage leaves would be missing in all of them."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)(0)


def own_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> str:
    """A column's name, whatever characters it holds, where a path is expected."""
    return "`" + name.replace("`", "``") + "`"


#: Bytes or characters of a text that are searched at once.
PIECE = 1 << 20


def pieces(text: str | bytes, gap: re.Pattern, size: int = PIECE) -> Iterator:
    """A text in pieces of about ``size``, cut where ``gap`` matches one character between words, so
    that no word is cut however long the text."""
    start = 0
    while start < len(text):
        cut = gap.search(text, start + size)
        end = cut.end() if cut else len(text)
        yield text[start:end]
        start = end
