"""Sharding by proportional stratified interleaving.

The rows of each source are shuffled by a seeded hash and ranked; rank r of n lies at the fraction
(2r - 1) / 2n. Sorted by that fraction the sources are interleaved in proportion, so every
contiguous piece of the order has the whole's mixture, and equal pieces are the shards.

No rank is taken over a whole source or the whole table in one task. Rows are ranked inside narrow
ranges of the hash, and the ranges' counts give what to add; the global place is found alike, over
narrow ranges of the fraction. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampleledger.llm.common import cut, stored, text_crc32, utf8_length

#: About so many rows are ranked in one group.
RANGE_ROWS = 8192
#: Bits of the shuffling hash.
HASH_BITS = 60


def shuffle_key(seed: int, id_: Column) -> Column:
    """A seeded hash of the id: the first 60 bits of an MD5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def _before(counts: DataFrame, per: list[str], by: str) -> DataFrame:
    """The rows in all earlier ranges of a group."""
    order = Window.partitionBy(*per).orderBy(by) if per else Window.orderBy(by)
    return counts.withColumn("before", F.sum("n").over(order) - F.col("n"))


def interleaved(docs: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """(doc_id, source, size, text_crc32, shard, slot): shards whose row counts differ by one at
    most and whose sources all stand in the table's proportions, to within a row or two.

    A null source is a source of its own, last in order. A null text has size 1, no bytes and the
    separator. Ties of the hash go by doc_id, size and CRC; rows that are equal in all of them are
    interchangeable. Fractions that tie go by source. An empty table gives no rows.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("~"))
    rows = cut(
        docs.select(
            "doc_id", "source", (utf8_length(F.col("text")) + 1).alias("size"), text_crc32(F.col("text")).alias("text_crc32"),
            shuffle_key(seed, F.col("doc_id")).alias("h"), key.alias("key"),
        )
    )
    total = rows.count()
    bits = max(0, (total // RANGE_ROWS).bit_length())
    ranged = rows.withColumn("range", F.shiftright("h", HASH_BITS - bits))
    counts = ranged.groupBy("key", "range").agg(F.count("*").alias("n"))
    sizes = Window.partitionBy("key")
    starts = stored(_before(counts, ["key"], "range").withColumn("of", F.sum("n").over(sizes)).drop("n"))
    inside = F.row_number().over(Window.partitionBy("key", "range").orderBy("h", "doc_id", "size", "text_crc32"))
    ranked = ranged.withColumn("inside", inside).join(starts, ["key", "range"])
    rank = F.col("before") + F.col("inside")
    fraction = (2 * rank - 1).cast("double") / (2 * F.col("of")).cast("double")
    placed = cut(ranked.select("doc_id", "source", "size", "text_crc32", "key", rank.alias("rank"), fraction.alias("fraction")))

    spans = placed.withColumn("span", F.floor(F.col("fraction") * (1 << bits)).cast("long"))
    ahead = stored(_before(spans.groupBy("span").agg(F.count("*").alias("n")), [], "span").drop("n"))
    within = F.row_number().over(Window.partitionBy("span").orderBy("fraction", "key", "rank"))
    place = F.col("before") + F.col("within") - 1
    found = spans.withColumn("within", within).join(ahead, "span").withColumn("place", place)
    n = max(total, 1)
    found = found.withColumn("shard", F.expr(f"CAST(place * {shards} DIV {n} AS INT)"))
    slot = F.expr(f"place - (CAST(shard AS BIGINT) * {n} + {shards - 1}) DIV {shards}")
    return found.select("doc_id", "source", "size", "text_crc32", "shard", slot.cast("long").alias("slot"))
