"""WARC archives written and read back, records found by boundary-chain verification.

Writing: a record per page, its payload the HTTP body. Of pages with equal payloads one is stored
as ``response``, the others as ``revisit`` records that refer to it and hold no payload. Archives
are plain WARC files, written by Spark's text sink with the end of a record as its line separator,
so they lie on whatever file system the cluster has and a lost task is written again.

Reading: archives are split at any byte, and nothing marks a record's start for certain, as its
magic line may stand in a payload, even in front of a whole record. Spark's text source, with the
magic as its line separator, gives each split its stretches between magics. Each is a candidate
whose header tells where its successor has to start. Inside a split a task follows these to where
they leave the split; from the start of each file, pointer jumping over the splits (each round
doubles the steps) finds the place at which the true chain enters each. A second pass walks every
split from its entry: what the chain does not visit is part of a payload.

Both passes have to see the same splits, while Spark cuts files by the cores it has at the time and
the files it reads. So archives are read through a session of their own, with this one's settings
but for a split size that depends on nothing.

Places are counted from the first stretch of their split: the lengths of all stretches of earlier
splits add up to its offset in the file.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sampleledger.llm.common import fresh_folder, stored

MAGIC, END = "WARC/1.1\r\n", "\r\n\r\n"
_MAGIC, _END, _M = MAGIC.encode(), END.encode(), len(MAGIC)
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: Bytes of a split of an archive.
SPLIT = 32 << 20
#: Splits with an entry of their own that are sent to executors at once.
ENTRIES = 1 << 17
#: Bytes of records that a task hands on at once.
HANDED = 1 << 24

_CANDIDATE = pa.schema([("file", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("to", pa.int64()), ("first", pa.int64()), ("total", pa.int64())])
_PART = pa.schema([
    ("file", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("whole", pa.bool_()),
    ("headers", pa.map_(pa.string(), pa.string())), ("content", pa.binary()),
])


def base32_sha1(data: Column) -> Column:
    """The SHA-1 as WARC writes it: ten hex digits at a time are eight digits in base 32."""
    digest = F.sha1(data)
    eights = [F.lpad(F.conv(F.substring(digest, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*eights), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _one_line(value: Column) -> Column:
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def record_texts(pages: DataFrame, at_least: int = 0) -> DataFrame:
    """(value): the WARC record of each page (page_id, url, html), up to its closing empty lines.

    Of equal payloads of ``at_least`` bytes or more the one with the largest page_id is the response
    (several, if rows share that id), the others refer to it. A null html is an empty payload; a
    null page_id comes before all others and is written as nothing; a null url has no line, line
    ends in one are percent-encoded. Other columns are not read. An empty table gives no rows.

    Payloads are equal if their SHA-256 is. Only payloads that repeat are looked up, so pages are
    shuffled only where those are too many to send to every task.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("html"), F.sha2(payload, 256).alias("same"))
    long_enough = F.octet_length("html") >= at_least
    repeated = stored(rows.filter(long_enough).groupBy("same").agg(F.count("*").alias("n"), F.max("page_id").alias("first")).filter("n > 1").drop("n"))
    rows = rows.join(repeated.withColumn("found", F.lit(True)), "same", "left")
    again = F.col("found").isNotNull() & long_enough & ~F.col("page_id").eqNullSafe(F.col("first"))
    size = F.octet_length("html").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit(END))
    named = lambda id_: F.concat(F.lit("<urn:page:"), F.coalesce(id_.cast("string"), F.lit("")), F.lit(">"))
    block = F.when(again, http).otherwise(F.concat(http, "html"))
    head = F.concat_ws(
        "\r\n",
        F.concat(F.lit(f"{MAGIC}WARC-Type: "), F.when(again, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), named(F.col("page_id"))),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), _one_line(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32_sha1(F.col("html"))),
        F.when(again, F.concat(F.lit("WARC-Refers-To: "), named(F.col("first")))),
        F.when(again, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END)),
    )
    return rows.select(F.concat(head, block).alias("value"))


def write(pages: DataFrame, folder: str, at_least: int = 0) -> None:
    """Archives of ``pages`` in a new folder, one file per task."""
    record_texts(pages, at_least).write.option("lineSep", END).text(folder)


# reading


def _header(head: bytes | None) -> dict[str, str] | None:
    """The named fields of a record's header; none if it is no header of a record."""
    if head is None:
        return None
    fields = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name or name.strip() != name:
            return None
        fields[name.decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    size = fields.get("content-length", "")
    return fields if "warc-type" in fields and size.isascii() and size.isdigit() and len(size) < 16 else None


def _with_fixed_splits(spark: SparkSession, split: int) -> SparkSession:
    """A session like this one that cuts files into pieces of ``split`` bytes whatever it reads."""
    other = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            other.conf.set(name, value)
    other.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    other.conf.set("spark.sql.files.minPartitionNum", "1")
    other.conf.set("spark.sql.files.openCostInBytes", str(min(split, 4 << 20)))
    return other


def _stretches(spark: SparkSession, folder: str, *more: Column) -> DataFrame:
    read = spark.read.option("lineSep", MAGIC).text(folder)
    return read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), *more)


def _leaving(file: str, block: int, total: int, first: int | None, steps: dict[int, int]) -> pa.RecordBatch:
    """Each candidate of a split with where its chain leaves it; a chain that breaks leaves nowhere."""
    rows, ends = [], {}
    for at in sorted(steps, reverse=True):
        to = steps[at]
        ends[at] = to if to >= total - _M else ends.get(to)
        rows.append((file, block, at, ends[at], first, total))
    if not rows:
        rows.append((file, block, None, None, first, total))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _CANDIDATE)], schema=_CANDIDATE)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    here, total, first, steps = None, 0, None, {}
    for batch in batches:
        for file, block, head, size in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "head", "size"))):
            if here != (file, block):
                if here:
                    yield _leaving(*here, total, first, steps)
                here, total, first, steps = (file, block), 0, None, {}
            if total or block:  # a file's first stretch comes before any magic
                at = total - _M
                first = at if first is None else first
                fields = _header(head)
                if fields:
                    steps[at] = total + len(head) + len(_END) + int(fields["content-length"]) + len(_END)
            total += size + _M
    if here:
        yield _leaving(*here, total, first, steps)


class Chains:
    """Where the true chain of each file enters its splits."""

    def __init__(self, spark: SparkSession, folder: str, split: int = SPLIT):
        text = F.col("value")
        head = F.when(F.contains(text, F.lit(END)), F.substring_index(text, END, 1)).cast("binary")
        slim = _stretches(_with_fixed_splits(spark, split), folder, head.alias("head"), F.octet_length(text).cast("long").alias("size"))
        found = stored(slim.mapInArrow(_candidates, "file string, block long, at long, to long, first long, total long"), spark)
        splits = found.select("file", "block", "first", "total").distinct()
        before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per split
        whole = Window.partitionBy("file")
        splits = splits.withColumns({"base": F.coalesce(F.sum("total").over(before), F.lit(0)), "size": F.sum("total").over(whole) - _M})
        self.splits = stored(splits)
        links = found.filter("at IS NOT NULL AND to IS NOT NULL").join(self.splits.select("file", "block", "base"), ["file", "block"])
        links = links.select("file", "block", (F.col("base") + F.col("at")).alias("at"), (F.col("base") + F.col("to")).alias("to"))
        # only places where a chain from another split arrives, and the starts of files, can be entries
        arrivals = links.select("file", F.col("to").alias("at")).distinct()
        nodes = stored(links.join(arrivals, ["file", "at"], "left_semi").union(links.filter("at = 0").select("file", "at", "block", "to")).distinct())
        self.entries = self._reached(nodes)

    @staticmethod
    def _reached(nodes: DataFrame) -> DataFrame:
        """Nodes that a chain from the start of their file visits: after k rounds all within 2 ** k
        steps. A round joins tables with a few rows per split."""
        jumps = nodes.select("file", "at", "to")
        reached = nodes.filter("at = 0").select("file", "at")
        while not jumps.isEmpty():
            ahead = reached.join(jumps, ["file", "at"]).select("file", F.col("to").alias("at"))
            reached = stored(reached.union(ahead).distinct())
            further = jumps.select("file", F.col("at").alias("to"), F.col("to").alias("beyond"))
            jumps = stored(jumps.join(further, ["file", "to"]).select("file", "at", F.col("beyond").alias("to")))
        # the end of a file is an arrival, but no node
        return stored(nodes.join(reached, ["file", "at"], "left_semi").select("file", "block", "at", "to"))

    def broken(self) -> DataFrame:
        """(file, size, reached): files whose chain of records ends before the file does."""
        sizes = self.splits.select("file", "size").distinct()
        last = self.entries.groupBy("file").agg(F.max("to").alias("reached"))
        found = sizes.join(last, "file", "left").select("file", "size", F.coalesce("reached", F.lit(0)).alias("reached"))
        return found.filter("size > 0 AND reached <> size")

    def unusual(self) -> DataFrame:
        """(file, block, entry): splits that the chain does not enter at their first magic; the entry
        is null where the chain passes over the whole split."""
        entered = self.entries.join(self.splits.select("file", "block", "base"), ["file", "block"])
        entered = entered.select("file", "block", (F.col("at") - F.col("base")).alias("entry"))
        found = self.splits.filter("first IS NOT NULL").join(entered, ["file", "block"], "left")
        return found.filter("NOT entry <=> first").select("file", "block", "entry")


class _Walk:
    """The records of one split, from its entry on."""

    def __init__(self, file: str, block: int, entries: dict, passed: object):
        self.file, self.block, self.at = file, block, 0
        self.next = entries.get((file, block), passed)
        self.first = self.next is passed  # the usual case: the chain enters at the first magic
        self.rest: list[bytes] = []
        self.start, self.headers, self.parts, self.missing = 0, None, [], 0

    def add(self, data: bytes) -> Iterator[tuple]:
        if self.at or self.block:
            here = self.at - _M
            if self.first:
                self.next, self.first = here, False
            if here == self.next:
                head, _, content = data.partition(_END)
                self.start, self.headers = here, _header(head)
                size = int(self.headers["content-length"])
                self.next = self.at + len(head) + len(_END) + size + len(_END)
                self.parts, self.missing = [content], size + len(_END) - len(content)
            elif self.headers is not None:
                self.parts += [_MAGIC, data]
                self.missing -= _M + len(data)
            else:
                self.rest += [_MAGIC, data]
            if self.headers is not None and self.missing <= 0:
                yield self.file, self.block, self.start, True, list(self.headers.items()), b"".join(self.parts)
                self.headers, self.parts = None, []
        self.at += len(data) + _M

    def end(self) -> Iterator[tuple]:
        if self.rest:
            yield self.file, self.block, -_M, False, None, b"".join(self.rest)
        if self.headers is not None:
            yield self.file, self.block, self.start, False, list(self.headers.items()), b"".join(self.parts)


def _walking(entries) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, rows, held, usual = None, [], 0, object()
        for batch in batches:
            for file, block, data in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), batch.column("data")):
                found = []
                if walk is None or (walk.file, walk.block) != (file, block):
                    found += walk.end() if walk else []
                    walk = _Walk(file, block, entries.value, usual)
                found += walk.add(data.as_py())
                rows += found
                held += sum(len(r[-1]) for r in found)
                if held > HANDED:
                    yield _parts(rows)
                    rows, held = [], 0
        rows += walk.end() if walk else []
        if rows:
            yield _parts(rows)

    return run


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PART)], schema=_PART)


def _joined(parts: DataFrame, splits: DataFrame) -> DataFrame:
    """Records that go on into later splits, past a magic in their payload: each beginning with the
    pieces that follow it, up to the next beginning."""
    slim = parts.filter("NOT whole").join(splits.select("file", "block", "base"), ["file", "block"])
    slim = slim.withColumn("offset", F.col("base") + F.col("at"))
    before = Window.partitionBy("file").orderBy("offset")  # two rows per split at most
    owner = F.last(F.when(F.col("headers").isNotNull(), F.struct("block", "at")), ignorenulls=True).over(before)
    owned = slim.select("file", "block", "at", "offset", "headers").withColumn("owner", owner).select("file", "block", "at", "offset", "owner")
    pieces = slim.drop("offset", "base").join(owned, ["file", "block", "at"])
    found = pieces.groupBy("file", "owner").agg(F.first("headers", ignorenulls=True).alias("headers"), F.sort_array(F.collect_list(F.struct("offset", "content"))).alias("all"))
    return found.select("file", "owner.block", "owner.at", "headers", F.expr("aggregate(all, cast('' AS binary), (a, p) -> concat(a, p.content))").alias("content"))


def records(spark: SparkSession, folder: str, split: int = SPLIT) -> DataFrame:
    """(file, block, at, headers, payload): the records of all archives in ``folder``. ``headers`` are
    named in lower case; the payload is what follows the HTTP header in a record of that type, and
    the whole content in any other. ``block`` and ``at`` tell the place: the split and the bytes from
    its first stretch.

    A file whose chain of records does not reach its end, as one that was cut off, is an error
    (``Chains.broken`` tells all of them). A record is held whole by a task, as a row (2 GB at most).
    Empty files have no records.
    """
    chains, reader = Chains(spark, folder, split), _with_fixed_splits(spark, split)
    if bad := chains.broken().limit(5).collect():
        raise ValueError(f"records do not reach the end of the file: {[tuple(r) for r in bad]}")
    unusual = stored(chains.unusual())
    many = unusual.count()
    batches, found = max(1, -(-many // ENTRIES)), None
    of = lambda file: F.pmod(F.xxhash64(file), F.lit(batches))
    for n in range(batches):
        entries = {(r["file"], r["block"]): r["entry"] for r in unusual.filter(of("file") == n).collect()}
        data = _stretches(reader, folder, F.col("value").cast("binary").alias("data")).filter(of("file") == n)
        parts = data.mapInArrow(_walking(spark.sparkContext.broadcast(entries)), "file string, block long, at long, whole boolean, headers map<string,string>, content binary")
        found = parts if found is None else found.union(parts)
    all_ = found.filter("whole").select("file", "block", "at", "headers", "content")
    if many:
        all_ = all_.union(_joined(found, chains.splits))
    # the content without the empty lines that end a record
    return all_.select("file", "block", "at", "headers", _payload(F.col("headers"), F.col("content")).alias("payload"))


def _payload(headers: Column, content: Column) -> Column:
    size = headers["content-length"].cast("int")
    block = F.substring(content, F.lit(1), size)
    text = block.cast("string")
    # bytes up to and with the first empty line
    http = F.octet_length(F.substring_index(text, END, 1)) + len(END)
    return F.when(headers["content-type"].startswith("application/http") & F.contains(text, F.lit(END)), F.substring(block, http + 1, size)).otherwise(block)


def page_records(spark: SparkSession, folder: str, split: int = SPLIT) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of archives that ``write`` made.
    The size and digest of a response are measured on its payload; a revisit has those of the
    response that it names by id and digest, so one whose response is missing has no size."""
    id_ = lambda name: F.regexp_extract(F.col("headers")[name], "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
    found = records(spark, folder, split).select(
        id_("warc-record-id").alias("page_id"), F.col("headers")["warc-type"].alias("record_type"), id_("warc-refers-to").alias("refers_to"),
        F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"),
        F.regexp_extract(F.col("headers")["warc-payload-digest"], "^sha1:(.*)$", 1).alias("stated"),
    )
    found = stored(found, spark)
    responses, again = found.filter("record_type <> 'revisit'"), found.filter("record_type = 'revisit'")
    originals = responses.select(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("stated"), "payload_bytes").distinct()
    again = again.drop("payload_bytes").join(originals, ["refers_to", "stated"], "left").withColumn("payload_digest", F.col("stated"))
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return responses.select(*columns).union(again.select(*columns))


def round_trip(pages: DataFrame, at_least: int = 0) -> DataFrame:
    """``pages`` written as archives in the session's shared folder, and what reading them back gives."""
    spark = pages.sparkSession
    folder = fresh_folder(spark, "warc")
    write(pages, folder, at_least)
    return page_records(spark, folder)
