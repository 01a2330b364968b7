"""WARC archives with a two-level capture index.

Archives are written by Spark as WARC/1.1 files of a bounded number of records: the first capture of a payload is a
``response`` record, later ones with the same payload are ``revisit`` records without it. The index is built from the
archives as they were written: captures ordered by reversed-host URL key and id are cut into compressed blocks (second
level), and the first key of every block makes the sparse directory (first level). A lookup searches the directory by
bisection, opens the blocks that can hold the key, bisects in them, and gets the file, offset and length to read.

The directory is small by construction: a block holds at least ``LINES`` captures, and more once there would be over
``DIRECTORY`` blocks, so at most that many keys (plus one for each partition of the order) are broadcast. Nothing else
leaves the executors.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import shuffle_partitions

LINES = 1_000                # captures of a block, at least
DIRECTORY = 100_000          # blocks, at most
RECORDS = 1_000              # records of an archive file
NO_ID = -(1 << 63)           # stands for a null id in the order of the index

CAPTURE = ("key string, id long, url string, type string, refers_to long, digest string, payload_bytes long, "
           "file string, offset long, length long")
_CAPTURE = pa.schema([("key", pa.string()), ("id", pa.int64()), ("url", pa.string()), ("type", pa.string()),
                      ("refers_to", pa.int64()), ("digest", pa.string()), ("payload_bytes", pa.int64()),
                      ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
_BLOCK = pa.schema([("block", pa.int64()), ("key", pa.string()), ("id", pa.int64()), ("n", pa.int64()),
                    ("body", pa.binary())])


def url_key(url: str | None) -> str:
    """``http://www.Example.com:80/a?b#c`` -> ``com,example)/a?b``: host reversed and in lower case, without scheme,
    user, port, leading ``www.`` and fragment. A null or empty url has the empty key."""
    if not url:
        return ""
    url = url.replace("\r", "%0D").replace("\n", "%0A")   # as in the archive's headers
    rest = url.split("://", 1)[-1].split("#", 1)[0]
    cut = min([i for i in (rest.find("/"), rest.find("?")) if i >= 0], default=len(rest))
    host, path = rest[:cut].rsplit("@", 1)[-1].lower(), rest[cut:]
    host = host.split(":", 1)[0].removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + (path if path.startswith("/") else "/" + path)


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column, by built-in functions: 40 bits are ten hex digits, or
    eight digits to the base 32."""
    hexed = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_archives(df: DataFrame, path: str, id: str = "page_id", url: str = "url", payload: str = "html",
                   least: int = 0, records: int = RECORDS) -> None:
    """Write one record per row of ``df`` under ``path``. Of rows with equal payloads of at least ``least`` bytes, those
    with the smallest id are responses and the others revisit it; rows with smaller payloads are all responses.

    A null payload is empty; a null url leaves out the target header; a null id is never the smallest unless the
    payload has no other. Rows with the same id and payload are alike: all response or all revisit. Line ends in
    urls are percent-encoded. An empty table leaves an empty archive. Other columns are not read.
    """
    spark = df.sparkSession
    src = df.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{url}`").alias("url"),
                    F.coalesce(F.col(f"`{payload}`"), F.lit("")).alias("body"))
    src = src.withColumn("digest", base32_sha1(F.col("body").cast("binary")))
    narrow = src.select("id", "digest", F.octet_length("body").alias("n")).where(F.col("n") >= least)
    firsts = narrow.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    # written, so that its size is known: the payloads are shuffled only if the revisits are many
    (narrow.join(firsts, "digest").where(~F.col("id").eqNullSafe(F.col("first"))).where("first is not null")
        .select("id", "digest", "first").distinct().write.parquet(f"{path}/revisits"))
    revisits = spark.read.schema("id long, digest string, first long").parquet(f"{path}/revisits")
    revisits = revisits.select(F.col("id").alias("r_id"), F.col("digest").alias("r_digest"), "first")
    rows = src.join(revisits, F.col("id").eqNullSafe(F.col("r_id")) & (F.col("digest") == F.col("r_digest")), "left")

    crlf = "\r\n"
    again = F.col("first").isNotNull()
    n = F.octet_length("body").cast("string")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{crlf}Content-Type: text/html; charset=utf-8{crlf}Content-Length: "), n,
                    F.lit(crlf * 2))
    block = F.when(again, http).otherwise(F.concat(http, F.col("body")))
    target = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(crlf)), F.lit(""))

    name = F.concat(F.lit("<urn:capture:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">"))
    refers = F.when(again, F.concat(F.lit("<urn:capture:"), F.col("first").cast("string"), F.lit(">")))
    record = F.concat(
        F.lit(f"WARC/1.1{crlf}"), line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", name), F.lit(f"WARC-Date: 2024-01-01T00:00:00Z{crlf}"),
        line("WARC-Target-URI", target), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Profile", F.when(again, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        line("WARC-Refers-To", refers), F.lit(f"Content-Type: application/http;msgtype=response{crlf}"),
        line("Content-Length", F.octet_length("block").cast("string")), F.lit(crlf), F.col("block"))
    # a record ends with two line ends: the writer's line separator
    (rows.withColumn("block", block).select(record.alias("value")).write
        .option("lineSep", crlf * 2).option("maxRecordsPerFile", records).text(f"{path}/archive"))


def parse_archive(data: memoryview, file: str) -> Iterator[tuple]:
    """Captures of one archive file, from its bytes; payloads are digested as they stand there."""
    at, raw = 0, bytes(data)
    while at < len(raw):
        head_end = raw.index(b"\r\n\r\n", at) + 4
        head = dict(x.split(": ", 1) for x in raw[at:head_end - 4].decode().split("\r\n")[1:])
        end = head_end + int(head["Content-Length"])
        http_end = raw.index(b"\r\n\r\n", head_end, end) + 4
        http = dict(x.split(": ", 1) for x in raw[head_end:http_end - 4].decode().split("\r\n")[1:])
        digest, size = head["WARC-Payload-Digest"].removeprefix("sha1:"), int(http["Content-Length"])
        if head["WARC-Type"] == "response":
            body = memoryview(raw)[http_end:end]
            if len(body) != size or base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
                raise ValueError(f"damaged record in {file} at {at}")
        capture, refers = (head.get(k, "")[len("<urn:capture:"):-1] for k in ("WARC-Record-ID", "WARC-Refers-To"))
        url = head.get("WARC-Target-URI")
        yield (url_key(url), int(capture) if capture else NO_ID, url, head["WARC-Type"],
               int(refers) if refers else None, digest, size, file, at, end - at)
        at = end + 4


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Captures (``CAPTURE``) of all archive files, read back whole and verified."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, body in zip(b.column("path").to_pylist(), b.column("content")):
                found = list(parse_archive(memoryview(body.as_buffer()), file))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), _CAPTURE)],
                                                     schema=_CAPTURE)

    files = spark.read.format("binaryFile").load(f"{path}/archive")
    return files.where("length > 0").select("path", "content").mapInArrow(run, CAPTURE)


@dataclass(frozen=True)
class Index:
    """Blocks on disk; the directory as parallel lists ordered by (key, id)."""
    path: str
    keys: list
    blocks: list


def build_index(spark: SparkSession, path: str, lines: int = LINES, most: int = DIRECTORY) -> Index:
    """Index the archives under ``path``. An archive without records has an empty index."""
    read_archives(spark, path).write.parquet(f"{path}/captures")
    captures = spark.read.schema(CAPTURE).parquet(f"{path}/captures")
    n = max(lines, -(-captures.count() // most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []

        def put() -> pa.RecordBatch:
            nonlocal number
            body = zlib.compress("\n".join(json.dumps(r) for r in held).encode())
            row = (number, held[0][0], held[0][1], len(held), body)
            number += 1
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _BLOCK)], schema=_BLOCK)

        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns]):
                held.append(row)
                if len(held) == n:
                    yield put()
        if held:
            yield put()

    order = ["key", "id"]
    (captures.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
        .mapInArrow(run, "block long, key string, id long, n long, body binary").write.parquet(f"{path}/index"))
    first = spark.read.schema("block long, key string, id long").parquet(f"{path}/index").collect()
    first.sort(key=lambda r: (r["key"], r["id"], r["block"]))
    return Index(path, [(r["key"], r["id"]) for r in first], [r["block"] for r in first])


def lookup(spark: SparkSession, index: Index, wanted: DataFrame, url: str = "url", id: str | None = None) -> DataFrame:
    """Captures (``CAPTURE``, id null again where it was) of each distinct url of ``wanted``, or of each distinct url
    and id. URLs that were never captured have no rows; a null url is looked up like any other key."""
    cols = [F.col(f"`{url}`").alias("url")] + ([F.col(f"`{id}`").cast("long").alias("id")] if id else [])
    held = spark.sparkContext.broadcast((index.keys, index.blocks))

    @F.arrow_udf("struct<key: string, blocks: array<long>>")
    def find(urls: pa.Array, ids: pa.Array) -> pa.Array:
        keys, blocks = held.value
        out = []
        for u, i in zip(urls.to_pylist(), ids.to_pylist()):
            k = url_key(u)
            lo, hi = ((k, i), (k, i)) if id else ((k, NO_ID), (k, 1 << 63))
            a, b = max(0, bisect.bisect_left(keys, lo) - 1), bisect.bisect_right(keys, hi)
            out.append({"key": k, "blocks": blocks[a:b]})
        return pa.array(out, pa.struct([("key", pa.string()), ("blocks", pa.list_(pa.int64()))]))

    number = F.coalesce(F.col("id"), F.lit(NO_ID)) if id else F.lit(NO_ID)
    asked = (wanted.select(*cols).withColumn("id", number).select(find("url", "id").alias("f"), "id").distinct()
             .select(F.col("f.key").alias("key"), "id", F.explode("f.blocks").alias("block")))

    def search(key, left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        for body in right.column("body").to_pylist():
            lines = [json.loads(x) for x in zlib.decompress(body).decode().split("\n")]
            order = [(x[0], x[1]) for x in lines]
            for k, i in set(zip(left.column("key").to_pylist(), left.column("id").to_pylist())):
                lo, hi = ((k, i), (k, i)) if id else ((k, NO_ID), (k, 1 << 63))
                rows.extend(lines[bisect.bisect_left(order, lo):bisect.bisect_right(order, hi)])
        columns = list(zip(*rows)) if rows else [[]] * len(_CAPTURE)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CAPTURE)], schema=_CAPTURE)

    blocks = spark.read.schema("block long, body binary").parquet(f"{index.path}/index")
    found = asked.groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(search, CAPTURE)
    return found.withColumn("id", F.when(F.col("id") != NO_ID, F.col("id")))


def read_records(spark: SparkSession, captures: DataFrame) -> DataFrame:
    """``captures`` with their records' bytes: a range of each file that they name. Only those files are opened; the
    names of the files one call needs are listed on the driver."""
    files = [r["file"] for r in captures.select("file").distinct().collect()]
    if not files:
        return captures.withColumn("record", F.lit(None).cast("binary"))
    content = spark.read.format("binaryFile").load(files).select(F.col("path").alias("file"), "content")
    return captures.join(content, "file").withColumn(
        "record", F.expr("substring(content, cast(offset + 1 as int), cast(length as int))")).drop("content")
