"""WARC archives of pages, and their index by external merge.

Writing: a page is a ``response`` record, an HTTP response whose payload is the
page in UTF-8.  Of equal payloads of at least ``MIN_REVISIT`` bytes only that of
the least page_id is stored; the others are ``revisit`` records that refer to
it and hold the HTTP header alone.  Spark's text writer makes the files (a
record is a value, the blank lines between records are its separator), so
archives go to any file system with its commit protocol.

Reading: archive files are read as binary and parsed record by record at their
Content-Length; a response's digest and length come from its payload, a
revisit's from its headers.

Index: each archive's captures, sorted by URL key and timestamp, are a run.  The
runs are dealt into key ranges (URL key, timestamp and id together, so one URL
with very many captures is split too), and in each range the pieces of the k
runs are merged by a loser tree.  Ranges in order, and rows in order within
them, are the captures of all archives in one order: a URL's captures stand
together as its history.

Defined results: null html is the empty payload; a null url has the empty URL
key; rows that share the least page_id of a payload are all responses; a row
without a page_id is a revisit if a row with one has its payload, else a
response; an empty table gives an empty index.  Other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import require_columns, shared_dir, staged

MIN_REVISIT = 100
RECORDS_PER_FILE = 20_000
#: Payload bytes of an archive at most (or one record); an archive is read as one value.
BYTES_PER_FILE = 1 << 29
#: Captures that one task of the merge holds.
CAPTURES_PER_RANGE = 400_000
FIRST_FETCH = "2024-01-01 00:00:00"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
SEPARATOR = "\r\n\r\n"

CAPTURE = pa.schema([
    ("url_key", pa.string()), ("fetch_time", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("archive", pa.string()), ("record_offset", pa.int64())])
CAPTURE_DDL = ("url_key string, fetch_time string, page_id long, url string, record_type string, refers_to long, "
               "payload_bytes long, payload_digest string, archive string, record_offset long")


def with_record_types(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``page_id, url, html, bytes, digest, refers_to`` (null for responses)."""
    require_columns(pages, ["page_id", "url", "html"])
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"),
                        F.octet_length(html).cast("long").alias("bytes"), F.sha2(html, 256).alias("digest"))
    # payloads that occur once need no partner: only the digests of copies are joined
    first = rows.where(F.col("bytes") >= min_revisit).groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").select("digest", "first_id")
    return rows.join(first, "digest", "left").withColumn(
        "refers_to", F.when(F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))).drop("first_id")


def record_text(fetch_time: Column) -> Column:
    """A record without the blank lines that end it."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit(SEPARATOR))
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    lines = [
        F.lit("WARC/1.0"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")),
        F.concat(F.lit("WARC-Date: "), F.date_format(fetch_time, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]", "%0A")),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(SEPARATOR), block)


def write_warc(pages: DataFrame, path: str, fetch_time: Column | None = None, min_revisit: int = MIN_REVISIT,
               records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write gzip-compressed archives of all pages to the folder ``path``.

    ``fetch_time`` is a timestamp over ``page_id`` and ``url``; without one, pages
    count as fetched a second apart in the order of their ids.
    """
    when = F.timestamp_seconds(F.unix_timestamp(F.lit(FIRST_FETCH)) + F.coalesce(F.col("page_id"), F.lit(0))) if fetch_time is None else fetch_time
    rows = with_record_types(pages, min_revisit)
    most = pages.agg(F.max(F.octet_length(F.col("html").cast("string")))).first()[0] or 0
    # archives of records up to a size, doubling it until the largest fits; mostly there is one such class
    low, high = -1, BYTES_PER_FILE // records_per_file
    while True:
        last = high >= most
        some = rows if low < 0 and last else rows.where((F.col("bytes") > low) & (F.col("bytes") <= (most if last else high)))
        some.select(record_text(when).alias("value")).write.mode("append" if low >= 0 else "error").option("lineSep", SEPARATOR).option("compression", "gzip").option(
            "maxRecordsPerFile", max(1, BYTES_PER_FILE // max(high, 1)) if low >= 0 else records_per_file).text(path)
        if last:
            return
        low, high = high, high * 16


def url_key(url: str | None) -> str:
    """The key that orders captures: host labels reversed, then path and query."""
    m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::(\d+))?([^#]*)", url or "")
    if not m:
        return (url or "").partition("#")[0]
    host = m[1].lower()
    host = host[4:] if host.startswith("www.") else host
    port = f":{m[2]}" if m[2] and m[2] not in ("80", "443") else ""
    return ",".join(reversed(host.split("."))) + port + ")" + (m[3] or "/")


def records(content: bytes, compressed: bool) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset in the uncompressed archive, headers, block) of each record."""
    f = gzip.GzipFile(fileobj=io.BytesIO(content)) if compressed else io.BytesIO(content)
    at = 0
    while True:
        line = f.readline()
        if not line:
            return
        start, at = at, at + len(line)
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record at offset {start}")
        headers = {}
        while (line := f.readline()) not in (b"\r\n", b"\n", b""):
            at += len(line)
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        at += len(line)
        block = f.read(int(headers["content-length"]))
        at += len(block)
        yield start, headers, block


def page_of(uri: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", uri or "")
    return int(m[1]) if m else None


def read_records(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """A row per record of the archives in ``path``; each file's rows in the order of the
    index (URL key, timestamp, id).  ``with_payload`` adds the stored payload (null for revisits)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1)):
                rows = []
                for offset, h, block in records(content.as_py(), name.endswith(".gz")):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    kind, url = h["warc-type"], h.get("warc-target-uri")
                    if kind == "response":
                        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                    else:
                        size = int(re.search(rb"(?i)content-length:\s*(\d+)", http)[1])
                        digest = h["warc-payload-digest"].partition(":")[2]
                    rows.append((url_key(url), h["warc-date"], page_of(h["warc-record-id"]), url, kind,
                                 page_of(h.get("warc-refers-to")), size, digest, name.rpartition("/")[2], offset,
                                 *([payload if kind == "response" else None] if with_payload else [])))
                rows.sort(key=lambda r: (r[0], r[1], r[2] is None, r[2] or 0, r[9]))
                schema = CAPTURE.append(pa.field("payload", pa.binary())) if with_payload else CAPTURE
                for lo in range(0, len(rows), 2000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[lo:lo + 2000]), schema)], schema=schema)

    return files.mapInArrow(run, CAPTURE_DDL + ", payload binary" * with_payload)


def merge_runs(runs: list[list[tuple]]) -> Iterator[tuple]:
    """K-way merge of sorted lists with a loser tree.

    Leaves are the runs' heads; an inner node keeps the loser of its match and
    sends the winner up, so the next winner takes one match per level.
    """
    k = len(runs)
    heads = [r[0] if r else None for r in runs]
    at = [0] * k

    def beats(a: int, b: int) -> bool:
        if heads[a] is None or heads[b] is None:
            return heads[a] is not None
        return (heads[a], a) < (heads[b], b)

    losers = [-1] * k  # losers[0] is the winner of all
    for leaf in range(k):
        winner, node = leaf, (leaf + k) // 2
        while node:
            if losers[node] < 0:
                losers[node] = winner
                break
            if beats(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node //= 2
        else:
            losers[0] = winner
    while k and heads[losers[0]] is not None:
        winner = losers[0]
        yield heads[winner]
        at[winner] += 1
        heads[winner] = runs[winner][at[winner]] if at[winner] < len(runs[winner]) else None
        node = (winner + k) // 2
        while node:
            if beats(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node //= 2
        losers[0] = winner


def merged_index(captures: DataFrame, per_range: int = CAPTURES_PER_RANGE) -> DataFrame:
    """All captures in the order of URL key, timestamp and id.

    ``range_no, row_no`` say where a capture stands: ranges are in order, and so
    are the rows of each.
    """
    runs = staged(captures, "runs")
    spark = captures.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // per_range))
    keys = ["url_key", "fetch_time", F.col("page_id").isNull(), "page_id", "archive", "record_offset"]
    dealt = runs.repartitionByRange(ranges, *keys)
    names = [f.name for f in CAPTURE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_run: dict[str, list[tuple]] = {}
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                key = (r[0], r[1], r[2] is None, r[2] or 0, r[8], r[9])
                by_run.setdefault(r[8], []).append((key, r))
        for part in by_run.values():
            part.sort(key=lambda x: x[0])  # pieces of a sorted run arrive in its order, unless a fetch was repeated
        number = TaskContext.get().partitionId()
        rows, n = [], 0
        for _, r in merge_runs(list(by_run.values())):
            rows.append((*r, number, n))
            n += 1
            if len(rows) == 5000:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)

    schema = CAPTURE.append(pa.field("range_no", pa.int32())).append(pa.field("row_no", pa.int64()))

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return dealt.select(*names).mapInArrow(run, CAPTURE_DDL + ", range_no int, row_no long")


def with_place(index: DataFrame) -> DataFrame:
    """The index with every capture's ``place`` in the global order (from 0): the rows of the
    ranges before its own, and its row."""
    index = staged(index, "index")
    sizes = index.groupBy("range_no").agg(F.count("*").alias("n"))  # a row per range
    before = sizes.select("range_no", F.coalesce(F.sum("n").over(
        Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return index.join(F.broadcast(before), "range_no").select(*index.columns, (F.col("before") + F.col("row_no")).alias("place"))


def archive_round_trip(pages: DataFrame, path: str | None = None, fetch_time: Column | None = None,
                       records_per_file: int = RECORDS_PER_FILE) -> DataFrame:
    """Write the archives, read them back and index them: a row per page, in the order of the index."""
    spark = pages.sparkSession
    path = path or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(pages, path, fetch_time, records_per_file=records_per_file)
    index = with_place(merged_index(read_records(spark, path)))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                        "url_key", "fetch_time", "place", "archive", "record_offset", "range_no", "row_no")
