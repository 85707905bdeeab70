"""WARC archives of pages, and the index of their captures.

Writing.  A page becomes a WARC/1.1 record around an HTTP response with its html in
UTF-8.  Of equal payloads (same length and SHA-1) the one with the least page id
is a ``response`` record, the others are ``revisit`` records that refer to it and leave
the payload out.  Which payloads repeat is found from digests alone; the pages are then
joined to those on the digest, a join whose hot keys adaptive execution splits.
Each record is a gzip member of its own, as readers that seek expect it. A task gathers
members up to ``file_bytes`` and Spark's text sink writes them as one row to one file.  The sink ends
each row with its line separator: that is the zero byte with which a gzip member of less than
16 MB of data ends; after a larger last one it is the padding that gzip allows.

Reading.  A file's members are unpacked one after the other, payloads are checked against
their digests, and the file's captures, sorted by URL key, time and page id, form a
run.  Runs are stored, range-partitioned by that key (a URL that holds very many captures
is split by time and id), and within each range the runs' slices, which arrive in their order, undergo a
k-way merge by a tree of losers.  The result is in global order, with each capture's
place in it.  ``fetch`` reads single records by the file, offset and length that the index gives.

Cases: a null html is an empty payload; a null url has no URL key and comes first; a null page id
comes before others of its URL and time, and is never the response of a payload that another page with
an id has (without any id, all are responses); repeated rows with the least id are all responses; an empty table
gives no archive and no rows; further columns are ignored.  Ids must be integers.  A very long page is a
record, and if need be a file, of its own; a worker holds a file and one page at a time, beside an Arrow batch.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from itertools import islice
from urllib.parse import quote, urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histdim.llm.frames import shuffle_partitions, stored

EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")      # the namespace for URLs


@dataclass(frozen=True)
class WarcParams:
    """``least_bytes``: shorter payloads are never revisits; ``file_bytes``: size at which a file is
    closed; ``level``: of compression; ``range_captures``: captures that one merge holds, about."""

    least_bytes: int = 0
    file_bytes: int = 32 << 20
    level: int = 6
    range_captures: int = 250_000


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """The host's labels from the last on, then path and query: captures of one site sort together."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return url.lower()
    host = host.removeprefix("www.")
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port not in (None, 80, 443) else "")
    return f"{key}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


# --- records ------------------------------------------------------------------------


def _name(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A record with the blank line that ends it."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http + payload if refers_to is None else http
    date = EPOCH + timedelta(seconds=(page_id or 0) % 10**9)
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_name(page_id, digest)}", f"WARC-Date: {date:%Y-%m-%dT%H:%M:%SZ}"]
    if url is not None:
        uri = re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url)
        head.append(f"WARC-Target-URI: {uri}")
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_name(refers_to, digest)}", f"WARC-Refers-To-Page-ID: {refers_to}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    """``data`` as a gzip member."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


_STEP = 1 << 14


def members(raw: bytes) -> Iterator[tuple[bytes, int, int]]:
    """(data, offset, length) of each gzip member of a file."""
    view, at = memoryview(raw), 0
    while at < len(raw):
        if raw[at] == 0:      # padding
            at += 1
            continue
        unpacker, out, to = zlib.decompressobj(31), [], at
        while not unpacker.eof:
            if to >= len(raw):
                raise ValueError(f"the member at byte {at} is cut off")
            out.append(unpacker.decompress(view[to:to + _STEP]))
            to = min(to + _STEP, len(raw))
        end = to - len(unpacker.unused_data)
        yield b"".join(out), at, end - at
        at = end


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of a WARC record."""
    split = data.index(b"\r\n\r\n")
    first, *lines = data[:split].decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record")
    head = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    end = split + 4 + int(head["content-length"])
    if data[end:] != b"\r\n\r\n":
        raise ValueError("the record doesn't end where it says")
    return head, data[split + 4:end]


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   params: WarcParams = WarcParams()) -> None:
    """WARC files under ``path``, a record for each page."""
    page = (pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                         F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("body"))
            .withColumn("digest", F.unhex(F.sha1("body"))))
    several = (page.filter(F.octet_length("body") >= params.least_bytes).groupBy("digest")
               .agg(F.count("*").alias("n"), F.min("id").alias("first")).filter("n > 1 and first is not null")
               .select(F.col("digest").alias("of"), "first"))
    linked = page.join(several, F.col("digest") == F.col("of"), "left").select("id", "url", "body", "digest", "first")

    def compose(batches):
        held, size = [], 0
        for batch in batches:
            for i, url, body, digest, first in zip(*batch.columns):
                i, first, body = i.as_py(), first.as_py(), body.as_py()
                if len(body) < params.least_bytes or first == i:
                    first = None
                held.append(member(record(i, url.as_py(), body, base64.b32encode(digest.as_py()).decode(), first), params.level))
                size += len(held[-1])
                if size >= params.file_bytes:
                    yield _row(held)
                    held, size = [], 0
        if held:
            yield _row(held)

    (linked.mapInArrow(compose, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path))


def _row(held: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b"".join(held).removesuffix(b"\0")], pa.binary())], ["value"])


# --- reading and the index -----------------------------------------------------------------

CAPTURE = T.StructType([
    T.StructField("url_key", T.StringType()), T.StructField("timestamp", T.StringType()),
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("refers_to", T.LongType()),
    T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())])
_ORDER = ("url_key", "timestamp", "page_id")
_BYTES = re.compile(rb"\r\nContent-Length: ([0-9]+)\r\n")


def captures(raw: bytes, file: str) -> list[tuple]:
    """A file's captures, sorted: its run."""
    found = []
    for data, at, length in members(raw):
        head, block = parsed(data)
        http, _, body = block.partition(b"\r\n\r\n")
        digest = head["warc-payload-digest"].removeprefix("sha1:")
        if head["warc-type"] == "response":
            size = len(body)
            if payload_digest(body) != digest:
                raise ValueError(f"{file}: the payload at byte {at} differs from its digest")
        else:
            size = int(_BYTES.search(http + b"\r\n")[1])
        number = lambda k: int(head[k]) if k in head else None
        url = head.get("warc-target-uri")
        found.append((url_key(url), re.sub("[^0-9]", "", head["warc-date"]), number("warc-page-id"), url, head["warc-type"],
                      size, digest, number("warc-refers-to-page-id"), file, at, length))
    return sorted(found, key=lambda c: (c[0], c[1], c[2] is not None, c[2] or 0, c[9]))


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all files with ``run`` (the file) and ``place`` in it."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    schema = T.StructType([*CAPTURE.fields, T.StructField("place", T.LongType())])

    def parse(batches):
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                run = captures(content.as_py(), name.as_py().rpartition("/")[2])
                if run:
                    columns = [*zip(*run), range(len(run))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if f.dataType == T.LongType() else pa.string())
                                                      for c, f in zip(columns, schema.fields)], schema.names)

    return files.mapInArrow(parse, schema)


class LoserTree:
    """Merges sorted iterators: each inner node keeps the loser of the match below
    it, so the next least element costs a match per level."""

    def __init__(self, runs: Sequence[Iterator], key: Callable):
        self.runs, self.key = runs, key
        self.n = n = max(1, len(runs))
        self.heads = [next(r, None) for r in runs] or [None]
        self.keys = [None if h is None else (key(h), i) for i, h in enumerate(self.heads)]
        self.loser = [0] * n
        winner = [0] * n + list(range(n))      # of the match at each node; leaves follow
        for at in range(n - 1, 0, -1):
            a, b = winner[2 * at], winner[2 * at + 1]
            winner[at], self.loser[at] = (a, b) if self._before(a, b) else (b, a)
        self.first = winner[1] if n > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        x, y = self.keys[a], self.keys[b]
        return y is None or (x is not None and x < y)

    def __iter__(self):
        while (head := self.heads[self.first]) is not None:
            yield head
            run = self.first
            self.heads[run] = new = next(self.runs[run], None)
            self.keys[run] = None if new is None else (self.key(new), run)
            at = (run + self.n) // 2
            while at:
                if self._before(self.loser[at], run):
                    self.loser[at], run = run, self.loser[at]
                at //= 2
            self.first = run


def merged_index(runs: DataFrame, params: WarcParams = WarcParams()) -> DataFrame:
    """The captures in order of URL key, time and page id, with ``position``, the place in the
    whole index, and ``range``, the part of it that one task merged."""
    total = runs.count()
    n = max(shuffle_partitions(runs.sparkSession), -(-total // params.range_captures))
    spread = runs.repartitionByRange(n, *_ORDER, "file", "offset").withColumn("range", F.spark_partition_id())
    schema = T.StructType([*CAPTURE.fields, T.StructField("range", T.IntegerType()), T.StructField("position", T.LongType())])
    names = [f.name for f in CAPTURE.fields]

    def merge(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        whole = pa.Table.from_batches(held).combine_chunks()
        file = whole["file"].combine_chunks().dictionary_encode().indices.to_numpy()
        place = whole["place"].to_numpy()
        # A slice is as much of a run as arrives in one piece; pieces of a run are merged like others.
        begins = np.flatnonzero(np.append(True, (file[1:] != file[:-1]) | (place[1:] <= place[:-1])))

        def piece(a: int, b: int):
            keys = [whole[c] for c in (*_ORDER, "file", "offset")]
            for lo in range(a, b, 1024):
                hi = min(lo + 1024, b)
                yield from zip(zip(*(k.slice(lo, hi - lo).to_pylist() for k in keys)), range(lo, hi))

        tree = LoserTree([piece(a, b) for a, b in zip(begins, [*begins[1:], whole.num_rows])],
                         lambda x: (x[0][0], x[0][1], x[0][2] is not None, x[0][2] or 0, x[0][3], x[0][4]))
        here, done = whole["range"][0].as_py(), 0
        while part := [row for _, row in islice(tree, 10_000)]:
            out = whole.select(names).take(pa.array(part, pa.int64())).combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [*(out[c].combine_chunks() for c in names), pa.array([here] * len(part), pa.int32()),
                 pa.array(range(done, done + len(part)), pa.int64())], schema.names)
            done += len(part)

    merged = stored(spread.mapInArrow(merge, schema), "index")
    before = (merged.groupBy(F.col("range").alias("of")).agg(F.count("*").alias("n"))      # a row for each range
              .select("of", (F.sum("n").over(Window.orderBy("of")) - F.col("n")).alias("before")))
    return merged.join(F.broadcast(before), F.col("range") == F.col("of")).select(
        *names, "range", (F.col("position") + F.col("before")).alias("position"))


def archived_index(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   params: WarcParams = WarcParams()) -> DataFrame:
    """Writes the archives under ``path``, reads them back and returns their index."""
    write_archives(pages, path, id_col, url_col, html_col, params)
    return merged_index(stored(read_runs(pages.sparkSession, path), "runs"), params)


def fetch(captured: DataFrame, path: str) -> DataFrame:
    """``page_id``, ``file``, ``offset`` and ``payload`` (binary) of the responses among captures of an index, each
    unpacked from its own member alone.  A revisit has no payload: look its ``refers_to`` up.  What is
    gathered of a file are the places wanted in it, which the file's size bounds."""
    wanted = (captured.filter("record_type = 'response'").groupBy(F.col("file").alias("of"))
              .agg(F.sort_array(F.collect_list(F.struct("offset", "length", "page_id"))).alias("places")))
    files = captured.sparkSession.read.format("binaryFile").load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "content")

    def unpack(batches):
        for batch in batches:
            for file, content, places in zip(*batch.columns):
                view = memoryview(content.as_buffer())
                for place in places.as_py():
                    at = place["offset"]
                    block = parsed(zlib.decompress(view[at:at + place["length"]], 31))[1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([place["page_id"]], pa.int64()), pa.array([file.as_py()], pa.string()), pa.array([at], pa.int64()),
                         pa.array([block.partition(b"\r\n\r\n")[2]], pa.binary())], ["page_id", "file", "offset", "payload"])

    return (files.join(wanted, F.col("file") == F.col("of")).select("file", "content", "places")
            .mapInArrow(unpack, "page_id long, file string, offset long, payload binary"))
