"""Removal of passages that repeat across documents, behind a count-min prefilter.

A window is ``k`` consecutive words.  A word goes if a window over it also starts
in a document with a smaller id.  Two passes find those windows.

1.  Documents are packed into chunks of a few MB (one compressed row each, stored
    once in the shared folder, bucketed by chunk so that text is never shuffled).  Every chunk makes a sparse count-min sketch of its
    windows, counted once per document: for each of two rows the cells and
    their counts.  The cells of a row are divided among shards by their high bits; each
    shard's sketches are merged in a task of its own and every chunk is told which of
    its cells reached two.  The merged sketch is never held in one place, and the
    estimate never falls short of the true count.
2.  Only windows estimated repeated, in both rows, go on: one row of (96-bit hash,
    least document) per chunk and window, grouped exactly in shards of the hash.
    A chunk is told the least document of those that a smaller one has.

A cell costs about two bytes of shuffle, an exact row about twenty.  A passage that
very many documents share counts once per chunk, whatever its number of copies,
and its windows fall into many shards.  The hash is keyed, and the key is drawn for each run: whatever
they are, two different words share their 64 bits with a chance of 2^-64, and two windows of other words
their 96 bits with one of 2^-96.  Chunks, shards and messages are
bounded; their number grows with the input.

Cases: a null or empty text has no words; a null id neither removes nor loses
words; rows that repeat an id are one document's for the question whose id
is smaller, and each is returned; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histdim.llm.frames import id_text, shuffle_partitions
from histdim.llm.words import Words, blocks, constants, fresh_key, mix, windows
from histdim.session import scratch_path

_U = np.uint64


@dataclass(frozen=True)
class DedupParams:
    """``shard_windows``: windows whose cells one shard counts; ``load``: cells per
    window in each of the sketch's two rows; ``key``: that of the hash, by default drawn for each run."""

    window: int = 13
    chunk_bytes: int = 8 << 20
    shard_windows: int = 4 << 20
    least_shards: int = 48
    load: int = 2
    key: int | None = None


# --- chunks ---------------------------------------------------------------------


def pack(ids: list, texts: list[bytes]) -> bytes:
    sizes = np.array([len(t) for t in texts], np.int64)
    known = np.array([i is not None for i in ids], np.int64)
    values = np.array([i or 0 for i in ids], np.int64)
    head = struct.pack("<q", len(ids)) + values.tobytes() + known.tobytes() + sizes.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(texts))


class Chunk:
    def __init__(self, packed: bytes, params: DedupParams):
        k, key = params.window, params.key or 0
        raw = zstandard.ZstdDecompressor().decompress(packed)
        n = struct.unpack_from("<q", raw)[0]
        self.ids, known, sizes = np.frombuffer(raw, np.int64, 3 * n, 8).reshape(3, n)
        self.known = known.astype(bool)
        self.data = np.frombuffer(raw, np.uint8, offset=8 + 24 * n)
        self.offs = np.concatenate([[0], np.cumsum(sizes)])
        at, row, h, g, self.bounds = [], [], [], [], [np.zeros(1, np.int64)]
        total = 0
        for lo, hi in blocks(self.offs):
            words = Words(self.data[self.offs[lo]:self.offs[hi]], self.offs[lo:hi + 1] - self.offs[lo])
            one = words.hashes(key)
            first, hashed = windows(words, one, k)
            at.append(first + total)
            row.append(words.row[first] + lo)
            h.append(hashed)
            g.append((windows(words, one, k, 1)[1] >> _U(32)).astype(np.uint32))
            self.bounds.append(words.bounds[1:] + total)
            total += len(words)
        empty = np.zeros(0, np.int64)
        self.words, self.bounds = total, np.concatenate(self.bounds)
        self.at, self.row = (np.concatenate(x or [empty]) for x in (at, row))
        self.h = np.concatenate(h or [empty.astype(_U)])
        self.g = np.concatenate(g or [empty.astype(np.uint32)])
        own = self.known[self.row]      # windows of documents without an id take no part
        self.at, self.row, self.h, self.g = self.at[own], self.row[own], self.h[own], self.g[own]

    def once_per_document(self) -> np.ndarray:
        """Window hashes, each once for each id that has it."""
        key = self.h ^ mix(self.ids[self.row].view(_U) + _U(1))
        return self.h[np.unique(key, return_index=True)[1]]


def chunks(docs: DataFrame, id_col: str, text_col: str, params: DedupParams) -> DataFrame:
    """(chunk, packed, windows): documents in order of reading, about
    ``chunk_bytes`` of text a row.  Chunk numbers are fixed once they are written."""
    df = id_text(docs, id_col, text_col).select(F.col("id").cast("long").alias("id"), "text",
                                                F.spark_partition_id().alias("part"))

    def gather(batches):
        ids, texts, size, number, part = [], [], 0, 0, 0

        def row():
            n = sum(max(0, len(t.split()) - params.window + 1) for t in texts)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + number], pa.int64()), pa.array([pack(ids, texts)], pa.binary()),
                 pa.array([n], pa.int64())], ["chunk", "packed", "windows"])

        for batch in batches:
            for i, t, p in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist(),
                               batch.column(2).to_pylist()):
                ids.append(i)
                texts.append(t or b"")
                size, part = size + len(texts[-1]) + 24, p
                if size >= params.chunk_bytes:
                    yield row()
                    ids, texts, size, number = [], [], 0, number + 1
        if ids:
            yield row()

    # Bucketed by chunk: the joins with messages to the chunks move the messages alone.
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "chunks")
    name = f"chunks_{path.rpartition('-')[2]}"
    (df.mapInArrow(gather, "chunk long, packed binary, windows long").write.option("path", path)
     .bucketBy(2 * shuffle_partitions(spark), "chunk").saveAsTable(name))
    held = spark.table(name)
    spark.sql(f"DROP TABLE {name}")      # the files stay, and held knows where and how they are bucketed
    return held


# --- messages ---------------------------------------------------------------------


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, byte planes apart, compressed."""
    raw = struct.pack("<q", len(arrays[0])) + b"".join(
        np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def spread(packed: bytes, *types) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    n, at, out = struct.unpack_from("<q", raw)[0], 8, []
    for t in map(np.dtype, types):
        planes = np.frombuffer(raw, np.uint8, n * t.itemsize, at).reshape(t.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(t).reshape(n))
        at += n * t.itemsize
    return out


def by_shard(shard: np.ndarray):
    """(shard, slice) of ascending shard numbers."""
    at = np.flatnonzero(np.diff(shard, prepend=-1))
    for lo, hi in zip(at, [*at[1:], len(shard)]):
        yield int(shard[lo]), slice(lo, hi)


class Sketch:
    """The layout of the merged sketch: ``shards`` times ``width`` cells a row."""

    def __init__(self, shards: int, params: DedupParams):
        self.shards, self.width = shards, params.load * params.shard_windows
        self.by = constants(77, 2)

    def cells(self, hashes: np.ndarray, row: int) -> np.ndarray:
        """The cell of each window among all shards' cells."""
        high = mix(hashes * self.by[row] + _U(row)) >> _U(11)
        return (high.astype(np.float64) * (self.shards * self.width / 2.0**53)).astype(np.int64)


def _messages(rows: list[tuple]) -> pa.RecordBatch:
    shard, part, chunk, body = zip(*rows) if rows else ((),) * 4
    return pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(part, pa.int32()), pa.array(chunk, pa.int64()),
                                       pa.array(body, pa.binary())], ["shard", "part", "chunk", "body"])


_MESSAGE = "shard int, part int, chunk long, body binary"


def sketched(held: DataFrame, sketch: Sketch, params: DedupParams) -> DataFrame:
    """(shard, part, chunk, body): the chunks' partial sketches; part: the row."""
    def make(batches):
        for batch in batches:
            for chunk, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h, rows = Chunk(packed, params).once_per_document(), []
                for r in (0, 1):
                    cell, count = np.unique(sketch.cells(h, r), return_counts=True)
                    for s, own in by_shard(cell // sketch.width):
                        gap = np.diff(cell[own] - s * sketch.width, prepend=0).astype(np.uint32)
                        rows.append((s, r, chunk, squeeze(gap, np.minimum(count[own], 2).astype(np.uint8))))
                yield _messages(rows)

    return held.select("chunk", "packed").mapInArrow(make, _MESSAGE)


def merged(partial: DataFrame, sketch: Sketch) -> DataFrame:
    """The partial sketches of a shard and row added up; the answer to each chunk
    has a bit for each of its cells: whether it reached two."""
    def add(table: pa.Table) -> pa.Table:
        counts, cells = np.zeros(sketch.width, np.uint8), []
        for body in table["body"]:
            gap, count = spread(body.as_py(), np.uint32, np.uint8)
            cells.append(np.cumsum(gap, dtype=np.int64))
            counts[cells[-1]] = np.minimum(counts[cells[-1]] + count, 2)
        table = table.drop_columns(["body"])
        return table.append_column("body", pa.array([np.packbits(counts[c] > 1).tobytes() for c in cells], pa.binary()))

    return partial.groupBy("shard", "part").applyInArrow(add, _MESSAGE)


def answered(held: DataFrame, answers: DataFrame) -> DataFrame:
    """(chunk, packed, answers): with each chunk's answers by shard and part."""
    mine = answers.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("shard", "part", "body"))).alias("answers"))
    return held.select("chunk", "packed").join(mine, "chunk", "left")


def estimated(chunk: Chunk, sketch: Sketch, answers: list[dict]) -> np.ndarray:
    """Which windows the merged sketch counts twice or more."""
    often = np.ones(len(chunk.h), bool)
    for r in (0, 1):
        cell = sketch.cells(chunk.h, r)      # each window's, and so each distinct one that was sketched
        order = np.argsort(cell)
        new = np.diff(cell[order], prepend=-1) > 0
        cell = cell[order][new]
        bits, at = np.zeros(len(cell), bool), 0
        shards = dict(by_shard(cell // sketch.width))
        for a in answers:
            if a["part"] == r:
                part = shards[a["shard"]]
                n = part.stop - part.start
                bits[part] = np.unpackbits(np.frombuffer(a["body"], np.uint8), count=n).astype(bool)
                at += n
        if at != len(cell):
            raise RuntimeError("a chunk differs from what was sketched of it")
        if len(cell):
            often[order] &= bits[np.cumsum(new) - 1]
    return often


def exact_rows(chunk: Chunk, often: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(h, g, least id, place among them of each window that is ``often``): the
    distinct windows in order of h, with the chunk's least document."""
    h, g, ids = chunk.h[often], chunk.g[often], chunk.ids[chunk.row[often]]
    if not len(h):
        return h, g, ids, np.zeros(0, np.int64)
    order, new = _runs(h, g)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    first = order[new]
    return h[first], g[first], np.minimum.reduceat(ids[order], np.flatnonzero(new)), place


def _exact_shard(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> _U(11)).astype(np.float64) * (shards / 2.0**53)).astype(np.int64)


def asked(with_answers: DataFrame, sketch: Sketch, params: DedupParams) -> DataFrame:
    """(shard, part, chunk, body): part 0 holds the windows estimated repeated, by
    shards of the hash; part 1 tells the chunk itself later which they were."""
    def make(batches):
        for batch in batches:
            for chunk, packed, answers in zip(*(batch.column(i).to_pylist() for i in range(3))):
                c = Chunk(packed, params)
                often = estimated(c, sketch, answers or [])
                h, g, ids, _ = exact_rows(c, often)
                marks = zstandard.ZstdCompressor(level=1).compress(np.packbits(often).tobytes())
                rows = [(-1 - chunk % sketch.shards, 1, chunk, marks)]
                for s, own in by_shard(_exact_shard(h, sketch.shards)):
                    rows.append((s, 0, chunk, squeeze(h[own], g[own], ids[own])))
                yield _messages(rows)

    return with_answers.mapInArrow(make, _MESSAGE)


def grouped(messages: DataFrame) -> DataFrame:
    """The exact groups of a shard: to each chunk the places of its windows that a
    smaller document has, and that document.  Part 1 passes."""
    def least(table: pa.Table) -> pa.Table:
        if table["shard"][0].as_py() < 0:
            return table
        parts = [spread(b.as_py(), _U, np.uint32, np.int64) for b in table["body"]]
        h, g, ids = (np.concatenate(x) for x in zip(*parts))
        order, new = _runs(h, g)
        if (h[order][1:] == h[order][:-1])[new[1:]].any():      # one h with several g: only the full order groups them
            order = np.lexsort((g, h))
            new[1:] = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])
        low = np.empty(len(order), np.int64)
        low[order] = np.minimum.reduceat(ids[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        bodies, at = [], 0
        for _, _, own in parts:
            low_own = low[at:at + len(own)]
            later = np.flatnonzero(low_own < own)
            bodies.append(squeeze(np.diff(later, prepend=0).astype(np.uint32), low_own[later]))
            at += len(own)
        return table.drop_columns(["body"]).append_column("body", pa.array(bodies, pa.binary()))

    return messages.groupBy("shard").applyInArrow(least, _MESSAGE)


def _runs(h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by h, and in it where a run of equal (h, g) begins."""
    order = np.argsort(h)
    new = np.ones(len(order), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])
    return order, new


def removed_words(chunk: Chunk, shards: int, answers: list[dict], k: int) -> np.ndarray:
    """A flag for each word of the chunk."""
    marks = next(a["body"] for a in answers if a["part"] == 1)
    bits = np.frombuffer(zstandard.ZstdDecompressor().decompress(marks), np.uint8)
    often = np.unpackbits(bits, count=len(chunk.h)).astype(bool)
    h, _, least, place = exact_rows(chunk, often)
    own = dict(by_shard(_exact_shard(h, shards)))
    for a in (a for a in answers if a["part"] == 0):
        gap, low = spread(a["body"], np.uint32, np.int64)
        least[own[a["shard"]].start + np.cumsum(gap, dtype=np.int64)] = low
    at, row = chunk.at[often], chunk.row[often]
    gone = at[least[place] < chunk.ids[row]] if len(at) else at
    edge = np.zeros(chunk.words + k + 1, np.int32)
    np.add.at(edge, gone, 1)
    np.add.at(edge, gone + k, -1)
    return np.cumsum(edge)[:chunk.words] > 0


def kept_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               params: DedupParams = DedupParams()) -> DataFrame:
    """``id_col``, ``n_words``, ``n_removed`` and ``kept``: the words left, joined
    by one space."""
    params = replace(params, key=fresh_key()) if params.key is None else params
    held = chunks(docs, id_col, text_col, params)
    total = held.agg(F.sum("windows")).first()[0] or 0
    sketch = Sketch(max(params.least_shards, -(-total // params.shard_windows)), params)
    first = merged(sketched(held, sketch, params), sketch)
    ready = answered(held, grouped(asked(answered(held, first), sketch, params)))
    k = params.window

    def rest(batches):
        for batch in batches:
            for packed, answers in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                c = Chunk(packed, params)
                gone = removed_words(c, sketch.shards, answers, k)
                raw, bounds, out = c.data.tobytes(), c.bounds, []
                n_gone = np.concatenate([[0], np.cumsum(gone)])[bounds]
                for i in range(len(c.ids)):
                    words = raw[c.offs[i]:c.offs[i + 1]].split()
                    if n_gone[i + 1] > n_gone[i]:
                        words = [w for w, g in zip(words, gone[bounds[i]:bounds[i + 1]].tolist()) if not g]
                    out.append(b" ".join(words))
                ids = pa.array(c.ids, mask=~c.known)
                for lo in range(0, len(out), 1000):
                    hi = min(lo + 1000, len(out))
                    yield pa.RecordBatch.from_arrays(
                        [ids[lo:hi], pa.array(np.diff(bounds)[lo:hi]), pa.array(np.diff(n_gone)[lo:hi]),
                         pa.array(out[lo:hi], pa.binary()).cast(pa.string())], ["id", "n_words", "n_removed", "kept"])

    return ready.mapInArrow(rest, "id long, n_words long, n_removed long, kept string").withColumnRenamed("id", id_col)
