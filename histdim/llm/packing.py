"""Token ids packed into rows of one length, as binary columns.

Every document becomes token ids closed by an end id, cut without loss into pieces
of at most ``length`` ids.  The pieces of a pool (some million ids of one
task) are packed best-fit-decreasing: from the longest on, each goes into the
row with the least room that still holds it; a segment tree over room sizes
finds that row in O(log length).  An output row is a row of the packed id matrix
with its cumulative segment lengths, its position ids (they start anew with every segment and with
the padding) and where each segment comes from.

Pools bound memory and never cross tasks; there is no shuffle.  Rows are numbered
by task and order, so a task that runs again writes the same rows.

Cases: a null or empty text is a segment with the end id alone; a null id is
packed with a null; repeated rows are packed each; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histdim.llm.frames import id_text

#: Fixed value: how byte-level BPE vocabularies of this kind divide a text.
BYTE_BPE_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


@dataclass(frozen=True)
class PackParams:
    """``vocabulary``: a file of base64 tokens and ranks, at one path on every
    executor; ``end_id`` closes a document, ``pad_id`` fills a row."""

    vocabulary: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    pattern: str = BYTE_BPE_PATTERN
    end_id: int = 50256
    pad_id: int = 50256
    length: int = 2048
    pool_ids: int = 1 << 22


# --- token ids ----------------------------------------------------------------------


class Tokenizer:
    """A text's ids as little-endian bytes."""

    def __init__(self, params: PackParams):
        import tiktoken

        with open(params.vocabulary, "rb") as file:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, file)}
        self.dtype = np.dtype("<u2" if max(max(ranks.values()), params.end_id, params.pad_id) < 1 << 16 else "<u4")
        self.encoding = tiktoken.Encoding("packed", pat_str=params.pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), self.dtype).tobytes()


@lru_cache(maxsize=2)
def tokenizer(params: PackParams) -> Tokenizer:
    return Tokenizer(params)


# --- packing ------------------------------------------------------------------------


class Room:
    """Rows by the room left in them; a segment tree tells which sizes occur."""

    def __init__(self, length: int):
        self.base = 1 << length.bit_length()
        self.tree = bytearray(2 * self.base)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = room + self.base
        while at and not self.tree[at]:
            self.tree[at] = 1
            at >>= 1

    def least(self, need: int) -> int | None:
        """The least room of at least ``need``."""
        at = need + self.base
        if self.tree[at]:
            return need
        while at > 1:
            if not at & 1 and self.tree[at + 1]:
                at += 1
                while at < self.base:
                    at = 2 * at + (not self.tree[2 * at])
                return at - self.base
            at >>= 1
        return None

    def take(self, room: int) -> int:
        row = self.rows[room].pop()
        if not self.rows[room]:
            at = room + self.base
            self.tree[at] = 0
            while at > 1 and not self.tree[at ^ 1]:
                at >>= 1
                self.tree[at] = 0
        return row


def best_fit_decreasing(sizes: Sequence[int], length: int) -> list[list[int]]:
    """Which pieces share a row; each size is at most ``length``."""
    rows: list[list[int]] = []
    room = Room(length)
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        fits = room.least(sizes[k])
        if fits is None:
            row, fits = len(rows), length
            rows.append([])
        else:
            row = room.take(fits)
        rows[row].append(k)
        if fits > sizes[k]:
            room.put(fits - sizes[k], row)
    return rows


class Pool:
    """Documents waiting to be packed."""

    def __init__(self, params: PackParams, dtype: np.dtype, id_type: pa.DataType):
        self.params, self.dtype, self.id_type = params, dtype, id_type
        self.clear()

    def clear(self) -> None:
        self.parts: list[bytes] = []
        self.owner: list = []
        self.offset: list[int] = []
        self.size = 0

    def add(self, doc, ids: bytes) -> None:
        wide = self.params.length * self.dtype.itemsize
        for lo in range(0, len(ids), wide):
            self.parts.append(ids[lo:lo + wide])
            self.owner.append(doc)
            self.offset.append(lo // self.dtype.itemsize)
        self.size += len(ids) // self.dtype.itemsize

    def packed(self, first: int) -> pa.RecordBatch:
        """The rows, numbered from ``first``."""
        n, item = self.params.length, self.dtype.itemsize
        sizes = [len(p) // item for p in self.parts]
        rows = best_fit_decreasing(sizes, n)
        pad = np.array([self.params.pad_id], self.dtype).tobytes()
        count = np.arange(n, dtype=self.dtype).tobytes()
        ids, positions, lengths, used = [], [], [], []
        for row in rows:
            ends = np.cumsum([0, *(sizes[k] for k in row)]).tolist()
            left = n - ends[-1]
            ids.append(b"".join([*(self.parts[k] for k in row), pad * left]))
            positions.append(b"".join([*(count[:sizes[k] * item] for k in row), count[:left * item]]))
            lengths.append(ends)
            used.append(ends[-1])
        many = len(rows)
        return pa.RecordBatch.from_arrays([
            pa.array(range(first, first + many), pa.int64()), pa.array(ids, pa.binary()), pa.array(positions, pa.binary()),
            pa.array(used, pa.int32()), pa.array(lengths, pa.list_(pa.int32())),
            pa.array([[self.owner[k] for k in row] for row in rows], pa.list_(self.id_type)),
            pa.array([[self.offset[k] for k in row] for row in rows], pa.list_(pa.int64()))], PACKED)


PACKED = ["row_id", "input_ids", "position_ids", "n_tokens", "cu_seqlens", "doc_ids", "doc_offsets"]


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   params: PackParams = PackParams()) -> DataFrame:
    """``row_id``; ``input_ids`` and ``position_ids`` (``length`` little-endian numbers
    of 2 bytes, 4 for larger vocabularies); ``n_tokens`` before the padding;
    ``cu_seqlens``; for each segment its document in ``doc_ids`` and the place in
    the document's ids in ``doc_offsets``."""
    df = id_text(docs, id_col, text_col).select("id", "text", F.spark_partition_id().alias("part"))
    schema = T.StructType([
        T.StructField("row_id", T.LongType()), T.StructField("input_ids", T.BinaryType()),
        T.StructField("position_ids", T.BinaryType()), T.StructField("n_tokens", T.IntegerType()),
        T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())),
        T.StructField("doc_ids", T.ArrayType(df.schema["id"].dataType)),
        T.StructField("doc_offsets", T.ArrayType(T.LongType()))])

    def pack(batches):
        encode = tokenizer(params)
        end, pool, first = np.array([params.end_id], encode.dtype).tobytes(), None, 0
        for batch in batches:
            if pool is None:
                pool, first = Pool(params, encode.dtype, batch.column(0).type), batch.column(2)[0].as_py() << 32
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                pool.add(doc, encode(text.as_py() or "") + end)
                if pool.size >= params.pool_ids:
                    out = pool.packed(first)
                    first += out.num_rows
                    pool.clear()
                    yield from _sliced(out)
        if pool is not None and pool.parts:
            yield from _sliced(pool.packed(first))

    return df.mapInArrow(pack, schema)


def _sliced(batch: pa.RecordBatch, rows: int = 512):
    for lo in range(0, batch.num_rows, rows):
        yield batch.slice(lo, rows)


def write_packed(packed: DataFrame, path: str, rows_per_file: int = 1 << 16) -> None:
    """Parquet files of at most ``rows_per_file`` rows."""
    packed.write.option("maxRecordsPerFile", rows_per_file).parquet(path)


def matrix(rows: Sequence, column: str, length: int) -> np.ndarray:
    """A column of collected rows as a matrix."""
    return np.stack([np.frombuffer(r[column], f"<u{len(r[column]) // length}") for r in rows])
