"""Benchmark decontamination by greedy string tiling.

Tokens are runs of letters and digits in lower case.  Benchmark items form a
stated query set, held against all documents in blocks of bounded size: a block's
seeds (hashes of ``least`` consecutive tokens) travel with the scan.  A
document and an item that share seeds are a candidate pair if the item's tokens
under shared seeds could reach the coverage at all.  For it, running Karp-Rabin
window hashes give all maximal common runs; again and again the longest run whose
tokens are all unmarked is marked as a tile (an overlapped run competes with what is left of
it), until none of ``least`` tokens is left.  An item has leaked into a document
if its tiles cover ``coverage`` of its tokens, in whatever order they stand there.

Documents are neither shuffled nor joined; a document's work doesn't depend on others.

Cases: a null or empty text or item has no tokens and no pair; items of fewer
than ``least`` tokens are too short to tell and are never reported; rows
that repeat a document or an item are reported each; empty tables give no rows
(and leave all documents); further columns are ignored or kept as they are.
"""

from __future__ import annotations

from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from histdim.llm.frames import id_text
from histdim.llm.words import Words, blocks, fresh_key, utf8, windows

_U = np.uint64
#: Whatever is neither an ASCII letter or digit nor part of a longer character.
_APART = np.ones(256, bool)
_APART[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")] = False
_APART[128:] = False


@dataclass(frozen=True)
class TilingParams:
    """``block_bytes``: text of the benchmark that one scan carries, at most about; ``key``: that of the
    hashes, by default drawn for each block."""

    least: int = 5
    coverage: float = 0.8
    block_bytes: int = 4 << 20
    key: int | None = None


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return utf8(pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")))


def common_runs(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(-length, place in item, place in text) of all maximal common runs of at least
    ``least`` tokens.  Both are given by their window hashes."""
    order = np.argsort(text, kind="stable")
    ranked = text[order]
    runs: list[tuple[int, int, int]] = []
    at, begun = np.zeros(0, np.int64), np.zeros(0, np.int64)      # runs that reach the last window: text place, first item place
    for p in range(len(item) + 1):
        if p < len(item):
            now = np.sort(order[np.searchsorted(ranked, item[p]):np.searchsorted(ranked, item[p], "right")])
        else:
            now = at[:0]
        ended = ~np.isin(at + 1, now, assume_unique=True)
        runs += [(-(p - b + least - 1), b, t - (p - 1 - b)) for t, b in zip(at[ended].tolist(), begun[ended].tolist())]
        first = np.full(len(now), p)
        if len(at):
            before = np.minimum(np.searchsorted(at, now - 1), len(at) - 1)
            goes_on = at[before] == now - 1
            first[goes_on] = begun[before[goes_on]]
        at, begun = now, first
    return runs


def tiles(item: np.ndarray, text: np.ndarray, n_item: int, n_text: int, least: int) -> list[tuple[int, int, int]]:
    """(place in item, place in text, length) of the greedy tiles."""
    todo = common_runs(item, text, least)
    heapify(todo)
    in_item, in_text, out = bytearray(n_item), bytearray(n_text), []
    while todo:
        n, p, t = heappop(todo)
        n = -n
        taken = [j for j in range(n) if in_item[p + j] or in_text[t + j]]
        if taken:
            for lo, hi in zip([-1, *taken], [*taken, n]):
                if hi - lo - 1 >= least:
                    heappush(todo, (-(hi - lo - 1), p + lo + 1, t + lo + 1))
            continue
        in_item[p:p + n] = in_text[t:t + n] = b"\x01" * n
        out.append((p, t, n))
    return out


class Items:
    """A block of the benchmark: its seeds and which items hold them."""

    def __init__(self, ids: list, texts: list[str], params: TilingParams):
        self.params, self.key = params, fresh_key() if params.key is None else params.key
        words = Words(*_tokens(pa.array(texts, pa.string())), _APART)
        at, seeds = windows(words, words.hashes(self.key), params.least)
        row = words.row[at]
        keep = np.flatnonzero(np.bincount(row, minlength=len(ids)))
        self.ids = [ids[i] for i in keep]
        self.sizes = np.diff(words.bounds)[keep]
        edges = np.searchsorted(row, [*keep, len(ids)])
        self.seeds = [seeds[a:b] for a, b in zip(edges, edges[1:])]
        pairs = np.unique(np.stack([seeds, np.searchsorted(keep, row).astype(_U)], 1), axis=0)
        self.known, first = np.unique(pairs[:, 0], return_index=True)
        self.first, self.holder = np.append(first, len(pairs)), pairs[:, 1].astype(np.int64)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(seeds & _U((1 << 20) - 1)).astype(np.int64)] = True

    def leaks(self, texts: pa.Array) -> list[tuple[int, int, int, int]]:
        """(row, item, covered tokens, tiles) of the pairs that reach the coverage."""
        data, offs = _tokens(texts)
        found = []
        for lo, hi in blocks(offs) if len(self.known) else ():
            words = Words(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], _APART)
            at, seeds = windows(words, words.hashes(self.key), self.params.least)
            some = np.flatnonzero(self.maybe[(seeds & _U((1 << 20) - 1)).astype(np.int64)])
            place = np.minimum(np.searchsorted(self.known, seeds[some]), len(self.known) - 1)
            hit = self.known[place] == seeds[some]
            at, seeds, place = at[some[hit]], seeds[some[hit]], place[hit]
            rows = words.row[at]
            edges = np.flatnonzero(np.diff(rows, prepend=-1, append=-1))
            for a, b in zip(edges, edges[1:]):
                found += self._of_document(int(rows[a]) + lo, at[a:b], seeds[a:b], np.unique(place[a:b]))
        return found

    def _of_document(self, row: int, at: np.ndarray, seeds: np.ndarray, place: np.ndarray):
        least, share = self.params.least, self.params.coverage
        held = np.concatenate([self.holder[self.first[k]:self.first[k + 1]] for k in place])
        items, count = np.unique(held, return_counts=True)
        shared = self.known[place]
        for item in items[count * least >= share * self.sizes[items] / self._most_repeats(items)].tolist():
            own = np.flatnonzero(np.isin(self.seeds[item], shared))
            under = np.zeros(self.sizes[item], bool)
            for j in range(least):
                under[own + j] = True
            if under.sum() < share * self.sizes[item]:
                continue
            # The document's part under shared seeds, runs set apart by a place that matches nothing.
            mine = np.isin(seeds, self.seeds[item])
            text = np.zeros(0, _U)
            if mine.any():
                p = at[mine]
                gap = np.diff(p, prepend=p[0] - 1)
                place_in = np.cumsum(np.where(gap == 1, 1, least + 1)) - 1
                text = np.zeros(int(place_in[-1]) + 1, _U)
                text[place_in] = seeds[mine]
            own_seeds = self.seeds[item]
            got = tiles(own_seeds, text, int(self.sizes[item]), len(text) + least, least)
            covered = sum(n for _, _, n in got)
            if covered >= share * self.sizes[item]:
                yield row, item, covered, len(got)

    def _most_repeats(self, items: np.ndarray) -> np.ndarray:
        """How often an item holds one seed, at most: its distinct seeds cover that many times more."""
        if not hasattr(self, "_repeats"):
            self._repeats = np.array([np.unique(s, return_counts=True)[1].max() for s in self.seeds])
        return self._repeats[items]


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, params: TilingParams):
    """The benchmark in blocks of about ``block_bytes`` (a longer item is a block's excess)."""
    items = id_text(benchmark, item_col, text_col).filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // params.block_bytes)
    for b in range(n):
        rows = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b).collect()
        yield Items([r["id"] for r in rows], [r["text"] for r in rows], params)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", params: TilingParams = TilingParams()) -> DataFrame:
    """A row for each document and item that leaked into it: ``id_col``,
    ``item_col``, ``n_tokens`` of the item, ``n_covered``, ``coverage``, ``n_tiles``."""
    df = id_text(docs, id_col, text_col)
    schema = T.StructType([
        T.StructField("id", df.schema["id"].dataType), T.StructField("item", benchmark.schema[item_col].dataType),
        T.StructField("n_tokens", T.LongType()), T.StructField("n_covered", T.LongType()),
        T.StructField("coverage", T.DoubleType()), T.StructField("n_tiles", T.LongType())])
    found = df.sparkSession.createDataFrame([], schema)
    for items in item_blocks(benchmark, item_col, item_text, params):
        found = found.unionAll(df.mapInArrow(_reporter(df.sparkSession.sparkContext.broadcast(items), to_arrow_type(schema["item"].dataType)), schema))
    return found.withColumnsRenamed({"id": id_col, "item": item_col})


def _reporter(shared, item_type):
    def report(batches):
        items = shared.value
        for batch in batches:
            leaks = items.leaks(batch.column(1))
            rows = pa.array([r for r, *_ in leaks], pa.int64())
            n = [int(items.sizes[i]) for _, i, *_ in leaks]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), pa.array([items.ids[i] for _, i, *_ in leaks], item_type),
                 pa.array(n, pa.int64()), pa.array([c for *_, c, _ in leaks], pa.int64()),
                 pa.array([c / m for (*_, c, _), m in zip(leaks, n)], pa.float64()),
                 pa.array([k for *_, k in leaks], pa.int64())],
                ["id", "item", "n_tokens", "n_covered", "coverage", "n_tiles"])

    return report


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", params: TilingParams = TilingParams()) -> DataFrame:
    """The documents into which no item leaked, all columns as they are."""
    text_at, kept = docs.columns.index(text_col), docs
    for items in item_blocks(benchmark, item_col, item_text, params):
        kept = kept.mapInArrow(_remover(docs.sparkSession.sparkContext.broadcast(items), text_at), docs.schema)
    return kept


def _remover(shared, text_at: int):
    def remove(batches):
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            keep[[r for r, *_ in shared.value.leaks(batch.column(text_at))]] = False
            yield batch.filter(pa.array(keep))

    return remove
