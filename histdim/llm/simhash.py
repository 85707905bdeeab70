"""SimHash fingerprints and the links between them.

A fingerprint is 64 majority bits over the hashes of a text's word shingles.
Copies share a fingerprint, so distinct fingerprints are compared.

Two fingerprints within ``radius`` bits agree on at least ``c`` of ``radius + c``
bands of bits; each fingerprint is sent to one group per choice of ``c`` bands,
keyed by them.  ``c`` and the number of key bits follow from the number of
fingerprints, so that a group holds some hundreds.  A group that is larger all the
same (near copies of one text, say) is cut into tiles, and each pair of tiles is
compared in a task of its own, so no task holds an unbounded group and no pair is lost.

Within a group, fingerprints stand vertically: bit plane j holds bit j of 64 of them in
a word.  A query fingerprint turns every plane into 64 differences at once,
which carry-save counters (ones, twos, fours, more) add up; a block of 64 is
abandoned when all its distances exceed the radius.  What leaves a group are the
edges of its components' stars, never its pairs; stars are merged by connected
components over all groups.

Cases: a null or empty text, or one without a word, has fingerprint zero and
is linked like any other; a null id never names a component unless it stands
alone (then the id is null); repeated rows are returned each; an empty table
gives no rows; further columns are ignored or, in ``one_of_each``, kept as they are.
``one_of_each`` judges rows, not ids, so an id with several texts loses no group.  Texts of
any length are hashed whole, a bounded number of shingles at a time.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histdim.llm.components import components
from histdim.llm.frames import stored

#: Fingerprints that a group has on average, and at most before it is cut into tiles.
GROUP_MEAN, GROUP_MOST = 512, 4096
#: Planes between two looks at which blocks are still needed.
PLANES = 8
_U = np.uint64
_ALL = ~_U(0)
SEED = 42


# --- fingerprints -----------------------------------------------------------------


def shingle_hashes(text: bytes, k: int) -> np.ndarray:
    """XXH64 of the shingles of ``k`` words, ASCII letters in lower case; of all
    words where there are fewer."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, _U)
    line, hashed = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= k:
        return np.array([hashed(line, SEED)], _U)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[:len(words) - k + 1].tolist()
    return np.array([hashed(line[a:b], SEED) for a, b in zip(starts, (ends[k - 1:] - 1).tolist())], _U)


def majority(hashes: np.ndarray) -> int:
    """Each bit that is set in over half the hashes."""
    counts = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 1 << 16):      # a bounded part at a time
        bits = np.unpackbits(hashes[lo:lo + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes)).view(">u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                 *further: str) -> DataFrame:
    """(id, print): the fingerprint as a signed 64-bit number; and ``further`` columns."""
    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *further)
    schema = T.StructType([df.schema["id"], T.StructField("print", T.LongType()), *(df.schema[c] for c in further)])

    def mark(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            marks = np.array([majority(shingle_hashes(t.as_py() or b"", shingle)) for t in texts], _U)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks.view(np.int64)),
                                              *(batch.column(2 + k) for k in range(len(further)))], schema.names)

    return df.mapInArrow(mark, schema)


# --- bit-sliced comparison -----------------------------------------------------------


def planes(prints: np.ndarray) -> np.ndarray:
    """(64, blocks): word w of plane j holds bit j of fingerprints 64 w ... 64 w + 63;
    lanes beyond the last repeat it."""
    n = -(-len(prints) // 64) * 64
    full = np.concatenate([prints, np.full(n - len(prints), prints[-1], _U)])
    bits = np.unpackbits(full.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    lanes = np.packbits(bits.T.reshape(64, -1, 64), axis=2, bitorder="little")
    return np.ascontiguousarray(lanes).view("<u8")[..., 0]


def close_pairs(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j) with left[i] and right[j] at most ``radius`` bits apart; the counters hold seven."""
    if not 0 <= radius <= 7:
        raise ValueError(f"a radius of 0 to 7 bits, not {radius}")
    vertical = planes(right)
    found_i, found_j = [], []
    step = max(1, (1 << 16) // vertical.shape[1])
    for lo in range(0, len(left), step):
        queries = left[lo:lo + step]
        blocks = vertical.shape[1]
        q, w = np.repeat(np.arange(len(queries)), blocks), np.tile(np.arange(blocks), len(queries))
        ones, twos, fours, over = (np.zeros(len(q), _U) for _ in range(4))
        for j in range(64):
            if j % PLANES == 0 and j:
                alive = np.flatnonzero(_beyond(ones, twos, fours, over, radius) != _ALL)
                q, w, ones, twos, fours, over = q[alive], w[alive], ones[alive], twos[alive], fours[alive], over[alive]
                if not len(q):
                    break
            differ = vertical[j][w] ^ (_U(0) - ((queries >> _U(63 - j)) & _U(1)))[q]
            carry = ones & differ
            ones ^= differ
            differ = twos & carry
            twos ^= carry
            carry = fours & differ
            fours ^= differ
            over |= carry
        if len(q):
            near = ~_beyond(ones, twos, fours, over, radius)
            some = np.flatnonzero(near)
            lanes = np.unpackbits(near[some].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            at, lane = np.nonzero(lanes)
            i, j = q[some][at] + lo, w[some][at] * 64 + lane
            found_i.append(i[j < len(right)])
            found_j.append(j[j < len(right)])
    if not found_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


def _beyond(ones: np.ndarray, twos: np.ndarray, fours: np.ndarray, over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose count so far exceeds the radius."""
    out = over.copy()
    for count in range(radius + 1, 8):
        lane = ones if count & 1 else ~ones
        lane = lane & (twos if count & 2 else ~twos)
        out |= lane & (fours if count & 4 else ~fours)
    return out


def stars(nodes: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, least node of its component) for the links nodes[i] - nodes[j];
    ``nodes`` ascend."""
    root = np.arange(len(nodes))
    while True:
        before = root
        root = root.copy()
        np.minimum.at(root, i, before[j])
        np.minimum.at(root, j, before[i])
        np.minimum.at(root, before[i], before[j])
        np.minimum.at(root, before[j], before[i])
        root = root[root]
        if (root == before).all():
            moved = np.flatnonzero(root != np.arange(len(nodes)))
            return nodes[moved], nodes[root[moved]]


# --- groups -----------------------------------------------------------------------------


def band_choices(n: int, radius: int, mean: int = GROUP_MEAN) -> list[tuple[int, int]]:
    """For ``n`` fingerprints: a mask of key bits for each choice of bands, such
    that any two within ``radius`` agree on one of them and a group has about
    ``mean`` at most if bits are even."""
    need = max(0, int(np.ceil(np.log2(max(n, 1) / mean))))
    for c in range(1, 64 - radius):
        edges = np.linspace(0, 64, radius + c + 1).astype(int)
        widths = np.diff(edges)
        if c * widths.min() >= need or c == 4:
            break
    masks = []
    for chosen in combinations(range(radius + c), c):
        bits = [b for x in chosen for b in range(edges[x], edges[x + 1])][:max(need, 1)]
        masks.append(sum(1 << (63 - b) for b in bits))
    return [(k, m) for k, m in enumerate(masks)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def print_links(prints: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints (column ``print``: long)
    within ``radius`` bits: stars of each group's components."""
    if not 0 <= radius <= 7:
        raise ValueError(f"a radius of 0 to 7 bits, not {radius}")
    n = prints.count()
    keyed = prints.select("print", F.explode(F.array(*[
        F.struct(F.lit(k).alias("choice"), F.col("print").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for k, m in band_choices(n, radius)])).alias("g")).select("print", "g.*")
    sizes = keyed.groupBy("choice", "key").count().filter("count > 1")
    tiles = sizes.withColumn("tiles", F.ceil(F.col("count") / F.lit(GROUP_MOST)).cast("int")).drop("count")
    # Tile t of a group meets tiles t..last: it goes to the pairs (t, u) and (u, t).
    own = F.pmod(F.xxhash64("print"), F.col("tiles")).cast("int")
    spread = (keyed.join(tiles, ["choice", "key"]).withColumn("own", own)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
              .select("choice", "key", "print", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                      (F.col("own") <= F.col("other")).alias("left"), (F.col("own") >= F.col("other")).alias("right")))

    def compare(table: pa.Table) -> pa.Table:
        every = np.sort(table["print"].to_numpy().astype(np.int64).view(_U))
        if len(every) < 2:
            a = b = every[:0]
        else:
            one, two = (np.sort(table.filter(table[side])["print"].to_numpy().view(_U)) for side in ("left", "right"))
            i, j = close_pairs(one, two, radius) if len(one) and len(two) else (every[:0].astype(int),) * 2
            i, j = np.searchsorted(every, one[i]), np.searchsorted(every, two[j])
            a, b = stars(every, i[i != j], j[i != j])
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return spread.groupBy("choice", "key", "low", "high").applyInArrow(compare, "a long, b long")


def by_component(marked: DataFrame, radius: int) -> DataFrame:
    """(print, component_id) of every distinct fingerprint in ``marked`` (id, print, ...), and
    ``root``, which names the component also where it has no id."""
    least = stored(marked.groupBy("print").agg(F.min("id").alias("least")), "prints")
    links = components(print_links(least.select("print"), radius))
    rooted = least.join(links, least["print"] == links["node"], "left").select(
        "print", "least", F.coalesce("root", "print").alias("root"))
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(of_root, "root").select("print", "component_id", "root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    radius: int = 4) -> DataFrame:
    """``id_col``, ``fingerprint`` and ``component_id``: the least id that is
    reachable over links of at most ``radius`` differing bits."""
    marked = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    digits = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return marked.join(by_component(marked, radius), "print").select(F.col("id").alias(id_col), digits, "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                radius: int = 4) -> DataFrame:
    """A row of each group of near copies, all columns as they are: the one with the least id, rows
    without an id last, and of rows with one id the one whose digest is least.  Texts are shuffled once, by
    that digest, where rows alike in every column meet as one."""
    columns = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    digest = F.concat(F.coalesce(F.sha2(F.col(text_col).cast("string"), 256), F.lit("")), F.hex(F.xxhash64(*columns)))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), digest.alias("digest"))
    rows = packed.select(F.col("row")[id_col].alias("id"), F.col("row")[text_col].alias("text"), "digest")
    marked = stored(fingerprints(rows, "id", "text", shingle, "digest"), "fingerprints")
    first = F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "digest")).alias("s")
    of_print = marked.groupBy("print").agg(first).select("print", "s.*")
    chosen = (of_print.join(by_component(marked, radius).select("print", "root"), "print")
              .groupBy("root").agg(first).select(F.col("s.digest").alias("digest")))
    return (packed.dropDuplicates(["digest"]).join(chosen, "digest", "left_semi")
            .select(*[F.col("row")[c].alias(c) for c in docs.columns]))
