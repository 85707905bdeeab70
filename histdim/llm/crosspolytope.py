"""Nearest neighbours by largest inner product, through cross-polytope hashing.

Vectors of one length become unit vectors of one more component: a candidate x is divided by the
largest norm M and completed by sqrt(1 - |x|^2 / M^2), a query gets a zero there.  The
angle between the two then falls as the inner product rises, whatever the norms.

A table turns such a vector by a pseudo-rotation, three rounds of random signs and a fast
Hadamard transform, and names the nearest of the signed axes.  ``axes`` rotations together make
a bucket's name; their number follows from the number of vectors, so that a bucket holds
some thousands at most if directions are even.  A query probes in each table the buckets whose axes lie
nearest to it.  How many, is measured: a bounded number of queries is answered by
brute force over all vectors, and the probes are those that find ``recall`` of their
neighbours.  Where none do, tables of fewer axes are taken; one axis with all its buckets
probed is exact.

Candidates and probes meet by bucket and are scored there with the original vectors, in
tiles of bounded size on either side, so that no task holds a whole bucket and nothing
is dropped.  A tile answers each query with its best ``k``.  Equal vectors are one candidate
that carries its least ``k + 1`` ids, and one query; a flood of copies is neither hashed nor
compared more than once.  A query that found fewer than ``k`` although there are more candidates is
held against all vectors of its length, in blocks.

Cases: ids are integers; vectors that are null, empty, zero, or hold a null or a number that isn't finite take no part, nor
do rows without an id.  Only vectors of equal length are candidates of each other.
Rows alike in id and vector count once; rows that share an id but not the vector are rows like any other.  Ties go to the smaller id.  An empty table, or one without queries, gives no rows; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from histdim.llm.frames import stored
from histdim.llm.vectors import by_length, finite_vectors, matrix

RESULT = "query_id long, rank int, vec_id long, score double"


@dataclass(frozen=True)
class HashParams:
    k: int = 20
    tables: int = 4
    #: Share of the true neighbours that the probes must find of the queries they are measured on.
    recall: float = 0.965
    measured: int = 96
    #: Buckets a query may probe in a table of several axes.
    most_probes: int = 4096
    #: Vectors of a bucket on average, beyond which a further axis is taken.
    bucket_mean: int = 4096
    #: Candidates, and queries, of a tile.
    tile: int = 4096
    seed: int = 12


# --- hashing --------------------------------------------------------------------------


def norms(m: np.ndarray) -> np.ndarray:
    """Euclidean norms, without overflow."""
    top = np.abs(m).max(1, initial=0)
    safe = np.where(top > 0, top, 1)
    return top * np.sqrt(((m / safe[:, None]) ** 2).sum(1))


@lru_cache(maxsize=64)
def signs(size: int, turn: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, size, turn]).choice([-1.0, 1.0], (3, size))


def turned(m: np.ndarray, size: int, turn: int, seed: int) -> np.ndarray:
    """Rows of ``m``, filled up to ``size`` (a power of two) and pseudo-rotated."""
    out = np.zeros((len(m), size))
    out[:, :m.shape[1]] = m
    for s in signs(size, turn, seed):
        out *= s
        step = 1
        while step < size:
            pair = out.reshape(len(m), -1, 2, step)
            out = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], 2).reshape(len(m), size)
            step *= 2
    return out / size ** 1.5


def rotation_size(d: int) -> int:
    return 1 << d.bit_length()      # room for one more component


def as_candidates(m: np.ndarray, largest: float) -> np.ndarray:
    n = np.minimum(norms(m) / largest, 1)
    return np.concatenate([m / largest, np.sqrt(1 - n * n)[:, None]], 1)


def as_queries(m: np.ndarray) -> np.ndarray:
    return np.concatenate([m / norms(m)[:, None], np.zeros((len(m), 1))], 1)


def bucket_of(unit: np.ndarray, d: int, table: int, axes: int, seed: int) -> np.ndarray:
    """The bucket's number: the nearest signed axis of each rotation, as digits."""
    size, code = rotation_size(d), np.zeros(len(unit), np.int64)
    for a in range(axes):
        y = turned(unit, size, table * 8 + a, seed)
        axis = np.abs(y).argmax(1)
        code = code * (2 * size) + 2 * axis + (y[np.arange(len(y)), axis] < 0)
    return code


def probes_of(unit: np.ndarray, d: int, table: int, axes: int, most: int, seed: int) -> np.ndarray:
    """(rows, up to ``most``) bucket numbers, nearest first: by the sum over rotations of the
    squared gap between the nearest signed axis and the bucket's."""
    size = rotation_size(d)
    gaps, order = [], []
    for a in range(axes):
        y = turned(unit, size, table * 8 + a, seed)
        both = np.stack([y, -y], 2).reshape(len(y), 2 * size)
        rank = np.argsort(-both, axis=1, kind="stable")
        near = np.take_along_axis(both, rank, 1)
        gaps.append((near[:, :1] - near) ** 2)
        order.append(rank)
    if axes == 1:
        return order[0][:, :most]
    return least_sums(gaps, order, most)


@lru_cache(maxsize=8)
def _corner(base: int, axes: int, most: int) -> np.ndarray:
    """(axes, n): the choices of a place per sorted list that can be among the ``most`` with the least
    sums: no more than that many choices are as near in every list."""
    found = np.arange(min(base, most))[None, :]
    for _ in range(1, axes):
        room = most // (found + 1).prod(0)
        each = np.minimum(room, base)
        start = np.repeat(np.cumsum(each) - each, each)
        found = np.concatenate([np.repeat(found, each, axis=1), (np.arange(each.sum()) - start)[None, :]])
    return found


def least_sums(gaps: list[np.ndarray], order: list[np.ndarray], most: int) -> np.ndarray:
    """For each row the codes of the ``most`` choices of one axis per rotation with the least sums of gaps
    (each rotation's gaps ascend; ``order`` names their axes), nearest first."""
    base, at = gaps[0].shape[1], _corner(gaps[0].shape[1], len(gaps), most)
    out = np.empty((len(gaps[0]), min(most, at.shape[1])), np.int64)
    step = max(1, (1 << 22) // at.shape[1])
    for lo in range(0, len(out), step):
        total = sum(g[lo:lo + step][:, a] for g, a in zip(gaps, at))
        near = np.argpartition(total, out.shape[1] - 1, axis=1)[:, :out.shape[1]]
        near = np.take_along_axis(near, np.argsort(np.take_along_axis(total, near, 1), axis=1, kind="stable"), 1)
        code = np.zeros(near.shape, np.int64)
        for o, a in zip(order, at):
            code = code * base + np.take_along_axis(o[lo:lo + step], a[near], 1)
        out[lo:lo + step] = code
    return out


# --- the best of a tile ----------------------------------------------------------------


def first_of(scores: np.ndarray, least: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores, ties to the smaller id."""
    return np.lexsort((least, -scores))[:k]


def best(queries: np.ndarray, vectors: np.ndarray, least: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the (places, scores) of its ``k`` largest inner products, ties to the smaller id
    in ``least``; a score depends on the two vectors alone, not on what else is in the tile."""
    out = []
    step = max(1, (1 << 22) // max(1, len(vectors)))
    for lo in range(0, len(queries), step):
        part = queries[lo:lo + step]
        with np.errstate(over="ignore", invalid="ignore"):
            rough = part @ vectors.T
        for q, row in zip(part, rough):
            at = np.arange(len(row))
            if len(row) > k:
                last = np.partition(row, len(row) - k)[len(row) - k]
                at = np.flatnonzero(row >= last - 1e-9 * abs(last) - 1e-300)
            scores = (vectors[at] * q).sum(1) + 0.0
            first = first_of(scores, least[at], k)
            out.append((at[first], scores[first]))
    return out


# --- Spark ------------------------------------------------------------------------------


def _tile(key: Column, tiles: Column) -> Column:
    return F.pmod(F.xxhash64(key), tiles).cast("int")


def _distinct(pairs: DataFrame, k: int, asks: Column) -> DataFrame:
    """(vid, vec, ids, asks): each distinct vector with its least ``k + 1`` ids and whether it is a query's."""
    asking = pairs.groupBy("vec").agg(F.max(asks).alias("asks"))
    least = (pairs.withColumn("n", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).filter(F.col("n") <= k + 1)
             .groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    return least.join(asking, "vec").withColumn("vid", F.monotonically_increasing_id())


TILED = "qid long, vids array<long>, least array<long>, scores array<double>"


def _found(qids, rows: list) -> pa.Table:
    """Rows of ``TILED`` from (vids, least, scores)."""
    return pa.table({"qid": qids, "vids": pa.array([r[0] for r in rows], pa.list_(pa.int64())),
                     "least": pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                     "scores": pa.array([r[2] for r in rows], pa.list_(pa.float64()))})


def _scored(members: DataFrame, asked: DataFrame, key: list[str], p: HashParams) -> DataFrame:
    """The best ``k + 1`` of each tile for each query in it.  ``members``: key, vid, least, vec;
    ``asked``: key, qid, vec."""
    sizes = (members.groupBy(*key).agg(F.count("*").alias("m")).join(asked.groupBy(*key).agg(F.count("*").alias("q")), key)
             .select(*key, F.ceil(F.col("m") / p.tile).cast("int").alias("down"), F.ceil(F.col("q") / p.tile).cast("int").alias("across")))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (members.join(sizes, key).withColumn("row", _tile(F.col("vid"), F.col("down"))).withColumn("col", every("across"))
            .select(*key, "row", "col", F.lit(False).alias("ask"), "vid", "least", "vec"))
    right = (asked.join(sizes, key).withColumn("col", _tile(F.col("qid"), F.col("across"))).withColumn("row", every("down"))
             .select(*key, "row", "col", F.lit(True).alias("ask"), F.col("qid").alias("vid"), F.lit(None).cast("long").alias("least"), "vec"))
    k = p.k

    def answer(table: pa.Table) -> pa.Table:
        ask = table["ask"].to_numpy()
        if ask.all() or not ask.any():
            return _found(pa.array([], pa.int64()), [])
        ids, vecs, least = table["vid"].to_numpy(), matrix(table["vec"]), table["least"].to_numpy()[~ask].astype(np.int64)
        vids = ids[~ask]
        return _found(ids[ask], [(vids[at], least[at], s) for at, s in best(vecs[ask], vecs[~ask], least, k + 1)])

    return left.unionByName(right).groupBy(*key, "row", "col").applyInArrow(answer, TILED)


def _gathered(found: DataFrame, k: int) -> DataFrame:
    """What tiles found for a query, once each, the best ``k + 1``.  A query's own vector is one of them at
    most, and each carries its ids, so the best ``k`` other rows are among their ids."""

    def merge(table: pa.Table) -> pa.Table:
        vids, least, scores = (table[c].combine_chunks().flatten().to_numpy() for c in ("vids", "least", "scores"))
        vids, once = np.unique(vids, return_index=True)
        first = first_of(scores[once], least[once], k + 1)
        return _found(table["qid"].slice(0, 1), [(vids[first], least[once][first], scores[once][first])])

    return found.groupBy("qid").applyInArrow(merge, TILED)


def _hashed(vectors: DataFrame, axes: int, largest: float, p: HashParams) -> DataFrame:
    """(d, tab, bucket, vid, least, vec) of every vector in every table."""
    kind = vectors.schema["vec"].dataType.simpleString()
    tables, seed = p.tables, p.seed

    def mark(batches):
        for batch in batches:
            vid, least, vec = batch.columns
            for at, m in by_length(vec):
                unit, d = as_candidates(m, largest), m.shape[1]
                rows = pa.array(at)
                for t in range(tables):
                    n = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, d, np.int32)), pa.array(np.full(n, t, np.int32)),
                         pa.array(bucket_of(unit, d, t, axes, seed)), vid.take(rows), least.take(rows),
                         vec.take(rows)], names)

    names = ["d", "tab", "bucket", "vid", "least", "vec"]
    return vectors.select("vid", F.col("ids")[0].alias("least"), "vec").mapInArrow(mark, f"d int, tab int, bucket long, vid long, least long, vec {kind}")


def _probed(asking: DataFrame, axes: int, probes: int, p: HashParams) -> DataFrame:
    """(d, tab, bucket, qid, vec): the buckets that each query looks into."""
    tables, seed = p.tables, p.seed

    def probe(batches):
        for batch in batches:
            for at, m in by_length(batch.column(1)):
                for lo in range(0, len(at), 1024):
                    rows, unit, d = at[lo:lo + 1024], as_queries(m[lo:lo + 1024]), m.shape[1]
                    for t in range(tables):
                        codes = probes_of(unit, d, t, axes, probes, seed)
                        n, each = codes.shape
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, d, np.int32)), pa.array(np.full(n, t, np.int32)),
                             pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * each, codes.ravel()),
                             batch.column(0).take(pa.array(rows))], ["d", "tab", "buckets", "qid"])

    where = stored(asking.select("vid", "vec").mapInArrow(probe, "d int, tab int, buckets array<long>, qid long"), "probes")
    return (where.join(asking.select(F.col("vid").alias("qid"), "vec"), "qid")
            .select("d", "tab", F.explode("buckets").alias("bucket"), "qid", "vec"))


def _probe_count(vectors: DataFrame, n: int, largest: float, p: HashParams) -> tuple[int, int]:
    """(axes, probes) that find ``recall`` of the true neighbours of ``measured`` queries."""
    some = (vectors.filter("asks").orderBy(F.xxhash64("vid"), "vid").limit(p.measured).select("vid", "vec").collect())
    asked = {}
    for r in some:
        asked.setdefault(len(r.vec), []).append(r)
    blocks = {d: (np.array([r.vid for r in rs]), np.array([r.vec for r in rs], float)) for d, rs in asked.items()}
    k = p.k

    def scan(batches):
        tops = {}
        for batch in batches:
            vid = batch.column(0).to_numpy()
            for at, m in by_length(batch.column(1)):
                if m.shape[1] not in blocks:
                    continue
                qids, qs = blocks[m.shape[1]]
                for q, (places, scores) in zip(qids, best(qs, m, vid[at], k + 1)):
                    own, vecs = vid[at[places]] != q, m[places]
                    old = tops.get(q)
                    s, v = scores[own], vecs[own]
                    if old is not None:
                        s, v = np.concatenate([old[0], s]), np.concatenate([old[1], v])
                    first = np.argsort(-s, kind="stable")[:k]
                    tops[q] = s[first], v[first]
        for q, (s, v) in tops.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), q)), pa.array(s), pa.array(list(v), pa.list_(pa.float64()))],
                                             ["qid", "score", "vec"])

    near = vectors.select("vid", "vec").mapInArrow(scan, "qid long, score double, vec array<double>")
    w = Window.partitionBy("qid").orderBy(F.desc("score"))
    near = near.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= k).collect()      # measured * k rows
    of = {}
    for r in near:
        of.setdefault(r.qid, []).append(r.vec)
    d = max((len(r.vec) for r in some), default=1)
    axes = 1
    while axes < 3 and n / (2 * rotation_size(d)) ** axes > p.bucket_mean:
        axes += 1
    while True:
        ranks = []
        for length, (qids, qs) in blocks.items():
            most = 2 * rotation_size(length) if axes == 1 else p.most_probes
            units, best_rank = as_queries(qs), {}
            for t in range(p.tables):
                codes = probes_of(units, length, t, axes, most, p.seed)
                for x, q in enumerate(qids):
                    if q not in of:
                        continue
                    theirs = bucket_of(as_candidates(np.array(of[q], float), largest), length, t, axes, p.seed)
                    place = {c: i for i, c in enumerate(codes[x].tolist())}
                    here = np.array([place.get(c, most) for c in theirs.tolist()])
                    best_rank[q] = np.minimum(best_rank[q], here) if q in best_rank else here
            ranks += [r for v in best_rank.values() for r in v.tolist()]
        limit = 2 * rotation_size(d) if axes == 1 else p.most_probes
        if not ranks:
            return axes, limit
        need = sorted(ranks)[max(0, int(np.ceil(p.recall * len(ranks))) - 1)] + 1
        if need <= limit or axes == 1:
            return axes, min(need, limit)
        axes -= 1


def nearest(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", asks: Column | None = None,
            params: HashParams = HashParams()) -> DataFrame:
    """query_id, rank, vec_id and score: of each row for which ``asks`` (of column ``id``; by default each row) holds,
    the ``k`` rows found with the largest inner products."""
    p, spark = params, rows.sparkSession
    asks = F.lit(True) if asks is None else F.coalesce(asks, F.lit(False))
    pairs = finite_vectors(rows, id_col, vec_col).select(F.col("id").cast("long").alias("id"), "vec")
    pairs = pairs.filter(F.col("id").isNotNull() & F.exists("vec", lambda x: x != 0)).distinct()
    pairs = stored(pairs, "vectors")
    vectors = stored(_distinct(pairs, p.k, asks), "distinct")

    def widest(batches):
        top = [float(norms(m).max()) for batch in batches for _, m in by_length(batch.column(0)) if len(m)]
        if top:
            yield pa.RecordBatch.from_arrays([pa.array([max(top)])], ["norm"])

    size = vectors.select(F.count("*").alias("n"), F.max("asks").alias("asks")).first()
    if not size.asks:
        return spark.createDataFrame([], RESULT)
    largest = vectors.select("vec").mapInArrow(widest, "norm double").agg(F.max("norm")).first()[0]
    axes, probes = _probe_count(vectors, size.n, largest, p)

    asking = vectors.filter("asks").select("vid", "vec")
    found = _scored(_hashed(vectors, axes, largest, p), _probed(asking, axes, probes, p), ["d", "tab", "bucket"], p)
    found = stored(_gathered(found, p.k), "found")

    # Queries that found too few, though there are more: against all vectors of their length, in blocks.
    width = F.size("vec").alias("d")
    there = vectors.select(width, F.size("ids").alias("ids")).groupBy("d").agg(F.sum("ids").alias("there"))
    held = found.select("qid", F.explode("vids").alias("vid")).join(vectors.select("vid", F.size("ids").alias("held")), "vid")
    held = held.groupBy("qid").agg(F.sum("held").alias("held"))
    short = (asking.select(F.col("vid").alias("qid"), "vec", width).join(there, "d").join(held, "qid", "left")
             .filter(F.coalesce("held", F.lit(0)) < F.least(F.lit(p.k + 1), "there")).select("d", "qid", "vec"))
    short = stored(short, "short")
    if short.first() is not None:
        again = _gathered(_scored(vectors.select(width, "vid", F.col("ids")[0].alias("least"), "vec"), short, ["d"], p), p.k)
        found = found.join(short.select("qid"), "qid", "left_anti").unionByName(again)

    # From vectors to ids: a query's own row goes, ties go to smaller ids.
    near = found.select("qid", F.explode(F.arrays_zip("vids", "scores")).alias("f")).select("qid", F.col("f.vids").alias("vid"), "f.scores")
    near = near.join(vectors.select("vid", "ids"), "vid").select("qid", "vid", "scores", F.explode("ids").alias("vec_id"))
    first = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("scores"), "vec_id", "vid"))
    near = near.withColumn("n", first).filter(F.col("n") <= p.k + 1).groupBy("qid").agg(
        F.sort_array(F.collect_list(F.struct("n", "vid", "vec_id", "scores"))).alias("near"))
    asked = pairs.filter(asks).join(vectors.filter("asks").select("vec", F.col("vid").alias("qid")), "vec").select("id", "qid")
    others = F.slice(F.filter("near", lambda x: (x["vec_id"] != F.col("id")) | (x["vid"] != F.col("qid"))), 1, p.k)
    return (asked.join(near, "qid").select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "f"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "f.vec_id", F.col("f.scores").alias("score")))
