"""Centroid clustering (Lloyd's rounds on integer vectors) through a VA-file.

Each dimension's values are cut into up to 2^``bits`` cells at their quantiles over all rows, and a
vector's approximation is the ``bits``-bit numbers of its cells, packed.  For each centroid two
lookup tables give the least and the largest squared difference that a cell allows in a dimension;
their sums are an interval that holds the vector's distance.  A centroid whose interval begins
beyond the end of another's can't be the nearest.  Where one centroid is left, the vector is
assigned by its cells alone; where intervals overlap, the full vector is fetched and held
against the centroids that are left.

The first round writes the table of approximations, assignments and full vectors.  A later
round scans approximations and assignments only (Parquet reads no other column); a vector matters to
the new centroids only if it may have moved, so those whose intervals overlap or whose
only candidate is another centroid than in the first round are fetched by row number, and
the sums of the first round are corrected by what they add and take away.  Where more than a
quarter of the rows are needed, reading the table through is cheaper than the join and
is done instead, with the same result.  The last scan reads all vectors, as their distances are asked for.
Nothing is shuffled but the row numbers and vectors that are fetched, and per task one partial sum for each
centroid and dimension, so a cluster that holds most rows weighs on no task.

All arithmetic is exact: components, distances and sums are integers.

Cases: a vector that is null, of another length, or holds a null or a number that isn't finite takes no
part; rows repeat as they are; a row without an id is clustered like any other, but is a first
centroid only if ids run out; ties go to the smaller centroid number; with fewer vectors than ``k`` there are
as many centroids as vectors; an empty table gives no rows; further columns are ignored.  A
component beyond ``largest_component`` raises an error, as a distance would no longer fit a long.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histdim.llm.frames import stored
from histdim.llm.vectors import finite_vectors, matrix

RESULT = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


@dataclass(frozen=True)
class ClusterParams:
    dims: int = 64
    scale: int = 64
    k: int = 16
    rounds: int = 3
    seed: str = "1:"
    bits: int = 6
    #: Accuracy of the quantiles: cells are cut within 1 / accuracy of their ranks.
    accuracy: int = 2000
    #: Share of rows up to which vectors are fetched by a join.
    fetch_share: float = 0.25

    @property
    def largest_component(self) -> int:
        """Squared distances of such vectors fit a long."""
        return min(2**31 - 1, math.isqrt((2**63 - 1) // (4 * self.dims)))


# --- approximations ------------------------------------------------------------------


def pack(cells: np.ndarray, bits: int) -> np.ndarray:
    """(n, bytes): each row's cell numbers in ``bits`` bits apiece."""
    split = (cells[:, :, None] >> np.arange(bits - 1, -1, -1)) & 1
    return np.packbits(split.reshape(len(cells), -1).astype(np.uint8), axis=1)


def unpack(packed: np.ndarray, dims: int, bits: int) -> np.ndarray:
    split = np.unpackbits(packed, axis=1)[:, :dims * bits].reshape(len(packed), dims, bits)
    return split @ (1 << np.arange(bits - 1, -1, -1))


@dataclass(frozen=True)
class Cells:
    """``upper``: for each dimension the largest value of each cell but the last, ascending;
    ``least`` and ``most``: its smallest and largest value of all."""

    upper: list[np.ndarray]
    least: list[int]
    most: list[int]
    bits: int

    def of(self, full: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(u, full[:, j], "left") for j, u in enumerate(self.upper)], 1)

    def tables(self, centroids: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Per dimension (cells, centroids): least and largest squared difference."""
        low, high = [], []
        for j, upper in enumerate(self.upper):
            begin = np.concatenate([[self.least[j]], upper + 1])[:, None]
            end = np.concatenate([upper, [self.most[j]]])[:, None]
            c = centroids[None, :, j]
            low.append(np.maximum(0, np.maximum(begin - c, c - end)) ** 2)
            high.append(np.maximum(abs(begin - c), abs(end - c)) ** 2)
        return low, high


def left_over(cells: np.ndarray, tables) -> np.ndarray:
    """(n, centroids): whether the centroid's interval begins no later than every interval ends."""
    low, high = tables
    least = np.zeros((len(cells), low[0].shape[1]), np.int64)
    most = least.copy()
    for j in range(cells.shape[1]):
        least += low[j][cells[:, j]]
        most += high[j][cells[:, j]]
    return least <= most.min(1, keepdims=True)


def distances(full: np.ndarray, centroids: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Squared distance of each row to the centroid numbered in ``of``."""
    return ((full - centroids[of]) ** 2).sum(1)


def assign(cells: np.ndarray, fetch, centroids: np.ndarray, tables) -> np.ndarray:
    """The nearest centroid of each row; ``fetch(rows)`` gives full vectors, and is called
    for rows whose intervals overlap."""
    out = np.empty(len(cells), np.int64)
    for lo in range(0, len(cells), 4096):
        some = left_over(cells[lo:lo + 4096], tables)
        out[lo:lo + 4096] = some.argmax(1)
        open_rows = np.flatnonzero(some.sum(1) > 1)
        if len(open_rows):
            full = fetch(open_rows + lo)
            far = np.full((len(open_rows), len(centroids)), np.iinfo(np.int64).max)
            for c in range(len(centroids)):
                here = np.flatnonzero(some[open_rows, c])
                far[here, c] = distances(full[here], centroids, np.full(len(here), c))
            out[open_rows + lo] = far.argmin(1)      # the first of equal ones
    return out


def _unpacked(column: pa.Array, dims: int, bits: int) -> np.ndarray:
    size = -(-dims * bits // 8)
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    return unpack(raw.reshape(-1, size), dims, bits)


# --- Spark -------------------------------------------------------------------------------


def integer_vectors(rows: DataFrame, id_col: str, vec_col: str, p: ClusterParams) -> DataFrame:
    """(row, id, full): the vectors that take part, as integers floor(scale * x)."""
    kept = finite_vectors(rows, id_col, vec_col).filter(F.size("vec") == p.dims)
    scaled = F.transform("vec", lambda x: x.cast("double") * float(p.scale))
    fits = F.forall(scaled, lambda x: F.abs(x) < float(p.largest_component))
    whole = F.when(fits, F.transform(scaled, lambda x: F.floor(x).cast("int"))).otherwise(
        F.raise_error(F.lit(f"a component beyond {p.largest_component} / {p.scale}")).cast("array<int>"))
    return kept.select(F.monotonically_increasing_id().alias("row"), "id", whole.alias("full"))


def first_centroids(base: DataFrame, p: ClusterParams) -> np.ndarray:
    """``k`` rows: those whose seeded ids hash lowest; equal ids by their vectors."""
    mark = F.sha2(F.concat(F.lit(p.seed), F.col("id").cast("string")), 256)
    chosen = base.select(mark.alias("mark"), "id", "full").orderBy(F.asc_nulls_last("mark"), "full").limit(p.k).collect()
    return np.array([r.full for r in chosen], np.int64).reshape(len(chosen), p.dims)


def cut_cells(base: DataFrame, p: ClusterParams) -> Cells:
    """Quantiles of all rows; a row per dimension comes to the driver."""
    n = 1 << p.bits
    shares = F.array(*[F.lit(i / n) for i in range(1, n)])
    cut = (base.select(F.posexplode("full").alias("dim", "x")).groupBy("dim")
           .agg(F.min("x").alias("least"), F.max("x").alias("most"), F.percentile_approx("x", shares, p.accuracy).alias("upper")).collect())
    cut = sorted(cut, key=lambda r: r.dim)
    # A cell ends at a quantile; one that would end with the dimension's largest value is the last anyway.
    upper = [np.unique(np.array([x for x in r.upper if x < r.most], np.int64)) for r in cut]
    return Cells(upper, [r.least for r in cut], [r.most for r in cut], p.bits)


def va_file(base: DataFrame, cells: Cells, centroids: np.ndarray, p: ClusterParams) -> DataFrame:
    """(row, id, cells, was, full): approximations, and the assignments of the first round."""
    tables = cells.tables(centroids)

    def encode(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            full = matrix(batch.column(2), np.int64)
            own = cells.of(full)
            was = assign(own, lambda rows, full=full: full[rows], centroids, tables)
            packed = pa.array([x.tobytes() for x in pack(own, p.bits)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed, pa.array(was.astype(np.int32)), batch.column(2)],
                                             ["row", "id", "cells", "was", "full"])

    kind = base.schema["id"].dataType.simpleString()
    return stored(base.mapInArrow(encode, f"row long, id {kind}, cells binary, was int, full array<int>"), "vafile")


def _totals(moves: DataFrame, k: int, dims: int) -> tuple[np.ndarray, list[int]]:
    """Python integers: sums (k, dims) and counts (k) of partial sums (cluster, dim, total, n)."""
    sums, counts = np.zeros((k, dims), object), [0] * k
    for r in moves.groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect():
        sums[r.cluster, r.dim] = int(r.total)
        counts[r.cluster] = r.n
    return sums, counts


MOVES = "cluster int, dim int, total long, n long"


def _partial(sums: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    some = np.flatnonzero(counts | sums.any(1))
    dims = sums.shape[1]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(some, dims).astype(np.int32)), pa.array(np.tile(np.arange(dims), len(some)).astype(np.int32)),
         pa.array(sums[some].ravel()), pa.array(np.repeat(counts[some], dims))], ["cluster", "dim", "total", "n"])


def _first_sums(table: DataFrame, k: int, dims: int) -> DataFrame:
    def add(batches):
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if batch.num_rows:
                was = batch.column(0).to_numpy()
                np.add.at(sums, was, matrix(batch.column(1), np.int64))
                counts += np.bincount(was, minlength=k)
        yield _partial(sums, counts)

    return table.select("was", "full").mapInArrow(add, MOVES)


def overlapping(table: DataFrame, cells: Cells, centroids: np.ndarray, p: ClusterParams) -> DataFrame:
    """(row): vectors that may have moved since the first round, by their cells alone."""
    tables = cells.tables(centroids)

    def scan(batches):
        for batch in batches:
            if batch.num_rows:
                some = left_over(_unpacked(batch.column(1), p.dims, p.bits), tables)
                moved = (some.sum(1) > 1) | (some.argmax(1) != batch.column(2).to_numpy())
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(moved))], ["row"])

    return table.select("row", "cells", "was").mapInArrow(scan, "row long")


def _moves(fetched: DataFrame, cells: Cells, centroids: np.ndarray, p: ClusterParams) -> DataFrame:
    tables, k = cells.tables(centroids), len(centroids)

    def move(batches):
        sums, counts = np.zeros((k, p.dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            full, was = matrix(batch.column(2), np.int64), batch.column(1).to_numpy()
            now = assign(_unpacked(batch.column(0), p.dims, p.bits), lambda rows, full=full: full[rows], centroids, tables)
            at = np.flatnonzero(now != was)
            for sign, to in ((1, now), (-1, was)):
                np.add.at(sums, to[at], sign * full[at])
                np.add.at(counts, to[at], sign)
        yield _partial(sums, counts)

    return fetched.select("cells", "was", "full").mapInArrow(move, MOVES)


def _next(centroids: np.ndarray, sums: np.ndarray, counts: list[int]) -> np.ndarray:
    out = centroids.copy()
    for c, n in enumerate(counts):
        if n:
            out[c] = [int(s) // n for s in sums[c]]
    return out


def cluster(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", params: ClusterParams = ClusterParams()) -> DataFrame:
    """``id_col``, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each vector that takes part."""
    p, spark = params, rows.sparkSession
    base = stored(integer_vectors(rows, id_col, vec_col, p), "integers")
    centroids = first_centroids(base, p)
    k, kind = len(centroids), base.schema["id"].dataType.simpleString()
    if not k:
        return spark.createDataFrame([], f"`{id_col}` {kind}, {RESULT}")
    cells = cut_cells(base, p)
    table = va_file(base, cells, centroids, p)
    n = table.count()
    if p.rounds:
        sums, counts = _totals(_first_sums(table, k, p.dims), k, p.dims)
        centroids = _next(centroids, sums, counts)
    for _ in range(1, p.rounds):
        needed = stored(overlapping(table, cells, centroids, p), "overlap")
        fetched = table.join(needed, "row") if needed.count() <= p.fetch_share * n else table
        more, change = _totals(_moves(fetched, cells, centroids, p), k, p.dims)
        centroids = _next(centroids, sums + more, [a + b for a, b in zip(counts, change)])

    last, tables = centroids, cells.tables(centroids)

    def finish(batches):
        for batch in batches:
            if batch.num_rows:
                full = matrix(batch.column(2), np.int64)
                of = assign(_unpacked(batch.column(1), p.dims, p.bits), lambda rows, full=full: full[rows], last, tables)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(of.astype(np.int32)), pa.array(distances(full, last, of))],
                                                 ["id", "cluster", "distance"])

    done = stored(table.select("id", "cells", "full").mapInArrow(finish, f"id {kind}, cluster int, distance long"), "clusters")
    spread = {r.cluster: int(r.s) for r in done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in last.tolist()]
    of_cluster = spark.createDataFrame([(c, s, sum(spread.values()), digests[c]) for c, s in spread.items()],
                                       "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")      # at most k rows
    return done.join(F.broadcast(of_cluster), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia",
                                                                "inertia", "centroid_sha256")
