import hashlib
import math
import random

import numpy as np
import pytest

from histdim.llm import vafile
from histdim.llm.registry import ORACLES, op11_va_file
from histdim.llm.vafile import Cells, ClusterParams, assign, cluster, integer_vectors, left_over, pack, unpack
from tests.llm.oracle import same_rows

SMALL = ClusterParams(dims=3, scale=64, k=4, rounds=3, bits=2)


def brute(rows, p):
    """(id, cluster, distance) and the centroids, by the definition."""
    kept = [(i, [math.floor(p.scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == p.dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: ("~" if r[0] is None else hashlib.sha256(f"{p.seed}{r[0]}".encode()).hexdigest(), r[1]))
    cs = [v for _, v in order[:p.k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min(range(len(cs)), key=lambda c: (far(v, cs[c]), c))
    for _ in range(p.rounds):
        of = [near(v) for _, v in kept]
        cs = [[sum(col) // len(col) for col in zip(*own)] if (own := [v for (_, v), c in zip(kept, of) if c == x]) else cs[x]
              for x in range(len(cs))]
    return [(i, near(v), far(v, cs[near(v)])) for i, v in kept], cs


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, cells string, was int")


def check(spark, rows, p):
    got = cluster(frame(spark, rows).repartition(3), params=p).collect()
    want, cs = brute(rows, p)
    key = lambda r: (r[0] is None, r)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=key) == sorted(want, key=key)
    for r in got:
        assert r.inertia == sum(d for _, _, d in want)
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, cs[r.cluster])).encode()).hexdigest()
    return got


def blobs(seed, n, dims=3, groups=5):
    rnd = random.Random(seed)
    at = [[rnd.uniform(-3, 3) for _ in range(dims)] for _ in range(groups)]
    return [(i, [x + rnd.gauss(0, 0.15) for x in at[i % groups]]) for i in range(n)]


@pytest.mark.parametrize("share", [0.0, 1.0])
@pytest.mark.parametrize("bits", [1, 2, 6])
def test_rows_match_brute_force_by_join_and_by_scan(spark, share, bits):
    """``fetch_share`` chooses between fetching by row number and reading all; rows don't differ."""
    check(spark, blobs(bits, 200), ClusterParams(dims=3, k=4, rounds=3, bits=bits, fetch_share=share))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = blobs(7, 30) + [(100, None), (101, []), (102, [1.0, 2.0]), (103, [1.0, None, 2.0]), (104, [nan, 0.0, 0.0]),
                           (105, [inf, 0.0, 0.0]), (None, [0.5, 0.5, 0.5]), (3, [0.25, 0.25, 0.25]), (3, [0.25, 0.25, 0.25]),
                           (106, [-0.0, 0.0, 1e-300]), (107, [-1e-300, 0.0, 0.0])]
    got = check(spark, rows, SMALL)
    assert len(got) == 35 and list(got[0].asDict()) == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_few_equal_and_no_vectors(spark):
    check(spark, [(1, [0.0, 0.0, 0.0]), (2, [1.0, 1.0, 1.0])], SMALL)
    check(spark, [(i, [0.5, 0.5, 0.5]) for i in range(9)], SMALL)      # ties: all in cluster 0, the others stay empty
    empty = cluster(frame(spark, []), params=SMALL)
    assert empty.collect() == [] and empty.columns[0] == "vec_id"


def test_a_component_too_large_is_an_error(spark):
    with pytest.raises(Exception, match="component beyond"):
        integer_vectors(frame(spark, [(1, [1e30, 0.0, 0.0])]), "vec_id", "embedding", SMALL).collect()


def test_intervals_hold_the_distance_and_full_vectors_are_fetched_only_where_they_overlap():
    rng = np.random.default_rng(5)
    full = np.concatenate([rng.integers(-30, 30, (300, 8)), rng.integers(900, 960, (300, 8))])
    cs = np.array([[0] * 8, [930] * 8, [20] * 8])
    cells = Cells([np.unique(np.quantile(full[:, j], np.arange(1, 16) / 16, method="lower")).astype(int) for j in range(8)],
                  full.min(0).tolist(), full.max(0).tolist(), 4)
    own = cells.of(full)
    low, high = cells.tables(cs)
    true = ((full[:, None] - cs) ** 2).sum(-1)
    assert (sum(low[j][own[:, j]] for j in range(8)) <= true).all() and (sum(high[j][own[:, j]] for j in range(8)) >= true).all()
    fetched = []
    of = assign(own, lambda rows: fetched.extend(rows) or full[rows], cs, (low, high))
    assert (of == true.argmin(1)).all()
    assert fetched and sum(r >= 300 for r in fetched) < 60      # but for cells that reach over the gap, the distant group needs none
    assert sorted(fetched) == np.flatnonzero(left_over(own, (low, high)).sum(1) > 1).tolist()


@pytest.mark.parametrize("bits", [1, 3, 6, 8])
def test_packing_round_trip(bits):
    cells = np.random.default_rng(bits).integers(0, 1 << bits, (50, 13))
    packed = pack(cells, bits)
    assert packed.shape[1] == -(-13 * bits // 8) and (unpack(packed, 13, bits) == cells).all()


def test_later_rounds_read_approximations_only(spark):
    p = ClusterParams(dims=3, k=4, bits=4)
    base = vafile.stored(integer_vectors(frame(spark, blobs(1, 60)), "vec_id", "embedding", p), "integers")
    cells = vafile.cut_cells(base, p)
    cs = vafile.first_centroids(base, p)
    plan = vafile.overlapping(vafile.va_file(base, cells, cs, p), cells, cs, p)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<row:bigint,cells:binary,was:int>" in plan


def test_query_equals_its_sql(spark):
    same_rows(spark, op11_va_file, ORACLES["op11_va_file"], "/root/testdata/sf0.01")
