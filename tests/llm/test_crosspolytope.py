from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from histdim.llm import crosspolytope
from histdim.llm.crosspolytope import HashParams, as_candidates, as_queries, best, bucket_of, least_sums, nearest, norms, probes_of, turned
from histdim.llm.registry import op12_nearest

SCHEMA = "vec_id long, embedding array<double>, bucket string, vid int, least int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0, 0) for i, v in rows], SCHEMA)


def brute(rows, asks, k):
    """query id -> [(vec_id, score)] by the definition."""
    ok = lambda v: v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    kept = sorted({(i, tuple(v)) for i, v in rows if i is not None and ok(v)})
    out = {}
    for i, v in kept:
        if asks(i):
            others = [(-float((np.array(v) * np.array(w)).sum()) + 0.0, j) for j, w in kept if len(w) == len(v) and (j, w) != (i, v)]
            out.setdefault(i, []).append([(j, -s + 0.0) for s, j in sorted(others)[:k]])
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def vectors(seed, n, d, spread=1.0):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, d)) * rng.uniform(1, 1 + spread, (n, 1))
    return [(i, r.tolist()) for i, r in enumerate(m)]


def test_pseudo_rotation_keeps_inner_products():
    m = np.random.default_rng(1).normal(size=(20, 7))
    y = turned(m, 8, 3, 5)
    assert np.allclose(y @ y.T, m @ m.T) and not np.allclose(y[:, :7], m)
    assert np.allclose(norms(m), np.linalg.norm(m, axis=1)) and np.isfinite(norms(np.array([[1e200, 1e200]]))).all()


def test_completed_vectors_rank_by_inner_product():
    m = np.array([v for _, v in vectors(2, 50, 6, 4.0)])
    u, q = as_candidates(m, norms(m).max()), as_queries(m)
    assert np.allclose((u ** 2).sum(1), 1) and np.allclose((q ** 2).sum(1), 1)
    assert (np.argsort(u @ q[0]) == np.argsort(m @ m[0])).all()


@pytest.mark.parametrize("axes", [1, 2])
def test_probes_are_sorted_and_complete(axes):
    m = np.array([v for _, v in vectors(3, 6, 3)])
    q = as_queries(m)
    n = (2 * 4) ** axes
    codes = probes_of(q, 3, 0, axes, n, 12)
    for row in codes:
        assert sorted(row.tolist()) == list(range(n))
    own = bucket_of(q, 3, 0, axes, 12)      # a vector's own bucket is probed first
    assert (codes[:, 0] == own).all()


@pytest.mark.parametrize("axes, most", [(2, 1), (2, 7), (2, 36), (3, 40), (3, 216), (3, 500)])
def test_least_sums_match_brute_force(axes, most):
    rng = np.random.default_rng(axes * 100 + most)
    gaps = [np.sort(rng.random((5, 6)), axis=1) for _ in range(axes)]
    order = [np.stack([rng.permutation(6) for _ in range(5)]) for _ in range(axes)]
    got = least_sums(gaps, order, most)
    for r in range(5):
        every = []
        for at in product(range(6), repeat=axes):
            code = 0
            for o, i in zip(order, at):
                code = code * 6 + int(o[r][i])
            every.append((sum(g[r][i] for g, i in zip(gaps, at)), code))
        assert got[r].tolist() == [c for _, c in sorted(every)[:most]]


def test_best_breaks_ties_by_id():
    v = np.array([[1.0, 0], [1, 0], [0, 1], [1, 0], [2, 0]])
    (at, scores), = best(np.array([[1.0, 0]]), v, np.array([9, 3, 1, 5, 7]), 3)
    assert at.tolist() == [4, 1, 3] and scores.tolist() == [2, 1, 1]


def test_all_buckets_probed_is_exact(spark):
    rows = vectors(5, 300, 6, 2.0)
    p = HashParams(k=7, tables=2, recall=1.0, measured=1000)
    got = answers(nearest(frame(spark, rows).repartition(4), asks=F.col("id") % 5 == 0, params=p))
    want = brute(rows, lambda i: i % 5 == 0, 7)
    assert set(got) == set(want)
    for q, near in got.items():
        assert [r for r, _, _ in near] == list(range(1, 8))
        assert [i for _, i, _ in near] == [i for i, _ in want[q][0]]
        assert np.allclose([s for _, _, s in near], [s for _, s in want[q][0]], rtol=0, atol=1e-12)


def test_tiles_lose_nothing(spark):
    rows = vectors(6, 200, 5) + [(1000 + i, [1.0, 0.01 * i, 0.0, 0.0, 0.0]) for i in range(60)]
    small = HashParams(k=5, tables=2, recall=1.0, measured=1000, tile=8)
    want = answers(nearest(frame(spark, rows), asks=F.col("id") % 4 == 0, params=HashParams(k=5, tables=2, recall=1.0, measured=1000)))
    assert answers(nearest(frame(spark, rows).repartition(5), asks=F.col("id") % 4 == 0, params=small)) == want


def test_several_axes_and_short_queries_fall_back_to_all_vectors(spark, monkeypatch):
    """Buckets of two axes, one probed: what is found is too little, so all vectors are searched."""
    rows = vectors(7, 150, 4)
    monkeypatch.setattr(crosspolytope, "_probe_count", lambda *a: (2, 1))
    got = answers(nearest(frame(spark, rows), asks=F.col("id") % 10 == 0, params=HashParams(k=60, tables=1)))
    want = brute(rows, lambda i: i % 10 == 0, 60)
    assert {q: [i for _, i, _ in near] for q, near in got.items()} == {q: [i for i, _ in near[0]] for q, near in want.items()}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (7, [1.0, 0.0]), (40, [0.0, 2.0]), (3, [0.5, 0.5]), (3, [-1.0, 0.0]),
            (60, None), (80, []), (100, [0.0, 0.0]), (120, [1.0, None]), (140, [nan, 1.0]), (160, [inf, 1.0]), (None, [9.0, 9.0]),
            (180, [1.0, 2.0, 3.0]), (200, [1.0, 0.0, 0.0]), (220, [5.0])]
    got = answers(nearest(frame(spark, rows), asks=F.col("id") % 20 == 0, params=HashParams(k=4)))
    want = {q: n[0] for q, n in brute(rows, lambda i: i % 20 == 0, 4).items() if n[0]}
    assert {q: [(i, s) for _, i, s in near] for q, near in got.items()} == want
    assert set(want) == {0, 20, 40, 180, 200}


def test_no_queries_and_no_rows(spark):
    for rows in ([], [(1, [1.0])], [(20, [0.0])]):
        out = nearest(frame(spark, rows), asks=F.col("id") % 20 == 0)
        assert out.collect() == [] and out.columns == ["query_id", "rank", "vec_id", "score"]


def test_a_flood_of_copies(spark):
    rows = [(i, [0.6, 0.8]) for i in range(300)] + vectors(8, 40, 2)[1:]
    rows = [(i, v) for i, v in enumerate([v for _, v in rows])]
    got = answers(nearest(frame(spark, rows).repartition(6), asks=F.col("id") % 20 == 0, params=HashParams(k=20, recall=1.0, measured=1000)))
    want = brute(rows, lambda i: i % 20 == 0, 20)
    assert {q: [i for _, i, _ in n] for q, n in got.items()} == {q: [i for i, _ in n[0]] for q, n in want.items()}


def test_query_finds_nine_tenths_of_the_true_neighbours(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got, want = answers(op12_nearest(spark, sf)), brute(rows, lambda i: i % 20 == 0, 20)
    assert set(got) == set(want) and all(len(n) == 20 for n in got.values())
    hits = sum(len({i for _, i, _ in got[q]} & {i for i, _ in want[q][0]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    by = {i: np.array(v) for i, v in rows}
    for q, near in got.items():
        assert np.allclose([s for _, _, s in near], [float(by[q] @ by[i]) for _, i, _ in near], rtol=0, atol=1e-12)
