import random

import numpy as np
import pytest
import xxhash

from histdim.llm import simhash
from histdim.llm.components import components
from histdim.llm.registry import op6_simhash
from histdim.llm.simhash import band_choices, close_pairs, majority, near_duplicates, one_of_each, planes, print_links, shingle_hashes, stars
from tests.llm.helpers import ODD_TEXTS, WORD, as_dicts, by_id, docs, prose


def brute_print(text, k=4):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(prints, ids, radius=4):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                root[find(a)] = find(b)
    least = {}
    for x in range(len(ids)):
        least[find(x)] = min(least.get(find(x), ids[x]), ids[x])
    return [least[find(x)] for x in range(len(ids))]


def copies():
    rnd = random.Random(8)
    out = [*ODD_TEXTS, "A b C d", "a B c d", "a b c", "e f"]
    for _ in range(25):
        base = prose(rnd, 150).split()
        for _ in range(rnd.choice([1, 1, 3])):
            w = list(base)
            for _ in range(rnd.choice([0, 1, 2])):
                w[rnd.randrange(len(w))] = "changed"
            out.append("  ".join(w))
    return out


def test_fingerprints_and_components_match_brute_force(spark):
    texts = copies()
    rnd = random.Random(1)
    ids = rnd.sample(range(10_000), len(texts))
    got = by_id(near_duplicates(docs(spark, texts, ids).repartition(3)))
    prints = [brute_print(t) for t in texts]
    assert [got[i]["fingerprint"] for i in ids] == [f"{p:016x}" for p in prints]
    assert [got[i]["component_id"] for i in ids] == brute_components(prints, ids)


def test_xxhash_is_that_of_spark(spark):
    from pyspark.sql import functions as F
    text = "the quick brown fox jumps over the lazy dog and more"
    h = spark.range(1).select(F.xxhash64(F.lit("the quick brown fox"))).first()[0]
    assert int(shingle_hashes(text.encode(), 4)[0]) == h % 2**64


def test_majority_needs_more_than_half():
    assert majority(np.array([1, 2], np.uint64)) == 0
    assert majority(np.array([3, 3, 4], np.uint64)) == 3
    assert majority(np.zeros(0, np.uint64)) == 0


@pytest.mark.parametrize("radius", [0, 1, 4, 6])
def test_close_pairs_match_brute_force(radius):
    rnd = random.Random(radius)
    base = [rnd.getrandbits(64) for _ in range(40)]
    near = [b ^ sum(1 << x for x in rnd.sample(range(64), rnd.randrange(9))) for b in base for _ in range(3)]
    left, right = np.array(base + near, np.uint64), np.array(near[:100], np.uint64)
    i, j = close_pairs(left, right, radius)
    want = {(a, b) for a in range(len(left)) for b in range(len(right))
            if (int(left[a]) ^ int(right[b])).bit_count() <= radius}
    assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)


@pytest.mark.parametrize("radius", [-1, 8, 64])
def test_a_radius_beyond_the_counters_is_an_error(spark, radius):
    with pytest.raises(ValueError, match="radius"):
        close_pairs(np.zeros(1, np.uint64), np.zeros(1, np.uint64), radius)
    with pytest.raises(ValueError, match="radius"):
        near_duplicates(docs(spark, ["a"]), radius=radius)


def test_planes_are_vertical():
    prints = np.array([1 << 63, 1, 0, 3], np.uint64)
    v = planes(prints)
    assert v.shape == (64, 1)
    assert int(v[0][0]) & 15 == 1 and int(v[63][0]) & 15 == 0b1010 and int(v[62][0]) & 15 == 0b1000


def test_some_band_agrees_within_the_radius():
    rnd = random.Random(2)
    for n in (10, 10**5, 10**8, 10**11):
        choices = band_choices(n, 4)
        for _ in range(300):
            a = rnd.getrandbits(64)
            b = a ^ sum(1 << x for x in rnd.sample(range(64), 4))
            assert any(a & m == b & m for _, m in choices)


def test_stars_are_components():
    nodes = np.array([5, 7, 9, 11, 20], np.uint64)
    a, b = stars(nodes, np.array([3, 1, 4]), np.array([1, 2, 4]))
    assert sorted(zip(a.tolist(), b.tolist())) == [(9, 7), (11, 7)]


def test_groups_beyond_the_limit_are_tiled_without_loss(spark, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP_MOST", 5)
    rnd = random.Random(3)
    base = rnd.getrandbits(64)
    prints = {base ^ sum(1 << x for x in rnd.sample(range(64), rnd.randrange(4))) for _ in range(60)}
    prints |= {rnd.getrandbits(64) for _ in range(20)}
    prints = sorted(p - 2**64 if p >= 2**63 else p for p in prints)
    links = print_links(spark.createDataFrame([(p,) for p in prints], "print long"), 4)
    root = {r.node: r.root for r in components(links).collect()}
    want = brute_components([p % 2**64 for p in prints], prints)
    assert [root.get(p, p) for p in prints] == want


def test_components_of_a_long_chain(spark):
    rnd = random.Random(6)
    names = rnd.sample(range(1000), 40)
    edges = list(zip(names[:30], names[1:30])) + [(names[30], names[31]), (names[31], names[31])]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    chain = min(names[:30])
    want = {n: chain for n in names[:30] if n != chain} | {max(names[30:32]): min(names[30:32])}
    assert got == want


def test_one_of_each_group_stays(spark):
    text = prose(random.Random(9), 120)
    d = docs(spark, [text, text, prose(random.Random(10), 120), None, "", text, "q"], [5, 3, 8, 9, 7, None, 5])
    kept = one_of_each(d)
    assert kept.schema == d.schema
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5, 7, 8]      # the copy without an id stands behind 3
    assert one_of_each(docs(spark, [])).collect() == []


def test_every_group_keeps_a_document_though_ids_repeat(spark):
    rnd = random.Random(12)
    a, b, c = (prose(rnd, 120) for _ in range(3))
    for order in ([0, 1, 2], [2, 1, 0], [1, 0, 2]):
        rows = [(5, a), (5, b), (7, a)]
        d = docs(spark, [rows[k][1] for k in order], [rows[k][0] for k in order])
        assert sorted((r.doc_id, r.text) for r in one_of_each(d).collect()) == sorted([(5, a), (5, b)])
    d = docs(spark, [a, b, a, a, b, c, c, c, c], [5, 5, 7, None, None, None, None, None, 5]).repartition(4)
    kept = [(r.doc_id, r.text) for r in one_of_each(d).collect()]
    assert sorted(kept) == sorted([(5, a), (5, b), (5, c)])      # one of each group, whatever its ids


def test_exact_copies_without_ids_are_reduced(spark):
    a = prose(random.Random(13), 120)
    assert [(r.doc_id, r.text) for r in one_of_each(docs(spark, [a] * 20, [None] * 20).repartition(5)).collect()] == [(None, a)]
    assert [(r.doc_id, r.text) for r in one_of_each(docs(spark, [a] * 20, [3] * 20).repartition(5)).collect()] == [(3, a)]


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = by_id(op6_simhash(spark, sf))
    prints = [brute_print(r.text) for r in source]
    ids = [r.doc_id for r in source]
    assert [got[i]["fingerprint"] for i in ids] == [f"{p:016x}" for p in prints]
    assert [got[i]["component_id"] for i in ids] == brute_components(prints, ids)


def test_odd_rows(spark):
    d = spark.createDataFrame([(None, "a b c d e f", 1), (1, "x", 2), (1, "x", 2), (None, "x", 3)],
                              "doc_id long, text string, print int")
    got = as_dicts(near_duplicates(d))
    assert sorted(str((r["doc_id"], r["component_id"])) for r in got) == ["(1, 1)", "(1, 1)", "(None, 1)", "(None, None)"]
    assert near_duplicates(docs(spark, [])).collect() == []


def test_columns_named_as_those_inside(spark):
    a, b = (prose(random.Random(n), 120) for n in (1, 2))
    names = "root string, node int, print int, id int, digest string, row string, least int, s string, component_id int, nameless int"
    d = spark.createDataFrame([(i, t, *["x", 1, 2, 3, "d", "r", 4, "s", 5, 6]) for i, t in ((2, a), (1, a), (None, a), (None, b), (None, b))],
                              f"doc_id long, text string, {names}")
    kept = one_of_each(d)
    assert kept.schema == d.schema and sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, a), (None, b)], key=str)
    assert near_duplicates(d).count() == 5


def test_texts_are_shuffled_once(spark):
    plan = one_of_each(docs(spark, ["a b", "c d"]))._jdf.queryExecution().executedPlan().toString()
    assert sum("row#" in line for line in plan.split("\n") if "Exchange" in line) <= 1
