import random
import re

import numpy as np
import pyarrow as pa
import pytest

from histdim.llm.registry import op9_decontamination
from histdim.llm.tiling import Items, TilingParams, find_leaks, tiles, without_leaks
from tests.llm.helpers import ODD_TEXTS, as_dicts, docs, prose, thue_morse

ITEMS = "item_id long, text string"


def tokens(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())


def brute_tiles(a, b, least=5):
    """Mark the longest unmarked common run (first in a, then in b), until none is left."""
    in_a, in_b, out = [False] * len(a), [False] * len(b), []
    while True:
        best = (0, 0, 0)
        for p in range(len(a)):
            for t in range(len(b)):
                n = 0
                while p + n < len(a) and t + n < len(b) and a[p + n] == b[t + n] and not in_a[p + n] and not in_b[t + n]:
                    n += 1
                if n > best[0]:
                    best = (n, p, t)
        n, p, t = best
        if n < least:
            return sorted(out)
        for j in range(n):
            in_a[p + j] = in_b[t + j] = True
        out.append((p, t, n))


def hashes(words, least):
    return np.array([hash(tuple(words[i:i + least])) % 2**64 for i in range(len(words) - least + 1)], np.uint64)


@pytest.mark.parametrize("seed", range(60))
def test_tiles_match_brute_force(seed):
    rnd = random.Random(seed)
    letters = "ab" if seed % 2 else "abcdef"
    a = [rnd.choice(letters) for _ in range(rnd.randrange(4, 30))]
    b = [rnd.choice(letters) for _ in range(rnd.randrange(30))]
    for _ in range(2):
        x = rnd.randrange(len(a))
        b[rnd.randrange(len(b) + 1):0] = a[x:x + 12]
    least = rnd.choice([2, 3, 5])
    got = tiles(hashes(a, least), hashes(b, least), len(a), len(b), least)
    assert sorted(got) == brute_tiles(a, b, least)


def brute_pairs(rows, items, share=0.8, least=5):
    out = []
    for i, t in rows:
        for j, x in items:
            a, b = tokens(x), tokens(t)
            if len(a) >= least:
                got = brute_tiles(a, b, least)
                n = sum(k for *_, k in got)
                if n >= share * len(a):
                    out.append((i, j, len(a), n, len(got)))
    return sorted(out, key=str)


def fixture():
    rnd = random.Random(21)
    items = [(j, prose(rnd, rnd.randrange(3, 40), 60)) for j in range(12)] + [(20, None), (21, ""), (22, "a b"), (23, "Été, à la mer. Oui! non")]
    rows = list(enumerate(ODD_TEXTS[:7]))
    for i in range(10, 60):
        w = tokens(rnd.choice(items)[1])
        if i % 3 == 0 and len(w) > 12:      # passages in another order
            c = rnd.randrange(5, len(w) - 5)
            w = w[c:] + ["between"] * 3 + w[:c]
        if i % 5 == 0 and w:
            w[rnd.randrange(len(w))] = "other"
        text = prose(rnd, rnd.randrange(30), 60).split()
        text[len(text) // 2:len(text) // 2] = w
        rows.append((i, rnd.choice([" ", ", ", "\n"]).join(x.upper() if rnd.random() < 0.2 else x for x in text)))
    return rows, items


@pytest.mark.parametrize("params", [TilingParams(), TilingParams(block_bytes=300)])
def test_leaks_match_brute_force(spark, params):
    rows, items = fixture()
    d = docs(spark, [t for _, t in rows], [i for i, _ in rows]).repartition(3)
    b = spark.createDataFrame(items, ITEMS)
    got = as_dicts(find_leaks(d, b, params=params))
    want = brute_pairs(rows, items)
    assert len(want) > 20
    assert sorted([(r["doc_id"], r["item_id"], r["n_tokens"], r["n_covered"], r["n_tiles"]) for r in got], key=str) == want
    gone = {i for i, *_ in want}
    kept = without_leaks(d, b, params=params)
    assert kept.schema == d.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in rows if i not in gone)


def test_reordered_passage_is_caught_and_a_shared_phrase_is_not():
    words = [f"t{i}" for i in range(30)]
    items = Items([7], [" ".join(words)], TilingParams())
    moved = " ".join(["x"] * 40 + words[20:] + ["y"] * 3 + words[:10] + ["z"] + words[10:20])
    phrase = " ".join(["x"] * 40 + words[3:14])
    assert items.leaks(pa.array([phrase, moved, None])) == [(1, 0, 30, 3)]


def test_a_document_of_one_repeated_word():
    items = Items([1], ["word " * 40], TilingParams())
    assert items.leaks(pa.array(["word " * 200_000, "word " * 20])) == [(0, 0, 40, 1)]


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = {(r["doc_id"], r["item_id"]) for r in as_dicts(op9_decontamination(spark, sf))}
    want = {(i, j) for i, t in rows for j, x in items if f" {' '.join(tokens(x))} " in f" {' '.join(tokens(t))} "}
    assert want and want <= got


def test_empty_tables_and_clashing_columns(spark):
    none = spark.createDataFrame([], ITEMS)
    d = spark.createDataFrame([(1, "a b c d e f", 3, "x"), (1, "a b c d e f", 3, "x"), (None, None, 4, None)],
                              "doc_id long, text string, item_id int, coverage string")
    assert find_leaks(d, none).collect() == [] and without_leaks(d, none).count() == 3
    one = spark.createDataFrame([(5, "A b, c d e f", 1), (5, "A b, c d e f", 1), (None, "zz", 1)], ITEMS + ", doc_id int")
    assert [(r["doc_id"], r["item_id"]) for r in as_dicts(find_leaks(d, one))] == [(1, 5)] * 4
    assert [r.item_id for r in without_leaks(d, one).collect()] == [4]
    assert find_leaks(docs(spark, []), one).collect() == []


def test_regular_words_are_told_apart():
    one, two = thue_morse(1024)
    items = Items([1], [" ".join([one] * 6 + ["x"])], TilingParams())
    assert items.leaks(pa.array([" ".join([two] * 6 + ["x"]), " ".join([one] * 6 + ["x"])])) == [(1, 0, 7, 1)]


@pytest.mark.parametrize("kind, ids", [("int", [5, 6]), ("long", [5, 6]), ("string", ["five", "six"])])
def test_ids_of_any_type(spark, kind, ids):
    items = spark.createDataFrame([(i, "a b c d e f") for i in ids], f"item_id {kind}, text string")
    d = spark.createDataFrame([(i, "a b c d e f") for i in ids] + [(None, "z")], f"doc_id {kind}, text string")
    got = find_leaks(d, items)
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == sorted((a, b) for a in ids for b in ids)
    assert got.schema["item_id"].dataType == items.schema["item_id"].dataType
