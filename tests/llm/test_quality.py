import random
from collections import Counter

import numpy as np
import pyarrow as pa

from histdim.llm.quality import STATISTICS, ForestParams, IsolationForest, calibrated, judge_documents, keep_good, statistics, telling
from histdim.llm.registry import op4_quality
from histdim.llm.words import utf8
from tests.llm.helpers import ODD_TEXTS, WORD, as_dicts, by_id, docs, prose, thue_morse


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = set()
    for i, g in enumerate(zip(w, w[1:], w[2:])):
        if grams[g] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "base_failed": len(w) < 50 or 100 * len(covered) > 50 * len(w)}


def texts():
    rnd = random.Random(2)
    out = [*ODD_TEXTS]
    for _ in range(300):
        t = prose(rnd, rnd.randrange(200), rnd.choice([3, 20, 400]))
        t = "".join(rnd.choice([c, "\n", "é#", "\n\n"]) if c == " " and rnd.random() < 0.1 else c for c in t)
        out.append(t)
    return out


def test_statistics_match_brute_force():
    all_texts = texts()
    got = statistics(*utf8(pa.array(all_texts)))
    for i, t in enumerate(all_texts):
        for k, v in brute(t).items():
            if k in STATISTICS:
                assert got[k][i] == v, (k, t)


def junk(rnd):
    return " ".join(f"{rnd.choice(['x', 'yy'])}{rnd.randrange(500)}{rnd.choice(['###', '$$$', '&&&'])}" for _ in range(80))


def labelled(spark, n=400):
    rnd = random.Random(7)
    bad = [i % 4 == 0 for i in range(n)]
    d = docs(spark, [junk(rnd) if b else prose(rnd, 120) for b in bad])
    labels = spark.createDataFrame([(i, int(not b), 0) for i, b in enumerate(bad) if i < n // 2],
                                   "doc_id long, quality int, toxic int")
    return d, labels, bad


def test_held_out_accuracy(spark):
    d, labels, bad = labelled(spark)
    got = by_id(judge_documents(d.repartition(4), labels))
    held = range(200, 400)
    assert np.mean([got[i]["kept"] == (not bad[i]) for i in held]) > 0.97
    assert all(got[i]["kept"] for i in held if not bad[i])
    again = by_id(judge_documents(d.repartition(7), labels))
    assert {i: r["anomaly"] for i, r in got.items()} == {i: r["anomaly"] for i, r in again.items()}


def test_kept_documents_are_passed_on_whole(spark):
    d, labels, bad = labelled(spark)
    kept = keep_good(d, labels)
    assert kept.schema == d.schema
    verdict = {r["doc_id"] for r in as_dicts(judge_documents(d, labels)) if r["kept"]}
    assert {r["doc_id"] for r in as_dicts(kept)} == verdict
    assert sorted(kept.collect()) == sorted(r for r in d.collect() if r.doc_id in verdict)


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    got = by_id(op4_quality(spark, sf))
    source = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(source)
    for r in source:
        want = brute(r.text)
        assert {k: got[r.doc_id][k] for k in want} == want
        assert not (want["base_failed"] and got[r.doc_id]["kept"])


def test_paths_are_shorter_off_the_good_rows():
    rnd = np.random.default_rng(0)
    good, odd = rnd.normal(0, 1, (500, 3)), np.full((5, 3), 6.0)
    f = IsolationForest(good, np.vstack([good, odd]), ForestParams(trees=50))
    assert f.scores(odd).min() > np.quantile(f.scores(good), 0.99)
    assert calibrated(np.array([0.1, 0.2, 0.9, 0.3]), np.array([True, True, False, True]), 0.0) == 0.3


def test_features_that_tell_nothing_are_left_out():
    rnd = np.random.default_rng(1)
    good = np.arange(400) % 4 > 0
    shares = np.stack([rnd.normal(0, 1, 400), rnd.normal(0, 1, 400) + ~good], 1)
    assert telling(shares, good, 0.1).tolist() == [1]
    assert telling(shares[:, :1], good, 0.3).tolist() == [0]
    assert telling(shares[good], np.ones(300, bool), 0.1).tolist() == [0, 1]


def test_rare_and_opposite_kinds_are_told():
    rnd = np.random.default_rng(4)
    good, n = np.arange(3400) >= 400, 3400
    shares = rnd.normal(0, 1, (n, 4))
    shares[:200, 0], shares[200:400, 0] = rnd.uniform(6, 7, 200), rnd.uniform(-7, -6, 200)      # cancel out
    shares[:8, 1] = 7      # a kind of 2 % of the bad rows
    shares[:392, 2] += 3
    assert telling(shares, good, 0.05).tolist() == [0, 1, 2]
    forest = IsolationForest(shares[good][:, [0, 1, 2]], shares[:, [0, 1, 2]], ForestParams(trees=50))
    scores = forest.scores(shares[:, [0, 1, 2]])
    cut = calibrated(scores, good, ForestParams().most_lost)
    assert (scores[:8] > cut).all() and (scores[good] > cut).mean() <= 0.005
    noise = np.concatenate([rnd.normal(0, 1, (n, 200)), shares[:, 2:3]], 1)
    assert len(telling(noise, good, 0.05)) < 4      # hardly any but the last


def test_no_labels_no_rows_odd_columns(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    d = spark.createDataFrame([(1, prose(random.Random(1), 60), 5, "l"), (1, None, 6, None), (None, "a b", None, None)],
                              "doc_id long, text string, n_words int, label string")
    got = judge_documents(d, none)
    assert [(r.doc_id, r.kept) for r in got.collect()] == [(1, True), (1, False), (None, False)]
    assert [r.n_words for r in keep_good(d, none).collect()] == [5]
    assert judge_documents(docs(spark, []), none).collect() == []
    nulls = spark.createDataFrame([(None, 1, None), (1, None, 0), (1, 1, 1), (1, 1, 1)], none.schema)
    assert [r.kept for r in judge_documents(d, nulls).collect()] == [True, False, False]


def test_regular_words_are_told_apart():
    one, two = thue_morse(1024)
    for text in (" ".join([one, "x", "y", two, "x", "y"]), " ".join([one, "x", "y", one, "x", "y"])):
        got = statistics(*utf8(pa.array([text])))
        assert got["n_repeat_words"][0] == brute(text)["n_repeat_words"]
