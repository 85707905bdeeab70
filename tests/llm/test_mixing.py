import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from histdim.llm.mixing import MixParams, _solve, document_rates, fit_domains, fit_rates, mixed, mixture
from histdim.llm.registry import op3_mixing
from tests.llm.helpers import ODD_TEXTS, WORD, as_dicts, by_id, docs

DOMAINS = ("a", "b", "c")
TARGETS = {"a": 0.5, "b": 0.3, "c": 0.2}


def fixture(spark, n=300):
    rnd = random.Random(5)
    of = [rnd.choices(DOMAINS, [6, 3, 1])[0] for _ in range(n)]
    texts = [" ".join(rnd.choice([f"{d}{rnd.randrange(12)}", f"w{rnd.randrange(300)}", f"w{rnd.randrange(300)}"])
                      for _ in range(rnd.randrange(20, 80))) for d in of]
    labels = spark.createDataFrame([(i, d) for i, d in enumerate(of) if i < n // 2], "doc_id long, domain string")
    return docs(spark, texts), labels, of, texts


def brute_posterior(model, text):
    words = set(WORD.findall(text or ""))
    logs = np.array(model.base) + sum((np.array(v) for w, v in model.weights.items() if w in words), np.zeros(len(model.base)))
    e = np.exp(logs - logs.max())
    return e / e.sum()


def test_posteriors_match_brute_force_and_held_out_labels(spark):
    d, labels, of, texts = fixture(spark)
    model = fit_domains(d, labels, DOMAINS)
    got = by_id(document_rates(d.repartition(4), labels, TARGETS))
    for i, t in enumerate(texts):
        want = brute_posterior(model, t)
        assert np.allclose([got[i][f"p_{x}"] for x in DOMAINS], want)
        assert got[i]["n_tokens"] == len(WORD.findall(t))
    held = range(150, 300)
    assert np.mean([max(DOMAINS, key=lambda x: got[i][f"p_{x}"]) == of[i] for i in held]) > 0.95


def test_expected_totals_match_targets(spark):
    d, labels, _, _ = fixture(spark)
    got = as_dicts(document_rates(d, labels, TARGETS))
    total = sum(r["n_tokens"] for r in got)
    for x, w in TARGETS.items():
        assert sum(r["n_tokens"] * r["rate"] * r[f"p_{x}"] for r in got) == pytest.approx(w * total, rel=1e-4)
    assert all(r["rate"] >= 0 and abs(r["n_copies"] - r["rate"]) < 1 for r in got)


def test_descent_matches_brute_force(spark):
    rnd = np.random.default_rng(3)
    p = rnd.dirichlet([0.3, 0.3, 0.3], 200)
    t = rnd.integers(1, 500, 200)
    rows = [(int(a), *map(float, b)) for a, b in zip(t, p)]
    shares = spark.createDataFrame(rows, "tokens long, p0 double, p1 double, p2 double")
    for weights in ({"a": 0.98, "b": 0.01, "c": 0.01}, TARGETS, {"a": 1.0, "b": 0.0, "c": 0.0}):
        got = fit_rates(shares, DOMAINS, weights)
        goals, r = np.array([weights[x] for x in DOMAINS]) * t.sum(), np.ones(200)
        for g in got.gradients:
            r = np.maximum(0, r - p @ np.array(g))
        assert np.allclose(got.reached, p.T @ (t * r), rtol=1e-6)
        least, m = np.ones(200), (p * t[:, None]).T @ p      # plain descent, as many steps
        for _ in got.gradients:
            least = np.maximum(0, least - p @ np.linalg.solve(m, p.T @ (t * least) - goals))

        def length(x):
            off = p.T @ (t * x) - goals
            return np.sqrt(off @ np.linalg.solve(m, off))

        assert length(r) <= 1.02 * length(least) + 1e-6 * length(np.ones(200))
        assert length(r) < 0.3 * length(np.ones(200))
    assert np.allclose(_solve([[2.0, 1.0], [1.0, 3.0]], [3.0, 5.0]), [0.8, 1.4])
    assert _solve([[0.0, 0.0], [0.0, 2.0]], [0.0, 4.0]) == [0.0, 2.0]


def test_domains_kept_whole(spark):
    d, labels, of, _ = fixture(spark)
    got = as_dicts(document_rates(d, labels, {"a": 0.6, "b": 0.39, "c": 0.01}, whole=("a", "b"), headroom=0.05))
    for x in "ab":
        now = sum(r["n_tokens"] * r[f"p_{x}"] for r in got)
        assert sum(r["n_tokens"] * r["rate"] * r[f"p_{x}"] for r in got) > 1.049 * now
    sure = [r["rate"] for r in got if r["p_a"] > 0.99]
    assert min(sure) > 1 and max(r["rate"] for r in got if r["p_c"] > 0.99) < 0.5


def test_mixture_repeats_whole_rows(spark):
    d, labels, _, _ = fixture(spark)
    copies = {r["doc_id"]: r["n_copies"] for r in as_dicts(document_rates(d, labels, TARGETS))}
    out = mixture(d, labels, TARGETS)
    assert out.schema.names == d.schema.names
    want = sorted((r for r in d.collect() for _ in range(copies[r.doc_id])), key=str)
    assert sorted(out.collect(), key=str) == want
    assert abs(sum(copies.values()) - sum(r["rate"] for r in as_dicts(document_rates(d, labels, TARGETS)))) < 40


def test_rows_written_once_and_names_that_clash(spark):
    d, labels, _, _ = fixture(spark, 60)
    clash = d.select("doc_id", "text", F.lit(7).alias("__copy"), F.lit(8).alias("__mix"), F.lit(9).alias("mix"), F.lit(10).alias("row"))
    copies = {r["doc_id"]: r["n_copies"] for r in as_dicts(document_rates(clash, labels, TARGETS))}
    out = as_dicts(mixture(clash, labels, TARGETS))
    assert len(out) == sum(copies.values()) and {(r["__copy"], r["__mix"], r["mix"], r["row"]) for r in out} == {(7, 8, 9, 10)}
    once = as_dicts(mixture(clash, labels, TARGETS, once=True))
    assert sorted(r["doc_id"] for r in once) == sorted(i for i, n in copies.items() if n)


def test_main_path_is_native(spark):
    d, labels, _, _ = fixture(spark, 40)
    plan = mixed(d, labels, TARGETS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = by_id(op3_mixing(spark, sf))
    assert len(got) == len(source)
    total = sum(r["n_tokens"] for r in got.values())
    assert all(got[r.doc_id]["n_tokens"] == len(WORD.findall(r.text)) for r in source)
    for x, w in {"good": 0.85, "poor": 0.1, "toxic": 0.05}.items():
        assert sum(r["n_tokens"] * r["rate"] * r[f"p_{x}"] for r in got.values()) == pytest.approx(w * total, rel=1e-3)


def test_odd_rows(spark):
    none = spark.createDataFrame([], "doc_id long, domain string")
    texts = [*ODD_TEXTS, "x y", "x y"]
    d = docs(spark, texts, [*range(len(ODD_TEXTS)), None, None])
    got = as_dicts(document_rates(d, none, TARGETS))
    assert len(got) == len(texts) and all(r["p_a"] == pytest.approx(1 / 3) for r in got)
    assert document_rates(docs(spark, []), none, TARGETS).collect() == []
    odd = spark.createDataFrame([(None, "a"), (0, None), (1, "zz"), (2, "a"), (2, "b")], none.schema)
    clash = spark.createDataFrame([(2, "x", 1, "q"), (2, "x", 1, "q"), (None, None, None, None)],
                                  "doc_id long, text string, tokens int, domain string")
    assert len(as_dicts(document_rates(clash, odd, TARGETS))) == 3
    assert mixture(clash, odd, TARGETS).columns == clash.columns


def test_a_rare_domain_is_no_target_to_reach(spark):
    rnd = random.Random(8)
    n = 3000
    rare = set(range(0, n, 750))      # far below one hundredth of the tokens
    texts = [" ".join(f"{'bad' if i in rare else 'w'}{rnd.randrange(9 if i in rare else 300)}" for _ in range(60)) for i in range(n)]
    labels = spark.createDataFrame([(i, "toxic" if i in rare else "clean") for i in range(n)], "doc_id long, domain string")
    options = {"whole": ("clean",), "headroom": corpus_pipeline.HEADROOM, "params": MixParams(least_docs=2)}
    rates = as_dicts(document_rates(docs(spark, texts), labels, corpus_pipeline.TARGETS, most=corpus_pipeline.MOST, **options))
    clean = min(r["rate"] for r in rates if r["p_clean"] > 0.99)
    toxic = [r["rate"] for r in rates if r["p_toxic"] > 0.99]
    assert len(toxic) == len(rare) and max(toxic) < 1 <= clean
    as_target = as_dicts(document_rates(docs(spark, texts), labels, corpus_pipeline.TARGETS, **options))
    assert max(r["rate"] for r in as_target if r["p_toxic"] > 0.99) > 2      # what the ceiling keeps from happening
