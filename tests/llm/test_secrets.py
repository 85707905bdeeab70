import hashlib
import random
import time
import re

from histdim.llm.registry import op1_secret_scan
from histdim.llm.secrets import RULES, Rule, TrigramIndex, scan_secrets, trigram_query
from histdim.llm.spans import digest_spans
from tests.llm.helpers import ODD_TEXTS, as_dicts, by_id, docs

BASE = ["assign", "access", "hex"]


def brute(text):
    """The base spans by plain expressions on the decoded text."""
    text = text or ""
    out = []
    letters = "".join
    either = lambda s: letters(f"[{c}{c.upper()}]" if c.isalpha() else c for c in s)
    names = "|".join(map(either, ("password", "passwd", "secret", "token"))) + "|" + either("api") + "_?" + either("key")
    for m in re.finditer(rf"({names})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{BASE[k]}:{a}:{b}" for a, k, b in sorted(out))


def texts():
    rnd = random.Random(3)
    bits = ["password=", "PassWd : '", "api_key=\"", "apikey = ", "ſecret=", "toKen:", "secret", "AKIA", "abcdef0123456789",
            "ABCDEFGH12345678", "é", "日本", " ", "\n", "deadbeef" * 4, "=", "x", "tok", "en=", "longvalue99", "K", "token=token="]
    return [*ODD_TEXTS, *("".join(rnd.choice(bits) for _ in range(rnd.randrange(1, 14))) for _ in range(400))]


def test_matches_brute_force(spark):
    all_texts = texts()
    got = by_id(digest_spans(scan_secrets(docs(spark, all_texts).repartition(3)), "doc_id", BASE))
    assert len(got) == len(all_texts)
    for i, t in enumerate(all_texts):
        want = brute(t)
        assert got[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), t
        assert got[i]["n_hex"] == want.count("hex:") and got[i]["n_assign"] == want.count("assign:")
        assert set(filter(None, want.split(","))) <= set(got[i]["spans"].split(","))


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = by_id(op1_secret_scan(spark, sf))
    assert len(got) == len(source)
    for r in source:
        assert got[r.doc_id]["base_sha256"] == hashlib.sha256(brute(r.text).encode()).hexdigest()


def test_trigram_queries():
    assert trigram_query("abcd") == ("and", (b"abc", b"bcd"))
    assert trigram_query("[0-9a-f]+") is True
    assert trigram_query("a.c") is True
    assert trigram_query("(abc|xyz)+q*") == ("or", (b"abc", b"xyz"))
    assert trigram_query("(abc)?d") is True
    assert trigram_query("ab[cd]") == ("or", (b"abc", b"abd"))


def test_index_never_misses_a_match():
    import numpy as np
    import pyarrow as pa

    from histdim.llm.words import utf8

    rules = [*RULES, Rule("r1", "fo+bar(baz|qux)"), Rule("r2", "a(bc)*def"), Rule("r3", "x{3}y"), Rule("r4", r"\bkey\d{3}z")]
    rnd = random.Random(5)
    pieces = ["foo", "bar", "baz", "qux", "abcbc", "def", "xxxx", "y", "key123z", "ghp_", "A" * 40, "sk_live_", "eyJaaaaaaaaa.",
              "-----BEGIN RSA PRIVATE KEY-----", " ", "\n"]
    all_texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(6))) for _ in range(600)]
    data, offs = utf8(pa.array(all_texts))
    index = TrigramIndex(rules)
    found = index.postings(data, offs)
    for k, rule in enumerate(rules):
        may = set(index.candidates(k, found).tolist())
        does = {i for i, t in enumerate(all_texts) if rule.compiled().search(t.encode())}
        assert does <= may
    assert len(index.candidates(3, found)) < len(all_texts) / 2
    assert found.dtype == np.bool_


def test_more_rules_add_spans(spark):
    t = "x ghp_" + "a1B2" * 9 + " -----BEGIN RSA PRIVATE KEY----- é"
    got = as_dicts(scan_secrets(docs(spark, [t])))
    assert [s["kind"] for s in got[0]["spans"]] == ["github", "private_key"]


def test_empty_table_clashing_columns_and_repeated_rows(spark):
    assert scan_secrets(docs(spark, [])).collect() == []
    d = spark.createDataFrame([(1, "token=abcdefgh1", "x", 2), (1, "token=abcdefgh1", "x", 2), (None, "a", None, None)],
                              "doc_id long, text string, spans string, id int")
    got = as_dicts(digest_spans(scan_secrets(d), "doc_id", BASE))
    assert [r["n_assign"] for r in got] == [1, 1, 0]


def test_a_megabyte_that_nearly_matches_takes_linear_time():
    for piece in ("eyJ", "eyJaaaaaaaa.", "eyJaaaaaaaa.eyJaaaaaaa ", "token ", "AKIA", "-----BEGIN ", "xoxb-a "):
        text = (piece * (1_000_000 // len(piece))).encode()
        began = time.time()
        for rule in RULES:
            sum(1 for _ in rule.compiled().finditer(text))
        assert time.time() - began < 20, piece


def test_web_tokens_begin_where_a_run_begins():
    jwt = next(r for r in RULES if r.kind == "jwt").compiled()
    token = b"eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSM"
    assert jwt.search(b"x " + token) and jwt.search(b'"' + token) and jwt.search(b"=" + token) and not jwt.search(b"Q" + token)
