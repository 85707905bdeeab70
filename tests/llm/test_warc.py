import base64
import glob
import gzip
import hashlib
import random

import pytest

from histdim.llm.registry import OP7_SQL, op7_warc
from histdim.llm.warc import (
    LoserTree, WarcParams, archived_index, fetch, member, members, merged_index, parsed, read_runs, record, url_key, write_archives)
from tests.llm.helpers import as_dicts
from tests.llm.oracle import same_rows

PAGES = "page_id long, url string, html string"


def fixture():
    rnd = random.Random(4)
    bodies = [None, "", "a", "é\r\n\r\nWARC/1.1\r\n\r\n", "x" * 300_000, "line\n\nline\r\n\r\n", " "]
    rows = [(i, rnd.choice([f"http://h{rnd.randrange(4)}.example.com/p{rnd.randrange(3)}", "https://www.b.org", None, "bad url\r\nX: y", "http://[bad"]),
             rnd.choice(bodies + [f"page {i}"])) for i in rnd.sample(range(1000), 150)]
    return rows + [(None, "http://n.com", "a"), (None, "http://n.com", "only null"), rows[0], rows[0]]


def brute(rows, least_bytes=0):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        body = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        f = first.get(h or "")
        again = f is not None and i != f and len(body) >= least_bytes
        out.append((i, len(body), digest, "revisit" if again else "response", f if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("params", [WarcParams(), WarcParams(least_bytes=2, file_bytes=2000, range_captures=20)])
def test_index_matches_brute_force_and_is_ordered(spark, tmp_path, params):
    rows = fixture()
    got = as_dicts(archived_index(spark.createDataFrame(rows, PAGES).repartition(3), str(tmp_path / "w"), params=params))
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got),
                  key=str) == brute(rows, params.least_bytes)
    got.sort(key=lambda r: r["position"])
    keys = [(r["url_key"], r["timestamp"], r["page_id"] is not None, r["page_id"] or 0) for r in got]
    assert keys == sorted(keys) and [r["position"] for r in got] == list(range(len(got)))
    assert [r["range"] for r in got] == sorted(r["range"] for r in got)


def test_files_are_warc(spark, tmp_path):
    rows = fixture()
    most = max(len(member(record(1, "u" * 30, (h or "").encode(), "x" * 32, None))) for _, _, h in rows) + 200
    write_archives(spark.createDataFrame(rows, PAGES).coalesce(1), str(tmp_path / "w"), params=WarcParams(file_bytes=5000))
    files = glob.glob(str(tmp_path / "w" / "part-*"))
    assert len(files) > 5
    found, text = {}, {i: h for i, _, h in rows}
    for f in files:
        with open(f, "rb") as opened:
            raw = opened.read()
        assert len(raw) < 5000 + most
        whole = [data for data, *_ in members(raw)]
        assert gzip.decompress(raw) == b"".join(whole)      # as any reader of gzip sees it
        for data, at, length in members(raw):
            assert gzip.decompress(raw[at:at + length]) == data and data.startswith(b"WARC/1.1\r\n")
            head, block = parsed(data)
            if head["warc-type"] == "response" and "warc-page-id" in head:
                i = int(head["warc-page-id"])
                found[i] = block.partition(b"\r\n\r\n")[2].decode()
                assert found[i] == (text[i] or "")
    assert set(found.values()) == {h or "" for i, _, h in rows if i is not None}


def test_payloads_are_fetched_by_place(spark, tmp_path):
    rows, path = fixture(), str(tmp_path / "w")
    index = archived_index(spark.createDataFrame(rows, PAGES), path, params=WarcParams(file_bytes=3000))
    text = {i: h or "" for i, _, h in rows}
    wanted = index.filter("page_id % 2 = 0")
    got = fetch(wanted, path).collect()
    assert len(got) == wanted.filter("record_type = 'response'").count() > 0
    assert all(bytes(r.payload).decode() == text[r.page_id] for r in got)
    assert fetch(index.filter("page_id < 0"), path).collect() == []


def test_a_member_of_16_mb_ends_its_file_with_padding(spark, tmp_path):
    rows = [(1, "http://a.b/", "ab" * (9 << 20)), (2, "http://a.b/", "c")]
    for name, some in (("last", rows[:1]), ("both", rows)):
        path = str(tmp_path / name)
        got = archived_index(spark.createDataFrame(some, PAGES).coalesce(1), path).collect()
        assert sorted((r.page_id, r.payload_bytes) for r in got) == [(i, len(h)) for i, _, h in some]


def test_damage_is_noticed(spark, tmp_path):
    path = tmp_path / "w"
    path.mkdir()
    good = record(1, "http://a.b", b"abc", base64.b32encode(hashlib.sha1(b"abc").digest()).decode(), None)
    (path / "x").write_bytes(member(good.replace(b"abc", b"abd")))
    with pytest.raises(Exception, match="differs from its digest"):
        read_runs(spark, str(path)).collect()
    with pytest.raises(ValueError, match="doesn't end"):
        parsed(good[:-1])
    with pytest.raises(ValueError, match="cut off"):
        list(members(member(good)[:-1]))


def test_url_keys():
    assert url_key("HTTP://WWW.Sub.Example.com:80/A?b=c#d") == "com,example,sub)/A?b=c"
    assert url_key("https://a.b:8080") == "b,a:8080)/"
    assert url_key(None) == "" and url_key("http://[x") == "http://[x"


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree_merges(k):
    rnd = random.Random(k)
    runs = [sorted(rnd.randrange(50) for _ in range(rnd.randrange(20))) for _ in range(k)]
    assert list(LoserTree([iter(r) for r in runs], lambda x: x)) == sorted(x for r in runs for x in r)


def test_merging_splits_one_url(spark, tmp_path):
    rows = [(i, "http://one.com/", f"b{i}") for i in range(500)]
    write_archives(spark.createDataFrame(rows, PAGES).repartition(4), str(tmp_path / "w"))
    got = as_dicts(merged_index(read_runs(spark, str(tmp_path / "w"))))
    assert len({r["range"] for r in got}) > 4
    got.sort(key=lambda r: r["position"])
    assert [r["page_id"] for r in got] == list(range(500))


def test_empty_table_and_clashing_columns(spark, tmp_path):
    assert archived_index(spark.createDataFrame([], PAGES), str(tmp_path / "e")).collect() == []
    d = spark.createDataFrame([(1, "u", "h", "x", 2)], PAGES + ", digest string, first long")
    assert archived_index(d, str(tmp_path / "c")).count() == 1


def test_query_equals_its_sql(spark):
    same_rows(spark, op7_warc, OP7_SQL, "/root/testdata/sf0.001")
