import random
import time
import re
from html import unescape

import pytest

from histdim.llm.html import extract_main_text, host_paths, main_text, read_page, votes
from histdim.llm.registry import op10_main_text
from tests.llm.helpers import as_dicts, by_id

PAGES = "page_id long, url string, html string"


@pytest.mark.parametrize(("html", "want"), [
    ("", ""), ("plain  text &amp; more", "plain text & more"),
    ("<p>a<p>b</p>c", "a\nb\nc"),
    ("<div>one<br>two &lt;x&gt;&#233;&nbsp;y</div><div>three</div>", "one two <x>é y\nthree"),
    ("<article><h1>T</h1><p><b>x<br><p>y</p></article><footer>no</footer>", "T\nx\ny"),
    ("<script>var t='</p>';</script><p>a<!-- <p>no</p> -->b</p><style>p{}</style>", "ab"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\nb\nc\nd"),
    ("<body><header>site</header><nav>m</nav><article><header><h1>T</h1></header><p>x, y</p><footer>f</footer></article></body>", "T\nx, y"),
    ("<article><p>text</p><section class='comments'><p>I agree</p></section><div id=ad-7>buy</div></article>", "text"),
    ("<article><p>text</p><div class='cookie-notice'>ok</div><div hidden>h</div><div style='display: none'>n</div><form><p>f</p></form></article>", "text"),
    ("<body class='has-sidebar'><div class='shadow advice'>in</div></body>", "in"),
    ("<p title='a>b'>x</p><p title=\"open>y</p>", "x\ny"),
    ("<p>a < b and c<d</p>", "a < b and c"),
    ("</p></div>x</b>y", "x y".replace(" ", "\n", 0).replace(" ", "")),
    ("<article><div class='entry-header'><h2>T</h2></div><p>x</p></article><div class=page-header>no</div>", "T\nx"),
    ("<p>x<!-- never closed <b>no</b> no", "x"), ("<p>a" + "<b" * 100_000, "a" + "<b" * 100_000),
    ("<p>unclosed <i>it <p>next</i> on", "unclosed it\nnext on"),
    ("<textarea><p>no</p></textarea><p>yes", "yes"), ("<script>never closed <p>x", ""),
    ("<p>" + "<b>" * 3000 + "deep", "deep"), ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
])
def test_blocks(html, want):
    blocks, _ = read_page(html)
    assert "\n".join(t for _, t, _ in blocks) == want


LONG = "Rivers carry sand and stones to the sea, where they build a wide and flat delta over many thousand years."


@pytest.mark.parametrize(("html", "want"), [
    ("<article><h2 id='related-work'>R</h2><p>a</p><h2 id=how-to-search>S</h2><section id='form-and-function'><p>b</p></section></article>", "R\na\nS\nb"),
    (f"<div class='content-sidebar-wrap'><p>{LONG}</p><div class='sidebar'>s</div></div><div>tail</div>", f"{LONG}\ntail"),
    (f"<div class='main-with-sidebar'><p>x</p></div><div>{LONG}</div>", f"x\n{LONG}"),
    ("<article class='post comments-open'><p>x</p></article>", "x"),
    (f"<div class='sidebar-layout'><article><p>x</p></article></div><div>{LONG}</div>", f"x\n{LONG}"),
    ("<p>a <a href='/x' title='A hidden gem'>word</a> b <a href='/hidden/valley'>c</a> <span class='share'>d</span></p>", "a word b c d"),
    ("<div data-hidden='false' data-id='comment-7'>x</div><div data-role='navigation'>y</div><p title=\"it's hidden\">z</p>", "x\ny\nz"),
    (f"<form id='aspnetForm'><p>{LONG}</p><form class=search>q</form></form><p>tail</p>", f"{LONG}\ntail"),
    (f"<div class=post><p>short</p></div><div class=comments-area><article class=comment-body><p>{LONG}</p></article></div>", "short"),
    (f"<article><p>short</p><section class='comments'><p>{LONG}</p></section></article>", "short"),
    ("<div class=x hidden>h</div><span hidden>i</span><div class=a class=sidebar>y</div>", "y"),
    ("<p title=\"open hidden>x</p>", "x"),
    ("<div class='sidebar'>" * 3000 + "deep" + "</div>" * 3000, "deep"),
])
def test_wrappers_and_headings_stay(html, want):
    blocks, _ = read_page(html)
    assert "\n".join(t for _, t, _ in blocks) == want


def filler(rnd, n):
    return " ".join(f"w{rnd.randrange(999)}" for _ in range(n))


def page(rnd, style, kind):
    """(html, article text) of a host with that style."""
    paras = [filler(rnd, rnd.randrange(8, 60)) + "," for _ in range(rnd.randrange(2, 7))]
    box = {"semantic": ("<article>", "</article>"), "div": (f"<div class='post post-{rnd.randrange(99)}'>", "</div>"),
           "table": ("<table class=lay><tr><td>", "</td></tr></table>")}[style]
    body = "".join(f"<p>{p}</p>" for p in paras)
    around = f"<div class=box><p>{filler(rnd, 6)}</p></div>" if kind else ""
    return (f"<html><head><title>t</title></head><body><nav><a href=/>menu</a></nav>{around}{box[0]}{body}{box[1]}"
            f"<div class=tail>{filler(rnd, 4)}</div><footer>f</footer></body></html>"), "\n".join(paras)


def test_hosts_agree_on_a_path(spark):
    rnd = random.Random(3)
    rows, want = [], {}
    for i in range(90):
        style = ["semantic", "div", "table"][i % 3]
        html, text = page(rnd, style, i % 2)
        rows.append((i, f"https://{style}.example.com/{i}", html))
        want[i] = text
    rows += [(100, "https://div.example.com/x", "<div class='post post-5'><p>s</p></div><div class=big><p>" + filler(rnd, 80) + "</p></div>"),
             (101, "https://div.example.com/y", "<section><p>other template</p></section>")]
    d = spark.createDataFrame(rows, PAGES).repartition(4)
    got = by_id(extract_main_text(d), "page_id")
    assert {i: got[i]["text"] for i in want} == want
    salted = by_id(extract_main_text(d, broadcast_bytes=0), "page_id")
    assert salted == got
    assert got[100]["text"] == "s" and got[101]["text"] == "other template"
    paths = {r["host"]: r["path"] for r in as_dicts(host_paths(d))}
    assert paths["div.example.com"] == "/div.post.post-#"
    sums = {}
    for _, u, h in rows:
        for p, v in votes(h).items():
            key = re.match("https://([^/]+)", u)[1], p
            sums[key] = sums.get(key, 0) + v
    for h, p in paths.items():
        assert sums[h, p] == max(v for (x, _), v in sums.items() if x == h)


def three_templates(rnd, i):
    """A page of a host with three templates and its article; a box beside it is longer than every fifth article."""
    paras = [filler(rnd, rnd.randrange(12, 40)) for _ in range(rnd.randrange(2, 6))]
    body, text = "".join(f"<p>{p}</p>" for p in paras), "\n".join(paras)
    aside = f"<section class=facts><p>{filler(rnd, 300 if i % 5 == 0 else 5)}</p></section>"
    return [(f"<div class=page><div class='story s-{i}'>{body}</div>{aside}</div>", text),
            (f"<main><h1>t{i}</h1>{body}</main><div class=facts><p>{filler(rnd, 5)}</p></div>", f"t{i}\n{text}"),
            (f"<table><tr><td><div class=cell>{body}</div></td></tr></table>", text)][0 if i % 10 < 6 else 1 if i % 10 < 9 else 2]


def test_a_host_with_three_templates(spark):
    """The most common one wins, also on pages whose own best container is another; pages without it
    use their own."""
    rnd = random.Random(8)
    pages = [three_templates(rnd, i) for i in range(100)]
    d = spark.createDataFrame([(i, "https://three.example.com/a", h) for i, (h, _) in enumerate(pages)], PAGES)
    assert [r["path"] for r in as_dicts(host_paths(d))] == ["/div.page/div.s-#.story"]
    got = by_id(extract_main_text(d), "page_id")
    assert {i: got[i]["text"] for i in range(100)} == {i: t for i, (_, t) in enumerate(pages)}
    assert main_text(pages[0][0], None) != pages[0][1]      # without the host's vote


@pytest.mark.parametrize(("name", "stays"), [
    ("cookie-recipe", True), ("menu-planning-tips", True), ("form-of-government", True), ("searchAlgorithms", True), ("social-history", True),
    ("cookie-banner", False), ("share-buttons", False), ("ad-slot-3", False), ("relatedPosts", False), ("newsletter", False),
    ("comment-policy", False), ("entry sidebar-right", False), ("c-promo__box", False)])
def test_class_words_inside_an_article_count_as_a_whole(name, stays):
    html = f"<article><p>a</p><div class='{name}'><p>b</p></div><p>c</p><p>more than half of the text, d</p></article>"
    assert ("b" in main_text(html, "/article").split("\n")) == stays


def brute(html):
    """The text of a page of the test tables, by their template."""
    inner = re.search(r"(?s)<article>(.*?)(</article>|$)", html)[1]
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"<br>", " ", re.sub(r"</?b>", "", inner)))
    return "\n".join(x for x in (" ".join(unescape(p).split()) for p in parts) if x)


def test_query_over_the_whole_table(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        source = spark.read.parquet(f"{sf}/pages.parquet").collect()
        got = by_id(op10_main_text(spark, sf), "page_id")
        assert len(got) == len(source)
        for r in source:
            assert got[r.page_id]["text"] == brute(r.html) and got[r.page_id]["n_chars"] == len(brute(r.html))
            assert got[r.page_id]["url"] == r.url


def test_odd_rows(spark):
    d = spark.createDataFrame([(1, None, None, "x", 1), (1, "", "", None, None), (None, "nohost", "<p>a", None, None), (2, "http://h", "<p>b", "p", 2),
                               (2, "http://h", "<p>b", "p", 2)], PAGES + ", path string, host int")
    got = extract_main_text(d)
    assert sorted(r.text for r in got.collect()) == ["", "", "a", "b", "b"]
    assert extract_main_text(spark.createDataFrame([], PAGES)).collect() == []
    assert main_text("<p>x</p>", "/not/there") == "x"


@pytest.mark.parametrize("empty", ["<div></div>", "<div hidden>h</div>", "<nav><div>menu</div></nav>", "<div><script>1</script></div>"])
def test_a_path_without_blocks_is_no_path(empty):
    assert main_text(empty + "<article><p>a</p><p>b</p></article>", "/div") == "a\nb"
    assert main_text(empty, "/div") == ""


def test_pages_whose_host_path_is_empty(spark):
    rnd = random.Random(5)
    rows = [(i, "https://h.example.com/x", f"<div class=post><p>{filler(rnd, 40)}</p></div>") for i in range(5)]
    rows += [(9, "https://h.example.com/y", "<div class=post></div><article><p>mine</p></article>")]
    got = by_id(extract_main_text(spark.createDataFrame(rows, PAGES)), "page_id")
    assert got[9]["text"] == "mine" and all(got[i]["text"] in rows[i][2] and got[i]["text"] for i in range(5))


@pytest.mark.parametrize("piece, close", [("<div>", ""), ("<b>x</i>", ""), ("<p><span>", ""), ("<li><ul>", ""), ("<td></p>", ""), ("<div><b>", "</div>")])
def test_a_megabyte_of_tags_takes_linear_time(piece, close):
    n = 1_000_000 // len(piece + close)
    began = time.time()
    main_text(piece * n + "word" + close * n, None)
    assert time.time() - began < 20      # two readings' worth in seconds, not hours, also on a slow machine


def test_open_elements_are_found_as_by_a_walk():
    """Stray, crossing and missing end tags."""
    assert [t for _, t, _ in read_page("<div><p>a<div>b</p>c</div></span>d</div>e")[0]] == ["a", "b", "c", "d", "e"]
    assert [t for _, t, _ in read_page("<table><tr><td><p>a<td>b<tr><td>c</table>d")[0]] == ["a", "b", "c", "d"]
    assert [t for _, t, _ in read_page("<ul><li>a<ul><li>b</ul><li>c</ul>")[0]] == ["a", "b", "c"]
