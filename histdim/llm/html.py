"""Main text of pages by consensus of their host.

A page is read once as a stream of tags into blocks of text, each in a chain of
containers with generalised paths (tags with class words, digits as ``#``).
Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments are told by tag, role and class words and left out.  Class and id words are held
against containers only, and not against one that turns out to be a wrapper of the article
or of most of the page's unlinked text.

1.  Every page scores its containers: a block counts by its unlinked characters, fully
    for the container that holds it and less for those further out; article and main
    elements count more.  The page votes with each path's share of its best score.
2.  Spark adds up the votes by host and path; the path with most votes wins its host.
3.  Every page is read again and yields the blocks below its host's path; a page that
    doesn't have any there yields those below its own best container.

Votes are aggregated before they are shuffled.  The join of pages with their host's path
is a broadcast of checked size, or salted, so that a host with very many pages is split.

Cases: a null or empty html has an empty text; pages with a null url or without a host
vote together; ties go to the path that sorts last; repeated rows count and are returned each; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histdim.llm.frames import shuffle_partitions, stored

#: Containers below this depth belong to the one at it.
MOST_DEPTH = 64
#: Votes of a page's best container.
FULL_VOTE = 1000

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>""", re.S)
#: Attributes one after the other, each with its value; a quote that stays open lasts to the end.
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s"'>]++)))?""")
_CLASS_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# HTML elements by their role.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in ("script", "style", "textarea", "title", "xmp", "noembed", "noframes")}
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                    "small span strike strong sub sup time tt u var wbr img br picture".split())
_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th caption figcaption summary tr".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
           "option": {"option"}}
_HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
          "option": {"select"}}
_LEFT_OUT = frozenset("nav footer aside form script style noscript template iframe svg math button select textarea menu dialog "
                      "object canvas audio video map head title datalist".split())
_LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form toolbar".split())
_LEFT_OUT_WORDS = frozenset(
    "nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside footer foot ad ads advert adverts "
    "advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended pagination pager toolbar widget "
    "comment comments reply replies respond disqus form search copyright".split())
#: Left out unless they belong to an article, whose heading they hold.
_HEADER_WORDS = frozenset("header masthead banner".split())
_NOT_OF_ITSELF = frozenset("has with no without is in".split())
#: Words of a thread of reader comments, unless what follows only tells its state.
_TALK_WORDS = frozenset("comment comments reply replies respond disqus".split())
_STATES = frozenset("open opened closed enabled disabled on off allowed".split())
#: Words that say which piece of a page a name is about, not what it is about. Inside an article a class leaves its
#: element out only if it has no others beside the words above: "cookie-banner" does, "cookie-recipe" doesn't.
_PIECE_WORDS = frozenset(
    "area bar block body bottom box btn button buttons card carousel cell class col column component container content count "
    "desktop div element end entry feed field fields fixed float global grid group hero holder hook html icon icons id inline inner "
    "input inset item items js label layout left lg link links list main md meta message middle mobile module more native net new "
    "outer page panel part post posts primary region right root row secondary section sm site slot small sticky story strip tab "
    "table tag tags text thread title top ui unit view wrap wrapper zone article articles your our us the of by for to and on off "
    "open opened closed enabled disabled show hide hidden visible active".split())
_ALWAYS_IN = frozenset("html body main".split())
_MAIN = frozenset("article main".split())
#: Elements whose names aren't judged: their ids and classes name what the text is about.
_SAYING = _INLINE | frozenset("h1 h2 h3 h4 h5 h6 p li dt dd pre blockquote caption figcaption summary".split())
#: Tags that a page may do without: no part of a path, which then begins below the body.
_OPTIONAL = frozenset("html body".split())
_JUDGED = frozenset("class id role hidden aria-hidden style".split())


class Container:
    __slots__ = ("depth", "out", "parent", "path", "score", "tag")

    def __init__(self, tag: str, path: str, parent: Container | None, out: bool):
        self.tag, self.path, self.parent, self.out, self.score = tag, path, parent, out, 0.0
        self.depth = parent.depth + 1 if parent else 0


class Region:
    """An element that its name would leave out.  It stays if it holds an article or most of
    the page's unlinked text: then it is a wrapper."""

    __slots__ = ("chars", "holds", "holds_talk", "inside", "out", "parent", "talk")

    def __init__(self, parent: Region | None, talk: bool, inside: bool):
        self.parent, self.talk, self.inside = parent, talk, inside
        self.chars, self.holds, self.holds_talk, self.out = 0, False, False, True


def _piece(word: str) -> bool:
    return len(word) == 1 or word.isdigit() or word in _PIECE_WORDS or word in _LEFT_OUT_WORDS or word in _HEADER_WORDS


def _named(name: str, value: str) -> tuple[bool, bool, bool, bool]:
    """(whether a class or id leaves its element out, makes it a header, a comment thread; whether it leaves
    it out inside an article too).  An id counts as a whole: all its words do."""
    out = head = talk = whole = False
    for token in value.split():
        words = [w.lower() for w in _CLASS_WORD.findall(token)]
        if name == "id":
            words = [w for w in words if not w.isdigit()]
            known = bool(words) and all(w in _LEFT_OUT_WORDS or w in _HEADER_WORDS for w in words)
        else:
            k = next((k for k, w in enumerate(words) if w in _NOT_OF_ITSELF), len(words))
            words, known = words[:k], True
        if known:
            out |= not _LEFT_OUT_WORDS.isdisjoint(words)
            head |= not _HEADER_WORDS.isdisjoint(words)
            talk |= bool(words) and words[0] in _TALK_WORDS and _STATES.isdisjoint(words)
            whole |= not _LEFT_OUT_WORDS.isdisjoint(words) and all(map(_piece, words))
    return out, head, talk, whole or talk


def _marks(rest: str) -> tuple[list[str], bool, bool, bool, bool, bool]:
    """(class words of an element, whether role or style or the like leave it out; whether its
    name does, makes it a header, a comment thread, leaves it out inside an article too)."""
    classes, hidden, named, seen = [], False, (False, False, False, False), set()
    for m in _ATTRIBUTE.finditer(rest):
        name = m[1].lower()
        if name in seen or name not in _JUDGED:      # the first of a name counts
            continue
        seen.add(name)
        value = unescape(m[2] or m[3] or m[4] or "")
        if name == "role":
            hidden |= value.lower() in _LEFT_OUT_ROLES
        elif name == "hidden":
            hidden = True
        elif name == "aria-hidden":
            hidden |= value.lower() == "true"
        elif name == "style":
            hidden |= "display:none" in re.sub(r"\s", "", value.lower())
        else:
            if name == "class":
                classes = sorted({re.sub("[0-9]+", "#", token.lower()) for token in value.split()})
            named = tuple(x or y for x, y in zip(named, _named(name, value)))
    return classes, hidden, *named


def read_page(html: str) -> tuple[list[tuple[Container, str, int]], list[Container]]:
    """(blocks: container, text, linked characters), containers in page order.
    Text that is left out has no block."""
    root = Container("", "", None, False)
    here, containers, blocks = root, [], []
    region, regions, of = None, [], []      # innermost one, all, that of each block
    stack: list[tuple[str, Container, bool, Region | None]] = []      # element, container and region around it, whether it leaves out what's in it
    places: dict[str, list[int]] = {}      # where in the stack the elements of each tag are open
    out, links, articles, text, linked, at = 0, 0, 0, [], 0, 0

    def flush():
        nonlocal linked
        if text:
            if line := " ".join(unescape("".join(text)).split()):
                blocks.append((here, line, linked))
                of.append(region)
            text.clear()
        linked = 0

    def pop(to: int):
        nonlocal here, out, links, articles, region
        while len(stack) > to:
            tag, around, left, outer = stack.pop()
            places[tag].pop()
            if tag not in _INLINE:
                flush()
            here, region = around, outer
            out -= left
            articles -= tag == "article"
            links -= tag == "a"

    def say(part: str):
        nonlocal linked
        if part and not out and not here.out:
            text.append(part)
            if links:
                linked += len(part)

    def last_open(tags, barriers=frozenset()) -> int | None:
        k = max((places[t][-1] for t in tags if places.get(t)), default=None)
        if k is None or any(places[t][-1] > k for t in barriers if places.get(t)):
            return None
        return k

    scan, last = 0, html.rfind(">") + 1      # behind the last ">" no tag can end
    while m := _TOKEN.search(html, scan, last):
        say(html[at:m.start()])
        at = scan = m.end()
        tag = m[2] or m[5]
        if not tag:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):      # never closed
                at = len(html)
                break
            continue
        tag, closing, rest = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
        if closing:
            if tag == "p" and last_open({"p"}) is None:
                flush()
            elif tag == "br":
                say(" ")
            elif (k := last_open({tag})) is not None:
                pop(k)
            continue
        if tag in _RAW:
            end = _RAW[tag].search(html, at)
            at = scan = end.start() if end else len(html)
            if not end:
                break
        if tag in _VOID:
            if tag == "hr":
                flush()
            elif tag in ("br", "wbr"):
                say(" " if tag == "br" else "")
            continue
        if tag not in _INLINE:
            if (k := last_open({"p"}, _BARRIERS)) is not None and tag not in _RAW:
                pop(k)
            if tag in _CLOSES and (k := last_open(_CLOSES[tag], _HOLDS[tag])) is not None:
                pop(k)
            flush()
        classes, left, named, head, talk, whole = _marks(rest) if rest else ([], False, False, False, False, False)
        if articles:
            named = whole
        # (whatever is in an article may be a header of its own)
        head = (head or tag == "header") and tag != "article" and not articles
        left = tag not in _ALWAYS_IN and (left or (head and tag == "header") or (tag in _LEFT_OUT and tag != "form"))
        places.setdefault(tag, []).append(len(stack))
        stack.append((tag, here, left, region))
        if tag in _MAIN:
            if region is not None and not out and not left:
                region.holds |= not talk or tag == "main"
                region.holds_talk |= talk
        elif tag == "form" or ((named or head) and tag not in _SAYING and tag not in _ALWAYS_IN):
            region = Region(region, talk and tag != "form", articles > 0)
            regions.append(region)
        articles += tag == "article"
        out += left
        links += tag == "a"
        if tag not in _INLINE and tag not in _BLOCKS and tag not in _OPTIONAL and here.depth < MOST_DEPTH:
            here = Container(tag, f"{here.path}/{'.'.join([tag, *classes])}", here, here.out)
            containers.append(here)
    say(html[at:].partition("<!--")[0])
    pop(0)
    flush()
    return _without(blocks, of, regions), [root, *containers]


def _without(blocks: list[tuple[Container, str, int]], of: list[Region | None], regions: list[Region]):
    """The blocks outside of regions, or in such that are wrappers of the page's text."""
    if not regions:
        return blocks
    total = 0
    for (_, line, linked), region in zip(blocks, of):
        total += max(0, len(line) - linked)
        if region is not None:
            region.chars += max(0, len(line) - linked)
    for r in reversed(regions):      # the inner ones first
        if r.parent is not None:
            r.parent.chars += r.chars
            r.parent.holds |= r.holds
            r.parent.holds_talk |= r.holds_talk
    for r in regions:
        stays = not r.inside and (r.holds or (r.holds_talk and not r.talk))
        stays |= r.chars == total > 0 if r.talk else 2 * r.chars > total
        r.out = not stays or (r.parent is not None and r.parent.out)
    return [b for b, r in zip(blocks, of) if r is None or not r.out]


_BARRIERS = frozenset("table td th caption button object applet marquee".split())


def score(blocks: list[tuple[Container, str, int]]) -> None:
    for inner, text, linked in blocks:
        worth, share, c = max(0, len(text) - linked) + 25 * text.count(","), 1.0, inner
        while c is not None and share > 0.05:
            c.score += worth * share * (2 if c.tag in ("article", "main") else 1)
            share *= 0.5
            c = c.parent


def best(containers: list[Container]) -> Container:
    return max(containers, key=lambda c: (c.score, c.path))


def votes(html: str) -> dict[str, int]:
    blocks, containers = read_page(html)
    score(blocks)
    most = best(containers).score
    paths: dict[str, float] = {}
    for c in containers:
        if c.score > 0.1 * most:
            paths[c.path] = max(paths.get(c.path, 0.0), c.score)
    return {p: round(FULL_VOTE * s / most) for p, s in paths.items()} if most else {}


def main_text(html: str, path: str | None) -> str:
    """The blocks below ``path``, or where there are none below the page's own best container."""
    blocks, containers = read_page(html)

    def below(path: str | None) -> list[str]:
        within: dict[Container, bool] = {}
        for c in containers:
            within[c] = c.path == path or (c.parent is not None and within[c.parent])
        return [text for c, text, _ in blocks if within[c]]

    if not (texts := below(path)) and blocks:
        score(blocks)
        texts = below(best(containers).path)
    return "\n".join(texts)


def host(url: Column) -> Column:
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(found, F.lit("")))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path, votes): the winning path of each host."""
    read = pages.select(host(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html"))

    def vote(batches):
        for batch in batches:
            rows = [(h, p, v) for h, t in zip(batch.column(0).to_pylist(), batch.column(1))
                    for p, v in votes(t.as_py() or "").items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in
                                              enumerate((pa.string(), pa.string(), pa.int64()))], ["host", "path", "votes"])

    sums = read.mapInArrow(vote, "host string, path string, votes long").groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    return sums.groupBy("host").agg(F.max_by("path", F.struct("votes", "path")).alias("path"), F.max("votes").alias("votes"))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                      broadcast_bytes: int = 16 << 20) -> DataFrame:
    """``id_col``, ``url_col`` and ``text``: the blocks joined by one line feed.

    The hosts' paths are broadcast if they measure at most ``broadcast_bytes``.  Beyond
    that pages and paths meet by (host, salt), so that no host's pages share a task."""
    paths = stored(host_paths(pages, url_col, html_col).select(F.col("host").alias("of"), "path"), "paths")
    size = paths.agg(F.sum(F.octet_length("of") + F.octet_length("path") + 64)).first()[0] or 0
    read = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"),
                        host(F.col(url_col)).alias("host"))
    if size <= broadcast_bytes:
        known = read.join(F.broadcast(paths), F.col("host") == F.col("of"), "left")
    else:
        salts = shuffle_partitions(pages.sparkSession)
        salted = paths.withColumn("with", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salt = F.pmod(F.xxhash64("id", "url"), F.lit(salts)).cast("int")
        known = read.withColumn("salt", salt).join(
            salted, (F.col("host") == F.col("of")) & (F.col("salt") == F.col("with")), "left")
    known = known.select("id", "url", "html", "path")

    def extract(batches):
        for batch in batches:
            texts = [main_text(t.as_py() or "", p) for t, p in zip(batch.column(2), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["id", "url", "text"])

    schema = known.select("id", "url", F.col("html").alias("text")).schema
    return known.mapInArrow(extract, schema).withColumnsRenamed({"id": id_col, "url": url_col})
