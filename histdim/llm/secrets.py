"""Secret scan over a trigram inverted index.

Every rule is a regular expression.  From its parse tree a Boolean trigram
query is derived: a text that matches must hold those trigrams.  Each Spark task
builds the posting lists of its documents segment by segment (about 1 MB of
text each, kept as one bitmap of documents per trigram that some rule needs),
intersects and unites them as the queries say and runs a rule's expression over
its candidates only.  A rule without mandatory trigrams (a plain character
class, say) scans every document.  There is no shuffle, and memory is bounded by
a segment, or by the longest single text.

Cases: a null or empty text has no spans; repeated rows and ids are each
scanned on their own; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from re import _constants as C
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from histdim.llm.frames import id_text
from histdim.llm.spans import ARROW_SPANS, span_schema
from histdim.llm.words import ascii_lower, blocks, utf8

#: A set of strings that grows beyond this is given up for a weaker query.
MOST_STRINGS = 64
#: A character class up to this size is spelled out.
MOST_CHARS = 12


@dataclass(frozen=True)
class Rule:
    """``group``: its length is held against ``least`` (0: the whole match)."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    ignore_case: bool = False

    def compiled(self) -> re.Pattern[bytes]:
        return re.compile(self.pattern.encode("ascii"), re.IGNORECASE if self.ignore_case else 0)


# The three base rules, in the order of their listing.
BASE_RULES = (
    Rule("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 8, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]+", 32),
)
#: Published formats of other credentials; they add spans.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,255}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES

# --- Boolean trigram queries -------------------------------------------------
# True (any text), a trigram (bytes), ("and", parts) or ("or", parts).

Query = bool | bytes | tuple


def both(*parts: Query) -> Query:
    flat: dict[Query, None] = {}
    for p in parts:
        if p is not True:
            flat.update(dict.fromkeys(p[1] if isinstance(p, tuple) and p[0] == "and" else (p,)))
    return True if not flat else next(iter(flat)) if len(flat) == 1 else ("and", tuple(flat))


def either(parts: Iterable[Query]) -> Query:
    flat = dict.fromkeys(parts)
    return True if True in flat or not flat else next(iter(flat)) if len(flat) == 1 else ("or", tuple(flat))


def holding(strings: Iterable[bytes]) -> Query:
    """The query for texts that hold one of the strings."""
    return either(both(*(s[i:i + 3] for i in range(len(s) - 2))) for s in sorted(strings))


@dataclass(frozen=True)
class _Seen:
    """What is known of the strings that a part matches: all of them (``exact``),
    or how they begin and end, and a query they all satisfy."""

    exact: frozenset[bytes] | None
    first: frozenset[bytes] = frozenset({b""})
    last: frozenset[bytes] = frozenset({b""})
    query: Query = True

    def opened(self) -> _Seen:
        if self.exact is None:
            return self
        return _Seen(None, frozenset(s[:2] for s in self.exact), frozenset(s[-2:] for s in self.exact),
                     holding(self.exact))


_EMPTY = _Seen(frozenset({b""}))
_ANY = _Seen(None)


def _join(a: _Seen, b: _Seen) -> _Seen:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= MOST_STRINGS:
        return _Seen(frozenset(x + y for x in a.exact for y in b.exact))
    if a.exact is not None and b.exact is None and len(a.exact) * len(b.first) <= MOST_STRINGS:
        whole = frozenset(x + y for x in a.exact for y in b.first)
        return _Seen(None, frozenset(s[:2] for s in whole), b.last, both(holding(whole), b.query))
    if b.exact is not None and a.exact is None and len(a.last) * len(b.exact) <= MOST_STRINGS:
        whole = frozenset(x + y for x in a.last for y in b.exact)
        return _Seen(None, a.first, frozenset(s[-2:] for s in whole), both(a.query, holding(whole)))
    a, b = a.opened(), b.opened()
    across = holding({x + y for x in a.last for y in b.first}) if len(a.last) * len(b.first) <= MOST_STRINGS else True
    return _Seen(None, a.first, b.last, both(a.query, across, b.query))


def _choice(options: Sequence[_Seen]) -> _Seen:
    if all(o.exact is not None for o in options):
        exact = frozenset().union(*(o.exact for o in options))
        if len(exact) <= MOST_STRINGS:
            return _Seen(exact)
    options = [o.opened() for o in options]
    return _Seen(None, frozenset().union(*(o.first for o in options)),
                 frozenset().union(*(o.last for o in options)), either(o.query for o in options))


def _chars(items) -> _Seen:
    found: set[bytes] = set()
    for op, arg in items:
        if op is C.LITERAL:
            found.add(chr(arg).lower().encode())
        elif op is C.RANGE and arg[1] - arg[0] < MOST_CHARS:
            found |= {chr(c).lower().encode() for c in range(arg[0], arg[1] + 1)}
        else:
            return _ANY
    return _Seen(frozenset(found)) if found and len(found) <= MOST_CHARS else _ANY


def _walk(parts) -> _Seen:
    seen = _EMPTY
    for op, arg in parts:
        if op is C.LITERAL:
            part = _Seen(frozenset({chr(arg).lower().encode()}))
        elif op is C.IN:
            part = _chars(arg)
        elif op is C.SUBPATTERN:
            part = _walk(arg[3])
        elif op is C.ATOMIC_GROUP:
            part = _walk(arg)
        elif op is C.BRANCH:
            part = _choice([_walk(x) for x in arg[1]])
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
            least, most, sub = arg
            one = _walk(sub)
            if least == 0:
                part = _choice([_EMPTY, one]) if most == 1 else _ANY
            else:
                part = one
                for _ in range(min(least, 4) - 1):
                    part = _join(part, one)
                if most > min(least, 4):
                    part = _join(_join(part.opened(), _ANY), _Seen(None, frozenset({b""}), one.opened().last))
        elif op in (C.AT, C.ASSERT, C.ASSERT_NOT):
            part = _EMPTY
        else:
            part = _ANY
        seen = _join(seen, part)
    return seen


def trigram_query(pattern: str) -> Query:
    """What a lower-cased text must hold for ``pattern`` to match it."""
    return _walk(parser.parse(pattern)).opened().query


def trigrams_of(query: Query) -> set[bytes]:
    if isinstance(query, bytes):
        return {query}
    return set().union(*map(trigrams_of, query[1])) if isinstance(query, tuple) else set()


# --- the index of a segment ---------------------------------------------------


class TrigramIndex:
    """Which trigrams are indexed, and the queries over them."""

    def __init__(self, rules: Sequence[Rule]):
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.trigrams = sorted(set().union(*map(trigrams_of, self.queries)))
        self.number = {t: i for i, t in enumerate(self.trigrams)}
        self.codes = np.zeros(1 << 24, np.uint16)
        for t, i in self.number.items():
            self.codes[t[0] << 16 | t[1] << 8 | t[2]] = i + 1
        self.fold = ascii_lower().astype(np.uint32)

    def postings(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """For each trigram a bitmap of the documents that hold it."""
        n = len(offs) - 1
        found = np.zeros((len(self.trigrams), n), bool)
        if len(data) >= 3 and self.trigrams:
            low = self.fold[data]
            which = self.codes[low[:-2] << 16 | low[1:-1] << 8 | low[2:]]
            at = np.flatnonzero(which)
            doc = np.searchsorted(offs, at, "right") - 1
            own = at + 3 <= offs[doc + 1]
            found[which[at[own]] - 1, doc[own]] = True
        return found

    def candidates(self, rule: int, found: np.ndarray) -> np.ndarray:
        def ask(q: Query) -> np.ndarray:
            if q is True:
                return np.ones(found.shape[1], bool)
            if isinstance(q, bytes):
                return found[self.number[q]]
            join = np.logical_and if q[0] == "and" else np.logical_or
            return join.reduce([ask(x) for x in q[1]])

        return np.flatnonzero(ask(self.queries[rule]))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rules: Sequence[Rule] = RULES) -> DataFrame:
    """``id_col`` and ``spans``: array of (kind, start, end) by start, then by the
    rules' order; code points, end exclusive.  Matches of one rule are leftmost
    and don't overlap; one whose checked group is too short is dropped."""
    df = id_text(docs, id_col, text_col)
    rules = tuple(rules)

    def scan(batches):
        index, patterns = TrigramIndex(rules), [r.compiled() for r in rules]
        for batch in batches:
            data, offs = utf8(batch.column(1))
            spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for lo, hi in blocks(offs):
                part, po = data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
                found = index.postings(part, po)
                hits: dict[int, list[tuple[int, int, int]]] = {}
                for r, rule in enumerate(rules):
                    for d in index.candidates(r, found).tolist():
                        for m in patterns[r].finditer(part[po[d]:po[d + 1]].tobytes()):
                            a, b = m.span(rule.group)
                            if b - a >= rule.least:
                                hits.setdefault(d, []).append((m.start(), r, m.end()))
                for d, found_in in hits.items():
                    text = part[po[d]:po[d + 1]]
                    lead = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
                    spans[lo + d] = [{"kind": rules[r].kind, "start": int(lead[a]), "end": int(lead[b]),
                                      "base": rules[r] in BASE_RULES}
                                     for a, r, b in sorted(found_in)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, ARROW_SPANS)], ["id", "spans"])

    return df.mapInArrow(scan, span_schema(df.schema["id"].dataType)).withColumnRenamed("id", id_col)
