"""Personal data, also where it is disguised.

The base expressions run on the text as it is.  Where a text holds disguises,
a chain of transducers rewrites it (homoglyphs and other scripts' digits to
ASCII, spelled digits to digits, at/dot disguises to ``@`` and ``.``).  Each keeps its
edits, so that any span of the result can be followed back to the source characters it stands for.  The
same expressions run on the result, and their spans are mapped back.  A span
found that way is added unless it lies within a base span of its kind.
Before any transducer runs, one scan over the text's separators and one over its digits tell which of them can apply at all.

Cases: a null or empty text has no spans; repeated rows and ids are each searched
on their own; an empty table gives no rows; further columns are ignored.  A very long text takes time in
proportion, and memory for itself, its rewritten forms and their edits.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from histdim.llm.frames import id_text
from histdim.llm.spans import ARROW_SPANS, span_schema

#: In the order of their listing.
KINDS = ("email", "ip", "card", "phone")

Span = tuple[int, int, int]      # start, kind, end

# --- base expressions ----------------------------------------------------------
# Runs are possessive and digits are entered at the start of their run only; the
# matches are those of the plain greedy expressions, in linear time.

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9]){11,}+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: What a match must hold. These begin with a digit, which the search skips to.
_MAYBE_DOTTED = re.compile(r"[0-9]\.[0-9]")
_MAYBE_CARD = re.compile(r"[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def ips(text: str) -> Iterator[tuple[int, int]]:
    if not _MAYBE_DOTTED.search(text):
        return
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
            yield m.span()


def luhn(digits: str) -> bool:
    doubled = (int(c) * 2 for c in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    if not _MAYBE_CARD.search(text):
        return
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            yield m.span()


DETECTORS: tuple[Callable[[str], Iterator[tuple[int, int]]], ...] = (emails, ips, cards, phones)


def detect(text: str) -> list[Span]:
    return sorted((a, k, b) for k, find in enumerate(DETECTORS) for a, b in find(text))


# --- transducers -----------------------------------------------------------------


def fold(text: str) -> str:
    """``text`` in lower case, character by character: of the same length. Matching folded texts with patterns in lower
    case takes a fifth of the time of patterns that ignore case, and finds the same."""
    if not text.isascii():
        text = text.replace("İ", "i").replace("ı", "i").replace("ſ", "s")
    return text.lower()


class Mapped:
    """A rewritten text, with the edits that made it from the text ``before``: edit
    ``k`` put text[new[k]:new_end[k]] where before.text[old[k]:old_end[k]] was."""

    __slots__ = ("_low", "before", "new", "new_end", "old", "old_end", "text")

    def __init__(self, text: str, before: Mapped | None = None):
        self.text, self.before, self._low = text, before, None
        self.new, self.new_end, self.old, self.old_end = array("q"), array("q"), array("q"), array("q")

    @property
    def low(self) -> str:
        if self._low is None:
            self._low = fold(self.text)
        return self._low

    def rewrite(self, pattern: re.Pattern[str], to: Callable[[re.Match[str]], str | None], cased: bool = False) -> Mapped:
        """Each match (in the folded text unless ``cased``) becomes ``to(match)``, whose characters all stand for the
        whole match; None leaves it."""
        done = Mapped("", self)
        out: list[str] = []
        at = shift = 0      # the end of the last edit, and how much longer the text has become by then
        for m in pattern.finditer(self.text if cased else self.low):
            if (new := to(m)) is None:
                continue
            a, b = m.span()
            out += (self.text[at:a], new)
            done.old.append(a)
            done.old_end.append(b)
            done.new.append(a + shift)
            done.new_end.append(a + shift + len(new))
            shift += len(new) - (b - a)
            at = b
        if not done.new:
            return self
        out.append(self.text[at:])
        done.text = "".join(out)
        return done

    def _char(self, i: int) -> tuple[int, int]:
        """The part of the text before that character ``i`` stands for."""
        k = bisect_right(self.new, i) - 1
        if k < 0:
            return i, i + 1
        if i < self.new_end[k]:
            return self.old[k], self.old_end[k]
        i += self.old_end[k] - self.new_end[k]
        return i, i + 1

    def source(self, a: int, b: int) -> tuple[int, int]:
        """The span of the source for which text[a:b] stands."""
        here = self
        while here.before is not None:
            a, b = here._char(a)[0], here._char(b - 1)[1]
            here = here.before
        return a, b


# Cyrillic and Greek letters that look like Latin ones.
_LOOKALIKES = dict(zip("авекмнорстухіјѕԁԛԝАВЕКМНОРСТУХІЈЅαονρτυχικΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
                       "abekmhopctyxijsdqwABEKMHOPCTYXIJSaovptuxikABEZHIKMNOPTYX", strict=True))


@lru_cache(maxsize=1 << 16)
def plain(c: str) -> str:
    """The ASCII character that ``c`` passes for, "" if it can't be seen, or itself."""
    if c in _LOOKALIKES:
        return _LOOKALIKES[c]
    kind = unicodedata.category(c)
    if kind == "Cf":
        return ""
    if kind == "Zs":
        return " "
    if kind == "Pd" or c == "−":
        return "-"
    if c in "․。｡·":
        return "."
    if kind == "Nd":
        return str(unicodedata.decimal(c))
    compact = unicodedata.normalize("NFKC", c)
    return compact if len(compact) == 1 and compact.isascii() else c


_ODD = re.compile(r"[^\x00-\x7f]")
# The digits in the documents' languages (English, German, Spanish, French).
_DIGIT = {w: str(i) for i, ws in enumerate((
    "zero oh null cero zéro", "one eins uno un", "two zwei zwo dos deux", "three drei tres trois", "four vier cuatro quatre",
    "five fünf fuenf cinco cinq", "six sechs seis", "seven sieben siete sept", "eight acht ocho huit", "nine neun nueve neuf"))
    for w in ws.split()}
_WORD = "|".join(sorted(_DIGIT, key=len, reverse=True))
_NOT_LETTER = r"[^\W\d_]"
_DOT_WORD = "(?:dot|punkt|punto|point)"
#: Two or more spelled digits in a row, between spaces, hyphens or commas, or next to written digits.
_SPELLED = re.compile(rf"(?<!{_NOT_LETTER})(?:(plus|m[aá]s)[ -]+)?((?:(?:double[ -]+|triple[ -]+)?(?:{_WORD})(?!{_NOT_LETTER})[ ,-]*){{2,}})")
_ONE = re.compile(rf"(?:(double|triple)[ -]+)?({_WORD})(?!{_NOT_LETTER})|([ ,-]+)")
#: A doubled or tripled digit, or a spelled digit on its own before a written one or a spelled dot, after such a dot, or
#: at the end of written ones.
_ALONE = re.compile(
    rf"(?<!{_NOT_LETTER})(?:{_WORD})(?=[ -]{{1,2}}[0-9]|[ \t_]+{_DOT_WORD}(?!{_NOT_LETTER}))"
    rf"|(?:(?<=dot )|(?<=punkt )|(?<=punto )|(?<=point ))(?:{_WORD})(?!{_NOT_LETTER})"
    rf"|(?<!{_NOT_LETTER})(?:double|triple)[ -]+(?:{_WORD})(?!{_NOT_LETTER})"
    rf"|(?<=[0-9][ -])(?:{_WORD})(?=[ \t]*(?:[.,;:!?)\n]|\Z)|[ -]{{1,2}}(?:{_WORD})(?!{_NOT_LETTER}))")
#: Four parts of spelled or written digits with dots in words between them.
_SPACED_IP = re.compile(
    r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){0,2}"
    rf"(?:[ \t_]+{_DOT_WORD}[ \t_]+[0-9](?:[ -]?[0-9]){{0,2}}){{3}}(?![ -]?[0-9])")
_AT = r"[ \t]*[\[({<][ \t]*(?:at|arroba|@)[ \t]*[\])}>][ \t]*"
_DOT = r"[ \t]*[\[({<][ \t]*(?:dot|punkt|punto|point|\.)[ \t]*[\])}>][ \t]*"
_BARE_DOT = r"[ \t_]+dot[ \t_]+"
_BRACKETED_AT = re.compile(rf"(?<=[a-z0-9]){_AT}(?=[a-z0-9])")
_BRACKETED_DOT = re.compile(rf"(?<=[a-z0-9]){_DOT}(?=[a-z0-9])")
_PUNTO = r"[ \t_]+(?:punto|punkt)[ \t_]+"
_ENDINGS = "com|org|net|edu|gov|info|biz|io|dev|app|eu|de|fr|es|uk|us|ch|it|nl|be|pt|pl|se|dk|ca|au|mx|ar|cl"
#: A bare "at" counts only before a name with a disguised dot, and not before an article or the like.
_BARE_AT = re.compile(rf"(?<=[a-z0-9])[ \t_]+(?:at|arroba)[ \t_]+(?!(?:the|an?|th[ai]s|that|my|your|our|his|her|its)\b)(?=[a-z0-9-]+(?:{_DOT}|{_BARE_DOT}|{_PUNTO})[a-z0-9])")
_BARE_DOTS = re.compile(rf"(?<=[a-z0-9]){_BARE_DOT}(?=[a-z0-9])")
_PUNTOS = re.compile(rf"(?<=[a-z0-9]){_PUNTO}(?=(?:[a-z0-9-]{{1,63}}{_PUNTO}){{0,5}}(?:{_ENDINGS})(?![a-z0-9-]))")
_DASHED_AT = re.compile(r"(?<=[a-z0-9])-at-(?=(?:[a-z0-9]{1,63}-){1,6}dot-[a-z])")
_DASHED_DOT = re.compile(r"(?<=[a-z0-9])-dot-(?=[a-z])")
#: A spaced @ before a host whose last dot is spaced as well; endings that are common words don't count.
_SPACED_AT = re.compile(
    r"(?<=[a-z0-9])[ \t]*@[ \t]*[a-z0-9-]+(?:[ \t]*\.[ \t]*[a-z0-9-]+)*?[ \t]+\.[ \t]+"
    r"(?=(?:com|org|net|edu|gov|info|biz|dev|eu|uk|fr|nl|pl|dk|mx)(?![a-z0-9-]))")
_REFERENCE = re.compile(r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z]{2,10});")
#: A number after a plus, with letters that pass for digits in it; of its words those with a digit count.
_LIKE_PHONE = re.compile(r"\+[ ().0-9OolI|-]{8,}+")
_LIKE_WORD = re.compile(r"(?<![A-Za-z0-9|])(?=[0-9OolI|]*[OolI|])[OolI|]*[0-9][0-9OolI|]*(?![A-Za-z0-9|])")
#: Letters that pass for digits, between digits.
_DIGIT_LIKE = re.compile(r"(?<=[0-9])[OolI|]+(?=[0-9])")
_DIGITS_FOR = str.maketrans("OolI|", "00111")
_BRACKETED = re.compile(r"[\[({<][ \t]*(?:at|arroba|@|dot|punkt|punto|point|\.)[ \t]*[\])}>]")
_MAYBE_IP = re.compile(rf"[0-9][ \t_]+{_DOT_WORD}[ \t_]+[0-9]")
#: A bare "at" before a plain name with a well-known ending; what stands before it is judged by _mailbox.
_PLAIN_AT = re.compile(
    r"(?<=[a-z0-9])[ \t]+at[ \t]+(?=(?:[a-z0-9-]{1,63}\.){1,5}"
    rf"(?:{_ENDINGS})(?![a-z0-9-]|\.[a-z0-9]))")
_BEFORE_AT = re.compile(r"(?:^|[^a-z0-9._%+-])(?:(e-?mails?|mailto|mail|write|contact|reach|send|address|schreib\w*|escrib\w*|écri\w*)"
                        r"(?:[ \t]+(?:to|me|is|an|a|à))?[ \t:]+)?([a-z0-9._%+-]+)$")
#: Mailboxes by what they are for, and common given names.
_MAILBOXES = frozenset(
    "info contact support sales admin office mail hello help service team webmaster postmaster press jobs privacy billing noreply kontakt "
    "contacto ventas presse john jane james mary robert michael david richard william thomas peter paul mark george kevin brian daniel "
    "anna anne maria marie laura julia sarah susan linda lisa emma emily alice bob tom tim jim joe max hans klaus jürgen stefan andreas "
    "martin petra sabine jean pierre jacques michel sophie claire juan jose carlos luis pedro miguel ana carmen lucia alex chris sam ben".split())
#: Words that stand before a site as well, whatever stands before them.
_NO_MAILBOX = frozenset("us me them him her it you we they available found online more out up here site website page look see visit "
                        "is are was were be team people address email mail".split())
#: A separator, then a spelled digit or a word for "at" or a dot.  The search skips from separator to separator.
_HINT = re.compile(rf"[ ,\t_-](?:((?:(?:double|triple)[ -]+)?(?:{_WORD}))|({_DOT_WORD})|at|arroba)(?!{_NOT_LETTER})")
_ENDS_SPELLED = re.compile(rf"(?<!{_NOT_LETTER})(?:{_WORD})\Z")
_ENDS_DOT = re.compile(rf"{_DOT_WORD}\Z")
_LONGEST = max(map(len, _DIGIT))
_DIGITS = re.compile("[0-9]++")
_MAYBE_LIKE = re.compile("[0-9][OolI|]")


def _spelled_before(text: str, end: int) -> bool:
    return _ENDS_SPELLED.search(text, max(0, end - _LONGEST), end) is not None


def _before(text: str, end: int, skipped: str) -> int:
    while end and text[end - 1] in skipped:
        end -= 1
    return end


def _hints(text: str) -> tuple[bool, bool, bool, bool]:
    """Of a folded text: whether _SPELLED or _ALONE can match, whether "at" and whether "dot" stand
    between separators, and whether a plain host follows an "at"."""
    spelled = at = dot = host = False
    for m in _HINT.finditer(text):
        a, b = m.span()
        if m[1]:
            spelled = spelled or m[1][0] in "dt" and m[1].startswith(("double", "triple")) or text[a - 1:a].isdigit() or _spelled_before(text, _before(text, a + 1, " ,-")) \
                or _ENDS_DOT.search(text, max(0, a - 5), a) is not None
        elif m[2]:
            dot = dot or text[b:b + 1] in _AFTER
            spelled = spelled or _spelled_before(text, _before(text, a + 1, " \t_"))
        elif text[b:b + 1] in _AFTER:
            at = True
            host = host or _HOST.match(text, b) is not None
    if not spelled:
        for m in _DIGITS.finditer(text):
            a = m.start()
            if a and text[a - 1] in " -" and _spelled_before(text, a - 1 - (text[max(0, a - 2):a - 1] in (" ", "-"))):
                return True, at, dot, host
    return spelled, at, dot, host


#: What may follow a bare "at" or "dot".
_AFTER = frozenset(" \t_")
_HOST = re.compile(r"[ \t]+[a-z0-9-]+\.[a-z0-9]")


def _referred(m: re.Match[str]) -> str | None:
    """The character that a reference stands for, if addresses are made of such."""
    c = unescape(m[0])
    return c if c == "@" or c in _LOCAL else None


def _mailbox(m: re.Match[str]) -> str | None:
    """``@`` if what stands before the "at" looks like a local part."""
    before = _BEFORE_AT.search(m.string[max(0, m.start() - 120):m.start()])
    if not before:
        return None
    local = before[2]
    known = local in _MAILBOXES or re.fullmatch(r"[a-z]+(?:[._+][a-z0-9]+)+|[a-z]{3,}[0-9]+", local)
    return "@" if known or (before[1] and local not in _NO_MAILBOX) else None


def _spell(mapped: Mapped) -> Mapped:
    """Spelled digits; each digit keeps the place of its own word."""
    def token(m: re.Match[str]) -> str | None:
        if m[3] is not None:
            return "" if "," in m[3] and inside[m.start()] else None
        return _DIGIT[m[2]] * {"double": 2, "triple": 3}.get(m[1] or "", 1) if inside[m.start()] else None

    inside = bytearray(len(mapped.text))
    signs = set()
    for m in _SPELLED.finditer(mapped.low):
        if m[1]:
            signs.add(m.start())
        a, b = m.span(2)
        b -= len(m[2]) - len(m[2].rstrip(" ,-"))
        inside[a:b] = b"\x01" * (b - a)
    for m in _ALONE.finditer(mapped.low):
        inside[m.start():m.end()] = b"\x01" * (m.end() - m.start())
    words = re.compile(rf"(?<!{_NOT_LETTER}){_ONE.pattern}")
    done = mapped.rewrite(words, token)
    if signs:
        done = done.rewrite(re.compile(rf"(?<!{_NOT_LETTER})(?:plus|m[aá]s)[ -]+(?=[0-9])"), lambda m: "+")
    return done


def normalise(text: str) -> Mapped | None:
    """The rewritten text, or None if nothing in it is disguised."""
    mapped = Mapped(text)
    if not text.isascii():
        swaps = {c: plain(c) for c in set(text) if ord(c) > 127}
        if any(v != c for c, v in swaps.items()):
            mapped = mapped.rewrite(_ODD, lambda m: None if swaps[m[0]] == m[0] else swaps[m[0]], cased=True)
    if "&" in text:
        mapped = mapped.rewrite(_REFERENCE, _referred, cased=True)
    spelled, at, dot, host = _hints(mapped.low)
    if spelled:
        mapped = _spell(mapped)
    if _MAYBE_IP.search(mapped.low):
        mapped = mapped.rewrite(_SPACED_IP, lambda m: ".".join(re.sub("[^0-9]", "", p) for p in re.split(_DOT_WORD, m[0])))
    bracketed = _BRACKETED.search(mapped.low) is not None
    before = mapped
    if at and (dot or bracketed):
        mapped = mapped.rewrite(_BARE_AT, lambda m: "@")
    if bracketed:
        mapped = mapped.rewrite(_BRACKETED_AT, lambda m: "@")
    if mapped is not before and dot:
        mapped = mapped.rewrite(_PUNTOS, lambda m: ".")
    if bracketed:
        mapped = mapped.rewrite(_BRACKETED_DOT, lambda m: ".")
    if dot or bracketed:
        mapped = mapped.rewrite(_BARE_DOTS, lambda m: ".")
    if host or (at and (dot or bracketed)):
        mapped = mapped.rewrite(_PLAIN_AT, _mailbox)
    if "-at-" in mapped.low and "-dot-" in mapped.low:
        ats = mapped.rewrite(_DASHED_AT, lambda m: "@")
        mapped = mapped if ats is mapped else ats.rewrite(_DASHED_DOT, lambda m: ".")
    if "@" in mapped.text:
        mapped = mapped.rewrite(_SPACED_AT, lambda m: re.sub("[ \t]", "", m[0]))
    if "+" in mapped.text and (numbers := [m.span() for m in _LIKE_PHONE.finditer(mapped.text) if sum(map(str.isdigit, m[0])) >= 7]):
        def inside(m: re.Match[str]) -> bool:
            k = bisect_right(numbers, (m.end(),)) - 1
            return k >= 0 and m.end() <= numbers[k][1]

        mapped = mapped.rewrite(_LIKE_WORD, lambda m: m[0].translate(_DIGITS_FOR) if inside(m) else None, cased=True)
    if _MAYBE_LIKE.search(mapped.text):
        mapped = mapped.rewrite(_DIGIT_LIKE, lambda m: m[0].translate(_DIGITS_FOR), cased=True)
    return None if mapped.text is text else mapped


def find(text: str) -> list[tuple[int, int, int, bool]]:
    """(start, kind, end, whether it is a base span) of all spans, sorted."""
    found = [(*s, True) for s in detect(text)]
    mapped = normalise(text)
    if mapped is None:
        return found
    taken: list[list[tuple[int, int]]] = [[] for _ in KINDS]
    for a, k, b, _ in found:
        taken[k].append((a, b))
    for spans in taken:
        spans.sort()
    for a, k, b in detect(mapped.text):
        a, b = mapped.source(a, b)
        near = bisect_left(taken[k], (a + 1,)) - 1      # the last base span that doesn't begin later
        if near < 0 or taken[k][near][1] < b:
            found.append((a, k, b, False))
    return sorted(found)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``spans``: array of (kind, start, end) in the source text."""
    df = id_text(docs, id_col, text_col)

    def search(batches):
        for batch in batches:
            spans = [[{"kind": KINDS[k], "start": a, "end": b, "base": base} for a, k, b, base in find(t.as_py() or "")]
                     for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, ARROW_SPANS)], ["id", "spans"])

    return df.mapInArrow(search, span_schema(df.schema["id"].dataType)).withColumnRenamed("id", id_col)
