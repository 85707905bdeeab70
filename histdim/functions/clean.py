"""Column-level cleaning expressions.

Every function takes and returns ``Column`` objects built from Spark's
built-in functions only, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The source systems' codes and labels.  These must stay exactly
# as the upstream systems emit them for results to match.
MISSING = "n/a"
MARITAL_STATUS = {"S": "Single", "M": "Married"}
GENDER = {"F": "Female", "M": "Male"}
PRODUCT_LINE = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
GENDER_ALIASES = {"Female": ["F", "FEMALE"], "Male": ["M", "MALE"]}
COUNTRY_ALIASES = {"Germany": ["DE"], "United States": ["US", "USA"]}
LEGACY_ID_PREFIX = "NAS"
ID_SEPARATOR = "-"
CATEGORY_ID_LENGTH = 5          # first 5 characters of a product key
PRODUCT_KEY_START = 7           # the product number starts at character 7
MIXED_DATE_FORMATS = ("yyyy-MM-dd", "M/d/yyyy")
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def load_time(value) -> Column:
    """A load time as a zone-less ``timestamp_ntz`` literal.  Built from text
    so neither the Python process's nor the session's time zone can shift
    it (``F.lit(datetime)`` would be a zoned timestamp)."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        text = value.replace(tzinfo=None).isoformat(sep=" ")
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")


def decode_codes(c, mapping: Mapping[str, str], default: str | None = MISSING) -> Column:
    """Trim + upper-case a code and map it to its label; unknown codes,
    blanks and NULL become ``default``."""
    norm = F.upper(F.trim(_c(c)))
    out = None
    for code, label in mapping.items():
        out = (F.when(norm == F.lit(code), F.lit(label)) if out is None
               else out.when(norm == F.lit(code), F.lit(label)))
    return out.otherwise(F.lit(default))


def decode_aliases(c, aliases: Mapping[str, Sequence[str]], default: str | None = MISSING) -> Column:
    """Like ``decode_codes`` but each label accepts a set of spellings."""
    norm = F.upper(F.trim(_c(c)))
    out = None
    for label, spellings in aliases.items():
        cond = norm.isin(list(spellings))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def normalize_country(c, aliases: Mapping[str, Sequence[str]] = COUNTRY_ALIASES,
                      missing: str = MISSING) -> Column:
    """Map country codes to names (case-sensitive), blank/NULL to ``missing``,
    anything else to its trimmed self."""
    raw = _c(c)
    t = F.trim(raw)
    out = None
    for label, spellings in aliases.items():
        cond = t.isin(list(spellings))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.when((t == F.lit("")) | raw.isNull(), F.lit(missing)).otherwise(t)


def trim_columns(df, cols: Sequence[str]):
    return df.withColumns({c: F.trim(F.col(c)) for c in cols})


def split_compound_key(c, category_length: int = CATEGORY_ID_LENGTH,
                       key_start: int = PRODUCT_KEY_START,
                       separator: str = ID_SEPARATOR, replacement: str = "_") -> tuple[Column, Column]:
    """Split ``CO-RF-FR-R92B-58`` into category id ``CO_RF`` and product key
    ``FR-R92B-58``.  Substrings are 1-based and may overshoot the end."""
    s = _c(c)
    category = F.replace(s.substr(F.lit(1), F.lit(category_length)), F.lit(separator),
                         F.lit(replacement))
    product = s.substr(F.lit(key_start), F.length(s))
    return category, product


def strip_prefix(c, prefix: str = LEGACY_ID_PREFIX) -> Column:
    s = _c(c)
    return F.when(s.startswith(prefix), s.substr(F.lit(len(prefix) + 1), F.length(s))).otherwise(s)


def remove_chars(c, chars: str = ID_SEPARATOR) -> Column:
    """Each of ``chars`` goes, wherever it stands."""
    return F.translate(_c(c), chars, "")


def parse_packed_date(c) -> Column:
    """Integer ``yyyymmdd`` to DATE.  0, anything that is not 8 characters
    long (incl. negatives) and anything that is not a calendar date become
    NULL; the last case never fails the job.  Pure integer arithmetic: no
    string formatting or parsing per row."""
    n = _c(c).cast("long")
    y, m, d = int_div(n, F.lit(10000)), int_div(n, F.lit(100)) % 100, n % 100
    first = F.when((n >= 10000101) & (n <= 99991231) & m.between(1, 12),
                   F.make_date(y.cast("int"), m.cast("int"), F.lit(1)))
    ok = (d >= 1) & (d <= F.dayofmonth(F.last_day(first)))
    return F.when(ok, F.date_add(first, (d - 1).cast("int")))


_TOKEN = re.compile(r"(y+|M+|d+)")


def _format_regex(fmt: str) -> str:
    """Shape check for a date pattern: ``yyyy`` -> 4 digits, ``MM``/``dd``
    -> 2, ``M``/``d`` -> 1-2; every other character literal."""
    out = []
    for part in _TOKEN.split(fmt):
        if not part:
            continue
        if part[0] == "y":
            out.append(r"\d{%d}" % max(len(part), 4))
        elif part[0] in "Md":
            out.append(r"\d{2}" if len(part) == 2 else r"\d{1,2}")
        else:
            out.append(re.escape(part))
    return "^" + "".join(out) + "$"


def parse_mixed_date(c, formats: Sequence[str] = MIXED_DATE_FORMATS) -> Column:
    """Parse a text date that may come in any of ``formats`` (first match
    wins).  A format is only tried on text of its shape, so a row costs one
    parse, not one failed parse per other format."""
    s = F.trim(_c(c))
    return F.coalesce(*[F.when(s.rlike(_format_regex(f)), F.try_to_date(s, f))
                        for f in formats])


def null_future_dates(c, load_ts) -> Column:
    """Dates later than the load time are impossible: NULL them."""
    d = _c(c)
    return F.when(d > load_time(load_ts), F.lit(None)).otherwise(d)


def int_div(a, b) -> Column:
    """SQL integer division: truncates toward zero, NULL when either side is
    NULL (never ``/``, which yields a fraction in Spark)."""
    return F.call_function("div", _c(a), _c(b))


def repair_amounts(sales, quantity, price) -> tuple[Column, Column]:
    """Rebuild sales as quantity * |price| when it is missing, non-positive or
    inconsistent; rebuild a missing or non-positive price from the *raw*
    sales divided by quantity (0 quantity gives NULL)."""
    s, q, p = _c(sales), _c(quantity), _c(price)
    expected = q * F.abs(p)
    sales_out = F.when(s.isNull() | (s <= 0) | (s != expected), expected).otherwise(s)
    price_out = F.when(p.isNull() | (p <= 0), int_div(s, F.nullif(q, F.lit(0)))).otherwise(p)
    return sales_out, price_out


def null_default(c, value) -> Column:
    return F.coalesce(_c(c), F.lit(value))


def reconcile(primary, fallback, missing: str = MISSING) -> Column:
    """Prefer ``primary`` unless it is ``missing`` (or NULL); then
    ``fallback``; then ``missing``."""
    p = _c(primary)
    return F.when(p != F.lit(missing), p).otherwise(F.coalesce(_c(fallback), F.lit(missing)))
