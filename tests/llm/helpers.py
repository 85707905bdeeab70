"""Small fixtures for the operators' tests."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, ids=None, sources=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", (sources or {}).get(i, "s"), None if t is None else len(t))
            for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOCS)


def as_dicts(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def by_id(df, key="doc_id"):
    return {r[key]: r for r in as_dicts(df)}


def prose(rnd: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def thue_morse(n: int) -> tuple[str, str]:
    """Two words of ``n`` letters (a power of two) that any polynomial hash modulo 2^64 takes for one, if they are long enough."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


ODD_TEXTS = [None, "", " ", "\n\n\t", "é", "a", "\x0b\x0c x \r\n y", "word " * 3000, "x" * 200000, "     b"]
