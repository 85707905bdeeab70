"""Vectorised word handling on Arrow text columns.

A word is a maximal run of bytes outside a set of separators; with the default
set this is ``[^\\x20\\x09-\\x0D]+``.  Texts are never decoded: word
boundaries and hashes are computed with numpy on the column's UTF-8 buffer.

Hashes are keyed.  A word's hash is two multilinear sums over its 32-bit pieces, with coefficients that
follow from the key, of which the upper halves count: any two words collide with a chance of
2^-64, whatever they are, unless the key is known.  Callers whose results rest on hashes draw the key
anew for each run (``fresh_key``), so that no text can be made to collide.  ``numbers`` is exact.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WHITE_SPACE = np.zeros(256, bool)
WHITE_SPACE[[9, 10, 11, 12, 13, 32]] = True

#: Bytes of text that are worked on at once; only a single longer text exceeds it.
BLOCK_BYTES = 1 << 20

_U = np.uint64
#: Words up to so many bytes are hashed together; longer ones one by one.
LONG_WORD = 64
_LOW = _U(0xFFFFFFFF)
_REST = np.array([(1 << 8 * n) - 1 for n in range(8)] + [2**64 - 1], _U)


def fresh_key() -> int:
    """A key that no text knows of; drawn on the driver, once for a run."""
    return int.from_bytes(os.urandom(7), "little")


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def constants(seed: int, n: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    i = np.arange(1, n + 1, dtype=_U)
    return mix(i * _U(0x9E3779B97F4A7C15) + _U(seed * 0xD1B54A32D192ED03 % 2**64)) | _U(1)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offs = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    return np.frombuffer(data, np.uint8)[offs[0]:offs[-1]], offs - offs[0]


def blocks(offs: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges with about ``most`` bytes of text each."""
    n, lo = len(offs) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi


class Words:
    """The words of consecutive texts.

    ``starts``/``ends``: byte ranges; ``bounds``: for each text its first word,
    and at the end the number of words; ``row``: the text of each word.
    """

    def __init__(self, data: np.ndarray, offs: np.ndarray, separators: np.ndarray = WHITE_SPACE):
        self.data, self.offs = data, offs
        n = len(data)
        apart = separators[data]
        at = np.unique(offs[:-1][offs[:-1] < offs[1:]])      # where a text that isn't empty begins
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[0] = after[-1] = True
            before[1:], after[:-1] = apart[:-1], apart[1:]
            before[at] = True
            after[at[at > 0] - 1] = True
        inside = ~apart
        self.starts = np.flatnonzero(inside & before)
        self.ends = np.flatnonzero(inside & after) + 1
        self.bounds = np.searchsorted(self.starts, offs)
        self.row = np.repeat(np.arange(len(offs) - 1), np.diff(self.bounds))

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, key: int = 0, fold: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each word; ``fold`` maps bytes first (e.g. to lower case)."""
        data = np.concatenate([self.data if fold is None else fold[self.data].astype(np.uint8), np.zeros(8, np.uint8)])
        lanes = np.ndarray((len(self.data) + 1,), "<u8", data.data, strides=(1,))
        by = np.random.default_rng([key, 64]).integers(0, 2**64, (2, 2 + LONG_WORD // 4), _U)
        out = np.empty(len(self), _U)
        for i in range(0, len(self), 1 << 18):      # a part of the words at a time
            starts, sizes = self.starts[i:i + (1 << 18)], (self.ends - self.starts)[i:i + (1 << 18)]
            one, two = (by[r, 0] + by[r, 1] * sizes.astype(_U) for r in (0, 1))
            own = np.arange(len(starts))
            for b in range(LONG_WORD // 8):
                x = lanes[starts[own] + 8 * b] & _REST[np.minimum(sizes[own] - 8 * b, 8)]
                low, high = x & _LOW, x >> _U(32)
                one[own] += low * by[0, 2 + 2 * b] + high * by[0, 3 + 2 * b]
                two[own] += low * by[1, 2 + 2 * b] + high * by[1, 3 + 2 * b]
                own = own[sizes[own] > 8 * b + 8]
                if not len(own):
                    break
            out[i:i + (1 << 18)] = mix((one & ~_LOW) | (two >> _U(32)))
        for w in np.flatnonzero(self.ends - self.starts > LONG_WORD).tolist():
            digest = hashlib.blake2b(data[self.starts[w]:self.ends[w]], key=key.to_bytes(8, "little"), digest_size=8)
            out[w] = int.from_bytes(digest.digest(), "little")
        return out

    def numbers(self) -> np.ndarray:
        """The same number for the same word, from 0: no hash, the words themselves are compared."""
        sizes = self.ends - self.starts
        at = np.concatenate([[0], np.cumsum(sizes)])
        inside = np.repeat(self.starts - at[:-1], sizes) + np.arange(at[-1])
        raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(at), pa.py_buffer(self.data[inside])])
        return raw.dictionary_encode().indices.to_numpy().astype(np.int64)


def same_windows(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, number) of every ``k`` consecutive words of one text: windows of the
    same words, and only those, have the same number."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    one = words.numbers()
    base = int(one.max()) + 1
    out, top = one[:n], base
    for j in range(1, k):
        if top * base >= 2**63:      # number what there is anew
            out = np.unique(out, return_inverse=True)[1]
            top = int(out.max()) + 1
        out, top = out * base + one[j:j + n], top * base
    at = np.flatnonzero(words.row[:n] == words.row[k - 1:])
    return at, out[at]


def windows(words: Words, hashes: np.ndarray, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every ``k`` consecutive words of one text."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    at = np.flatnonzero(words.row[:n] == words.row[k - 1:])
    by = constants(seed + 101, k)
    h = hashes[:n] * by[0]
    for j in range(1, k):
        h += hashes[j:j + n] * by[j]
    return at, mix(h[at])


def ascii_lower() -> np.ndarray:
    fold = np.arange(256)
    fold[ord("A"):ord("Z") + 1] += 32
    return fold
