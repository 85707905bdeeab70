import random

import numpy as np
import pyarrow as pa

from histdim.llm.words import LONG_WORD, Words, ascii_lower, blocks, fresh_key, same_windows, utf8, windows
from tests.llm.helpers import ODD_TEXTS, WORD, prose, thue_morse


def some_texts():
    rnd = random.Random(1)
    return [*ODD_TEXTS, *(prose(rnd, rnd.randrange(40)) for _ in range(30)), "", "é è　ü", None]


def test_words_are_those_of_the_pattern():
    texts = some_texts()
    data, offs = utf8(pa.array(texts))
    w = Words(data, offs)
    raw = data.tobytes()
    for i, t in enumerate(texts):
        mine = [raw[w.starts[j]:w.ends[j]].decode() for j in range(w.bounds[i], w.bounds[i + 1])]
        assert mine == WORD.findall(t or "")


def test_equal_words_and_windows_have_equal_hashes():
    texts = ["a b c d e a b c", "x a b c", "a", None, "b c d"]
    data, offs = utf8(pa.array(texts))
    w = Words(data, offs)
    h = w.hashes()
    words = [data[a:b].tobytes() for a, b in zip(w.starts, w.ends)]
    assert len(set(zip(words, h.tolist()))) == len(set(words)) == len(set(h.tolist()))
    at, win = windows(w, h, 3)
    seen = {}
    for a, x in zip(at.tolist(), win.tolist()):
        seen.setdefault(x, set()).add(tuple(words[a:a + 3]))
    assert all(len(v) == 1 for v in seen.values())
    assert len(seen) == len({tuple(words[a:a + 3]) for a in at.tolist()})
    assert len(at) == 6 + 2 + 0 + 1


def test_hashes_do_not_depend_on_where_a_word_stands():
    long = "y" * 3_000_000
    a = Words(*utf8(pa.array(["q " * 900_000 + long + " z"])))
    b = Words(*utf8(pa.array(["z q", long])))
    ha, hb = a.hashes(), b.hashes()
    assert ha[0] == hb[1] and ha[-1] == hb[0] and ha[-2] == hb[2]
    assert len(np.unique(ha)) == 3


def test_blocks_cover_all_rows_once():
    offs = np.array([0, 0, 5, 5, 100, 101, 102, 102])
    got = list(blocks(offs, 10))
    assert got[0][0] == 0 and got[-1][1] == 7
    assert all(a[1] == b[0] for a, b in zip(got, got[1:]))


def test_sliced_columns():
    data, offs = utf8(pa.array(["aa", "bb cc", None, "dd"]).slice(1, 3))
    w = Words(data, offs)
    assert w.bounds.tolist() == [0, 2, 2, 3]


def test_no_words_are_taken_for_one():
    """Regular words, words that differ in one byte anywhere, prefixes and zero bytes."""
    words = [w for n in (64, 1024, 2048, 65536) for w in thue_morse(n)]
    for n in (1, 3, 4, 5, 7, 8, 9, 16, 31, LONG_WORD - 1, LONG_WORD, LONG_WORD + 1, 200):
        words += ["x" * n, *("x" * i + "y" + "x" * (n - i - 1) for i in range(n)), "x" * (n - 1) + "\0", "\0" * n]
    words = list(dict.fromkeys(words))
    w = Words(*utf8(pa.array(words)))
    assert len(w) == len(words)
    for key in (0, 1, fresh_key()):
        assert len(np.unique(w.hashes(key))) == len(words)
    assert len(np.unique(w.numbers())) == len(words) and w.numbers().max() == len(words) - 1
    assert (w.hashes(1) != w.hashes(2)).all() and fresh_key() != fresh_key()


def test_folded_words_hash_alike():
    w = Words(*utf8(pa.array(["Ab aB AB ab Ü ü " + "Q" * 100 + " " + "q" * 100])))
    h = w.hashes(3, ascii_lower())
    assert len(set(h[:4].tolist())) == 1 and h[4] != h[5] and h[6] == h[7] and len(set(w.hashes(3).tolist())) == 8


def test_windows_have_one_number_if_their_words_are_the_same():
    texts = some_texts() + ["a b a b a b a", "b a b"]
    w = Words(*utf8(pa.array(texts)))
    words = [w.data[a:b].tobytes() for a, b in zip(w.starts, w.ends)]
    for k in (1, 3, 5, 9):      # nine words: numbers no longer fit 64 bits as they are
        at, number = same_windows(w, k)
        assert at.tolist() == [a for a in range(len(words) - k + 1) if w.row[a] == w.row[a + k - 1]]
        seen = {}
        for a, x in zip(at.tolist(), number.tolist()):
            seen.setdefault(x, set()).add(tuple(words[a:a + k]))
        assert all(len(v) == 1 for v in seen.values())
        assert len(seen) == len({tuple(words[a:a + k]) for a in at.tolist()})
