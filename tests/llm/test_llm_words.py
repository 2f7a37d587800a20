"""Word kernel against regular expressions."""

import random
import re

import numpy as np
import pyarrow as pa

from txnlake.llm.common import byte_slices
from txnlake.llm.words import buffers, words_of

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def texts(n=60):
    rng = random.Random(5)
    parts = ["the", "The", "É", "über", " ", "\n", "...", "-", "日本", "a1", "9", "\x00", "ß", "Z"]
    return [None, "", "  ", *("".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(n))]


def test_words_and_borders_of_texts():
    some = texts()
    data, offsets = buffers(pa.array(some))
    words = words_of(data, offsets)
    for i, text in enumerate(some):
        a, b = words.first[i], words.first[i + 1]
        found = [words.text(j, j + 1) for j in range(a, b)]
        assert found == WORD.findall(lower(text or ""))


def test_equal_words_and_shingles_have_equal_hashes_and_stay_within_a_text():
    some = texts()
    data, offsets = buffers(pa.array(some))
    words = words_of(data, offsets)
    for length in (1, 2, 3):
        hashes, at = words.shingles(length)
        wanted = []
        for i, text in enumerate(some):
            own = WORD.findall(lower(text or ""))
            wanted += [tuple(own[j : j + length]) for j in range(len(own) - length + 1)]
        assert len(hashes) == len(wanted)
        seen = {}
        for h, w in zip(hashes.tolist(), wanted, strict=True):
            assert seen.setdefault(h, w) == w
        assert len(seen) == len(set(wanted))


def test_a_slice_of_an_array_and_an_empty_one():
    data, offsets = buffers(pa.array(["ab", "cd", None, "ef"]).slice(1, 2))
    assert data.tobytes() == b"cd" and offsets.tolist() == [0, 2, 2]
    data, offsets = buffers(pa.array([], pa.string()))
    assert len(words_of(data, offsets).starts) == 0


def test_slices_cover_all_rows_in_order():
    sizes = [5, 100, 1, 1, 1, 0, 7]
    found = list(byte_slices(sizes, 8))
    assert [i for a, b in found for i in range(a, b)] == list(range(len(sizes)))
    assert all(sum(sizes[a:b]) <= 8 or b - a == 1 for a, b in found)
    assert list(byte_slices([], 8)) == [] and np.diff(found).min() > 0


def test_pieces_of_long_texts_give_the_same_words():
    rng = random.Random(6)
    some = [*texts(), "".join(rng.choices(["ab", " ", "É", "\n", "Z9"], k=5000)), "x" * 3000, ""]
    data, offsets = buffers(pa.array(some))
    whole = words_of(data, offsets)
    for piece in (1, 7, 100, 1000):
        parts = words_of(data, offsets, piece)
        for name in ("low", "starts", "ends", "first", "hashes"):
            assert np.array_equal(getattr(parts, name), getattr(whole, name))
