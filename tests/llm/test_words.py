"""Vectorised words against regular expressions."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from acreage.llm.words import ALPHANUMERIC, NON_SPACE, find_words, grams, hash_word, slices, texts_of
from tests.llm.brute import ITEM_WORDS, LOWER, SPACE_WORDS

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB9 \t\n-é漢!\x1f\x7f", max_size=30)), max_size=6)


def _words(texts, table):
    held = texts_of(pa.array(texts, pa.string()))
    found = find_words(held, table)
    out = [[] for _ in texts]
    for s, e, t in zip(found.start, found.end, found.text, strict=True):
        out[t].append(held.data[s:e].tobytes().decode())
    return out, found


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_match_patterns(texts):
    assert _words(texts, NON_SPACE)[0] == [SPACE_WORDS.findall(t or "") for t in texts]
    lowered = [[w.translate(LOWER) for w in ws] for ws in _words(texts, ALPHANUMERIC)[0]]
    assert lowered == [ITEM_WORDS.findall((t or "").translate(LOWER)) for t in texts]


def test_equal_words_have_equal_hashes_wherever_they_are():
    found = _words(["abc x Abc", None, "", "zz\nabc"], NON_SPACE)[1]
    assert found.hash[0] == found.hash[2] == found.hash[4] == np.uint64(hash_word("ABC"))
    assert len({int(h) for h in found.hash}) == 3
    assert found.count.tolist() == [3, 0, 0, 2]


def test_grams_stay_inside_texts():
    found = _words(["a b c", "d", "a b"], NON_SPACE)[1]
    hashes, at = grams(found, 2)
    assert at.tolist() == [0, 1, 4] and hashes[0] == hashes[2] != hashes[1]


def test_slices_cover_sliced_columns_and_long_texts():
    column = pa.array(["skipped", "ab", None, "x" * 50, "", "cd"], pa.string())[1:]
    parts = [(low, high, texts.data.tobytes()) for low, high, texts in slices(column, 10)]
    assert [p[:2] for p in parts][0][0] == 0 and parts[-1][1] == 5
    assert b"".join(p[2] for p in parts).decode() == "ab" + "x" * 50 + "cd"
    assert list(slices(pa.array([], pa.string()))) == []
