"""Vectorised text helpers against plain Python."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gatecount.llm import text as X

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB é\t\n,.ß漢", max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None, database=None)
@given(TEXTS)
def test_words_match_pattern(texts):
    got = []
    for first, _, data, offsets in X.pieces(pa.array(texts, pa.string()), 16):
        start, end, row = X.words(data, offsets)
        got += [(first + r, data[s:e].tobytes().decode()) for s, e, r in zip(start, end, row, strict=True)]
    want = [(k, w) for k, t in enumerate(texts) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    assert got == want


@settings(max_examples=100, deadline=None, database=None)
@given(TEXTS, st.integers(1, 5))
def test_shingles_equal_when_words_are(texts, width):
    rows = []
    for first, last, data, offsets in X.pieces(pa.array(texts, pa.string())):
        start, end, row = X.words(data, offsets)
        h, r = X.shingles(X.span_hashes(data, start, end), row, last - first, width)
        rows += [(first + b, int(a)) for a, b in zip(h, r, strict=True)]
    seen: dict = {}
    for k, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        want = [tuple(w[i : i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else ([tuple(w)] if w else [])
        got = [h for r, h in rows if r == k]
        assert len(got) == len(want)
        for h, s in zip(got, want, strict=True):
            assert seen.setdefault(s, h) == h
    assert len(set(seen.values())) == len(seen)


def test_hash_is_place_independent():
    a, b = np.frombuffer(b"xx word", np.uint8), np.frombuffer(b"word", np.uint8)
    assert X.span_hashes(a, np.array([3]), np.array([7])) == X.span_hashes(b, np.array([0]), np.array([4]))


def test_long_and_sliced_columns():
    column = pa.array(["skip", "a" * 300_000 + " b", None, "c"]).slice(1)
    spans = [(f, l) for f, l, _, _ in X.pieces(column, 1000)]
    assert spans[0] == (0, 1) and spans[-1][1] == 3
    assert X.ragged(np.array([2, 0, 3])).tolist() == [0, 1, 0, 1, 2]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_both_string_kinds(kind):
    data, offsets = X.buffers(pa.array(["ab", None, ""], kind))
    assert offsets.tolist() == [0, 2, 2, 2] and data[:2].tobytes() == b"ab"
