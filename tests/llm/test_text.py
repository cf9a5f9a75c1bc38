"""Words, hashes and the stored helpers."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from stationcast.llm.text import (ALNUM, FOLD, SPACE, hash_spans, slices, span_strings,
                                  split_words)

TEXTS = st.lists(st.one_of(st.none(), st.text(
    alphabet="abcABC zé日\t\n\x0b\r.,-0_\x7f", max_size=30)), max_size=6)


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_match_the_expressions(texts):
    column = pa.array(texts, pa.string())
    for inside, table, pattern, change in (
            (SPACE, None, r"[^\x20\x09-\x0D]+", str),
            (ALNUM, FOLD, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold)):
        words = split_words(column, inside, *([table] if table is not None else []))
        expected = [re.findall(pattern, change(t or "")) for t in texts]
        assert words.counts.tolist() == list(map(len, expected))
        got = span_strings(words.data, words.start, words.end).to_pylist()
        assert got == [w for ws in expected for w in ws]
        assert words.owner.tolist() == [k for k, ws in enumerate(expected) for _ in ws]


def test_hashes_depend_on_the_word_alone():
    text = "alpha beta alpha gamma  beta"
    words = split_words(pa.array([text, "gamma " + "y" * 3_000_000 + " alpha"]))
    h = words.hashes().tolist()
    assert h[0] == h[2] == h[7] and h[1] == h[4] and h[3] == h[5] and len(set(h)) == 4


def test_no_collisions_among_many_words():
    words = [f"{k:x}" for k in range(200_000)]
    split = split_words(pa.array([" ".join(words)]))
    assert len(np.unique(split.hashes())) == len(words)
    assert len(hash_spans(split.data, split.start[:0], split.end[:0])) == 0


def test_slices_bound_bytes_and_keep_all_rows():
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["a" * 10, None, "b" * 90, "", "c" * 5])], ["text"])
    parts = list(slices(iter([batch]), "text", 20))
    assert [p.column(0).to_pylist() for p in parts] == [["a" * 10, None], ["b" * 90], ["", "c" * 5]]
