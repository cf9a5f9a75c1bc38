"""Keys of repeated windows: whole 128 bits, and no names left behind."""

from __future__ import annotations

import numpy as np

from stationcast.llm import substrings
from tests.llm.conftest import make_docs


def test_keys_are_known_by_both_halves():
    known = np.unique(np.array([[1, 5], [1, 7], [1, 9], [3, 0], [8, 2]], np.uint64), axis=0)
    values = np.array([[1, 9], [1, 8], [3, 0], [3, 1], [0, 0], [9, 9], [1, 5], [8, 2]], np.uint64)
    assert substrings._among(values, known).tolist() == [
        True, False, True, False, False, False, True, True]
    assert not substrings._among(values, known[:0]).any()


def test_no_table_stays_in_the_catalogue(spark):
    words = " ".join(f"w{k}" for k in range(60))
    docs = make_docs(spark, [(1, words, "a"), (2, "before " + words, "a"), (3, "nothing else", "b")])
    out = substrings.repeated_passages(docs)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("substring_texts_")]
    assert sorted(r.kept for r in out.collect()) == ["", "before", "nothing else"]
