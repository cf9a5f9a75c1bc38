"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stationcast.llm import queries, runs
from tests.llm.conftest import ODD_ROWS


def dense(symbols):
    if not len(symbols):
        return np.zeros(0, np.int64)
    return np.unique(np.asarray(symbols), return_inverse=True)[1].reshape(-1).astype(np.int64)


def longest_lyndon(s):
    return [max(j - i for j in range(i + 1, len(s) + 1)
                if all(s[i:j] < s[k:j] for k in range(i + 1, j))) for i in range(len(s))]


def runs_by_hand(s, exponent, least):
    """Stretches that keep a period, for every period, without those that keep a smaller one."""
    found = []
    for q in range(1, len(s) // exponent + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            if j - i + q >= max(exponent * q, least) and not any(
                    start <= i and i + (j - i + q) <= start + length for start, length, _ in found):
                found.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=24))
def test_lyndon_lengths(symbols):
    text = dense(symbols)
    assert runs.lyndon_lengths(text) == longest_lyndon(text.tolist())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=12), st.integers(1, 6), st.lists(st.integers(0, 3), max_size=8))
def test_runs_of_any_exponent(part, times, tail):
    text = dense(part * times + tail)
    for exponent, least in ((2, 2), (3, 1), (4, 6)):
        assert [tuple(map(int, r)) for r in runs.find_runs(text, exponent, least)] == \
            runs_by_hand(text.tolist(), exponent, least)


def test_a_million_words_of_one_period():
    found = runs.find_runs(np.arange(1_000_000) % 9973, 4, 6)
    assert found.tolist() == [[0, 1_000_000, 9973]]
    with pytest.raises(ValueError, match="twice"):
        runs.find_runs(np.arange(3), 1)


def by_hand(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = hand_runs(words)
    dropped = {i for start, length, q in found for i in range(start + q, start + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def hand_runs(words):
    """As ``runs_by_hand`` at exponent 4, the stretches of each period found by comparing arrays."""
    ids = dense(words) if words else np.zeros(0, np.int64)
    found = []
    for q in range(1, len(ids) // 4 + 1):
        same = np.concatenate([[False], ids[:-q] == ids[q:], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        for i, j in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if j - i + q >= max(6, 4 * q) and not any(
                    s <= i and j + q <= s + n for s, n, _ in found):
                found.append((i, j - i + q, q))
    return sorted(found, key=lambda run: (run[0], run[2]))


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
           "collapsed_sha256")


def check(rows, texts):
    got = sorted((tuple(r[c] for c in COLUMNS) for r in rows), key=str)
    assert got == sorted((by_hand(i, t) for i, t in texts), key=str)


def test_query_equals_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("length(text) < 12000")
    rows = runs.op11_periodic_runs(spark, docs).collect()
    assert sum(r.n_runs > 0 for r in rows) > 10
    check(rows, [(r.doc_id, r.text) for r in docs.collect()])
    whole = queries.QUERIES["op11_periodic_runs"](spark, small)
    assert whole.count() == spark.read.parquet(f"{small}/documents.parquet").count()


def test_odd_rows(spark, odd_docs, no_docs):
    texts = [(i, t) for i, t, _ in ODD_ROWS if t is None or len(t) < 100_000]
    ids = [i for i, _ in texts]
    rows = runs.op11_periodic_runs(spark, odd_docs).collect()
    assert len(rows) == len(ODD_ROWS)
    check([r for r in rows if r.doc_id in ids or r.doc_id is None], texts)
    assert runs.op11_periodic_runs(spark, no_docs).count() == 0
    found = runs.word_runs(odd_docs).where("doc_id = 8").select(
        "n_words", F.col("runs")[0].alias("run"), "collapsed").first()
    assert (found.n_words, tuple(found.run), found.collapsed) == (1000, (0, 1000, 1), "same")
