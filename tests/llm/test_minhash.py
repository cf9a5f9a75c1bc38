"""Near duplicates at several thresholds, and the prefix filter, against all pairs."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stationcast.llm import minhash
from tests.llm.conftest import make_docs


def crowd(seed, bases=6, copies=14, words=90, vocabulary=300):
    """Texts around a few bases, changed by up to a fifth of their words; some hold a repeated part."""
    random = np.random.default_rng(seed)
    names = np.array([f"w{k}" for k in range(vocabulary)])
    texts = []
    for b in range(bases):
        base = random.choice(names, words)
        for _ in range(copies):
            text = base.copy()
            at = random.choice(words - 3, random.integers(0, words // 25 + 1), replace=False)
            for k in at:
                text[k:k + 1] = random.choice(names, 1)
            text = list(text)
            if b % 2:
                text += text[:20] * int(random.integers(0, 3))
            texts.append(" ".join(text))
    return texts


def similarities(texts):
    owner, value, weight = minhash.weighted_shingles(pa.array(texts))
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    parts = [(value[cut[k]:cut[k + 1]], weight[cut[k]:cut[k + 1]]) for k in range(len(texts))]
    return {(a, b): minhash.probability_jaccard(*parts[a], *parts[b])
            for a, b in combinations(range(len(texts)), 2)}


def classes(n, links):
    parent = list(range(n))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return [root(k) for k in range(n)]


@pytest.mark.parametrize("threshold", [0.65, 0.8, 0.9])
def test_classes_at_a_threshold(spark, threshold):
    texts = crowd(int(threshold * 100))
    found = similarities(texts)
    want = classes(len(texts), [p for p, s in found.items() if s >= threshold])
    assert 6 < len(set(want)) < len(texts)
    docs = make_docs(spark, [(i, t, "s") for i, t in enumerate(texts)])
    rows = minhash.near_duplicates(docs, threshold).collect()
    assert {r.doc_id: r.class_id for r in rows} == dict(enumerate(want))
    assert sum(r.keeper for r in rows) == len(set(want))


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_the_prefix_filter_loses_no_pair(spark, threshold):
    texts = crowd(3) + ["a b c", "", "a b c d e f"]
    table = spark.createDataFrame(list(enumerate(texts)), "cid BIGINT, text STRING")
    placed = table.select("cid", (F.col("cid") % 50).alias("component"))
    pairs = {(r.a, r.b) for r in minhash._possible_pairs(table, placed, threshold).collect()}
    near = {p for p, s in similarities(texts).items() if s >= threshold and (p[0] - p[1]) % 50}
    assert near <= pairs
    # All pairs of a crowd share shingles; those that the filter leaves are mostly links.
    assert len(pairs) < 3 * len(near) + 10


def test_a_crowd_of_far_copies_makes_few_pairs(spark):
    """Copies that are each too far from all others share most words with them, and no pair is made."""
    random = np.random.default_rng(4)
    base = [f"b{k}" for k in range(150)]
    texts = []
    for i in range(300):
        text = list(base)
        for k in random.choice(150, 9, replace=False):
            text[k] = f"x{i}-{k}" if i % 3 else f"y{k}-{i // 30}"
        texts.append(" ".join(text))
    table = spark.createDataFrame(list(enumerate(texts)), "cid BIGINT, text STRING")
    pairs = minhash._possible_pairs(table, table.select("cid", F.col("cid").alias("component")), 0.8)
    near = sum(s >= 0.8 for s in similarities(texts).values())
    assert pairs.count() <= 20 * near + 100 < 300 * 299 / 20


def test_rows_of_a_band_follow_the_threshold():
    assert [minhash.band_rows(t) for t in (0.9, 0.8, 0.65, 0.5, 0.1)] == [7, 7, 3, 2, 1]
    for t in (0.9, 0.8, 0.65, 0.5):
        assert (1 - t ** minhash.band_rows(t)) ** minhash.BANDS < 1e-3
    for odd in (0, -1, 1.5):
        with pytest.raises(ValueError, match="threshold"):
            minhash.band_rows(odd)
