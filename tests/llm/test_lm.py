"""The score column against a sum over all segmentations and all classes, written out."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stationcast.llm import lm
from stationcast.llm.lattice import load_vocabulary
from tests.llm.test_models import segmentations

pytestmark = pytest.mark.skipif(not Path(lm.VOCABULARY).is_file(), reason="no vocabulary file")

ROWS = [(1, "The cat sat on the mat", "en", True), (2, "the dog sat", "en", True),
        (3, "le chat et le chien", "fr", True), (4, "un chien noir", "fr", True),
        (5, "die katze", "de", True), (6, "the chat zebu", "en", False), (7, "", "fr", False),
        (8, None, None, True), (9, "the the the THE", "xx", False), (10, "mat cat é 42", "de", False)]


def tokens(text):
    return [*(text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split(), b""]


def by_hand(rows, max_groups):
    """Weights of pieces by two rounds of expectations, then every document's marginal probability."""
    vocabulary = load_vocabulary(lm.VOCABULARY)
    prior = dict(zip(vocabulary.pieces, vocabulary.prior.tolist()))
    train = [r for r in rows if r[3]]
    size = Counter("null" if r[2] is None else r[2] for r in train)
    names = sorted(size, key=lambda g: (-size[g], g))[:max_groups - 1]

    def kind(group):
        group = "null" if group is None else group
        return names.index(group) if group in names else len(names)

    count = defaultdict(lambda: [0] * (len(names) + 1))
    documents = [0] * (len(names) + 1)
    for _, text, group, _ in train:
        documents[kind(group)] += 1
        for token in tokens(text):
            count[token][kind(group)] += 1
    ways = {t: [w for w in segmentations(b" " + t, prior)] for _, text, _, _ in rows
            for t in tokens(text) if t}

    def spelled(token, piece):
        return sum(math.prod(piece[p] for p in way) for way in ways[token])

    piece = prior
    for _ in range(2):
        used = {p: 100 * w for p, w in prior.items()}
        for token in count:
            if token:
                whole = spelled(token, piece)
                for way in ways[token]:
                    share = math.prod(piece[p] for p in way) / whole
                    for p in way:
                        used[p] += share
        total = sum(used.values())
        piece = {p: u / total for p, u in used.items()}

    every = [sum(c) for c in count.values()]
    n, v = sum(every), len(every)
    once, twice = every.count(1), every.count(2)
    d = min(0.95, max(0.1, (once + 1) / (once + 2 * twice + 2)))
    classes = range(len(names) + 1)
    n_class = [sum(c[k] for c in count.values()) for k in classes]
    v_class = [sum(c[k] > 0 for c in count.values()) for k in classes]

    def probability(token, k):
        seen = count.get(token, [0] * len(classes))
        lattice = spelled(token, piece) if token else 0.0
        corpus = (max(sum(seen) - d, 0) + d * v * lattice) / n
        if not n_class[k]:
            return corpus
        return (max(seen[k] - d, 0) + d * v_class[k] * corpus) / n_class[k]

    return {i: math.log10(sum(
        documents[k] / sum(documents) * math.prod(probability(t, k) for t in tokens(text))
        for k in classes)) for i, text, _, _ in rows}


@pytest.mark.parametrize("max_groups", [2, 8])
def test_scores_are_marginal_probabilities(spark, max_groups):
    docs = spark.createDataFrame(ROWS, "doc_id BIGINT, text STRING, lang STRING, learn BOOLEAN")
    rows = lm.score_documents(docs, F.col("learn"), F.col("lang"), max_groups=max_groups).collect()
    want = by_hand(ROWS, max_groups)
    assert {r.doc_id: r.score for r in rows} == pytest.approx(want, rel=1e-5)


def test_nine_classes_are_nine(spark):
    """Classes are told apart as far as the parameter says."""
    rows = [(10 * g + k, f"w{g}a w{g}b common w{g}c", f"g{g}", k < 2) for g in range(9) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, learn BOOLEAN")
    got = lm.score_documents(docs, F.col("learn"), F.col("lang"), max_groups=12).collect()
    assert {r.doc_id: r.score for r in got} == pytest.approx(by_hand(rows, 12), rel=1e-5)
