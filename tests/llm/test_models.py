"""Lattices, fields and decoding against plain enumeration."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import pytest

from stationcast.llm import quality, toxicity
from stationcast.llm.lattice import Lattice, make_vocabulary
from stationcast.llm.text import hash_spans, split_words


def segmentations(word: bytes, pieces):
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if word[:n] in pieces:
            for rest in segmentations(word[n:], pieces):
                yield [word[:n], *rest]


def test_lattice_sums_over_all_segmentations():
    weight = {bytes([b]): 0.01 for b in range(256)} | {
        b" a": 0.2, b"ab": 0.1, b"abc": 0.05, b" abc": 0.02, b"bc": 0.1, b"c": 0.2, "é".encode(): .1}
    vocabulary = make_vocabulary(weight)
    score = np.log(vocabulary.prior)
    by_piece = dict(zip(vocabulary.pieces, score))
    words = ["abc", "a", "cab", "éa", "abcabc", "zz"]
    data = np.frombuffer("|".join(words).encode(), np.uint8)
    sizes = np.array([len(w.encode()) for w in words])
    start = np.cumsum(sizes + 1) - (sizes + 1)
    paths = Lattice(vocabulary, data, start, start + sizes)
    got, used = paths.log_probability(score), paths.expected(score, np.arange(1.0, 7), len(score))
    expected = np.zeros(len(score))
    for k, word in enumerate(words):
        ways = list(segmentations(b" " + word.encode(), by_piece))
        weights = [math.exp(sum(by_piece[p] for p in way)) for way in ways]
        assert got[k] == pytest.approx(math.log(sum(weights)))
        for way, w in zip(ways, weights):
            for piece in way:
                expected[vocabulary.pieces.index(piece)] += (k + 1) * w / sum(weights)
    assert used == pytest.approx(expected)


def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    first = np.array([0, 3, 3, 4, 9])
    unary, transition = rng.normal(size=9), rng.normal(size=(2, 2))
    good, pair, z = quality.marginals(unary, first, transition)
    for k in range(4):
        lines = range(first[k], first[k + 1])
        total, one, two = 0.0, np.zeros(9), np.zeros((9, 2, 2))
        for labels in itertools.product((0, 1), repeat=len(lines)):
            w = math.exp(sum(unary[i] for i, y in zip(lines, labels) if y)
                         + sum(transition[a, b] for a, b in zip(labels, labels[1:])))
            total += w
            for j, i in enumerate(lines):
                one[i] += w * labels[j]
                if j:
                    two[i, labels[j - 1], labels[j]] += w
        for j, i in enumerate(lines):
            assert good[i] == pytest.approx(one[i] / total)
            if j:
                assert pair[i] == pytest.approx(two[i] / total)
        if len(lines):
            assert z[k] == pytest.approx(math.log(total))


def test_lines_know_their_neighbours():
    lines = quality.line_features(pa.array(["Good line.\n\n!!! $$$ ###\nlast", None, "", "x x x x"]))
    assert np.diff(lines.first).tolist() == [3, 0, 0, 1]
    own = quality.OWN
    assert (lines.features[1, own:2 * own] == lines.features[0, :own]).all()
    assert (lines.features[1, 2 * own:3 * own] == lines.features[2, :own]).all()
    assert lines.features[0, -2] == 1 and lines.features[2, -1] == 1
    assert lines.features[3, 7] == 0.75      # three of four words repeat the one before
    assert lines.weight.tolist() == [10, 11, 4, 7]


def test_field_learns_mixed_documents():
    good = "This is a plain sentence of words.\nAnd here is another one of them."
    bad = "$$$ ### %%% &&&\n*** $$$ @@@"
    texts = [good] * 30 + [bad] * 25 + ["A plain sentence of words.\n" + bad + "\n" + bad] * 15
    labels = np.array([1.0] * 30 + [0.0] * 40)
    lines = quality.line_features(pa.array(texts))
    scores = quality.text_scores(lines, quality.fit_field(lines, labels))
    assert scores[:30].min() > 0.8 and scores[30:].max() < 0.3


def letters_model():
    words = split_words(pa.array(["idiot moron hello stupid world told idiot " * 50]))
    counts = toxicity.transition_counts(words) + 0.5
    counts = counts.reshape(toxicity.SYMBOLS, toxicity.SYMBOLS)
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def readings(token: bytes):
    """Every path through the lattice of a token: symbols read, cost, letters written out."""
    steps = []
    for k, byte in enumerate(token):
        again = k > 0 and token[k - 1] == byte
        third = again and k > 1 and token[k - 2] == byte
        letter, space = bool(toxicity._LETTER[byte]), byte == 0x20
        own = int(toxicity._SYMBOL[byte])
        options = []
        if third:
            options.append((None, 0.0, b""))
        elif letter:
            options.append((own, 0.0, bytes([byte])))
            if again:
                options.append((None, toxicity.DOUBLE, b""))
        else:
            options.append((None, 0.0 if again else float(toxicity._DROP[byte]), b""))
            options.append((0, toxicity.BREAK, b" ") if space
                           else (toxicity.OTHER, toxicity.KEEP, b""))
            options += [(int(r), toxicity.SWAP, bytes([96 + int(r)]))
                        for r in toxicity._READINGS[byte] if r]
        steps.append(options)
    for path in itertools.product(*steps):
        yield path


@pytest.mark.parametrize("token", [b"1d10t", b"m00ron", b"h e l l o", b"st.u", b"l0o", b"iddiot!"])
def test_decoding_finds_the_best_path(token):
    model = letters_model()

    def value(path):
        total, last = 0.0, 0
        for symbol, cost, _ in path:
            total += cost
            if symbol is not None:
                total += model[last, symbol]
                last = symbol
        return total + model[last, 0]

    best = max(readings(token), key=value)
    assert toxicity.decode([token], model) == [b"".join(p[2] for p in best)]


def test_decoding_restores_disguised_words():
    model = letters_model()
    assert toxicity.decode([b"1d10t", b"i d i o t", b"m.o.r.o.n", b"stuuuupid", b"$tup1d"], model) \
        == [b"idiot", b"idiot", b"moron", b"stupid", b"stupid"]
    long = b"1d10t." * 500
    assert toxicity.decode([long, b"idiot"], model)[1] == b"idiot"
    assert toxicity.decode([], model) == []


@pytest.mark.parametrize("text, words", [
    ("you iddiot", "you iddiot idiot"), ("stuupid world", "stuupid stupid world"),
    ("hello you", "hello you"), ("!diot", "diot idiot"), ("(idio+)", "idio idiot"),
    ("told +old", "told old told"), ("hello, world. [idiot]", "hello world idiot"),
    ("i d ! o t", "i d o t idiot"), ("you m o r o n ! you", "you moron you"),
    ("s + u p | d", "s d stupid"), ("i d i o +", "idio idiot")])
def test_disguises_of_words_that_look_clean_are_read(text, words):
    column = pa.array([None, text, "other"])
    hashes, texts = toxicity.restored_features(column, letters_model())
    asked = split_words(pa.array([words]))
    found = hashes[texts == 1]
    assert set(hash_spans(asked.data, asked.start, asked.end)) <= set(found)
    other = split_words(pa.array(["other"]))
    assert hash_spans(other.data, other.start, other.end) in hashes[texts == 2]
    assert set(texts) == {1, 2}


def test_a_plain_reading_counts_once():
    model = letters_model()
    one, _ = toxicity.restored_features(pa.array(["hello world idiot"]), model)
    two, _ = toxicity.restored_features(pa.array(["hello world idiot!"]), model)
    assert sorted(one) == sorted(two)
    assert [len(x) for x in toxicity.restored_features(pa.array(["", None]), model)] == [0, 0]
