"""Long tokens and large lexicons of the noisy channel."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from stationcast.llm import toxicity
from stationcast.llm.text import FOLD, SPACE, split_words


@pytest.fixture(scope="module")
def characters():
    words = "idiot moron stupid clown trash hello world banana letter good morning idea doom" * 20
    counts = toxicity.transition_counts(split_words(pa.array([words]), SPACE, FOLD)) + 0.5
    counts = counts.reshape(toxicity.SYMBOLS, -1)
    return np.log(counts / counts.sum(axis=1, keepdims=True))


@pytest.mark.parametrize("longest", [1, 2, 7, 40])
def test_pieces_decode_like_the_whole(characters, monkeypatch, longest):
    random = np.random.default_rng(longest)
    letters = np.frombuffer(b"idiotmrn01345$@!. -aalleezz\xc3\xa9", np.uint8)
    tokens = [random.choice(letters, n).tobytes() for n in (1, 3, 8, 41, 97, 300)]
    tokens += [b"iiiii" * 20, b"m.o.r.o.n." * 13, b"\x00\x00\x00a1"]
    whole = toxicity.decode(tokens, characters)
    monkeypatch.setattr(toxicity, "LONGEST", longest)
    pieces = toxicity.decode(tokens, characters)
    # Of equally good paths one may read a letter that the other leaves out.
    assert np.mean([a == b for a, b in zip(whole, pieces)]) > 0.8
    assert all(abs(len(a) - len(b)) <= 2 for a, b in zip(whole, pieces))


def test_a_disguised_word_on_any_cut_of_a_long_token_is_read(characters):
    for at in (994, 996, 998, 1000, 1994, 1998):
        token = b"-" * at + b"1d10t" + b"-" * (3000 - at)
        assert toxicity.decode([token], characters) == [b"idiot"]


def test_a_lexicon_beyond_fifty_thousand_entries_is_whole(spark):
    """Every word that toxic texts share is an entry, however many there are."""
    words = [[f"{chr(97 + k // 676 % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k % 26)}x{chr(97 + k // 17576)}"
              for k in range(s, s + 3500)] for s in range(0, 56_000, 3500)]
    rows = [(i, " ".join(part), 1) for i, part in enumerate(w for w in words for _ in range(4))]
    rows = [(i, f"{text} copy{'abcdefgh'[i % 8] * 3}", t) for i, text, t in rows]
    rows += [(1000 + i, f"clean words {i} of no interest", 0) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, toxic INT")
    scorer = toxicity.train_scorer(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert len(scorer.entries) > 50_000
