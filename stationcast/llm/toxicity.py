"""Toxicity of texts restored from leetspeak, spacing and repetition.

A noisy channel turns words into what is written: letters become digits and signs, are repeated, or
are set apart by spaces and dots. Written tokens are read back as lattices of characters, and the
best path under a character language model of the corpus, by Viterbi, is the restored text. A
lexicon learnt from labelled, restored texts then scores whole documents.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stationcast.llm.quality import labelled_sample
from stationcast.llm.store import in_fold
from stationcast.llm.text import FOLD, SPACE, hash_spans, mix, ranges, slices, split_words

CHUNK_BYTES = 2 << 20
#: Labelled documents the lexicon is learnt from, those with the smallest hash of the id.
FIT_DOCUMENTS = 40_000
PREFIX = 5          # letters of a word's stem, a feature beside the word
TABLE = 1 << 20     # bytes decoded at once
LONGEST = 1000      # bytes of a token that one row of steps decodes; longer ones take several rows

# Symbols of the language model: 0 word boundary, 1-26 letters, 27 any other character.
OTHER, SYMBOLS = 27, 28
_SYMBOL = np.full(256, OTHER, np.int64)
_SYMBOL[0x61:0x7B] = np.arange(1, 27)
_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B], _LETTER[0x80:] = True, True
# Marks around a word that belong to the sentence.
MARKS = b".,;:?!\"'()[]{}<>-_|~`/\\*#%&=+^"
_MARK = np.zeros(256, bool)
_MARK[list(MARKS)] = True

#: Letters a sign may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b",
        "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c"}
_READINGS = np.zeros((256, 2), np.int64)
for _sign, _letters in LEET.items():
    for _k, _letter in enumerate(_letters):
        _READINGS[ord(_sign), _k] = ord(_letter) - 96
#: Marks that may also stand for letters.
_SIGN = _MARK & (_READINGS[:, 0] > 0)
# Channel costs (natural log): reading a sign as a letter, or as itself; reading a letter once more
# than its first time; reading a space between single characters as a word boundary.
SWAP, KEEP, DOUBLE, BREAK = -1.0, -6.0, -2.0, -5.0
# Reading nothing: cheap for separators, dearer for signs that look like letters.
_DROP = np.full(256, -1.0)
_DROP[list(b"!|(<+")] = -2.5
_DROP[list(b"$@")] = -4.0
_DROP[0x30:0x3A] = -8.0
_DROP[0x20] = 0.0


def transition_counts(words) -> np.ndarray:
    """Bigram counts of the words that hold letters alone, boundaries included."""
    clean, start, end = _clean(words)
    start, end = start[clean], end[clean]
    place = ranges(start, end - start)
    symbol = _SYMBOL[words.data[place]]
    head = np.zeros(len(place), bool)
    head[np.cumsum(end - start) - (end - start)] = True
    previous = np.where(head, 0, np.concatenate([[0], symbol[:-1]]))
    last = _SYMBOL[words.data[end - 1]]
    pairs = np.concatenate([previous * SYMBOLS + symbol, last * SYMBOLS])
    return np.bincount(pairs, minlength=SYMBOLS ** 2)


def _clean(words):
    """Which words hold letters alone once the marks around them are off, and their bounds."""
    data, n = words.data, len(words.data)
    if not len(words):
        return np.zeros(0, bool), words.start, words.end
    at = np.arange(n)
    plain = ~_MARK[data]
    before = np.maximum.accumulate(np.where(plain, at, -1))
    after = np.minimum.accumulate(np.where(plain, at, n)[::-1])[::-1]
    start, end = after[words.start], before[words.end - 1] + 1
    empty = end <= start
    start, end = np.where(empty, words.start, start), np.where(empty, words.start, end)
    odd = np.concatenate([[0], np.cumsum(~_LETTER[data])])
    letters = (odd[end] - odd[start] == 0) & ~empty
    # Three equal letters in a row may be stretched.
    triple = np.zeros(n + 1, np.int64)
    if n > 2:
        triple[3:] = np.cumsum((data[2:] == data[1:-1]) & (data[1:-1] == data[:-2])
                               & (data[2:] < 0x80))
    long = end - start >= 3
    inside = triple[end] - triple[np.minimum(start + 2, end)]
    return letters & ~(long & (inside > 0)), start, end


def train_characters(docs: DataFrame) -> np.ndarray:
    """Log transition probabilities over the corpus: one pass, at most 784 sums per task."""
    def count(batches):
        total = np.zeros(SYMBOLS ** 2, np.int64)
        for batch in slices(batches, "text", CHUNK_BYTES):
            total += transition_counts(split_words(batch.column("text"), SPACE, FOLD))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["pair", "n"])

    counts = np.full(SYMBOLS ** 2, 0.5)
    for row in (docs.select("text").mapInArrow(count, "pair bigint, n bigint")
                .groupBy("pair").agg(F.sum("n").alias("n")).collect()):
        counts[row["pair"]] += row["n"]
    counts = counts.reshape(SYMBOLS, SYMBOLS)
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def decode(tokens: list[bytes], transitions: np.ndarray) -> list[bytes]:
    """The most likely reading of each token, boundaries as spaces; other signs are left out.

    Viterbi over lattices of one step per byte: the states are the last symbol read, all tokens of
    similar length advance together. Each byte offers up to two letters, its own symbol, and a step
    that reads nothing. The pieces of a token of more than ``LONGEST`` bytes advance together too, see
    ``_decode_long``; the best path is the same.
    """
    out: list[bytes] = [b""] * len(tokens)
    length = np.array([len(t) for t in tokens], np.int64)
    order = np.argsort(length, kind="stable")
    while len(order) and length[order[-1]] > LONGEST:
        out[order[-1]] = _decode_long(tokens[order[-1]], transitions)
        order = order[:-1]
    k = 0
    while k < len(order):
        j = k + 1
        while j < len(order) and (j + 1 - k) * (length[order[j]] + 1) <= TABLE // SYMBOLS:
            j += 1
        part = order[k:j]
        for n, text in zip(part, _viterbi([tokens[i] for i in part], transitions)):
            out[n] = text
        k = j
    return out


def _decode_long(token: bytes, transitions: np.ndarray) -> bytes:
    """The best path of one long token. Every piece is run from each state it may start in; the pieces'
    best scores from state to state are joined in order, which says where each piece starts and ends."""
    cuts = range(0, len(token), LONGEST)
    pieces, before = [token[k:k + LONGEST] for k in cuts], [token[max(0, k - 2):k] for k in cuts]
    best = np.where(np.arange(SYMBOLS) == 0, 0.0, -np.inf)
    came = []
    at_once = max(1, TABLE // SYMBOLS ** 2 // 16)
    for k in range(0, len(pieces), at_once):
        some = pieces[k:k + at_once]
        starts = np.tile(np.arange(SYMBOLS), len(some))
        scores = _viterbi([p for p in some for _ in range(SYMBOLS)], transitions,
                          [b for b in before[k:k + at_once] for _ in range(SYMBOLS)], starts)
        for through in scores.reshape(len(some), SYMBOLS, SYMBOLS):
            joined = best[:, None] + through
            came.append(joined.argmax(axis=0))
            best = joined.max(axis=0)
    ends = [int((best + transitions[:, 0]).argmax())]
    for back in reversed(came):
        ends.append(int(back[ends[-1]]))
    ends = np.array(ends[::-1])
    out = []
    for k in range(0, len(pieces), at_once):
        some = slice(k, k + at_once)
        out += _viterbi(pieces[some], transitions, before[some], ends[:-1][some], ends[1:][some])
    return b"".join(out)


def _viterbi(tokens: list[bytes], transitions: np.ndarray, before: list[bytes] | None = None,
             starts: np.ndarray | None = None, ends: np.ndarray | None = None):
    """Readings of tokens, or of pieces that begin after the bytes ``before`` in the states ``starts`` and
    end in the states ``ends``; with ``starts`` alone, the best score of every state at the end."""
    n, size = len(tokens), max(map(len, tokens))
    text = np.zeros((n, size), np.uint8)
    for i, token in enumerate(tokens):
        text[i, :len(token)] = np.frombuffer(token, np.uint8)
    length = np.array(list(map(len, tokens)))
    # The two bytes before each, 256 for none.
    lead = np.full((n, 2), 256)
    for i, some in enumerate(before or []):
        lead[i, 2 - len(some):] = list(some)
    past = np.column_stack([lead, text.astype(np.int64)])
    trace = starts is None or ends is not None
    best = np.full((n, SYMBOLS), -np.inf)
    best[np.arange(n), 0 if starts is None else starts] = 0
    # For each step: the state before, and whether the byte was read; enough to walk back.
    came = np.zeros((size if trace else 0, n, SYMBOLS), np.int8)
    read = np.zeros((size if trace else 0, n, SYMBOLS), bool)
    rows = np.arange(n)
    for k in range(size):
        byte = text[:, k]
        own = _SYMBOL[byte]
        letter, space = _LETTER[byte], byte == 0x20
        again = past[:, k + 1] == byte
        third = again & (past[:, k] == byte)
        # Reading nothing keeps the state.
        drop = np.where(letter, np.where(third, 0.0, np.where(again, DOUBLE, -np.inf)),
                        np.where(again, 0.0, _DROP[byte]))
        new = best + drop[:, None]
        back = np.broadcast_to(np.arange(SYMBOLS), (n, SYMBOLS)).astype(np.int8)
        used = np.zeros((n, SYMBOLS), bool)
        options = [(np.where(letter, own, np.where(space, 0, OTHER)),
                    np.where(third, -np.inf, np.where(letter, 0.0, np.where(space, BREAK, KEEP))))]
        for r in range(2):
            reading = _READINGS[byte, r]
            options.append((reading, np.where((reading > 0) & ~third, SWAP, -np.inf)))
        for symbol, cost in options:
            some = np.flatnonzero(cost > -np.inf)
            if not len(some):
                continue
            step = best[some] + transitions[:, symbol[some]].T
            source = step.argmax(axis=1)
            value = step[np.arange(len(some)), source] + cost[some]
            better = value > new[some, symbol[some]]
            at, to = some[better], symbol[some][better]
            new[at, to] = value[better]
            back[at, to] = source[better]
            used[at, to] = True
        live = k < length
        best[live] = new[live]
        if trace:
            came[k][live], read[k][live] = back[live], used[live]
            came[k][~live] = np.arange(SYMBOLS)
    if not trace:
        return best
    state = (best + transitions[:, 0]).argmax(axis=1) if ends is None else ends.copy()
    pieces: list[list[int]] = [[] for _ in tokens]
    letters = b" abcdefghijklmnopqrstuvwxyz"
    emitted = np.zeros((size, n), np.int64)
    for k in range(size - 1, -1, -1):
        emitted[k] = np.where(read[k, rows, state], np.where(
            (state == OTHER) & (text[:, k] < 0x80), 0,
            np.where(state == OTHER, text[:, k], np.array(list(letters) + [0])[state])), 0)
        state = came[k, rows, state].astype(np.int64)
    for i in range(n):
        symbols = emitted[:, i]
        pieces[i] = symbols[symbols > 0].astype(np.uint8).tobytes()
    return pieces


def restored_features(column: pa.Array, transitions: np.ndarray):
    """Hashes of the words, and of the stems of longer ones, of the restored texts, and their texts.

    Words of letters alone are read as they are. Other tokens, and runs of three or more single
    characters with the spaces between them, are decoded; equal tokens once per batch. What may be
    either has both readings: a word with a doubled letter, or with a sign that may stand for a letter
    among the marks around it, is decoded as well, and so are runs to which such signs belong.
    """
    words = split_words(column, SPACE, FOLD)
    n = len(words)
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if not n:
        return none
    clean, start, end = _clean(words)
    owner = words.owner
    single, mark = words.end - words.start == 1, words.data[words.start]
    run, head, size, spaced = _runs(single & ~_MARK[mark], owner)
    in_run = spaced[run]
    plain = np.flatnonzero(clean & ~in_run)
    hashes, texts = _word_and_stem(words.data, start[plain], end[plain], owner[plain])
    noisy = np.flatnonzero(~clean & ~in_run & (end > start))
    runs = np.flatnonzero(spaced)
    both = np.flatnonzero(clean & (_doubled(words.data, start, end) | _signed(words)))
    _, wide, width, spaced = _runs(single & (~_MARK | _SIGN)[mark], owner)
    signs = np.add.reduceat(single & _SIGN[mark], wide)
    wide, width = wide[spaced & (signs > 0)], width[spaced & (signs > 0)]
    # Marks at the end may stand for letters too: decode the token as written.
    first = np.concatenate([noisy, head[runs], wide, both])
    last = np.concatenate([noisy, head[runs] + size[runs] - 1, wide + width - 1, both])
    begin, stop, of = words.start[first], words.end[last], owner[first]
    if len(begin):
        raw = words.data.tobytes()
        tokens = [b" ".join(raw[b:e].split()) for b, e in zip(begin.tolist(), stop.tolist())]
        distinct = sorted(set(tokens))
        number = {t: k for k, t in enumerate(distinct)}
        readings = decode(distinct, transitions)
        which = np.array([number[t] for t in tokens])
        joined = split_words(pa.array([r.decode("utf-8", "ignore") for r in readings]), SPACE)
        many = joined.counts[which]
        # The plain reading of a word counts once.
        same = np.array([r == t.strip(MARKS) for r, t in zip(readings, distinct)])
        many[len(many) - len(both):][same[which[len(many) - len(both):]]] = 0
        at = ranges(joined.first[:-1][which], many)
        new, new_texts = _word_and_stem(joined.data, joined.start, joined.end,
                                        np.arange(len(joined)), keep=True)
        hashes = np.concatenate([hashes, new[0][at], new[1][at]])
        texts = np.concatenate([texts, np.repeat(of, many), np.repeat(of, many)])
    return hashes, texts


def _runs(single, owner):
    """Runs of words alike in ``single`` within a text: each word's run, each run's first word and
    size, and whether it is three or more of the single ones."""
    edge = np.concatenate([[True], (single[1:] != single[:-1]) | (owner[1:] != owner[:-1])])
    head = np.flatnonzero(edge)
    size = np.diff(np.append(head, len(single)))
    return np.cumsum(edge) - 1, head, size, single[head] & (size >= 3)


def _doubled(data, start, end):
    """Which spans, none of them empty, hold a letter twice in a row."""
    twice = np.zeros(len(data) + 1, np.int64)
    twice[2:] = np.cumsum((data[1:] == data[:-1]) & (data[1:] < 0x80) & _LETTER[data[1:]])
    return twice[end] > twice[start + 1]


def _signed(words):
    """Which words hold a mark that may stand for a letter."""
    signs = np.concatenate([[0], np.cumsum(_SIGN[words.data])])
    return signs[words.end] > signs[words.start]


def _word_and_stem(data, start, end, owner, keep=False):
    word = hash_spans(data, start, end)
    stem = mix(hash_spans(data, start, np.minimum(end, start + PREFIX)), salt=1)
    if keep:
        return (word, stem), owner
    long = end - start > PREFIX
    return np.concatenate([word, stem[long]]), np.concatenate([owner, owner[long]])


@dataclass
class Scorer:
    transitions: np.ndarray
    entries: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))   # sorted hashes
    toxic: np.ndarray = field(default_factory=lambda: np.zeros(0))      # toxic texts with the entry
    clean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    n_toxic: float = 0.0
    n_clean: float = 0.0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(4))

    def evidence(self, toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
        """Lower confidence bound of each entry's log odds ratio."""
        t, c = np.maximum(toxic, 0) + 0.5, np.maximum(clean, 0) + 0.5
        ratio = np.log(t / (self.n_toxic + 1)) - np.log(c / (self.n_clean + 1))
        return np.maximum(0, ratio - 1.64 * np.sqrt(1 / t + 1 / c))

    def inputs(self, hashes, texts, n: int, label: np.ndarray | None = None) -> np.ndarray:
        """Per text: 1, the strongest evidence, the log of its sum, and the sum per root of length.

        With labels, each text's own share in the counts is left out.
        """
        out = np.zeros((n, 4))
        out[:, 0] = 1
        if not len(hashes) or not len(self.entries):
            return out
        length = np.bincount(texts, minlength=n)
        at = np.minimum(np.searchsorted(self.entries, hashes), len(self.entries) - 1)
        known = self.entries[at] == hashes
        pairs = np.unique(texts[known] * len(self.entries) + at[known])
        text, entry = pairs // len(self.entries), pairs % len(self.entries)
        toxic, clean = self.toxic[entry], self.clean[entry]
        if label is not None:
            toxic, clean = toxic - label[text], clean - (1 - label[text])
        value = self.evidence(toxic, clean)
        np.maximum.at(out[:, 1], text, value)
        total = np.bincount(text, value, n)
        out[:, 2], out[:, 3] = np.log1p(total), total / np.sqrt(10 + length)
        return out

    def score(self, inputs: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(inputs @ self.weights).clip(-30, 30)))


def train_scorer(docs: DataFrame, labels: DataFrame, label: str = "toxic", held_out: int = 0,
                 limit: int = FIT_DOCUMENTS) -> Scorer:
    """Learn the character model from all texts, and the lexicon and weights from labelled ones.

    The lexicon holds the words and stems that more toxic than clean texts share, counted over at
    most ``limit`` restored labelled texts outside the held-out fold, copies once. Weights of the
    four inputs are fitted to the same texts, with each one's own share left out of the counts.
    """
    spark = docs.sparkSession
    transitions = train_characters(docs)
    shared = spark.sparkContext.broadcast(transitions)

    def features(batches):
        for batch in slices(batches, "text", CHUNK_BYTES):
            hashes, texts = restored_features(batch.column("text"), shared.value)
            pairs = np.unique(np.rec.fromarrays([texts, hashes]))
            label = batch.column("label").to_numpy()
            yield pa.RecordBatch.from_arrays([
                pa.array(pairs.f1.view(np.int64)), pa.array(label[pairs.f0]),
            ], ["entry", "label"])

    sample = labelled_sample(docs, labels, label, limit, held_out)
    sample = sample.groupBy("text").agg(F.max("label").alias("label"))
    counted = (sample.select("label", "text").mapInArrow(features, "entry bigint, label int")
               .groupBy("entry").agg(F.sum("label").alias("toxic"),
                                     F.sum(1 - F.col("label")).alias("clean")))
    sizes = sample.agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c")).first()
    scorer = Scorer(transitions, n_toxic=float(sizes["t"] or 0), n_clean=float(sizes["c"] or 0))
    t, c = F.col("toxic") + 0.5, F.col("clean") + 0.5
    bound = (F.log(t / (scorer.n_toxic + 1)) - F.log(c / (scorer.n_clean + 1))
             - 1.64 * F.sqrt(1 / t + 1 / c))
    rows = (counted.where("toxic >= 2").withColumn("bound", bound).where("bound > 0")
            .collect())                        # words of at most ``limit`` texts
    entries = np.array([row["entry"] for row in rows], np.int64).view(np.uint64)
    order = np.argsort(entries)
    scorer.entries = entries[order]
    scorer.toxic = np.array([float(row["toxic"]) for row in rows])[order]
    scorer.clean = np.array([float(row["clean"]) for row in rows])[order]
    model = spark.sparkContext.broadcast(scorer)

    def inputs(batches):
        for batch in slices(batches, "text", CHUNK_BYTES):
            label = batch.column("label").to_numpy().astype(float)
            found = model.value.inputs(*restored_features(
                batch.column("text"), model.value.transitions), batch.num_rows, label)
            yield pa.RecordBatch.from_arrays(
                [pa.array(label), *[pa.array(found[:, k]) for k in range(4)]],
                ["label", "a", "b", "c", "d"])

    table = np.array(sorted(tuple(r) for r in sample.select("label", "text").mapInArrow(
        inputs, "label double, a double, b double, c double, d double").toLocalIterator()))
    scorer.weights = _logistic(table[:, 1:], table[:, 0]) if len(table) else np.array(
        [-5.0, 0.0, 0.0, 0.0])
    return scorer


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the constant is not shrunk."""
    w = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge)
    shrink[0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w).clip(-30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(shrink),
                               x.T @ (y - p) - shrink * w)
        w = w + step.clip(-2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def score_documents(docs: DataFrame, scorer: Scorer, output: str = "score") -> DataFrame:
    """``docs`` with the toxicity of every whole text, 0 to 1, as column ``output``.

    A null or wordless text has no evidence and takes the score of the constant alone; without labels
    every text does, and none is called toxic. Repeated rows score alike. Other columns pass through;
    a column named like the output is replaced; an empty table gives no rows.
    """
    kept = docs.select(*[c for c in docs.columns if c != output])
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def score(batches):
        for batch in slices(batches, "text", CHUNK_BYTES):
            model = shared.value
            found = model.inputs(*restored_features(batch.column("text"), model.transitions),
                                 batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(found))],
                                             [*batch.schema.names, output])

    return kept.mapInArrow(
        score, StructType([*kept.schema.fields, StructField(output, DoubleType())]))


def op4_noisy_channel(spark, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The toxicity of all documents; odd rows as in ``score_documents``. A null id is in no fold."""
    scored = score_documents(docs.select("doc_id", "text"), train_scorer(docs, labels))
    return scored.select("doc_id", in_fold(F.col("doc_id"), 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
