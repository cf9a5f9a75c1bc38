"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stationcast.llm.store import in_fold, unused_name
from stationcast.llm.text import SPACE, slices, split_words, text_bytes

CHUNK_BYTES = 2 << 20
#: Labelled documents the field is fitted on, those with the smallest hash of the id.
FIT_DOCUMENTS = 4000

_KIND = np.zeros(256, np.int64)     # 0 other, 1 upper case, 2 lower case, 3 digit, 4 symbol, 5 shout
_KIND[0x41:0x5B], _KIND[0x61:0x7B], _KIND[0x30:0x3A], _KIND[0x80:] = 1, 2, 3, 2
for _c in b"#$%&*+/<=>@[\\]^_`{|}~":
    _KIND[_c] = 4
_KIND[ord("!")] = 5
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".?:;"]] = True


@dataclass
class Lines:
    """Lines with words, in order, of some texts."""

    features: np.ndarray    # one row per line
    weight: np.ndarray      # bytes of the line
    first: np.ndarray       # index of each text's first line, one more at the end


def line_features(column: pa.Array) -> Lines:
    """Features of every line that has a word: its own, then those of both neighbours."""
    data, texts = text_bytes(column)
    words = split_words(column, SPACE)
    n_texts = len(texts) - 1
    if not len(words):
        return Lines(np.zeros((0, 3 * OWN + 2)), np.zeros(0), np.zeros(n_texts + 1, np.int64))
    # A line starts at a text's first word and at the first word after a line feed.
    feeds = np.concatenate([[0], np.cumsum(data == 0x0A)])
    line_of = feeds[words.start]
    fresh = np.ones(len(words), bool)
    fresh[1:] = (np.diff(line_of) > 0) | (np.diff(words.owner) > 0)
    head = np.flatnonzero(fresh)
    n_lines = len(head)
    line = np.cumsum(fresh) - 1
    tail = np.append(head[1:], len(words)) - 1
    begin, stop = words.start[head], words.end[tail]

    def total(flags):
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[stop] - sums[begin]

    kind = _KIND[data]
    upper, lower, digit, symbol, shout = (total(kind == k) for k in range(1, 6))
    n_words = tail - head + 1
    length = words.end - words.start
    letters = np.bincount(line, length, n_lines)
    hashes = words.hashes()

    def repeats(back):
        same = np.zeros(len(words), bool)
        same[back:] = (hashes[back:] == hashes[:-back]) & (line[back:] == line[:-back])
        return np.bincount(line, same, n_lines) / n_words

    bare = total(kind == 0) - (stop - begin - letters)   # punctuation, control characters
    own = np.column_stack([
        np.log1p(n_words), np.log(letters / n_words), symbol / letters, shout / letters,
        upper / np.maximum(1, upper + lower), digit / letters, bare / letters,
        repeats(1), np.maximum(repeats(2), repeats(3)),
        np.log(np.maximum.reduceat(length, head)), _END[data[stop - 1]],
    ])
    first = np.searchsorted(words.owner[head], np.arange(n_texts + 1))
    edge = np.zeros((n_lines, 2))
    edge[first[:-1][np.diff(first) > 0], 0] = 1
    edge[first[1:][np.diff(first) > 0] - 1, 1] = 1
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[edge[:, 0] == 1] = 0
    after[edge[:, 1] == 1] = 0
    return Lines(np.hstack([own, before, after, edge]), (stop - begin).astype(float), first)


OWN = 11


@dataclass
class Field:
    """Weights of the field: a score for label 1 per line and for each pair of neighbour labels."""

    mean: np.ndarray
    scale: np.ndarray
    emission: np.ndarray
    bias: float
    transition: np.ndarray
    prior: float

    def unary(self, features: np.ndarray) -> np.ndarray:
        return ((features - self.mean) / self.scale).clip(-8, 8) @ self.emission + self.bias


def marginals(unary: np.ndarray, first: np.ndarray, transition: np.ndarray):
    """Forward-backward over all texts at once, one line position at a time.

    Returns P(label 1) per line, P(labels i, j) per pair of neighbours, indexed by its second line,
    and the log partition function per text.
    """
    n = np.diff(first)
    score = np.column_stack([np.zeros(len(unary)), unary])
    alpha, beta = score.copy(), np.zeros_like(score)
    order = np.argsort(-n, kind="stable")
    longest = np.searchsorted(-n[order], -np.arange(1, (n.max() if len(n) else 0) + 1),
                              side="right")   # texts with at least k lines
    for k in range(1, len(longest)):
        at = first[order[:longest[k]]] + k
        alpha[at] += np.logaddexp.reduce(alpha[at - 1][:, :, None] + transition, axis=1)
    for k in range(len(longest) - 1, 0, -1):
        at = first[order[:longest[k]]] + k
        beta[at - 1] = np.logaddexp.reduce(transition + (score[at] + beta[at])[:, None, :], axis=2)
    some = n > 0
    z = np.zeros(len(n))
    z[some] = np.logaddexp.reduce(alpha[first[1:][some] - 1], axis=1)
    per_line = np.repeat(z, n)
    good = np.exp(alpha[:, 1] + beta[:, 1] - per_line)
    inner = np.ones(len(unary), bool)
    inner[first[:-1][some]] = False
    at = np.flatnonzero(inner)
    pair = np.zeros((len(unary), 2, 2))
    pair[at] = np.exp(alpha[at - 1][:, :, None] + transition + (score[at] + beta[at])[:, None, :]
                      - per_line[at][:, None, None])
    return good, pair, z


def text_scores(lines: Lines, field: Field) -> np.ndarray:
    """Share of a text's bytes in good lines, by marginals; the prior for a text without words."""
    if not len(lines.weight):
        return np.full(len(lines.first) - 1, field.prior)
    good, _, _ = marginals(field.unary(lines.features), lines.first, field.transition)
    text = np.repeat(np.arange(len(lines.first) - 1), np.diff(lines.first))
    n = len(lines.first) - 1
    total = np.bincount(text, lines.weight, n)
    share = np.bincount(text, lines.weight * good, n) / np.maximum(total, 1e-300)
    return np.where(total > 0, share, field.prior).clip(0, 1)


def fit_field(lines: Lines, labels: np.ndarray, rounds: int = 3, steps: int = 120,
              ridge: float = 1e-3) -> Field:
    """Fit by gradient ascent on the labelled lines' likelihood.

    Lines begin with their document's label. After each round, lines of bad documents that the field
    calls good with the rest of the document known to be bad are relabelled, but the worse half of a
    bad document (by bytes) stays bad.
    """
    n = np.diff(lines.first)
    text = np.repeat(np.arange(len(n)), n)
    x = lines.features
    mean, scale = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (
        np.zeros(3 * OWN + 2), np.ones(3 * OWN + 2))
    prior = float(labels.mean()) if len(labels) else 0.5
    field = Field(mean, scale, np.zeros(x.shape[1]), 0.0, np.zeros((2, 2)), prior)
    if len(set(labels.tolist())) < 2 or not len(x):
        field.bias = 8.0 * (prior - 0.5)     # one label only, or none: nothing to tell lines by
        return field
    z = ((x - mean) / scale).clip(-8, 8)
    y = labels[text].astype(int)
    # Each document counts alike, and both labels alike.
    share = np.where(labels == 1, 0.5 / max(prior, 1e-9), 0.5 / max(1 - prior, 1e-9)) / len(labels)
    per_line = (share / np.maximum(n, 1))[text]
    inner = np.ones(len(x), bool)
    inner[lines.first[:-1][n > 0]] = False
    at = np.flatnonzero(inner)
    size = x.shape[1]
    theta, m, v = np.zeros(size + 5), np.zeros(size + 5), np.zeros(size + 5)
    step = 0
    for round_ in range(rounds):
        for _ in range(steps):
            step += 1
            field.emission, field.bias = theta[:size], theta[size]
            field.transition = theta[size + 1:].reshape(2, 2)
            good, pair, _ = marginals(z @ field.emission + field.bias, lines.first,
                                      field.transition)
            miss = (y - good) * per_line
            seen = np.zeros((2, 2))
            np.add.at(seen, (y[at - 1], y[at]), per_line[at])
            gradient = np.concatenate([
                miss @ z, [miss.sum()],
                (seen - (pair[at] * per_line[at, None, None]).sum(axis=0)).ravel()])
            gradient -= ridge * theta
            m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient ** 2
            theta = theta + 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        good, _, _ = marginals(z @ theta[:size] + theta[size], lines.first,
                               theta[size + 1:].reshape(2, 2))
        # Bytes of worse lines in the same text, this one's half included.
        order = np.lexsort((good, text))
        sums = np.cumsum(lines.weight[order])
        base = np.concatenate([[0], sums])[lines.first[:-1]][text]
        middle = np.empty(len(x))
        middle[order] = sums - lines.weight[order] / 2
        total = np.bincount(text, lines.weight, len(n))[text]
        best_half = (middle - base) > 0.5 * total
        y = np.where(labels[text] == 1, 1, ((good > 0.9) & best_half).astype(int))
    return field


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int,
                    held_out: int = 0) -> DataFrame:
    """At most ``limit`` labelled documents outside the held-out fold: doc_id, text, label.

    Those with the smallest hash of the id, so that the sample is spread and repeatable. It is
    bounded, so it is broadcast to the documents. An id labelled twice takes the smaller label.
    """
    value = F.col(label).cast("int")
    chosen = (labels.where(value.isin(0, 1) & F.col("doc_id").isNotNull()
                           & ~in_fold(F.col("doc_id"), held_out))
              .groupBy("doc_id").agg(F.min(value).alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where(
        "text IS NOT NULL")


def train_field(docs: DataFrame, labels: DataFrame, label: str = "quality", held_out: int = 0,
                limit: int = FIT_DOCUMENTS) -> Field:
    """Fit the field on line features of at most ``limit`` labelled documents.

    The features are made where the texts lie; lines of the sample come to the driver in single
    precision. Copies of a text count once.
    """
    def features(batches):
        for batch in slices(batches, "text", CHUNK_BYTES):
            lines = line_features(batch.column("text"))
            rows = np.hstack([lines.features, lines.weight[:, None]]).astype(np.float32)
            for k, label in enumerate(batch.column("label").to_pylist()):
                part = rows[lines.first[k]:lines.first[k + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label], pa.int32()), pa.array([part.tobytes()], pa.binary())],
                    ["label", "lines"])

    sample = labelled_sample(docs, labels, label, limit, held_out)
    sample = sample.groupBy("text").agg(F.min("label").alias("label"))
    rows = sorted((bytes(r["lines"]), r["label"]) for r in sample.select("label", "text")
                  .mapInArrow(features, "label int, lines binary").toLocalIterator())
    parts = [np.frombuffer(b, np.float32).reshape(-1, 3 * OWN + 3).astype(float) for b, _ in rows]
    stacked = np.vstack([np.zeros((0, 3 * OWN + 3)), *parts])
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return fit_field(Lines(stacked[:, :-1], stacked[:, -1], first),
                     np.array([label for _, label in rows], float))


def score_documents(docs: DataFrame, field: Field, output: str = "score") -> DataFrame:
    """``docs`` with the quality of every whole text, 0 to 1, as column ``output``.

    A null or wordless text takes the share of good documents in the sample, a half if it is empty.
    Without labels every text scores a half. Repeated rows score alike. Other columns pass
    through; a column named like the output is replaced; an empty table gives no rows.
    """
    kept = docs.select(*[c for c in docs.columns if c != output])
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def score(batches):
        for batch in slices(batches, "text", CHUNK_BYTES):
            values = text_scores(line_features(batch.column("text")), shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)],
                                             [*batch.schema.names, output])

    return kept.mapInArrow(
        score, StructType([*kept.schema.fields, StructField(output, DoubleType())]))


def keep_good(docs: DataFrame, labels: DataFrame, at_least: float = 0.3) -> DataFrame:
    """The documents whose quality reaches ``at_least``, same columns.

    A null or wordless text takes the share of good documents in the sample, and every text a half
    without labels, so that they stay. Repeated rows share their fate; a null id has no label; an empty
    table gives no rows.
    """
    name = unused_name(docs, "quality")
    scored = score_documents(docs, train_field(docs, labels), name)
    return scored.where(F.col(name) >= at_least).select(*docs.columns)


def op2_line_field(spark, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The quality of all documents; odd rows as in ``score_documents``. A null id is in no fold."""
    field = train_field(docs, labels)
    scored = score_documents(docs.select("doc_id", "text"), field)
    return scored.select("doc_id", in_fold(F.col("doc_id"), 0).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))
