"""Document likelihood from a subword lattice.

A text is its words and one end. Every word is read along all paths of a lattice: as a whole word of a
class's vocabulary, as a whole word of the corpus, or as any segmentation into the pieces of an
existing subword vocabulary. The classes (languages, say) are a hidden choice per document and are
summed out as well, so that the score is the log of the text's marginal probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationcast.llm.lattice import Lattice, Vocabulary, load_vocabulary
from stationcast.llm.store import in_fold, stored
from stationcast.llm.text import FOLD, SPACE, slices, span_strings, split_words, text_bytes

#: The public vocabulary file of the query; read by the driver alone.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
BLOCK_BYTES = 8 << 20
LATTICE_BYTES = 1 << 18
END = ""            # no word is empty

BLOCK = ("block bigint, ids array<bigint>, held array<boolean>, words array<string>, "
         "trained binary, first array<int>, pairs binary")


@dataclass
class Model:
    vocabulary: Vocabulary
    score: np.ndarray         # log probability of each piece
    tokens: np.ndarray        # per class, then in all: training tokens, ends included
    types: np.ndarray         # the same for distinct tokens
    documents: np.ndarray     # training documents per class
    discount: float

    def class_scores(self, counts: np.ndarray, lattice: np.ndarray) -> np.ndarray:
        """Log probability of each token in each class.

        ``counts``: training count per token and class; ``lattice``: log probability by pieces. A
        whole-word arc keeps its count less the discount; what the discounts free goes to the
        corpus's words, and theirs to the pieces.
        """
        total, d = counts.sum(axis=1), self.discount
        if not self.tokens[-1]:
            # Nothing was learnt: an end is as likely as any other token.
            flat = np.log(0.5) + np.where(np.isneginf(lattice), 0.0, lattice)
            return np.repeat(flat[:, None], counts.shape[1], axis=1)
        with np.errstate(divide="ignore"):
            corpus = np.logaddexp(np.log(np.maximum(total - d, 0)),
                                  np.log(d * self.types[-1]) + lattice) - np.log(self.tokens[-1])
            own = np.logaddexp(np.log(np.maximum(counts - d, 0)),
                               np.log(d * self.types[:-1]) + corpus[:, None])
            used = self.tokens[:-1] > 0
            return np.where(used, own - np.log(np.maximum(1, self.tokens[:-1])), corpus[:, None])


def word_blocks(docs: DataFrame, train: Column, group: Column, groups: int) -> DataFrame:
    """The documents in blocks of some 8 MB of whole texts, a row each, stored.

    A block lists its distinct words, how often each occurs in training texts of every class, and in
    which of its documents, how often. The end is a token of every document and the last word.
    """
    def build(batches):
        block = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text", BLOCK_BYTES):
            yield _block(batch, block, groups)
            block += 1

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                       train.alias("train"), (~train).alias("held"),
                       group.cast("int").alias("class"))
    # Few blocks to a file: a reader holds a file's rows at once.
    return stored(rows.mapInArrow(build, BLOCK), "blocks", maxRecordsPerFile=4)


def _block(batch: pa.RecordBatch, block: int, groups: int) -> pa.RecordBatch:
    """The row of one block. A function of its own: nothing of a block is held while the next is made."""
    words = split_words(batch.column("text"), SPACE, FOLD)
    n = batch.num_rows
    by_word = words.hashes()
    order = np.argsort(by_word, kind="stable")              # by word, then by document
    by_word = by_word[order]
    new_word = np.ones(len(order), bool)
    new_word[1:] = by_word[1:] != by_word[:-1]
    del by_word
    owner = words.owner.astype(np.int32)[order]
    new_pair = new_word.copy()
    new_pair[1:] |= owner[1:] != owner[:-1]
    pair = np.flatnonzero(new_pair)
    owner = owner[pair]
    counts = np.diff(np.append(pair, len(order)))
    heads = np.flatnonzero(new_word)
    first = np.concatenate([np.searchsorted(pair, heads), [len(pair), len(pair) + n]])
    word_no = np.cumsum(new_word, dtype=np.int32)[pair] - 1
    at = order[heads]
    del order, new_word, new_pair, pair
    names = pa.concat_arrays([span_strings(words.data, words.start[at], words.end[at]),
                              pa.array([END])])
    del words
    kept = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
    kind = batch.column("class").to_numpy(zero_copy_only=False).astype(np.int64)
    trained = np.zeros((len(heads) + 1, groups), np.int32)
    seen = kept[owner]
    np.add.at(trained, (word_no[seen], kind[owner[seen]]), counts[seen])
    np.add.at(trained[-1], kind[kept], 1)

    def row(values):
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    return pa.RecordBatch.from_arrays([
        pa.array([block], pa.int64()), row(batch.column("doc_id")),
        row(batch.column("held")), row(names), pa.array([trained.tobytes()], pa.binary()),
        row(pa.array(first, pa.int32())),
        pa.array([_packed(np.concatenate([owner, np.arange(n)]),
                          np.concatenate([counts, np.ones(n, np.int64)]))], pa.binary()),
    ], ["block", "ids", "held", "words", "trained", "first", "pairs"])


def _packed(docs: np.ndarray, counts: np.ndarray) -> bytes:
    """Documents (as steps, which are small) and counts, compressed: the bulk of a block."""
    steps = np.diff(docs, prepend=0)
    return pa.compress(np.concatenate([steps, counts]).astype(np.int32).tobytes(), "zstd",
                       asbytes=True)


def _unpacked(pairs: pa.Scalar, n: int) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(pa.decompress(pairs.as_buffer(), 8 * n, "zstd"), np.int32)
    return np.cumsum(both[:n], dtype=np.int64), both[n:].astype(float)


def block_words(blocks: DataFrame, count: list[str]) -> DataFrame:
    """One row per block and word: word, block, place in the block, training counts."""
    def flatten(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                words = batch.column("words")[k].values
                trained = np.frombuffer(batch.column("trained")[k].as_buffer(), np.int32).reshape(
                    len(words), -1)
                yield pa.RecordBatch.from_arrays([
                    words, pa.array(np.full(len(words), batch.column("block")[k].as_py())),
                    pa.array(np.arange(len(words), dtype=np.int32)),
                    *[pa.array(np.ascontiguousarray(c)) for c in trained.T],
                ], ["word", "block", "place", *count])

    return blocks.select("block", "words", "trained").mapInArrow(flatten, ", ".join(
        ["word string, block bigint, place int", *[f"{c} int" for c in count]]))


def _lattices(batch: pa.RecordBatch, vocabulary: Vocabulary):
    """Lattices of the words of a batch, some at a time, and which words each holds."""
    data, offsets = text_bytes(batch.column("word"))
    k = 0
    while k < batch.num_rows:
        j = int(np.searchsorted(offsets, offsets[k] + LATTICE_BYTES, side="right")) - 1
        j = min(batch.num_rows, max(k + 1, j))
        yield slice(k, j), Lattice(vocabulary, data, offsets[k:j], offsets[k + 1:j + 1])
        k = j


def fit_pieces(words: DataFrame, vocabulary: Vocabulary, rounds: int = 2,
               strength: float = 100.0) -> np.ndarray:
    """Log probabilities of the pieces by expectation maximisation over all distinct words.

    The file's scores are the start and, with weight ``strength``, the prior. Each distinct word
    counts once, because the pieces stand in for words that were not seen. A round is one pass; the
    sums that reach the driver have one row per piece of the vocabulary.
    """
    spark, n = words.sparkSession, len(vocabulary.pieces)
    score = np.log(vocabulary.prior)
    lattice = spark.sparkContext.broadcast(vocabulary)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(score)

        def expect(batches):
            used = np.zeros(n)
            for batch in batches:
                for part, paths in _lattices(batch, lattice.value):
                    used += paths.expected(shared.value, np.ones(part.stop - part.start), n)
            some = np.flatnonzero(used > 0)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(used[some])],
                                             ["piece", "used"])

        used = strength * vocabulary.prior
        for row in (words.where(F.col("word") != END).select("word")
                    .mapInArrow(expect, "piece bigint, used double")
                    .groupBy("piece").agg(F.sum("used").alias("used")).collect()):
            used[row["piece"]] += row["used"]
        score = np.log(used / used.sum())
    return score


def score_documents(docs: DataFrame, train: Column | None = None, group: Column | None = None,
                    vocabulary: str = VOCABULARY, scores: str = "ranks",
                    max_groups: int = 8) -> DataFrame:
    """Fit the lattice on the rows where ``train`` holds and score every row of ``docs``.

    Words are the runs of bytes between ASCII white space, A-Z in lower case. ``group`` names each
    training row's class; the ``max_groups`` - 1 most frequent ones are told apart and the others
    form one. A row's own class is not used to score it.

    Returns doc_id, held_out, n_tokens (with the end), n_known, train_tokens, base_score (whole
    words alone, half a count added to each and to one unknown word) and score, both log10. A null
    or empty text is its end. Repeated rows are scored one by one; a null id stays null and a null
    class is one of its own; without training rows only the pieces' prior scores count.
    """
    spark = docs.sparkSession
    train = F.lit(True) if train is None else train
    group = F.lit("") if group is None else F.coalesce(group.cast("string"), F.lit("null"))
    common = [row["g"] for row in docs.where(train).groupBy(group.alias("g")).count()
              .orderBy(F.desc("count"), "g").limit(max_groups - 1).collect()]
    groups = len(common) + 1
    number = F.lit(groups - 1)
    for k, name in enumerate(common):
        number = F.when(group == name, k).otherwise(number)
    blocks = word_blocks(docs, train, number, groups)

    count = [f"c{k}" for k in range(groups)]
    words = block_words(blocks, count)
    types = stored(words.groupBy("word").agg(*[F.sum(c).alias(c) for c in count]), "types")
    total = sum((F.col(c) for c in count[1:]), F.col(count[0]))
    stats = types.agg(
        *[F.sum(c).alias(f"n_{c}") for c in count], F.count_if(total > 0).alias("v_all"),
        *[F.count_if(F.col(c) > 0).alias(f"v_{c}") for c in count],
        F.count_if(total == 1).alias("once"), F.count_if(total == 2).alias("twice"),
        *[F.sum(F.when(F.col("word") == END, F.col(c))).alias(f"d_{c}") for c in count]).first()
    tokens = np.array([stats[f"n_{c}"] or 0 for c in count])
    # The usual estimate of an absolute discount, from the words seen once and twice.
    discount = (stats["once"] + 1) / (stats["once"] + 2 * stats["twice"] + 2)
    pieces = load_vocabulary(vocabulary, scores)
    model = Model(pieces, fit_pieces(types.where(total > 0), pieces),
                  np.append(tokens, tokens.sum()),
                  np.array([stats[f"v_{c}"] for c in count] + [stats["v_all"]]),
                  np.array([stats[f"d_{c}"] or 0 for c in count]), min(0.95, max(0.1, discount)))
    shared = spark.sparkContext.broadcast(model)

    def spell(batches):
        for batch in batches:
            value = np.zeros(batch.num_rows)
            for part, paths in _lattices(batch, shared.value.vocabulary):
                value[part] = paths.log_probability(shared.value.score)
            # The end is not spelled.
            value[np.diff(text_bytes(batch.column("word"))[1]) == 0] = -np.inf
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value.astype(np.float32))],
                                             [*batch.schema.names, "lattice"])

    spelled = types.mapInArrow(spell, ", ".join(
        ["word string", *[f"{c} bigint" for c in count], "lattice float"]))
    # Only words travel to their counts and back; which documents have them stays in the blocks.
    found = words.select("word", "block", "place").join(spelled, "word").drop("word")

    def add(left, right):
        return _score_block(shared.value, left, right, count)

    return blocks.drop("words", "trained").groupBy("block").cogroup(
        found.groupBy("block")).applyInArrow(
        add, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
             "train_tokens bigint, base_score double, score double")


def _score_block(model: Model, block: pa.Table, found: pa.Table, count: list[str]) -> pa.Table:
    def flat(name):
        return block.column(name).combine_chunks().flatten()

    ids, held, first = flat("ids"), flat("held"), flat("first").to_numpy()
    docs, times = _unpacked(block.column("pairs")[0], int(first[-1]))
    n = len(ids)
    order = np.argsort(found.column("place").to_numpy(), kind="stable")
    counts = np.column_stack([found.column(c).to_numpy() for c in count])[order].astype(float)
    lattice = found.column("lattice").to_numpy()[order].astype(float)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    total, all_tokens = counts.sum(axis=1), model.tokens[-1]
    base = np.log10((total + 0.5) / (all_tokens + 0.5 * (model.types[-1] + 1)))
    by_class = model.class_scores(counts, lattice)
    scores = np.column_stack([np.bincount(docs, times * by_class[row, k], n)
                              for k in range(len(count))])
    with np.errstate(divide="ignore"):
        prior = np.log(model.documents / max(1, model.documents.sum()))
    if not model.documents.any():
        prior = np.full(len(count), -np.log(len(count)))
    scores = np.logaddexp.reduce(scores + prior, axis=1) / np.log(10)
    return pa.table({
        "doc_id": ids, "held_out": held,
        "n_tokens": pa.array(np.bincount(docs, times, n).astype(np.int64)),
        "n_known": pa.array(np.bincount(docs, times * (total[row] > 0), n).astype(np.int64)),
        "train_tokens": pa.array(np.full(n, all_tokens, np.int64)),
        "base_score": pa.array(np.bincount(docs, times * base[row], n)),
        "score": pa.array(scores)})


def op1_subword_lattice(spark, docs: DataFrame) -> DataFrame:
    """The likelihood of all documents, learnt outside one fold; odd rows as in ``score_documents``. A null
    id is in no fold, so it is learnt from."""
    return score_documents(docs, ~in_fold(F.col("doc_id"), 1), F.col("lang"))
