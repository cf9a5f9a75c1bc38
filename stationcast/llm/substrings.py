"""Repeated passages found by recompression.

Every text is a sequence of word symbols that shrinks in rounds. A round names maximal runs of one
symbol, or pairs of neighbours of which a coin tossed on the left one's name says left and the right
one's says right. Names are hashes of what they stand for, so equal substrings get the same names
inside wherever they lie, in any task, without asking anyone. Only near its edges does a substring's
parse depend on what surrounds it, and each symbol carries the exact range of words it depends on.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.llm.text import SPACE, _powers, mix, ranges, split_words
from stationcast.session import scratch_path

WINDOW = 35
#: "run" or "pair"; the last round's symbols are the first choice for looking up a window.
ROUNDS = ("run", "pair", "pair", "run", "pair", "pair", "pair", "pair")
BLOCK_BYTES = 5 << 19
_BASES = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class Level:
    """Symbols of one round: first word, name, and the range of words that decided them."""

    def __init__(self, start, name, low, high):
        self.start, self.name, self.low, self.high = start, name, low, high


def parse(names: np.ndarray, first: np.ndarray, rounds=ROUNDS) -> list[Level]:
    """All rounds over some texts; ``first`` has the index of each text's first word, and the end."""
    n = len(names)
    at = np.arange(n)
    levels = [Level(at, mix(names), at, at + 1)]
    for number, kind in enumerate(rounds):
        last = levels[-1]
        levels.append(_round(last, first, kind, number))
    return levels


def _round(level: Level, first: np.ndarray, kind: str, number: int) -> Level:
    name, low, high, start = level.name, level.low, level.high, level.start
    n = len(name)
    if not n:
        return level
    text = np.searchsorted(first, start, side="right") - 1
    opens = np.ones(n, bool)
    opens[1:] = text[1:] != text[:-1]
    closes = np.append(opens[1:], True)
    # What lies beside a symbol decided it too. Beyond a text's edge lies something that no window
    # can hold, so such a symbol can vouch for no window.
    left_low = np.where(opens, first[text] - 1, np.roll(low, 1))
    left_high = np.where(opens, high, np.roll(high, 1))
    right_low = np.where(closes, low, np.roll(low, -1))
    right_high = np.where(closes, first[text + 1] + 1, np.roll(high, -1))
    if kind == "run":
        head = opens.copy()
        head[1:] |= name[1:] != name[:-1]
        heads = np.flatnonzero(head)
        tails = np.append(heads[1:], n) - 1
        length = tails - heads + 1
        run = mix(name[heads] ^ mix(length.astype(np.uint64), 11), 13)
        return Level(
            start[heads], np.where(length > 1, run, name[heads]),
            np.minimum(np.minimum.reduceat(low, heads),
                       np.minimum(left_low[heads], right_low[tails])),
            np.maximum(np.maximum.reduceat(high, heads),
                       np.maximum(left_high[heads], right_high[tails])))
    left = (mix(name, 100 + number) >> np.uint64(63)) == 0
    pair = np.zeros(n, bool)
    pair[:-1] = left[:-1] & ~left[1:] & ~closes[:-1]
    second = np.zeros(n, bool)
    second[1:] = pair[:-1]
    # A left symbol that stays single does so because of its right neighbour, and the other way.
    alone = ~pair & ~second
    by_right, by_left = alone & left, alone & ~left
    low = np.where(by_right, np.minimum(low, right_low), np.where(
        by_left, np.minimum(low, left_low), low))
    high = np.where(by_right, np.maximum(high, right_high), np.where(
        by_left, np.maximum(high, left_high), high))
    heads = np.flatnonzero(~second)
    joined = pair[heads]
    mate = np.minimum(heads + 1, n - 1)
    return Level(
        start[heads],
        np.where(joined, mix(name[heads] ^ mix(name[mate], 17), 19), name[heads]),
        np.where(joined, np.minimum(low[heads], low[mate]), low[heads]),
        np.where(joined, np.maximum(high[heads], high[mate]), high[heads]))


class Witnesses:
    """The symbols that vouch for each window: at the highest level that has any inside it."""

    def __init__(self, names: np.ndarray, first: np.ndarray, window: int = WINDOW, rounds=ROUNDS):
        n = len(names)
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        self.valid = np.arange(n) + window <= first[owner + 1] if n else np.zeros(0, bool)
        open_ = self.valid.copy()
        self.levels = []                    # (names, from, to, windows decided here)
        for level in reversed(parse(names, first, rounds)):
            text = np.searchsorted(first, level.start, side="right") - 1
            low = np.maximum(level.high - window, first[text])
            high = np.minimum(level.low, first[text + 1] - window)
            inside = (low <= high) & (level.low >= first[text]) & (level.high <= first[text + 1])
            sums = np.concatenate([[0], np.cumsum(open_)])
            k = np.flatnonzero(inside)
            k = k[sums[high[k] + 1] > sums[low[k]]]
            here = _cover(n, low[k], high[k] + 1) & open_
            self.levels.append((level.name[k], low[k], high[k] + 1, here))
            open_ &= ~here

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """Names of all symbols that vouch for a window, and each one's window that starts first."""
        return (np.concatenate([x[0] for x in self.levels]),
                np.concatenate([x[1] for x in self.levels]))

    def candidates(self, repeated: np.ndarray) -> np.ndarray:
        """Windows all of whose witnesses are among the sorted ``repeated`` names."""
        out = np.zeros(len(self.valid), bool)
        for name, low, high, here in self.levels:
            known = _among(name, repeated)
            out |= here & ~_cover(len(out), low[~known], high[~known])
        return out


def _cover(n: int, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, stop, -1)
    return np.cumsum(change)[:n] > 0


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values (one or two columns, as the sorted ``known`` have) are known."""
    if not len(known):
        return np.zeros(len(values), bool)
    if known.ndim == 1:
        at = np.minimum(np.searchsorted(known, values), len(known) - 1)
        return known[at] == values
    # By the first halves; known keys that share one are rare and looked through.
    at = np.searchsorted(known[:, 0], values[:, 0])
    out = np.zeros(len(values), bool)
    live = np.flatnonzero(at < len(known))
    while len(live):
        live = live[known[at[live], 0] == values[live, 0]]
        out[live] |= known[at[live], 1] == values[live, 1]
        at[live] += 1
        live = live[(at[live] < len(known)) & ~out[live]]
    return out


def window_hashes(names: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Two 64-bit hashes of the words of every window, by differences of running sums."""
    n = len(names)
    out = np.zeros((n, 2), np.uint64)
    if n < window:
        return out
    for k, base in enumerate(_BASES):
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        sums = np.concatenate([np.zeros(1, np.uint64),
                               np.cumsum(mix(names, 31 + k) * _powers(base, n))])
        m = n - window + 1
        out[:m, k] = mix((sums[window:] - sums[:m]) * _powers(inverse, m), 41 + k)
    return out


# Between tasks go rows of a block's keys that share a bucket: 16 bytes a key, and whether the block
# itself has it twice.
KEYS = "bucket int, block int, keys binary, twice binary"


def _packed(block: int, keys: np.ndarray, twice: np.ndarray, buckets: int) -> pa.Table:
    """Distinct keys (two columns) of a block as one row per bucket."""
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    keys, twice = keys[order], twice[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    heads = np.flatnonzero(new)
    if len(heads):
        again = np.maximum.reduceat(twice.astype(np.uint8), heads)
        again |= np.diff(np.append(heads, len(keys))) > 1
        keys, twice = keys[heads], again
    bucket = (keys[:, 0] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    keys, twice, bucket = keys[order], twice[order].astype(np.uint8), bucket[order]
    used, begin = np.unique(bucket, return_index=True)
    stop = np.append(begin[1:], len(bucket))
    return pa.table({
        "bucket": pa.array(used.astype(np.int32)),
        "block": pa.array(np.full(len(used), block, np.int32)),
        "keys": pa.array([keys[b:e].tobytes() for b, e in zip(begin, stop)], pa.binary()),
        "twice": pa.array([twice[b:e].tobytes() for b, e in zip(begin, stop)], pa.binary())})


def _repeated(table):
    """Of a bucket's keys those that occur twice in all, for each block that has them."""
    blocks = table.column("block").to_numpy()
    parts = [np.frombuffer(b, np.uint64).reshape(-1, 2) for b in table.column("keys").to_pylist()]
    twice = np.concatenate([np.frombuffer(b, np.uint8) for b in table.column("twice").to_pylist()])
    keys = np.concatenate(parts)
    row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    keys, twice, row = keys[order], twice[order], row[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(keys)))
    often = np.repeat((sizes > 1) | (np.maximum.reduceat(twice, heads) > 0), sizes)
    keys, row = keys[often], row[often]
    order = np.argsort(row, kind="stable")
    keys, row = keys[order], row[order]
    used, begin = np.unique(row, return_index=True)
    stop = np.append(begin[1:], len(row))
    return pa.table({"block": pa.array(blocks[used].astype(np.int32)),
                     "found": pa.array([keys[b:e].tobytes() for b, e in zip(begin, stop)],
                                       pa.binary())})


def _known(table: pa.Table) -> np.ndarray:
    """The keys (two columns) found for a block, in order of their first halves. A key comes from one
    bucket, so once."""
    parts = [np.frombuffer(b, np.uint64).reshape(-1, 2) for b in table.column("found").to_pylist()]
    keys = np.concatenate([np.zeros((0, 2), np.uint64), *parts])
    return keys[np.argsort(keys[:, 0], kind="stable")]


def _distinct_texts(docs: DataFrame) -> tuple[DataFrame, int]:
    """Distinct texts with their number of copies, in blocks, as a table bucketed by block.

    Copies are counted before anything else, so however many there are, each text is parsed once.
    The bucketing lets both later steps meet the texts without moving them again.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A multiple of the partitions: hashed the same way, a partition's texts fill its own blocks.
    blocks = partitions * max(1, math.ceil(total / BLOCK_BYTES / partitions))
    texts = (docs.select(text.alias("text")).groupBy("text").agg(F.count("*").alias("copies"))
             .withColumn("block", F.pmod(F.hash("text"), F.lit(blocks))))
    name = f"substring_texts_{uuid.uuid4().hex}"
    (texts.write.bucketBy(blocks, "block").option("path", scratch_path(spark, "texts"))
     .saveAsTable(name))
    # What is read has been resolved; the name need not stay in the catalogue.
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table, blocks


def repeated_passages(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Mark every word inside a window whose word sequence also starts anywhere else.

    A window is ``window`` consecutive words (runs between ASCII white space, unchanged) of one
    text. First the names of the symbols that vouch for windows are counted over all texts; a window
    with a witness that occurs once cannot repeat. The others are verified: a 128-bit hash of their
    words is counted over all texts. Within a block equal keys are sent once.

    Returns one row per distinct text: key (MD5), n_words, removed (array of start and stop words) and
    kept (the other words, joined by one space). Null counts as an empty text, which has no words; a
    text shorter than the window keeps all; a text with copies loses all its words, if it has a
    window. An empty table gives no rows.
    """
    texts, blocks = _distinct_texts(docs)

    def words_of(table):
        words = split_words(table.column("text"), SPACE)
        copied = np.repeat(table.column("copies").to_numpy() > 1, words.counts)
        return words, words.hashes(), copied

    def vouch(key, table):
        words, names, copied = words_of(table)
        found, at = Witnesses(names, words.first, window).names()
        keys = np.column_stack([found, np.zeros(len(found), np.uint64)])
        return _packed(key[0].as_py(), keys, copied[at], blocks)

    def verify(key, table, known):
        words, names, copied = words_of(table)
        at = np.flatnonzero(Witnesses(names, words.first, window).candidates(_known(known)[:, 0]))
        return _packed(key[0].as_py(), window_hashes(names, window)[at], copied[at], blocks)

    def remove(key, table, known):
        words, names, _ = words_of(table)
        n = len(names)
        stop = np.repeat(words.first[1:], words.counts)
        whole = np.arange(n) + window <= stop
        again = np.flatnonzero(whole & _among(window_hashes(names, window), _known(known)))
        return _without(table, words, _cover(n, again, again + window))

    by_block = texts.groupBy("block")
    symbols = by_block.applyInArrow(vouch, KEYS).groupBy("bucket").applyInArrow(
        _repeated, "block int, found binary")
    windows = (by_block.cogroup(symbols.groupBy("block")).applyInArrow(verify, KEYS)
               .groupBy("bucket").applyInArrow(_repeated, "block int, found binary"))
    return (by_block.cogroup(windows.groupBy("block"))
            .applyInArrow(remove, "text string, n_words bigint, "
                          "removed array<struct<start:int,stop:int>>, kept string")
            .select(F.md5(F.col("text").cast("binary")).alias("key"), "n_words", "removed", "kept"))


def _without(table: pa.Table, words, gone: np.ndarray) -> pa.Table:
    """Each text's removed word ranges, and its other words joined by one space."""
    n = len(gone)
    owner = words.owner
    edge = np.zeros(n + 1, bool)
    edge[words.first] = True
    starts = np.flatnonzero(gone & (edge[:n] | ~np.concatenate([[False], gone[:-1]])))
    stops = np.flatnonzero(gone & (edge[1:] | ~np.append(gone[1:], False))) + 1
    base = words.first[owner[starts]] if n else starts
    texts = words.first
    removed = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(starts, texts).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array((starts - base).astype(np.int32)),
                                    pa.array((stops - base).astype(np.int32))],
                                   ["start", "stop"]))
    keep = np.flatnonzero(~gone)
    # Each kept word goes with the byte after it, made a space; a text's last one is then cut off.
    length = words.end[keep] - words.start[keep] + 1
    data = np.append(words.data, np.uint8(0x20))[ranges(words.start[keep], length)]
    ends = np.cumsum(length)
    data[ends - 1] = 0x20
    of = owner[keep]
    last = np.ones(len(keep), bool)
    last[:-1] = of[1:] != of[:-1]
    solid = np.ones(len(data), bool)
    solid[ends[last] - 1] = False
    size = np.bincount(of, length, len(texts) - 1).astype(np.int64)
    size -= np.bincount(of[last], minlength=len(texts) - 1)
    offsets = np.concatenate([[0], np.cumsum(size)])
    kept = pa.LargeStringArray.from_buffers(
        len(texts) - 1, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[solid])))
    return pa.table({"text": table.column("text"), "n_words": pa.array(words.counts),
                     "removed": removed, "kept": kept.cast(pa.string())})


def op6_recompression(spark, docs: DataFrame) -> DataFrame:
    """What repeated passages take from every document; odd rows as in ``repeated_passages``, null ids and
    repeated rows each with their row."""
    gone = F.aggregate("removed", F.lit(0).cast("bigint"), lambda a, s: a + s["stop"] - s["start"])
    per_text = repeated_passages(docs).select(
        "key", "n_words", gone.alias("n_removed"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
    keyed = docs.select("doc_id", F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
                        .alias("key"))
    return keyed.join(per_text, "key").select("doc_id", "n_words", "n_removed", "kept_sha256")
