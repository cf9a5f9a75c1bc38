"""Maximal periodic runs of words: Lyndon arrays by Baier's grouping, extended by common extensions.

Every maximal run holds a Lyndon root: the longest Lyndon word that starts at some place of the run,
under the order of words or under its reverse. The first phase of Baier's suffix sorter puts every
suffix into the group of its longest Lyndon prefix, so that phase alone, run once under each order,
gives all candidate roots; how far a root repeats to both sides makes the run.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.llm.text import slices

BATCH_BYTES = 8 << 20


def lyndon_lengths(symbols: np.ndarray) -> list[int]:
    """The length of the longest Lyndon word that starts at each place (dense symbols from 0).

    Groups of suffixes are visited from the highest down. What is left of a place among those not yet
    visited is a suffix of a lower group whose prefix the visited group continues; suffixes followed
    by equally many members of the group move together into a new group just above their own.
    """
    n = len(symbols)
    if not n:
        return []
    order = np.argsort(symbols, kind="stable")
    cuts = np.flatnonzero(np.diff(symbols[order])) + 1
    members = [part.tolist() for part in np.split(order, cuts)]
    group = symbols.tolist()
    size = [1] * len(members)
    below = list(range(-1, len(members) - 1))
    above = list(range(1, len(members) + 1))
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    out = [0] * n
    current = len(members) - 1
    while current >= 0:
        length = size[current]
        followed: list[list[int]] = []        # (place to the left, how often), by place
        last = -1
        for i in members[current]:
            if group[i] != current:           # has moved to a higher group
                continue
            out[i] = length
            before, after = left[i], right[i]
            if after < n:
                left[after] = before
            if before >= 0:
                right[before] = after
                if before == last:
                    followed[-1][1] += 1
                else:
                    followed.append([before, 1])
                    last = before
        members[current] = None
        if followed:
            if len(followed) > 1:
                followed.sort(key=lambda pair: -pair[1])
            moved: dict[int, int] = {}
            times = 0
            for place, count in followed:
                if count != times:
                    moved.clear()
                    times = count
                old = group[place]
                new = moved.get(old)
                if new is None:
                    moved[old] = new = len(members)
                    members.append([])
                    size.append(size[old] + count * length)
                    higher = above[old]
                    below.append(old)
                    above.append(higher)
                    below[higher] = new
                    above[old] = new
                members[new].append(place)
                group[place] = new
        current = below[current]
    return out


def common_extension(a: np.ndarray, b: np.ndarray, sums: np.ndarray, powers: np.ndarray,
                     back: bool = False) -> np.ndarray:
    """How many symbols from places ``a`` and ``b`` on (or before them, ``back``) are the same.

    Binary search over the hashes of all pairs' blocks at once; ``a`` is before ``b``.
    """
    n = len(sums) - 1
    most = a.copy() if back else n - b
    low = np.zeros(len(a), np.int64)
    step = 1 << max(0, int(most.max(initial=0)).bit_length() - 1)
    while step:
        take = np.flatnonzero(low + step <= most)
        x, y, far = a[take], b[take], low[take] + step
        if back:
            x, y = x - far, y - far
        same = ((sums[x + far] - sums[x]) * powers[y - x]) == (sums[y + far] - sums[y])
        low[take[same]] += step
        step >>= 1
    return low


def find_runs(words: np.ndarray, min_exponent: int = 2, min_length: int = 2) -> np.ndarray:
    """All maximal runs of a sequence of dense word numbers, as rows (start, length, period) by start,
    then period.

    A run is a stretch with smallest period q and a length of at least ``min_exponent`` (2 or more)
    times q and ``min_length`` that no neighbour extends. An empty sequence has none. Linear but for
    the binary searches; every run found by hashes is compared word by word before it counts.
    """
    if min_exponent < 2:
        raise ValueError("a run repeats its period at least twice")
    none = np.zeros((0, 3), np.int64)
    places = repetitive(words, min_exponent, max(min_length, min_exponent))
    if not len(places):
        return none
    # The stretches that may hold runs, one string; a symbol of its own, lower than all, after each.
    breaks = np.flatnonzero(np.diff(places) > 1) + 1
    at = np.insert(places, breaks, -1)
    gaps = np.flatnonzero(at < 0)
    text = np.empty(len(at), np.int64)
    text[at >= 0] = words[places] + len(gaps)
    text[gaps] = np.arange(len(gaps))
    text = np.unique(text, return_inverse=True)[1].reshape(-1).astype(np.int64)
    n = len(text)

    random = np.random.default_rng(20240611)
    powers = np.ones(n + 1, np.uint64)
    powers[1:] = random.integers(1, 1 << 62, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    powers = np.multiply.accumulate(powers)
    letters = random.integers(0, 1 << 63, int(text.max()) + 1, dtype=np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(letters[text] * powers[:n], out=sums[1:])

    found = []
    start = np.arange(n)
    for symbols in (text, text.max() - text):
        period = np.array(lyndon_lengths(symbols), np.int64)
        k = np.flatnonzero(start + period < n)
        k = k[text[k] == text[k + period[k]]]
        p = period[k]
        ahead = common_extension(k, k + p, sums, powers)
        behind = common_extension(k, k + p, sums, powers, back=True)
        length = ahead + behind + p
        kept = length >= np.maximum(min_exponent * p, min_length)
        found.append(np.column_stack([k - behind, length, p])[kept])
    runs = np.unique(np.concatenate(found), axis=0)
    runs = np.array([exact(text, *map(int, run)) for run in runs], np.int64).reshape(-1, 3)
    runs = np.unique(runs[runs[:, 1] >= np.maximum(min_exponent * runs[:, 2], min_length)], axis=0)
    runs[:, 0] = at[runs[:, 0]]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))] if len(runs) else none


def exact(text: np.ndarray, start: int, length: int, period: int) -> tuple[int, int, int]:
    """A run as its words say: cut at the first words that differ from its middle on, should equal
    hashes have hidden some."""
    differ = np.flatnonzero(text[start:start + length - period] != text[start + period:start + length])
    if not len(differ):
        return start, length, period
    bounds = np.concatenate([[-1], differ, [length - period]])
    widest = int(np.argmax(np.diff(bounds)))
    low, high = int(bounds[widest]) + 1, int(bounds[widest + 1])
    return start + low, high - low + period, period


def repetitive(words: np.ndarray, exponent: int, min_length: int) -> np.ndarray:
    """The places that may lie in a run, ascending; the others cannot.

    In a run of period q each word occurs again q places before or after it, and q is at most the
    length of the stretch around it divided by ``exponent``. Places whose word is farther from its
    next copy than that are taken out, which shortens the stretches, until nothing changes.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    gap = np.diff(order)
    gap[words[order[1:]] != words[order[:-1]]] = n + 1
    near = np.full(n, n + 1, np.int64)
    near[order[1:]] = gap
    near[order[:-1]] = np.minimum(near[order[:-1]], gap)
    places = np.flatnonzero(near * exponent <= n)
    while len(places):
        edges = np.concatenate([[0], np.flatnonzero(np.diff(places) > 1) + 1, [len(places)]])
        size = np.diff(edges)
        size = np.repeat(np.where(size < min_length, 0, size), size)
        good = near[places] * exponent <= size
        if good.all():
            return places
        places = places[good]
    return places


def collapsed(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay when every run keeps its first period only."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:n]) == 0


def number_words(words: list[bytes]) -> np.ndarray:
    """Dense numbers, equal for equal words; larger words have larger numbers."""
    rank = {word: k for k, word in enumerate(sorted(set(words)))}
    return np.fromiter(map(rank.__getitem__, words), np.int64, len(words))


RUNS = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def _run_batches(batches: Iterator[pa.RecordBatch], alter: Callable | None, exponent: int,
                 min_length: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", BATCH_BYTES):
        counts, found, texts = [], [], []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(),
                                batch.column("text").to_pylist()):
            words = (text or "").encode().split()
            numbers = number_words(words)
            if alter is not None:
                taken = alter(doc_id, len(words))
                if taken is not None:
                    words, numbers = [words[i] for i in taken.tolist()], numbers[taken]
            runs = find_runs(numbers, exponent, min_length)
            counts.append(len(words))
            found.append(runs)
            if len(runs):
                words = [words[i] for i in np.flatnonzero(collapsed(len(words), runs)).tolist()]
            texts.append(b" ".join(words))
        rows = np.concatenate([np.zeros((0, 3), np.int64), *found])
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(counts, pa.int64()),
            pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(
                [pa.array(np.ascontiguousarray(rows[:, i])) for i in range(3)],
                ["start", "length", "period"])),
            pa.array(texts, pa.binary()).cast(pa.string()),
        ], ["doc_id", "n_words", "runs", "collapsed"])


def word_runs(docs: DataFrame, min_exponent: int = 4, min_length: int = 6,
              alter: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """The periodic runs of every document's words ``[^\\x20\\x09-\\x0D]+`` and its collapsed text.

    Returns, per row of ``docs`` (doc_id, text; other columns are not read): doc_id, n_words, runs
    (array of start, length, period by start, then period; word numbers from 0) and collapsed, the
    words outside runs and in a run's first period, joined by one space. ``alter(doc_id, n)`` may
    name the words to read instead, as word numbers.

    A null or empty text and one of spaces alone have no words, no runs and an empty collapsed text;
    a null id is kept; repeated rows are answered one by one; equal longest runs are all listed; an
    empty table gives no rows. Each text is read whole, one at a time, by one task, and no row is
    shuffled: a task's memory follows its longest text, and a lost task is run again by itself.
    """
    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: _run_batches(batches, alter, min_exponent, min_length),
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {RUNS}")


def planted_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """The word numbers of a text whose tail is made periodic where its id's checksum asks for it."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])


def op11_periodic_runs(spark, docs: DataFrame) -> DataFrame:
    """Runs and collapsed texts of all documents as digests; nulls and ties as in ``word_runs``, of
    equally long runs the first by start, then period. A null id has no planted tail."""
    longest = F.expr("""reduce(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>),
        (best, run) -> if(best is null or run.length > best.length, run, best))""")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return word_runs(docs, alter=planted_tail).withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
