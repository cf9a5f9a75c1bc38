"""Benchmark decontamination with a positional inverted index.

The index is made of segments, each a row that covers some 2 MB of whole texts: its distinct terms in
order, how often each occurs, and the positions of each. Segments are built and searched where they
lie; no posting is shuffled. Terms are 64-bit hashes of words; a match is at least as many equal
hashes in a row as the window has words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.llm.store import null_safe_join, stored, unused_name
from stationcast.llm.text import ALNUM, FOLD, ranges, slices, split_words

SEGMENT_BYTES = 2 << 20
#: Pairs of a window and an item searched for at once: what the driver and a task hold of the benchmark is
#: bounded by this, some 100 bytes each.
BLOCK_WINDOWS = 500_000

SEGMENT = ("keys array<bigint>, ids array<bigint>, first array<int>, terms array<bigint>, "
           "counts array<int>, positions binary")


def build_index(docs: DataFrame) -> DataFrame:
    """Positional postings of all words of ``docs`` (doc_id, text), stored as segments.

    Position p of text d in a segment is ``first[d] + p``; one position is left free between texts,
    so that no phrase runs from one into the next. A null text has no words.
    """
    def build(batches):
        for batch in slices(batches, "text", SEGMENT_BYTES):
            words = split_words(batch.column("text"), ALNUM, FOLD)
            first = words.first + np.arange(len(words.first))
            place = (np.arange(len(words)) + words.owner).astype(np.int32)
            hashes = words.hashes().view(np.int64)
            order = np.argsort(hashes, kind="stable")
            terms, begin = np.unique(hashes[order], return_index=True)
            one = [0, None]
            def row(values, kind):
                one[1] = len(values)
                return pa.ListArray.from_arrays(pa.array(one, pa.int32()), pa.array(values, kind))
            yield pa.RecordBatch.from_arrays([
                row(batch.column("key"), pa.int64()), row(batch.column("doc_id"), pa.int64()),
                row(first.astype(np.int32), pa.int32()), row(terms, pa.int64()),
                row(np.diff(np.append(begin, len(words))).astype(np.int32), pa.int32()),
                pa.array([place[order].tobytes()], pa.binary()),
            ], ["keys", "ids", "first", "terms", "counts", "positions"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       row_key().alias("key"), "text")
    # Few segments to a file: a reader holds a file's rows at once.
    return stored(rows.mapInArrow(build, SEGMENT), "segments", maxRecordsPerFile=16)


def row_key():
    """What a document is known by beside its id."""
    return F.xxhash64("doc_id", "text")


def item_windows(items: DataFrame, size: int) -> DataFrame:
    """The distinct pairs (window, item): a window as bytes, its length and its terms, 0 for none."""
    def cut(batches):
        for batch in slices(batches, "text", SEGMENT_BYTES):
            words = split_words(batch.column("text"), ALNUM, FOLD)
            hashes, n = words.hashes().view(np.int64), words.counts
            n_windows = np.where(n >= size, n - size + 1, np.minimum(n, 1))
            item = np.repeat(np.arange(len(n)), n_windows)
            length = np.minimum(n[item], size)
            at = ranges(words.first[:-1], n_windows)[:, None] + np.minimum(
                np.arange(size), np.maximum(length, 1)[:, None] - 1)
            rows = np.zeros((len(item), size + 1), np.int64)
            rows[:, 0] = length
            if len(item):
                rows[:, 1:] = np.where(np.arange(size) < length[:, None], hashes[at], 0)
            yield pa.RecordBatch.from_arrays([
                pa.array([row.tobytes() for row in rows], pa.binary()),
                batch.column("item").take(pa.array(item))], ["window", "item"])

    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text")
    return named.mapInArrow(cut, "window binary, item string").distinct()


class Windows:
    """Distinct windows of a block of pairs as padded arrays, in the order of their rarest terms."""

    def __init__(self, pairs: pa.Table, size: int):
        codes = pairs.column("window").combine_chunks().dictionary_encode()
        rows = np.frombuffer(b"".join(codes.dictionary.to_pylist()), np.int64).reshape(-1, size + 1)
        self.length, self.terms = rows[:, 0], rows[:, 1:]
        self.inside = np.arange(size) < self.length[:, None]
        self.vocabulary = np.unique(self.terms[self.inside])
        named = pairs.column("item").combine_chunks().dictionary_encode()
        self.names = np.array(named.dictionary.to_pylist(), dtype=object)
        self.pairs = np.column_stack([codes.indices.to_numpy(), named.indices.to_numpy()]).astype(np.int64)

    def rank(self, frequency: dict[int, int]) -> None:
        """Order each window's offsets from its rarest term in the corpus to its most common, and file
        the windows under their rarest terms."""
        known = np.array([frequency.get(int(t), 0) for t in self.vocabulary], np.int64)
        rarity = np.full(self.terms.shape, np.iinfo(np.int64).max)
        rarity[self.inside] = known[np.searchsorted(self.vocabulary, self.terms[self.inside])]
        order = np.argsort(rarity, axis=1, kind="stable").astype(np.int16)
        rarest = np.take_along_axis(self.terms, order[:, :1].astype(np.int64), axis=1)[:, 0]
        sort = np.argsort(rarest, kind="stable")
        self.length, self.terms, self.order = self.length[sort], self.terms[sort], order[sort]
        self.rarest, self.filed = np.unique(rarest[sort], return_index=True)
        self.filed = np.append(self.filed, len(sort))
        place = np.empty(len(sort), np.int64)
        place[sort] = np.arange(len(sort))
        pairs = np.column_stack([place[self.pairs[:, 0]], self.pairs[:, 1]])
        pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
        self.items = pairs[:, 1]
        self.items_from = np.searchsorted(pairs[:, 0], np.arange(len(sort) + 1))
        self.inside = self.pairs = None

    def fetched(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The windows whose rarest term a segment has, and that term's number in the segment; no other
        window can occur in it."""
        none = np.zeros(0, np.int64)
        if not len(self.rarest):
            return none, none
        at = np.minimum(np.searchsorted(self.rarest, terms), len(self.rarest) - 1)
        term = np.flatnonzero(self.rarest[at] == terms)
        hit = at[term]
        filed = self.filed[hit + 1] - self.filed[hit]
        return ranges(self.filed[hit], filed), np.repeat(term, filed)


def _phrases(windows: Windows, terms, begin, counts, positions, length):
    """Starts and windows of all exact matches in a segment of ``length`` places.

    The rarest term's postings, moved back by its offset, are the candidates; they are intersected
    with the other terms' lists, rarer ones first, by looking up the term at the moved position.
    """
    which, term = windows.fetched(terms)
    rarest = windows.order[which, 0].astype(np.int64)
    start = positions[ranges(begin[term], counts[term])] - np.repeat(rarest, counts[term])
    which = np.repeat(which, counts[term])
    term_at = np.zeros(length, np.int64)
    term_at[positions] = np.repeat(terms, counts)
    gap = np.ones(length, bool)
    gap[positions] = False
    for k in range(1, windows.terms.shape[1]):
        offset = windows.order[which, k].astype(np.int64)
        place = start + offset
        fits = (place >= 0) & (place < length)
        place = np.where(fits, place, 0)
        same = fits & (term_at[place] == windows.terms[which, offset]) & ~gap[place]
        keep = (windows.length[which] <= k) | same
        which, start = which[keep], start[keep]
    fits = (start >= 0) & (start + windows.length[which] <= length)
    return start[fits], which[fits]


def _near(windows: Windows, terms, begin, counts, positions, slop: int):
    """Places of each window's rarest term that have all its other terms within ``slop`` words."""
    found, which = [], []
    for w in windows.fetched(terms)[0]:
        wanted = windows.terms[w, windows.order[w, :windows.length[w]].astype(np.int64)]
        at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
        if (terms[at] != wanted).any():
            continue
        lists = [positions[begin[t]:begin[t] + counts[t]] for t in at]
        near = lists[0]
        for other in lists[1:]:
            at = np.searchsorted(other, near - slop)
            near = near[(at < len(other)) & (other[np.minimum(at, len(other) - 1)] <= near + slop)]
        found.append(near)
        which.append(np.full(len(near), w))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found]), np.concatenate([none, *which])


def search(segments: DataFrame, items: DataFrame, window: int = 10,
           slop: int | None = None) -> DataFrame:
    """Find the benchmark items' windows in an index.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one
    window. Exact phrases are found by default; with ``slop``, places of a window's rarest term that
    have its other terms, in any order, at most ``slop`` words away in the same text.

    Returns one row per indexed document: key, doc_id, n_words, spans (array of start and stop, the
    merged runs of words inside matches) and items (ids as text, sorted, each once). Items without
    words match nothing; a null id reads "null", and items of one id are one. Repeated documents each
    have their row, null and empty texts one without words, an empty index none; without items no
    document has matches. Windows are cut by Spark and
    searched for in blocks of about ``BLOCK_WINDOWS`` pairs of window and item, each a pass over the
    index; the driver sees hashed windows, a block at a time, and no text. A segment looks up its
    distinct terms among the windows' rarest and compares only the windows it finds, so its cost follows
    its own words.
    """
    spark = segments.sparkSession
    pairs = stored(item_windows(items, window), "windows")
    blocks = max(1, -(-pairs.count() // BLOCK_WINDOWS))
    block = F.pmod(F.xxhash64("window", "item"), F.lit(blocks))
    parts = [_search_block(spark, segments, pairs.where(block == b), window, slop)
             for b in range(blocks)]
    if len(parts) == 1:
        return parts[0]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    # Rows equal in key and id are equal texts with equal matches.
    merged = found.groupBy("key", "doc_id", "n_words").agg(
        F.flatten(F.collect_set("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.count("*").alias("n"))
    rows = merged.withColumn("copy", F.explode(F.sequence(
        F.lit(1), (F.col("n") / len(parts)).cast("int"))))
    return rows.select("key", "doc_id", "n_words", _merged("spans").alias("spans"), "items")


def _merged(name: str):
    return F.expr(f"""aggregate(array_sort({name}), cast(array() as array<struct<start:int,stop:int>>),
        (a, s) -> if(size(a) > 0 and s.start <= element_at(a, -1).stop,
            concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start,
                'stop', greatest(element_at(a, -1).stop, s.stop)))),
            concat(a, array(s))))""")


def _search_block(spark, segments: DataFrame, pairs: DataFrame, window: int, slop):
    windows = Windows(pairs.toArrow(), window)
    vocabulary = spark.sparkContext.broadcast(windows.vocabulary)

    def frequencies(batches):
        total = np.zeros(len(vocabulary.value), np.int64)
        for batch in batches:
            terms = batch.column("terms").flatten().to_numpy(zero_copy_only=False)
            counts = batch.column("counts").flatten().to_numpy(zero_copy_only=False)
            if len(terms) and len(total):
                at = np.minimum(np.searchsorted(vocabulary.value, terms), len(total) - 1)
                known = vocabulary.value[at] == terms
                total += np.bincount(at[known], counts[known], len(total)).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(vocabulary.value[some]), pa.array(total[some])],
                                         ["term", "n"])

    # Reads two columns; at most one row per benchmark word reaches the driver.
    frequency = segments.select("terms", "counts").mapInArrow(frequencies, "term bigint, n bigint")
    windows.rank({row["term"]: row["n"] for row in
                  frequency.groupBy("term").agg(F.sum("n").alias("n")).collect()})
    query = spark.sparkContext.broadcast(windows)

    def match(batches):
        windows = query.value
        for batch in batches:
            for row in range(batch.num_rows):
                yield _match_segment(windows, slop, *[
                    batch.column(c)[row] for c in ("keys", "ids", "first", "terms", "counts",
                                                   "positions")])

    return segments.mapInArrow(match, "key bigint, doc_id bigint, n_words int, "
                               "spans array<struct<start:int,stop:int>>, items array<string>")


def _match_segment(windows, slop, keys, ids, first, terms, counts, positions):
    first = first.values.to_numpy().astype(np.int64)
    n_words = np.diff(first) - 1
    terms, counts = terms.values.to_numpy(), counts.values.to_numpy().astype(np.int64)
    positions = np.frombuffer(positions.as_buffer(), np.int32).astype(np.int64)
    begin = np.cumsum(counts) - counts
    start = which = np.zeros(0, np.int64)
    length, names = windows.length, windows.names
    if len(terms) and slop is None:
        start, which = _phrases(windows, terms, begin, counts, positions, int(first[-1]))
    elif len(terms):
        # Texts are set apart by more than the slop, then put back.
        gap = np.arange(len(n_words)) * (slop + 1)
        apart = positions + gap[np.searchsorted(first, positions, side="right") - 1]
        start, which = _near(windows, terms, begin, counts, apart, slop)
        start -= gap[np.searchsorted(first[:-1] + gap, start, side="right") - 1]
        length = np.ones_like(windows.length)
    # Words inside matches, as merged runs per text.
    change = np.zeros(int(first[-1]) + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + length[which], -1)
    hit = np.concatenate([[False], np.cumsum(change) > 0])
    edge = np.flatnonzero(hit[1:] != hit[:-1])
    run_start, run_stop = edge[::2], edge[1::2]
    owner = np.searchsorted(first, run_start, side="right") - 1
    spans = pa.StructArray.from_arrays(
        [pa.array((run_start - first[owner]).astype(np.int32)),
         pa.array((run_stop - first[owner]).astype(np.int32))], ["start", "stop"])
    text = np.searchsorted(first, start, side="right") - 1
    seen = np.unique(np.column_stack([text, which]), axis=0) if len(text) else \
        np.zeros((0, 2), np.int64)
    many = np.diff(windows.items_from)[seen[:, 1]] if len(seen) else np.zeros(0, np.int64)
    item = windows.items[ranges(windows.items_from[:-1][seen[:, 1]], many)] if len(seen) else many
    listed = sorted(set(zip(np.repeat(seen[:, 0], many).tolist(), names[item].tolist())))
    of = np.array([t for t, _ in listed], np.int64)
    texts = np.arange(len(n_words) + 1)
    return pa.RecordBatch.from_arrays([
        keys.values, ids.values, pa.array(n_words.astype(np.int32)),
        pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, texts).astype(np.int32)), spans),
        pa.ListArray.from_arrays(pa.array(np.searchsorted(of, texts).astype(np.int32)),
                                 pa.array([n for _, n in listed], pa.string())),
    ], ["key", "doc_id", "n_words", "spans", "items"])


def clean_rows(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` without the documents that hold a window of a benchmark item, same columns.

    Null and empty texts hold none and stay; repeated rows share their fate, by id and text, null ids
    too; without items every row stays; an empty table gives no rows.
    """
    found = search(build_index(docs), items, window).where(F.size("spans") > 0)
    key = unused_name(docs, "__key")
    bad = stored(found.select(F.col("key").alias(key), "doc_id").distinct(), "contaminated")
    return null_safe_join(docs.withColumn(key, row_key()), bad, [key, "doc_id"],
                          "left_anti").select(*docs.columns)


def op9_positional_index(spark, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Words and items that all documents share with the benchmark; odd rows as in ``search``."""
    found = search(build_index(docs), benchmark)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["stop"] - s["start"])
    return found.select(
        "doc_id", F.col("n_words").cast("bigint").alias("n_words"), n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))
