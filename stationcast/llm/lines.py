"""Lines that occur in several documents, kept once: first occurrences streamed in the order of hashes.

Hashes of lines are dealt to ranges of (hash, document, position) and sorted, so that a key's first row
in its range is its first document there. A key may go on over many ranges, however common it is: each
range reports its first and last key, and those few rows tell every range who owns the key it begins
with. What comes back is a compressed bitmap per document of the lines that stay, not text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.llm.store import null_safe_join, stored
from stationcast.llm.text import slices

BATCH_BYTES = 8 << 20
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"
#: What a streamed row says.
DROPPED, FIRST_KEY, BEGINS, ENDS = range(4)


def line_keys(text: str | None, min_chars: int) -> tuple[list[int], list[bytes]]:
    """Numbers and 128-bit hashes of the lines long enough to count."""
    places, digests = [], []
    for place, line in enumerate((text or "").encode().split(b"\n")):
        key = line.strip(SPACE_BYTES).lower()             # of bytes: A-Z only
        size = len(key)
        # A character takes one to four bytes.
        if size >= min_chars and (size >= 4 * min_chars or len(key.decode()) >= min_chars):
            places.append(place)
            digests.append(hashlib.blake2b(key, digest_size=16).digest())
    return places, digests


def hashed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """A row (h1, h2, doc_id, key, place) for every line that counts."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            found = [line_keys(text, min_chars) for text in batch.column("text").to_pylist()]
            counts = [len(places) for places, _ in found]
            hashes = np.frombuffer(b"".join(d for _, digests in found for d in digests), np.int64)
            row = pa.array(np.repeat(np.arange(batch.num_rows), counts))
            yield pa.RecordBatch.from_arrays([
                pa.array(hashes[0::2]), pa.array(hashes[1::2]), batch.column("doc_id").take(row),
                batch.column("key").take(row),
                pa.array([p for places, _ in found for p in places], pa.int32()),
            ], ["h1", "h2", "doc_id", "key", "place"])

    return documents(docs).mapInArrow(
        hashed, "h1 bigint, h2 bigint, doc_id bigint, key bigint, place int")


def documents(docs: DataFrame) -> DataFrame:
    """doc_id, text, and with the id what a row is known by: rows equal in both share their lines."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                       F.xxhash64("doc_id", "text").alias("key"))


STREAMED = "part int, says int, h1 bigint, h2 bigint, doc_id bigint, key bigint, place int"


def _first_occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream a sorted range. Lines of a key are dropped unless they are in the document of its first
    row; those of the range's first key are handed on, for the ranges before may hold it too."""
    part = TaskContext.get().partitionId()
    first = last = None                                   # (h1, h2, owner), owner: (is null, id)

    def report(says: int, key: tuple) -> pa.RecordBatch:
        h1, h2, (missing, owner) = key
        return pa.RecordBatch.from_pylist(
            [{"part": part, "says": says, "h1": h1, "h2": h2, "doc_id": None if missing else owner,
              "key": None, "place": None}], schema)

    schema = pa.schema([("part", pa.int32()), ("says", pa.int32()), ("h1", pa.int64()),
                        ("h2", pa.int64()), ("doc_id", pa.int64()), ("key", pa.int64()),
                        ("place", pa.int32())])
    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2 = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("h1", "h2"))
        ids = batch.column("doc_id")
        missing = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        if first is None:
            first = last = (int(h1[0]), int(h2[0]), (bool(missing[0]), int(ids[0])))
            yield report(BEGINS, first)
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        head = np.flatnonzero(new)
        owner, absent = ids[head], missing[head]
        goes_on = (int(h1[0]), int(h2[0])) == last[:2]
        if goes_on:
            absent[0], owner[0] = last[2]
        group = np.cumsum(new) - 1
        differs = (missing != absent[group]) | (ids != owner[group])
        of_first = np.zeros(len(h1), bool)
        if goes_on and last[:2] == first[:2]:
            of_first = group == 0
        last = (int(h1[-1]), int(h2[-1]), (bool(absent[-1]), int(owner[-1])))
        kept = np.flatnonzero(differs | of_first)
        rows = pa.array(kept)
        empty = pa.nulls(len(kept), pa.int64())
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(kept), part, np.int32)),
            pa.array(np.where(of_first[kept], FIRST_KEY, DROPPED).astype(np.int32)), empty, empty,
            batch.column("doc_id").take(rows), batch.column("key").take(rows),
            batch.column("place").take(rows)], schema=schema)
    if last is not None:
        yield report(ENDS, last)


def range_owners(reports: list) -> list[tuple]:
    """Per range, the document that owns its first key, from the first and last keys of all ranges."""
    ends = {row["part"]: row for row in reports if row["says"] == ENDS}
    owners, key, owner = [], None, None
    for row in sorted((r for r in reports if r["says"] == BEGINS), key=lambda r: r["part"]):
        own = (row["h1"], row["h2"])
        if own != key:
            owner = row["doc_id"]
        owners.append((row["part"], owner))
        end = ends[row["part"]]
        key = (end["h1"], end["h2"])
        if key != own:
            owner = end["doc_id"]
    return owners


def dropped_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """A row (doc_id, key, place) for every line that another, smaller document holds too."""
    spark = docs.sparkSession
    order = ["h1", "h2", F.col("doc_id").asc_nulls_last(), "key", "place"]
    streamed = stored(hashed_lines(docs, min_chars).repartitionByRange(*order)
                      .sortWithinPartitions(*order).mapInArrow(_first_occurrences, STREAMED), "lines")
    reports = streamed.where(F.col("says").isin(BEGINS, ENDS)).select(
        "part", "says", "h1", "h2", "doc_id").collect()           # two rows per range
    owners = spark.createDataFrame(range_owners(reports), "part int, owner bigint")
    line = ["doc_id", "key", "place"]
    begun = (streamed.where(F.col("says") == FIRST_KEY).join(F.broadcast(owners), "part")
             .where(~F.col("doc_id").eqNullSafe(F.col("owner"))))
    return (streamed.where(F.col("says") == DROPPED).select(*line)
            .unionByName(begun.select(*line)))


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_lines = batch.column("n_lines").to_pylist()
        dropped, maps = [], []
        for n, places in zip(n_lines, batch.column("places")):
            keep = np.ones(n, bool)
            if places.is_valid:
                keep[places.values.to_numpy()] = False
            dropped.append(n - int(keep.sum()))
            maps.append(zlib.compress(np.packbits(keep).tobytes(), 1))
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("key"), batch.column("n_lines"),
            pa.array(dropped, pa.int64()), pa.array(maps, pa.binary())],
            ["doc_id", "key", "n_lines", "n_dropped", "keep"])


def keep_bitmaps(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """Which lines of each document stay when a line is kept in one document only.

    A text is split at \\n; a line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z
    lower-cased. Keys of at least ``min_chars`` characters that several documents hold stay in the one
    with the smallest doc_id, there wherever they occur; shorter ones stay everywhere.

    Returns a row per row of ``docs`` (doc_id, text; other columns are not read): doc_id, key, n_lines,
    n_dropped and keep, a zlib-compressed bitmap of the lines that stay, first line in the highest bit
    of the first byte. A null or empty text is one empty line. Rows of equal doc_id are one document,
    null ids too, and that one comes after all others; repeated rows are answered one by one; an empty
    table gives no rows. Lines travel as 128-bit hashes, never as text, and are cut by range of (hash,
    document, position), so a key in a third of all documents spans ranges instead of filling one.
    """
    lines = F.octet_length("text") - F.octet_length(F.replace(F.col("text"), F.lit("\n"))) + 1
    rows = documents(docs).select("doc_id", "key", F.coalesce(lines, F.lit(1)).cast("bigint")
                                  .alias("n_lines"))
    # Repeated rows name the same places; each place once, so that a list is no longer than its text.
    places = (dropped_lines(docs, min_chars).distinct().groupBy("doc_id", "key")
              .agg(F.collect_list("place").alias("places")))
    return null_safe_join(rows, places, ["doc_id", "key"], "left").select(
        "doc_id", "key", "n_lines", "places").mapInArrow(
        _bitmaps, "doc_id bigint, key bigint, n_lines bigint, n_dropped bigint, keep binary")


def kept_text(text: str | None, keep: bytes) -> str:
    """The lines that a bitmap of ``keep_bitmaps`` keeps, joined by \\n."""
    lines = (text or "").split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))
    return "\n".join(lines[i] for i in np.flatnonzero(bits).tolist())


def op13_line_bitmaps(spark, docs: DataFrame) -> DataFrame:
    """Line counts and the digest of the kept lines of all documents; odd rows as in
    ``keep_bitmaps``. A document that loses all its lines has the digest of no text."""
    some = keep_bitmaps(docs).where("n_dropped > 0").dropDuplicates(["doc_id", "key"])
    lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("bigint")

    def digests(batches):
        for batch in slices(batches, "text", BATCH_BYTES):
            out = [hashlib.sha256((text or "" if keep is None else kept_text(text, keep)).encode())
                   .hexdigest() for text, keep in zip(batch.column("text").to_pylist(),
                                                      batch.column("keep").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_lines"), batch.column("n_dropped"),
                 pa.array(out, pa.string())], ["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    rows = documents(docs).withColumn("n_lines", lines)
    joined = null_safe_join(rows, some.select("doc_id", "key", "n_dropped", "keep"),
                            ["doc_id", "key"], "left")
    return joined.select("doc_id", "n_lines", F.coalesce("n_dropped", F.lit(0).cast("bigint"))
                         .alias("n_dropped"), "text", "keep").mapInArrow(
        digests, "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string")
