"""Line dedup against brute force."""

from __future__ import annotations

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from stationcast.llm import lines, queries
from tests.llm.conftest import ODD_ROWS, make_docs

SPACES = " \t\n\x0b\x0c\r"
UPPER = {c: c + 32 for c in range(65, 91)}


def by_hand(rows, least=10):
    def key(line):
        return line.strip(SPACES).translate(UPPER)

    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(i)
    owner = {k: min(ids, key=lambda i: (i is None, i)) for k, ids in holders.items() if len(k) >= least}
    out = []
    for i, text in rows:
        all_lines = (text or "").split("\n")
        kept = [line for line in all_lines if owner.get(key(line), i) == i]
        out.append((i, len(all_lines), len(all_lines) - len(kept),
                    hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def answered(spark, docs):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256)
                   for r in lines.op13_line_bitmaps(spark, docs).collect()), key=str)


def test_odd_rows(spark, odd_docs, no_docs):
    assert answered(spark, odd_docs) == by_hand([(i, t) for i, t, _ in ODD_ROWS])
    assert lines.op13_line_bitmaps(spark, no_docs).count() == 0


def test_ties_nulls_and_widths(spark):
    rows = [
        (5, "  A line of THIS text\nshort\nother 123456789"),
        (3, "a line of this text\t\nshort\n\na line of this text"),
        (3, "another text of the same id\na LINE of this text"),        # one document with the row above
        (None, "a line of this text\nonly here, no id"), (None, "only here, no id\nonly here, no id"),
        (9, "ÄÖÜäöüßéè\nÄÖÜäöüßéèê"), (8, "ÄÖÜäöüßéè\nÄÖÜäöüßéèê"),        # 9 and 10 characters
        (7, " a line of this text"), (6, "other 123456789"), (6, "other 123456789"),
    ]
    docs = make_docs(spark, [(i, t, "a") for i, t in rows])
    assert answered(spark, docs) == by_hand(rows)
    maps = lines.keep_bitmaps(docs).where("doc_id = 3").collect()
    assert {(r.n_lines, r.n_dropped) for r in maps} == {(4, 0), (2, 0)}
    nine = lines.keep_bitmaps(docs).where("doc_id = 9").first()
    assert lines.kept_text(rows[5][1], nine.keep) == "ÄÖÜäöüßéè"


def test_a_common_line_spans_ranges(spark):
    """A key in every document, over many ranges: all but the smallest document lose it."""
    docs = spark.range(1, 4001).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("the most common line\nown line number "), F.col("id") % 1500,
                 F.lit("\nthe most common line")).alias("text"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = answered(spark, docs)
        owners = lines.dropped_lines(docs).groupBy("doc_id").count().count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    assert got == by_hand([(r.doc_id, r.text) for r in docs.collect()]) and owners == 3999


def test_owners_of_ranges():
    def row(part, says, key, owner):
        return {"part": part, "says": says, "h1": key, "h2": 0, "doc_id": owner}

    reports = [row(7, lines.BEGINS, 5, 90), row(7, lines.ENDS, 6, 4), row(2, lines.BEGINS, 1, 3),
               row(2, lines.ENDS, 5, 12), row(3, lines.BEGINS, 5, 40), row(3, lines.ENDS, 5, 40),
               row(9, lines.BEGINS, 8, None), row(9, lines.ENDS, 8, None),
               row(11, lines.BEGINS, 8, None), row(11, lines.ENDS, 9, 1)]
    assert lines.range_owners(reports) == [(2, 3), (3, 12), (7, 12), (9, None), (11, None)]


def test_query_equals_brute_force(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256)
                  for r in queries.QUERIES["op13_line_bitmaps"](spark, small).collect()), key=str)
    assert got == by_hand(docs) and sum(r[2] for r in got) > 100
