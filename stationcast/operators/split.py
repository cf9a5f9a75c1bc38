"""Reproducible 64/16/20 split and class-label encoding."""

from __future__ import annotations

import math

from pyspark.ml.feature import StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationcast.schemas import SEED, TARGET_CONDITION
from stationcast.session import cut_lineage

# First eight hex digits of the hash at which the last 20 % and the 16 % before them begin.
TEST_FROM = "cccccccc"
VALIDATE_FROM = "a3d70a3d"
MINIMUM_ROWS = 8


def split_hash(seed: int = SEED) -> Column:
    """A hash of the row key: it depends on the row alone, not on partitioning or row order."""
    return F.md5(F.concat_ws("|", "city", F.col("date").cast("string"), F.lit(str(seed))))


def require_enough_rows(rows: DataFrame) -> DataFrame:
    """Return ``rows``, or fail when a split would leave a part empty.

    This runs a job, so call it on stored rows; the split itself stays lazy.
    """
    if len(rows.select("city").take(MINIMUM_ROWS)) < MINIMUM_ROWS:
        raise ValueError(f"cannot split fewer than {MINIMUM_ROWS} rows")
    return rows


def split_64_16_20(rows: DataFrame, seed: int = SEED, exact: bool = False) -> DataFrame:
    """Add ``split``: train, validate or test.

    The default compares the hash with fixed bounds, a row-local expression whose sizes are right
    on average. ``exact`` finds the bounds that give ceil(20 %) test rows and ceil(20 %) of the
    rest as validation rows.
    """
    h = split_hash(seed)
    if exact:
        test_from, validate_from = _exact_bounds(cut_lineage(rows.select(h.alias("h"))))
    else:
        test_from, validate_from, h = TEST_FROM, VALIDATE_FROM, F.substring(h, 1, 8)
    label = F.when(h >= test_from, "test").when(h >= validate_from, "validate").otherwise("train")
    return rows.withColumn("split", label)


def _exact_bounds(hashes: DataFrame) -> tuple[str, str]:
    """The hash values from which test and validation rows begin; ``hashes`` are stored rows.

    Rows are counted per four-digit hash prefix (65,536 counts at most, evenly filled because md5
    is); only the two prefixes that contain a bound are then looked into.
    """
    counts = {r.p: r["count"] for r in hashes.groupBy(
        F.substring("h", 1, 4).alias("p")).count().collect()}
    total = sum(counts.values())
    tests = math.ceil(total * 0.2)
    validates = math.ceil((total - tests) * 0.2)

    def bound(from_top: int) -> str:
        above = 0
        for prefix in sorted(counts, reverse=True):
            if above + counts[prefix] >= from_top:
                inside = hashes.filter(F.substring("h", 1, 4) == prefix).orderBy(F.desc("h"))
                return inside.limit(from_top - above).agg(F.min("h").alias("h")).first().h
            above += counts[prefix]
        raise AssertionError("bound lies outside the rows")

    return bound(tests), bound(tests + validates)


def split_by_time(rows: DataFrame) -> DataFrame:
    """Add ``split`` in order of time: the newest fifth of the rows tests, the fifth before the rest
    validates. Rows of one date stay together, so no date lies in two parts.

    Rolling features of neighbouring days overlap, so a split by hash tests on days that training has
    partly seen; this one does not. Rows are counted per date, which the calendar bounds.
    """
    counts = sorted((r["date"], r["count"]) for r in rows.groupBy("date").count().collect())
    total, seen, starts = sum(n for _, n in counts), 0, {}
    for day, n in counts:
        part = ("train" if seen < 0.64 * total else "validate" if seen < 0.8 * total else "test")
        starts.setdefault(part, day)
        seen += n
    label = F.lit("train")
    for part in ("validate", "test"):
        if part in starts:
            label = F.when(F.col("date") >= F.lit(starts[part]), part).otherwise(label)
    return rows.withColumn("split", label)


def condition_encoder(labelled: DataFrame):
    """Index of the alphabetical class list, fitted on all labelled rows."""
    return StringIndexer(inputCol="y_condition", outputCol=TARGET_CONDITION,
                         stringOrderType="alphabetAsc").fit(labelled)


def encode_condition(labelled: DataFrame) -> DataFrame:
    encoded = condition_encoder(labelled).transform(labelled)
    return encoded.withColumn(TARGET_CONDITION, F.col(TARGET_CONDITION).cast("int"))
