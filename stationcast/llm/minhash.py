"""Near-duplicate documents by ProbMinHash signatures of weighted word shingles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationcast.llm.components import connected_components
from stationcast.llm.store import null_safe_join, stored, unused_name
from stationcast.llm.text import FOLD, SPACE, mix, slices, split_words

CHUNK_BYTES = 4 << 20
SHINGLE = 5
BANDS, MOST_ROWS = 32, 7
THRESHOLD = 0.8
PAIR_BYTES = 4 << 20


def band_rows(threshold: float) -> int:
    """Registers per band, so that texts at the threshold agree in all of a band with a probability of
    0.2 at least, and so in one of 32 bands with 0.999."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is a similarity above 0, at most 1")
    rows = MOST_ROWS
    while rows > 1 and threshold ** rows < 0.2:
        rows -= 1
    return rows


def weighted_shingles(column: pa.Array, size: int = SHINGLE):
    """Distinct shingles of each text: (text, hash, weight), ordered by text and hash.

    A shingle is ``size`` consecutive words, ASCII case folded; a text of fewer words, but not none,
    is one shingle. The weight is the number of times it occurs.
    """
    words = split_words(column, SPACE, FOLD)
    counts, hashes = words.counts, words.hashes()
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(counts)), n)
    if not len(owner):
        return owner, np.zeros(0, np.uint64), np.zeros(0)
    begin = words.first[:-1][owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n))
    stop = words.first[1:][owner]
    value = np.full(len(owner), 0x9E3779B97F4A7C15, np.uint64)
    for k in range(size):
        at = begin + k
        inside = at < stop
        word = np.where(inside, hashes[np.minimum(at, len(hashes) - 1)], np.uint64(0))
        value = mix(value ^ word, salt=k + 1)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    head = np.flatnonzero(new)
    return owner[head], value[head], np.diff(np.append(head, len(owner))).astype(float)


def signatures(owner, value, weight, texts: int, registers: int) -> np.ndarray:
    """Per text and register the hash of the element that arrives there first.

    Every element sends arrivals at the times of a Poisson process with its weight as rate, each to a
    random register. Arrivals come in rounds, all elements of all texts at once; an element stops
    once its time lies past the last register of its text to be reached. Two texts agree in a
    register with the probability Jaccard similarity of their weighted shingles.
    """
    first = np.full(texts * registers, np.inf)
    winner = np.zeros(texts * registers, np.uint64)
    time = np.zeros(len(owner))
    live, latest, k = np.arange(len(owner)), np.full(texts, np.inf), 0
    while len(live):
        k += 1
        draw = mix(value[live], salt=2 * k)
        uniform = ((draw >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)
        time[live] -= np.log(uniform) / weight[live]
        place = (mix(value[live], salt=2 * k + 1) % np.uint64(registers)).astype(np.int64)
        slot, now = owner[live] * registers + place, time[live]
        np.minimum.at(first, slot, now)
        won = first[slot] == now
        winner[slot[won]] = value[live[won]]
        # The last register's time falls ever more slowly; looking at it now and then is enough.
        if k <= 8 or k % 8 == 0:
            some = np.unique(owner[live])
            latest[some] = first.reshape(texts, registers)[some].max(axis=1)
            live = live[time[live] < latest[owner[live]]]
    return winner.reshape(texts, registers)


def probability_jaccard(value_a, weight_a, value_b, weight_b) -> float:
    """Sum over common elements x of 1 / sum over y of max(a(y)/a(x), b(y)/b(x))."""
    common, at_a, at_b = np.intersect1d(value_a, value_b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    shared_a, shared_b = weight_a[at_a], weight_b[at_b]
    only_a, only_b = weight_a.sum() - shared_a.sum(), weight_b.sum() - shared_b.sum()
    total = 0.0
    # The inner sum depends on x only through a(x) and the ratio a(x) / b(x), which takes few values.
    ratio = shared_a / shared_b
    for r in np.unique(ratio):
        inner = only_a + r * only_b + np.maximum(shared_a, r * shared_b).sum()
        total += shared_a[ratio == r].sum() / inner
    return total


def text_key():
    return F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))


def _classes(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Documents by the MD5 of their text, and one row per distinct text with its bands."""
    per_band = band_rows(threshold)
    registers = BANDS * per_band

    def sign(batches):
        for batch in slices(batches, "text", CHUNK_BYTES):
            owner, value, weight = weighted_shingles(batch.column("text"))
            found = signatures(owner, value, weight, batch.num_rows, registers)
            band = np.zeros((batch.num_rows, BANDS), np.uint64)
            for k in range(per_band):
                band = mix(band ^ found[:, k::per_band], salt=k + 1)
            some = np.zeros(batch.num_rows, bool)
            some[owner] = True
            # A text without words has no bands and meets only its copies.
            sizes = np.where(some, BANDS, 0)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("key"),
                pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)),
                    pa.array(band[some].ravel().view(np.int64))),
            ], ["doc_id", "key", "bands"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key().alias("key"),
                       "text").mapInArrow(
        sign, "doc_id bigint, key string, bands array<bigint>")
    signed = stored(rows, "signatures")
    # Numbers given while writing stay as they are written.
    classes = stored(signed.groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands")).withColumn("cid", F.monotonically_increasing_id()),
        "classes")
    return signed.select("doc_id", "key"), classes


def _texts_of(wanted: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The texts of the classes ``wanted`` (cid), stored: cid, text.

    One copy of each text is fetched, by key and id, so that copies of one text do not meet. This is
    the one step that moves texts; the hint keeps it the same at every size.
    """
    needed = wanted.join(classes.select("cid", "key", F.col("rep").alias("doc_id")), "cid")
    keyed = docs.select("doc_id", text_key().alias("key"), "text").hint("merge")
    return stored(null_safe_join(keyed, needed, ["key", "doc_id"])
                  .select("cid", "key", "doc_id", "text").dropDuplicates(["key", "doc_id"])
                  .select("cid", "text"), "texts")


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of classes whose texts' similarity reaches the threshold."""
    def verify(batches):
        for batch in batches:
            for part in slices(iter([batch]), "text_a", PAIR_BYTES):
                left = _per_row(part.column("text_a"), part.num_rows)
                right = _per_row(part.column("text_b"), part.num_rows)
                keep = [probability_jaccard(*left[k], *right[k]) >= threshold
                        for k in range(part.num_rows)]
                yield part.select(["a", "b"]).filter(pa.array(keep))

    named = texts.select(F.col("cid").alias("a"), F.col("text").alias("text_a"))
    other = texts.select(F.col("cid").alias("b"), F.col("text").alias("text_b"))
    return stored(pairs.select("a", "b").hint("merge").join(named, "a").hint("merge")
                  .join(other, "b").select("a", "b", "text_a", "text_b")
                  .mapInArrow(verify, "a bigint, b bigint"), "links")


def _possible_pairs(texts: DataFrame, placed: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of ``texts`` (cid, text) in different components that may reach the threshold.

    A prefix filter, which loses no pair. Shingles are ordered from the rarest among these texts to the
    most common. Behind the first shingle that two texts share lies all they can share, so of each text
    at least the share f of its weight, where 1 / f_a + 1 / f_b - 1 is at most 1 / threshold (by the
    concavity of a * b / (P * b + Q * a) in the shared weights a and b; if every weight is one, by the
    smaller part). So f is at least the threshold in both texts and at least 2 t / (1 + t) in one: only
    such first places are joined, the rarer part of each text.
    """
    def shingle(batches):
        for batch in slices(batches, "text", CHUNK_BYTES):
            owner, value, weight = weighted_shingles(batch.column("text"))
            ids = batch.column("cid").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[owner]), pa.array(value.view(np.int64)), pa.array(weight)],
                ["cid", "shingle", "weight"])

    rows = stored(texts.select("cid", "text").mapInArrow(
        shingle, "cid bigint, shingle bigint, weight double"), "shingles")
    counted = rows.join(rows.groupBy("shingle").agg(F.count("*").alias("n")), "shingle")
    own = Window.partitionBy("cid")
    before = own.orderBy("n", "shingle").rowsBetween(Window.unboundedPreceding, -1)
    prefixes = counted.select(
        "cid", "shingle", "n", F.sum("weight").over(own).alias("weight"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("rarer"),
        (F.max("weight").over(own) == 1).alias("plain")
    ).withColumn("rest", F.col("weight") - F.col("rarer")).drop("rarer").where((F.col("n") > 1) & (F.col("rest") >= threshold * F.col("weight") - 1e-9))
    prefixes = stored(prefixes.join(placed, "cid"), "prefixes")
    several = prefixes.groupBy("shingle").agg(
        F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    probe = prefixes.join(several.select("shingle"), "shingle")
    least = 2 * threshold / (1 + threshold)
    probe = probe.withColumn("early", F.col("rest") >= least * F.col("weight") - 1e-9)
    columns = ("cid", "component", "rest", "weight", "plain", "early")
    first, second = (probe.select("shingle", *[F.col(c).alias(f"{c}_{side}") for c in columns])
                     for side in "ab")
    common = F.least("rest_a", "rest_b")
    bound = F.when(F.col("plain_a") & F.col("plain_b"),
                   common / (F.col("weight_a") + F.col("weight_b") - common)).otherwise(
        1 / (F.col("weight_a") / F.col("rest_a") + F.col("weight_b") / F.col("rest_b") - 1))
    possible = ((F.col("component_a") != F.col("component_b")) & (bound >= threshold - 1e-9)
                & (~F.col("early_b") | (F.col("cid_a") < F.col("cid_b"))))
    return (first.where("early_a").withColumnRenamed("shingle", "s")
            .join(second, (F.col("s") == F.col("shingle")) & possible)
            .select(F.least("cid_a", "cid_b").alias("a"), F.greatest("cid_a", "cid_b").alias("b"))
            .distinct())


def _per_row(column: pa.Array, n: int):
    owner, value, weight = weighted_shingles(column)
    cut = np.searchsorted(owner, np.arange(n + 1))
    return [(value[cut[k]:cut[k + 1]], weight[cut[k]:cut[k + 1]]) for k in range(n)]


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Classes of documents linked by near-equal texts: doc_id, key, class_id, keeper.

    Texts are signed with 32 bands of registers, seven a band at 0.8 and fewer at lower thresholds: texts
    at the threshold agree in some band with a probability of 0.999 at least. In every band the texts
    that agree are compared with the one that agrees with most others in all, and links are kept where
    the exact probability Jaccard of five-word shingles (weighted by count) reaches ``threshold``. Texts
    that share a band but are not connected after that are compared with each other where a prefix
    filter, which is exact, leaves a link possible. So no link within a band is lost, and a group of
    copies is not paired out.

    ``class_id`` is the smallest doc_id of all documents reachable over links; ``key`` the MD5 of the
    text; ``keeper`` marks the class's one text and id to keep. Equal texts are always together;
    null and empty texts are equal, and texts without words meet only their copies. A null id names a
    class only if no document of it has another. Repeated rows each come out, with the same marks; an
    empty table gives no rows.
    """
    rows, classes = _classes(docs, threshold)
    banded = classes.select("cid", F.posexplode("bands").alias("band", "value"))
    shared = banded.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(banded.join(shared, ["band", "value"]), "members")
    # The center of a group of copies is in larger buckets than the copies, which agree with it more
    # than with each other: it is the one to compare with.
    crowd = members.groupBy("cid").agg(F.sum("n").alias("crowd"))
    ranked = members.join(crowd, "cid")
    first = F.max(F.struct("crowd", F.xxhash64("cid", "band"), F.col("cid").alias("c")))["c"]
    centers = ranked.groupBy("band", "value").agg(first.alias("center"))
    stars = stored(members.join(centers, ["band", "value"]).where("cid <> center").select(
        F.least("cid", "center").alias("a"), F.greatest("cid", "center").alias("b")).distinct(),
        "stars")
    texts = _texts_of(members.select("cid").distinct(), classes, docs)
    links = _verified(stars, texts, threshold)
    found = connected_components(links).withColumnRenamed("node", "cid")
    placed = members.select("band", "value", "cid").join(found, "cid", "left").withColumn(
        "component", F.coalesce("component", "cid"))
    mixed = placed.groupBy("band", "value").agg(
        F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    rest = stored(placed.join(mixed.select("band", "value"), ["band", "value"])
                  .select("cid", "component").distinct(), "rest")
    close = stored(_possible_pairs(rest.select("cid").join(texts, "cid"), rest, threshold)
                   .join(stars, ["a", "b"], "left_anti"), "close")
    if not close.isEmpty():
        # The stars found so far stand for their links.
        more = _verified(close, texts, threshold).unionByName(
            found.select(F.col("cid").alias("a"), F.col("component").alias("b")))
        found = connected_components(more).withColumnRenamed("node", "cid")
    member = classes.join(found, "cid", "left").withColumn(
        "component", F.coalesce("component", "cid"))
    best = member.groupBy("component").agg(
        F.min(F.struct(F.col("rep").isNull(), "rep", "key")).alias("best"))
    named = stored(member.join(best, "component").select(
        "key", F.col("best.rep").alias("class_id"), (F.col("best.key") == F.col("key")).alias("own")),
        "named")
    return rows.join(named, "key").select(
        "doc_id", "key", "class_id",
        (F.col("own") & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("keeper"))


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class, the one with the smallest id; same columns."""
    key = unused_name(docs, "__key")
    keepers = stored(near_duplicates(docs, threshold).where("keeper")
                     .select(F.col("key").alias(key), "doc_id").distinct(), "keepers")
    kept = null_safe_join(docs.withColumn(key, text_key()), keepers, [key, "doc_id"])
    return kept.dropDuplicates([key, "doc_id"]).select(*docs.columns)


def op8_prob_minhash(spark, docs: DataFrame) -> DataFrame:
    """The class of every document; odd rows as in ``near_duplicates``."""
    return near_duplicates(docs).select(
        "doc_id", "class_id", F.col("keeper").alias("kept"))
