"""The document operators against brute force, on the small tables and on odd rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stationcast.llm import (components, decontamination, embeddings, lm, minhash, quality, queries,
                             substrings, toxicity)
from stationcast.llm.text import split_words
from tests.llm.conftest import LONG, ODD_ROWS, make_docs


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def documents(spark, small):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}


def held(doc_id, remainder):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == remainder


def auc(scores, labels):
    rank = pd.Series(scores).rank().to_numpy()
    y = np.asarray(labels) == 1
    return (rank[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())


# --- language model ------------------------------------------------------------------------------

def base_by_hand(texts):
    tokens = [[*spaced(lower(t)), None] for _, t in texts]
    count = Counter(w for (i, _), ws in zip(texts, tokens) if not held(i, 1) for w in ws)
    total, types = sum(count.values()), len(count)
    return [(i, held(i, 1), len(ws), sum(w in count for w in ws), total,
             sum(math.log10((count[w] + .5) / (total + .5 * (types + 1))) for w in ws))
            for (i, _), ws in zip(texts, tokens)]


def check_base(rows, texts):
    def order(t):
        return (t[0] is None, t[0] or 0, t[2], t[5])

    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                   r["base_score"]) for r in rows), key=order)
    expected = sorted(base_by_hand(texts), key=order)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert [g[5] for g in got] == pytest.approx([e[5] for e in expected], rel=1e-9)


def test_language_model(spark, small):
    rows = queries.QUERIES["op1_subword_lattice"](spark, small).collect()
    check_base(rows, list(documents(spark, small).items()))
    seen = [r for r in rows if not r["held_out"]]
    assert sum(r["score"] for r in seen) > sum(r["base_score"] for r in seen)
    assert all(r["score"] < 0 for r in rows)
    # A model without classes finds held-out texts less likely.
    docs = spark.read.parquet(f"{small}/documents.parquet")
    flat = lm.score_documents(docs, ~lm.in_fold(F.col("doc_id"), 1)).where("held_out").agg(
        F.sum("score")).first()[0]
    assert sum(r["score"] for r in rows if r["held_out"]) > flat


def test_language_model_of_odd_and_no_rows(spark, odd_docs, no_docs):
    rows = lm.op1_subword_lattice(spark, odd_docs).collect()
    check_base(rows, [(i, t) for i, t, _ in ODD_ROWS])
    assert all(math.isfinite(r["score"]) for r in rows)
    assert lm.op1_subword_lattice(spark, no_docs).collect() == []
    # Nothing to learn from: still one finite score a row.
    untrained = lm.score_documents(odd_docs, F.lit(False)).collect()
    assert len(untrained) == len(ODD_ROWS) and {r["train_tokens"] for r in untrained} == {0}
    assert all(math.isfinite(r["score"]) for r in untrained)


def test_probabilities_of_all_texts_stay_below_one(spark):
    words = ["a", "b", "ab", "ba"]
    docs = make_docs(spark, [(k, " ".join(np.random.default_rng(k).choice(words, k % 3)), "s")
                             for k in range(60)])
    asked = [" ".join(t) for n in range(3) for t in __import__("itertools").product(words, repeat=n)]
    both = docs.withColumn("train", F.lit(True)).unionByName(make_docs(
        spark, [(1000 + k, t, "s") for k, t in enumerate(asked)]).withColumn("train", F.lit(False)))
    rows = lm.score_documents(both, F.col("train")).where("held_out").collect()
    assert 0.5 < sum(10 ** r["score"] for r in rows) < 1


# --- quality and toxicity -------------------------------------------------------------------------

@pytest.mark.parametrize("name, label, least", [("op2_line_field", "quality", 0.99),
                                                ("op4_noisy_channel", "toxic", 0.75)])
def test_held_out_labels(spark, small, name, label, least):
    rows = {r["doc_id"]: r for r in queries.QUERIES[name](spark, small).collect()}
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    assert len(rows) == len(documents(spark, small))
    assert all(r["held_out"] == held(i, 0) and 0 <= r["score"] <= 1 for i, r in rows.items())
    bound = 0.3 if label == "quality" else 0.5
    assert all(r["predicted"] == (r["score"] >= bound) for r in rows.values())
    ids = [i for i in labels if held(i, 0)]
    assert auc([rows[i]["score"] for i in ids], [labels[i] for i in ids]) > least
    wrong = sum(rows[i]["predicted"] != labels[i] for i in ids)
    assert wrong <= 0.06 * len(ids)


def test_scores_of_odd_and_no_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 1, 0), (7, 1, 0), (8, 0, 1), (9, None, None), (None, 1, 1), (8, 0, 0)],
        "doc_id long, quality int, toxic int")
    for run in (quality.op2_line_field, toxicity.op4_noisy_channel):
        rows = run(spark, odd_docs, labels).collect()
        assert len(rows) == len(ODD_ROWS)
        assert all(0 <= r["score"] <= 1 for r in rows)
        assert run(spark, no_docs, labels).collect() == []
        for r in run(spark, odd_docs, labels.limit(0)).collect():
            assert r["predicted"] == (1 if run is quality.op2_line_field else 0)
    kept = quality.keep_good(odd_docs, labels)
    assert kept.columns == odd_docs.columns
    assert {r["quality"] for r in kept.collect()} <= {"own"}


def test_disguised_words_are_found(spark):
    rng = np.random.default_rng(5)
    words = ["river", "stone", "garden", "window", "letter", "morning", "paper", "silver"]

    def text(bad=None):
        parts = list(rng.choice(words, 12))
        if bad:
            parts[3], parts[8] = bad
        return " ".join(parts)

    rows, labels = [], []
    for k in range(300):
        toxic = k % 4 == 0
        rows.append((k, text(("grobnik", "vaslute")) if toxic else text(), "s"))
        labels.append((k, int(toxic)))
    asked = [("gr0bn1k", "v@slut3"), ("g r o b n i k", "vaaaslute"), ("g.r.o.b.n.i.k", "va-slute")]
    rows += [(1000 + k, text(pair), "s") for k, pair in enumerate(asked)]
    rows += [(2000 + k, text(), "s") for k in range(20)]
    scored = {r["doc_id"]: r["predicted"] for r in toxicity.op4_noisy_channel(
        spark, make_docs(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    ).collect()}
    assert [scored[1000 + k] for k in range(len(asked))] == [1] * len(asked)
    assert not any(scored[2000 + k] for k in range(20))


# --- repeated passages ----------------------------------------------------------------------------

def removed_by_hand(texts, window=35):
    words = [spaced(t) for _, t in texts]
    seen = Counter(tuple(w[k:k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(texts, words):
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k:k + window])] > 1:
                gone[k:k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def check_passages(spark, docs, texts):
    rows = substrings.op6_recompression(spark, docs).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows),
                  key=str) == removed_by_hand(texts)


def test_repeated_passages(spark, small):
    check_passages(spark, spark.read.parquet(f"{small}/documents.parquet"),
                   list(documents(spark, small).items()))


def test_repeated_passages_of_odd_and_no_rows(spark, odd_docs, no_docs):
    check_passages(spark, odd_docs, [(i, t) for i, t, _ in ODD_ROWS])
    assert substrings.op6_recompression(spark, no_docs).collect() == []


def test_passages_in_runs_and_at_edges(spark):
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(400)]
    passage, pair = list(rng.choice(words, 60)), ["ping", "pong"]

    def some(n):
        return list(rng.choice(words, n))

    texts = [some(50) + passage + some(40), passage + some(10), some(3) + passage[:35],
             some(5) + passage[1:36] + some(5), some(30) + passage[10:44] + some(30),
             pair * 100, some(20) + pair * 30 + some(20), ["echo"] * 300, some(9) + ["echo"] * 35,
             some(40) + ["echo"] * 34 + some(40), some(200) + passage + some(20) + passage, some(34),
             passage + passage, some(35)]
    rows = [(k, " ".join(t), "s") for k, t in enumerate(texts)]
    rows += [(100 + k, " ".join(texts[0]), "s") for k in range(30)]
    check_passages(spark, make_docs(spark, rows), [(i, t) for i, t, _ in rows])


def test_equal_windows_have_equal_witnesses():
    rng = np.random.default_rng(11)
    passage = rng.integers(0, 50, 80).astype(np.uint64)
    for _ in range(50):
        a, b = (rng.integers(0, 50, n).astype(np.uint64) for n in rng.integers(0, 60, 2))
        c, d = (rng.integers(0, 50, n).astype(np.uint64) for n in rng.integers(0, 60, 2))
        texts = [np.concatenate([a, passage, b]), np.concatenate([c, passage, d])]
        first = np.cumsum([0, *map(len, texts)])
        witnesses = substrings.Witnesses(np.concatenate(texts), first)
        vouched = defaultdict(set)
        for names, low, high, here in witnesses.levels:
            for name, start, stop in zip(names.tolist(), low.tolist(), high.tolist()):
                for p in range(start, stop):
                    if here[p]:
                        vouched[p].add(name)
        for k in range(80 - substrings.WINDOW + 1):
            left = vouched[len(a) + k]
            assert left and left == vouched[first[1] + len(c) + k]


# --- near duplicates ------------------------------------------------------------------------------

def shingles(text, size=5):
    words = spaced(lower(text))
    if len(words) < size:
        return Counter([tuple(words)] if words else [])
    return Counter(tuple(words[k:k + size]) for k in range(len(words) - size + 1))


def similarity(a, b):
    total = 0.0
    for x in a.keys() & b.keys():
        total += 1 / sum(max(a[y] / a[x], b[y] / b[x]) for y in a.keys() | b.keys())
    return total


def classes_by_hand(texts):
    parent = list(range(len(texts)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    sets = [shingles(t) for _, t in texts]
    for a in range(len(texts)):
        for b in range(a):
            same = (texts[a][1] or "") == (texts[b][1] or "")
            if same or (min(len(sets[a]), len(sets[b])) > 0.5 * max(len(sets[a]), len(sets[b]))
                        and len(sets[a].keys() & sets[b].keys()) > 0.5 * len(sets[a])
                        and similarity(sets[a], sets[b]) >= 0.8):
                parent[root(a)] = root(b)
    return [root(k) for k in range(len(texts))]


def check_classes(rows, texts):
    groups = defaultdict(list)
    for (i, _), r in zip(texts, classes_by_hand(texts)):
        groups[r].append(i)
    assert Counter((r["doc_id"], r["class_id"]) for r in rows) == Counter(
        (i, min(g, key=lambda x: (x is None, x or 0))) for g in groups.values() for i in g)
    return len(groups)


def test_near_duplicates(spark, small):
    texts = [(i, t) for i, t in documents(spark, small).items() if len(t) < 3000][:500]
    docs = make_docs(spark, [(i, t, "s") for i, t in texts])
    rows = minhash.op8_prob_minhash(spark, docs).collect()
    n = check_classes(rows, texts)
    assert sum(r["kept"] for r in rows) == n
    assert minhash.one_of_each(docs).count() == n


def test_near_duplicates_of_odd_and_no_rows(spark, odd_docs, no_docs):
    rows = minhash.op8_prob_minhash(spark, odd_docs).collect()
    n = check_classes(rows, [(i, t) for i, t, _ in ODD_ROWS])
    kept = minhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == n
    assert {r["key"] for r in kept.collect()} == {"own"}
    assert minhash.op8_prob_minhash(spark, no_docs).collect() == []
    assert minhash.one_of_each(no_docs).count() == 0


def test_chains_of_links_are_one_class(spark):
    rng = np.random.default_rng(8)
    words = [f"t{k}" for k in range(500)]
    text, rows = list(rng.choice(words, 200)), []
    for k in range(40):                       # each step changes a little, the ends share little
        rows.append((k, " ".join(text), "s"))
        at = (k * 11) % 190
        text = text[:at] + list(rng.choice(words, 2)) + text[at + 2:]
    rows += [(100 + k, " ".join(rng.choice(words, 150)), "s") for k in range(50)]
    check_classes(minhash.op8_prob_minhash(spark, make_docs(spark, rows)).collect(),
                  [(i, t) for i, t, _ in rows])


def test_registers_estimate_probability_jaccard():
    texts = ["a b c d e f g h i j", "a b c d e f g h i x y z", "a b c d e a b c d e a b c d e q"]
    owner, value, weight = minhash.weighted_shingles(pa.array(texts))
    found = minhash.signatures(owner, value, weight, 3, 4000)
    cut = np.searchsorted(owner, np.arange(4))
    for a, b in ((0, 1), (0, 2), (1, 2)):
        exact = similarity(shingles(texts[a]), shingles(texts[b]))
        parts = [(value[cut[k]:cut[k + 1]], weight[cut[k]:cut[k + 1]]) for k in (a, b)]
        assert minhash.probability_jaccard(*parts[0], *parts[1]) == pytest.approx(exact)
        assert (found[a] == found[b]).mean() == pytest.approx(exact, abs=0.035)


def test_components_of_paths_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(500, k) for k in range(501, 600)] \
        + [(700, 701), (701, 700), (702, 702)]
    rows = components.connected_components(
        spark.createDataFrame([(float(a), b) for a, b in edges], "a double, b long")
        .select(F.col("a").cast("long"), "b")).collect()
    expected = {k: 1 for k in range(1, 61)} | {k: 500 for k in range(500, 600)} | {700: 700, 701: 700}
    assert {r["node"]: r["component"] for r in rows} == expected and len(rows) == len(expected)


# --- vectors ---------------------------------------------------------------------------------------

def links_by_hand(vectors, threshold=0.9):
    good = {}
    for i, v in vectors:
        if i is not None and v is not None and len(v) == 16 and all(
                x is not None and math.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v) / np.abs(v).max()
    ids = sorted(good)
    x = np.array([good[i] / np.linalg.norm(good[i]) for i in ids])
    near = x @ x.T >= threshold
    parent = list(range(len(ids)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in zip(*np.nonzero(near)):
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {i: (int(near[k].sum()) - 1, ids[root(k)]) for k, i in enumerate(ids)}


def test_vectors_link_like_brute_force(spark):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(30, 16))
    vectors = [(k, (centers[k % 30] + rng.normal(scale=0.25, size=16)).tolist()) for k in range(300)]
    vectors += [(300 + k, vectors[0][1]) for k in range(50)]                  # copies
    vectors += [(400, (np.array(vectors[0][1]) * 1e150).tolist()), (401, [0.0] * 16), (402, None),
                (403, [None, *[1.0] * 15]), (404, [math.nan] * 16), (405, [math.inf] * 16),
                (406, [1.0, 2.0]), (407, []), (None, vectors[1][1]), (408, [-0.0, *[0.0] * 14, 1.0]),
                (409, [0.0, *[0.0] * 14, 1.0])]
    rows = embeddings.near_vectors(spark.createDataFrame(
        [(i, v, "own") for i, v in vectors], "vec_id long, embedding array<double>, rep string"))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in rows.collect()}
    expected = links_by_hand(vectors)
    assert len(got) == len(vectors)
    assert got.pop(None) == (0, None, False)
    found = sum(got[i][0] for i in expected)
    assert found >= 0.98 * sum(n for n, _ in expected.values())
    for i, (n, component, kept) in got.items():
        links, name = expected.get(i, (0, i))
        assert n <= links and kept == (i == component)
        assert (component == name) or n < links


def test_vectors_are_compared_within_each_dimension(spark):
    base = np.random.default_rng(6).normal(size=(3, 8)).tolist()
    vectors = [(k, base[k % 3]) for k in range(6)]                            # most have 8
    vectors += [(10, [1.0, 2.0, 3.0]), (11, [1.0, 2.0, 3.0]), (12, [1.0, 2.0, 3.1]),
                (13, [-3.0, 1.0, 0.0]), (20, [1.0, 2.0]), (21, [2.0, 4.0]),
                (30, [1.0] * 5), (31, [1.0] * 5)]
    rows = embeddings.near_vectors(spark.createDataFrame(
        vectors, "vec_id long, embedding array<double>")).collect()
    expected = {k: (1, k % 3) for k in range(6)} | {10: (2, 10), 11: (2, 10), 12: (2, 10),
                13: (0, 13), 20: (1, 20), 21: (1, 20), 30: (1, 30), 31: (1, 30)}
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rows} == expected


def test_vectors_of_the_small_table(spark, small):
    rows = queries.QUERIES["op7_iterative_quantisation"](spark, small).collect()
    table = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    x = np.array([r["embedding"] for r in table], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    expected = dict(zip([r["vec_id"] for r in table], ((x @ x.T >= 0.9).sum(axis=1) - 1).tolist()))
    assert {r["vec_id"]: r["n_links"] for r in rows} == expected
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embeddings.near_vectors(empty).collect() == []


def test_turned_codes_lose_little():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 16)) * np.linspace(3, 0.3, 16)
    x /= np.linalg.norm(x, axis=1)[:, None]
    turned = x @ embeddings.learn_rotation(x, 16)
    plain = x @ embeddings.learn_rotation(x, 16, rounds=0)

    def loss(v):
        return ((np.where(v >= 0, 1.0, -1.0) - v) ** 2).sum()

    assert loss(turned) < loss(plain)
    assert np.abs((turned >= 0).mean(axis=0) - 0.5).max() < 0.2
    assert embeddings.learn_rotation(x, 64).shape == (16, 64)


def common_direction(mean, n=3000, size=64, seed=12):
    """Unit noise around a common mean, and near copies of some of it."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, size)) + mean
    copies = x[:n // 5] + rng.normal(size=(n // 5, size)) * 0.35 * np.sqrt(
        (x[:n // 5] ** 2).mean(axis=1))[:, None]
    return np.vstack([x, copies])


def test_a_common_direction_does_not_make_all_vectors_candidates(spark):
    pairs = {}
    for mean in (0.0, 1.5):
        x = common_direction(mean)
        unit = x / np.linalg.norm(x, axis=1)[:, None]
        near = unit @ unit.T >= 0.9
        plan = embeddings.learn_codes(unit, len(unit), 0.9)
        table = spark.createDataFrame(pa.table({
            "rep": np.arange(len(x)), "copies": np.ones(len(x), np.int64), "embedding": x.tolist()}))
        codes = embeddings.encode(table, {64: plan})
        found = {(r.a, r.b) for r in embeddings.candidate_pairs(codes, {64: plan.width}, 0.9).collect()}
        links = {(i, j) for i, j in zip(*np.nonzero(near)) if i < j}
        assert len(found & links) >= 0.95 * len(links) > 100
        pairs[mean] = len(found)
    # Tables and signs of vectors without a common direction let 0.8 % of all pairs meet.
    assert pairs[0.0] <= pairs[1.5] < 0.008 * len(x) * (len(x) - 1) / 2


def test_tables_follow_the_rows():
    few, many = (embeddings.plan_tables(n, 0.144) for n in (10_000, 1_000_000_000))
    assert many[1] >= few[1] + 10 and many[0] < 400
    tables, width = few
    miss = 1 - (1 - 0.144) ** width - width * 0.144 * (1 - 0.144) ** (width - 1)
    assert miss ** tables <= 0.01


# --- benchmark -------------------------------------------------------------------------------------

def hits_by_hand(texts, items, size=10):
    windows = defaultdict(set)
    for name, text in items:
        w = plain(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[k:k + size])].add("null" if name is None else str(name))
    lengths = {len(w) for w in windows}
    out = []
    for i, text in texts:
        w, hit, names = plain(text), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                found = windows.get(tuple(w[k:k + n]))
                if found:
                    hit |= set(range(k, k + n))
                    names |= found
        out.append((i, len(w), len(hit), len(names),
                    hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def check_hits(spark, docs, benchmark, texts, items):
    rows = decontamination.op9_positional_index(spark, docs, benchmark).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"],
                    r["contaminated"]) for r in rows), key=str) == hits_by_hand(texts, items)


def test_benchmark_windows(spark, small, monkeypatch):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    benchmark = spark.read.parquet(f"{small}/benchmark.parquet")
    texts = list(documents(spark, small).items())
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    check_hits(spark, docs, benchmark, texts, items)
    # The same in several blocks of the benchmark.
    monkeypatch.setattr(decontamination, "BLOCK_WINDOWS", 300)
    check_hits(spark, docs, benchmark, texts, items)


def test_windows_are_filed_under_their_rarest_term(spark):
    items = spark.createDataFrame(
        [(1, "a b c d e f g h i j k"), (2, "A-B c d e f g h i j k"), (3, "x y"), (4, "..."), (None, None)],
        "item_id long, text string")
    pairs = decontamination.item_windows(items, 10).toArrow()
    assert pairs.num_rows == 5                # two windows in two items, one short one
    windows = decontamination.Windows(pairs, 10)
    term = {w: int(split_words(pa.array([w])).hashes().view(np.int64)[0]) for w in "abcdefghijkxy"}
    windows.rank({h: 5 + k for k, h in enumerate(term.values())} | {term["j"]: 1, term["y"]: 2})
    assert set(windows.rarest.tolist()) == {term["j"], term["y"]}

    def fetched(words):
        which, at = windows.fetched(np.sort([term[w] for w in words]))
        assert len(which) == len(at)
        return len(which)

    assert (fetched("abcdefghik"), fetched("jx"), fetched("y"), fetched("jy")) == (0, 2, 1, 3)


ITEMS = [(7, "one two three four five six seven eight nine ten"), (8, "Some WORDS"), (9, ""),
         (10, None), (None, "zweite zeile"), (11, "word0x0 word1x1 " * 6), (7, "same same same")]


def test_benchmark_of_odd_and_no_rows(spark, odd_docs, no_docs):
    benchmark = spark.createDataFrame([(i, t, "own") for i, t in ITEMS],
                                      "item_id long, text string, key string")
    check_hits(spark, odd_docs, benchmark, [(i, t) for i, t, _ in ODD_ROWS], ITEMS)
    check_hits(spark, odd_docs, benchmark.limit(0), [(i, t) for i, t, _ in ODD_ROWS], [])
    assert decontamination.op9_positional_index(spark, no_docs, benchmark).collect() == []
    kept = decontamination.clean_rows(odd_docs, benchmark)
    assert kept.columns == odd_docs.columns
    dirty = Counter(h[0] for h in hits_by_hand([(i, t) for i, t, _ in ODD_ROWS], ITEMS) if h[5])
    assert kept.count() == len(ODD_ROWS) - sum(dirty.values())


def test_proximity_matches(spark):
    docs = make_docs(spark, [(1, "alpha x beta y gamma", "s"), (2, "gamma beta alpha", "s"),
                             (3, "alpha beta " + "z " * 20 + "gamma", "s"), (4, "alpha beta", "s"),
                             (5, "gamma", "s"), (6, "z alpha z beta z z z gamma", "s")])
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    index = decontamination.build_index(docs)
    near = {r["doc_id"]: r["items"] for r in decontamination.search(index, items, slop=4).collect()}
    assert {i for i, found in near.items() if found} == {1, 2}
    exact = decontamination.search(index, items).where(F.size("items") > 0).collect()
    assert exact == []


def test_long_texts_are_read_whole(spark):
    tail = "the very last ten words of a long text here"
    docs = make_docs(spark, [(1, LONG + " " + tail, "s"), (2, tail, "s")])
    items = spark.createDataFrame([(1, tail)], "item_id long, text string")
    rows = {r["doc_id"]: r["n_hit"] for r in
            decontamination.op9_positional_index(spark, docs, items).collect()}
    assert rows == {1: 10, 2: 10}
    assert split_words(pa.array([LONG])).counts.tolist() == [30_000]
