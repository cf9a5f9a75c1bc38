"""The native operators: shards, mixing and URL rules."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stationcast.llm import mixing, oracles, queries, sharding, urls
from tests import compare
from tests.llm.conftest import ODD_ROWS, make_docs


def check_shards(rows, shards=40):
    by_shard = defaultdict(list)
    for row in rows:
        by_shard[row["shard"]].append(row["slot"])
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert set(by_shard) <= set(range(shards))


def test_shards_are_balanced_and_contiguous(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = queries.QUERIES["op10_byte_shards"](spark, small).collect()
    assert len(rows) == len(texts)
    check_shards(rows)
    total, size = defaultdict(int), 0
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
        assert (r["law"], r["grown_shard"]) == ("bytes", None)
        total[r["shard"]] += r["size"]
        size = max(size, r["size"])
    target = sum(total.values()) / 40
    assert all(abs(t - target) <= size + 0.02 * target for t in total.values())
    placed = sorted(sharding.assign_shards(docs).collect(), key=lambda r: (r["shard"], r["slot"]))
    keys = [(r["group"], r["id_key"]) for r in placed]
    assert keys == sorted(keys)


def test_shards_of_odd_and_no_rows(spark, odd_docs, no_docs):
    rows = sharding.op10_byte_shards(spark, odd_docs).collect()
    assert len(rows) == len(ODD_ROWS)
    check_shards(rows)
    assert {(r["doc_id"], r["size"]) for r in rows if r["doc_id"] in (3, 4)} == {(3, 16), (4, 16)}
    assert sharding.op10_byte_shards(spark, no_docs).collect() == []
    out = sharding.shard_rows(odd_docs, 5)
    assert out.columns == odd_docs.columns and out.count() == len(ODD_ROWS)
    assert sharding.shard_rows(no_docs).count() == 0


def test_a_third_of_all_rows_in_one_group(spark):
    docs = make_docs(spark, [(k, "copy of one text" if k % 3 == 0 else f"text number {k}", "a")
                             for k in range(3000)])
    rows = sharding.op10_byte_shards(spark, docs).collect()
    check_shards(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["shard"]] += r["size"]
    assert len(sizes) == 40 and max(sizes.values()) < 1.1 * min(sizes.values())
    # Rows with their shard agree with the slots' shards.
    by_id = {r["doc_id"]: r["shard"] for r in rows}
    assert {r["doc_id"]: int(r["shard"]) for r in sharding.shard_rows(docs).collect()} == by_id


def targets_by_hand(sizes: dict, weights=(5, 2, 1), cap=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, full, open_ = sum(sizes.values()), {}, set(order)
    while open_:
        left = total - sum(full.values())
        share = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        above = {s for s in open_ if share[s] >= cap * sizes[s]}
        if not above:
            return full | share
        full |= {s: cap * sizes[s] for s in above}
        open_ -= above
    return full


def check_mix(rows, limit):
    sizes, taken, target, largest = (defaultdict(float) for _ in range(4))
    for r in rows:
        s = r["source"]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        largest[s] = max(largest[s], r["size"])
        assert r["taken"] % max(1, r["size"]) == 0 and r["taken"] <= 3 * r["size"]
    assert target == pytest.approx(targets_by_hand(sizes))
    for s in sizes:
        assert abs(taken[s] - target[s]) <= limit * largest[s] + 1e-6, s


def test_mix_meets_its_targets(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = mixing.copies_to_take(docs).collect()
    check_mix(rows, 0.5)
    words = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in docs.collect()}
    assert {r["doc_id"]: r["size"] for r in rows} == words
    again = queries.QUERIES["op3_pareto_mix"](spark, small).collect()
    assert {(r["doc_id"], r["taken"]) for r in again} == {(r["doc_id"], r["taken"]) for r in rows}


def test_small_sources_stop_at_three_copies(spark):
    docs = make_docs(spark, [(k, "w " * (1 + k % 7), "abcdef"[min(5, k // 10)] if k < 700 else None)
                             for k in range(900)])
    rows = mixing.copies_to_take(docs).collect()
    check_mix(rows, 0.5)
    assert max(r["copies"] for r in rows if r["source"] == "a") == 3
    # The whole copies come first, then the Pareto sample.
    assert {r["copies"] for r in rows if r["source"] == "f"} <= {0, 1}


def test_a_cut_between_documents_is_met(spark, tmp_path):
    # 240 words share as 150, 60 and 30: whole documents of ten words meet each of them.
    equal = [(k, " ".join(["w"] * 10), "abc"[k % 3]) for k in range(24)]
    empty = [(100 + k, "", "abc"[k % 3]) for k in range(60)]
    for number, rows in enumerate((equal, equal + empty)):
        docs = make_docs(spark, rows)
        (folder := tmp_path / str(number)).mkdir()
        pq.write_table(docs.toArrow(), folder / "documents.parquet")
        taken = defaultdict(int)
        for r in mixing.copies_to_take(docs).collect():
            taken[r["source"]] += r["taken"]
        assert taken == {"a": 150, "b": 60, "c": 30}
        assert compare.differences(mixing.op3_pareto_mix(spark, docs), compare.duck(str(folder)),
                                   oracles.ORACLES["op3_pareto_mix"]) == []


def test_mixed_rows_repeat_whole_rows(spark, odd_docs, no_docs):
    taken = {(r["doc_id"], r["size"]): r["copies"]
             for r in mixing.copies_to_take(odd_docs).collect()}
    out = mixing.mixed_rows(odd_docs)
    assert out.columns == odd_docs.columns
    found = defaultdict(int)
    for r in out.collect():
        assert r["size"] == "own"
        found[r["doc_id"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))] += 1
    repeats = defaultdict(int)
    for i, t, _ in ODD_ROWS:
        repeats[i, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))] += 1
    assert found == {k: n * repeats[k] for k, n in taken.items() if n}
    assert mixing.mixed_rows(no_docs).collect() == []
    assert mixing.copies_to_take(no_docs).collect() == []


def test_weights_make_unequal_copies(spark):
    docs = make_docs(spark, [(k, "w " * 5, "ab"[k % 2]) for k in range(2000)])
    rows = mixing.copies_to_take(docs, weight=F.when(F.col("doc_id") < 400, 6.0).otherwise(1.0)
                                 ).collect()
    for s in "ab":
        part = [r for r in rows if r["source"] == s]
        assert abs(sum(r["taken"] for r in part) - part[0]["target"]) <= 5
        heavy = [r["copies"] for r in part if r["doc_id"] < 400]
        light = [r["copies"] for r in part if r["doc_id"] >= 400]
        assert sum(heavy) / len(heavy) > 2 * sum(light) / len(light) and max(heavy) <= 3


URLS = ["http://Example.COM/en/1", "https://www.example.com/en/x?q#f", "https://a.b.example.com/fr/",
        "http://x.net/es/", "http://net/fr/1", "http://badnet/fr/1", "http://casino.example.org/a",
        "http://free-bets.org/", "http://m.example.org/EN/", "http://example.com", "no url", "", None,
        "http://a.com/en/", "http://x.org/xxx/1", "//y.com/en", "ftp://net/es/?://com/en/",
        "http://example.com:80/en/", "http://exam-ple.com/en", "http://user@net/es/a"]


def judge_by_hand(url, rules=urls.RULES):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule in rules:
        if rule.decides:
            h, _, p = rule.name.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p) \
                    and (best is None or len(rule.name) > len(best.name)):
                best = rule
    pattern = next((r for r in rules if not r.decides and re.search(r.pattern, host + path)), None)
    return (host, path, best.name if best else None,
            best.verdict if best else "block" if pattern else "allow")


def test_urls_match_plain_rules(spark, small):
    pages = spark.createDataFrame([(k, u, "x", "own") for k, u in enumerate(URLS * 2)],
                                  "page_id long, url string, html string, verdict string")
    table = spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url")
    for frame in (pages, table):
        expected = {r["page_id"]: judge_by_hand(r["url"]) for r in frame.collect()}
        rows = urls.op5_url_rules(spark, frame).collect()
        assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows} \
            == expected and len(rows) == len(expected)
    assert urls.op5_url_rules(spark, pages.limit(0)).collect() == []


def test_each_rule_is_filed_once_under_its_rarest_token(spark):
    rules = urls.rule_table(spark, [
        urls.prefix_rule("block", "rare.common.com/"), urls.pattern_rule("block", "any", "zz"),
        urls.prefix_rule("allow", "com/")])
    pages = spark.createDataFrame(
        [(k, f"http://h{k}.common.com/") for k in range(20)] + [(99, "http://rare.common.com/zz")],
        "page_id long, url string")
    rows = {r["page_id"]: (r["rule"], r["pattern"], r["verdict"])
            for r in urls.judge_pages(pages, rules).collect()}
    assert rows[99] == ("rare.common.com/", "any", "block")
    assert all(rows[k] == ("com/", None, "allow") for k in range(20))
