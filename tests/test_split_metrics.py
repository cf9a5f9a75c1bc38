from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationcast.operators import metrics, split


def rows_of(spark, n):
    return spark.range(n).select(
        F.concat(F.lit("c"), (F.col("id") % 5).cast("string")).alias("city"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 5).cast("int")).alias("date"))


def sizes(df):
    return {r.split: r["count"] for r in df.groupBy("split").count().collect()}


@pytest.mark.parametrize("n", [8, 9, 400, 8985])
def test_exact_split_sizes(spark, n):
    got = sizes(split.split_64_16_20(rows_of(spark, n), exact=True))
    test = math.ceil(n * 0.2)
    validate = math.ceil((n - test) * 0.2)
    assert got == {"test": test, "validate": validate, "train": n - test - validate}


def test_hash_split_is_near_its_shares_and_ignores_partitioning(spark):
    df = rows_of(spark, 20000)
    one = split.split_64_16_20(df)
    share = {k: v / 20000 for k, v in sizes(one).items()}
    assert share["test"] == pytest.approx(0.2, abs=0.01)
    assert share["validate"] == pytest.approx(0.16, abs=0.01)
    two = split.split_64_16_20(df.repartition(7, F.rand(1)))
    assert one.exceptAll(two).count() == 0
    assert split.split_64_16_20(df, seed=7).exceptAll(one).count() > 0


@pytest.mark.parametrize("n", [0, 4, 7])
def test_too_few_rows(spark, n):
    with pytest.raises(ValueError, match="fewer than 8"):
        split.require_enough_rows(rows_of(spark, n))


def test_encoder_is_alphabetical(spark):
    df = spark.createDataFrame([("Rain",), ("Clear",), ("Unknown",), ("Rain",)],
                               "y_condition STRING")
    got = {(r.y_condition, r.y_condition_code) for r in split.encode_condition(df).collect()}
    assert got == {("Clear", 0), ("Rain", 1), ("Unknown", 2)}


def test_temperature_scores(spark):
    rng = np.random.default_rng(1)
    y, p, t = rng.normal(10, 5, (3, 500))
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(y, p, t)],
                               "y DOUBLE, p DOUBLE, t DOUBLE")
    got = metrics.evaluate_temperature(df, "y", "p", "t").first()
    assert got.mae_c == pytest.approx(np.abs(y - p).mean())
    assert got.rmse_c == pytest.approx(math.sqrt(((y - p) ** 2).mean()))
    assert got.r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert got.baseline_persistence_mae_c == pytest.approx(np.abs(y - t).mean())


@pytest.mark.parametrize("scores, expected", [([1.0, 1.0], 1.0), ([1.0, 2.0], 0.0)])
def test_r2_of_constant_truth(spark, scores, expected):
    df = spark.createDataFrame([(1.0, s, 0.0) for s in scores], "y DOUBLE, p DOUBLE, t DOUBLE")
    assert metrics.evaluate_temperature(df, "y", "p", "t").first().r2 == expected


def test_precipitation_scores_with_a_hot_score(spark):
    """A third of the rows share one probability; ties count half in AUC."""
    rng = random.Random(2)
    data = []
    for i in range(900):
        p = 0.25 if i % 3 == 0 else round(rng.random(), 2)
        data.append((float(rng.random() < p), p))
    data += [(1.0, 1.0), (0.0, 0.0)]
    df = spark.createDataFrame(data, "y DOUBLE, p DOUBLE")
    got = metrics.evaluate_precipitation(df, "y", "p").first()
    wet = [p for y, p in data if y]
    dry = [p for y, p in data if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in wet for b in dry) / (len(wet) * len(dry))
    n = len(data)
    eps = metrics.EPSILON

    def loss(y, p):
        return -math.log(min(max(p if y else 1 - p, eps), 1 - eps))

    assert got.roc_auc == pytest.approx(auc)
    assert got.accuracy == pytest.approx(sum((p >= 0.5) == (y == 1) for y, p in data) / n)
    assert got.log_loss == pytest.approx(sum(loss(y, p) for y, p in data) / n)
    assert got.brier == pytest.approx(sum((p - y) ** 2 for y, p in data) / n)
    assert got.base_rate == pytest.approx(len(wet) / n)
    assert got.baseline_majority_accuracy == pytest.approx(max(len(wet), len(dry)) / n)


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([(1.0, 0.2), (1.0, 0.7)], "y DOUBLE, p DOUBLE")
    assert metrics.evaluate_precipitation(df, "y", "p").first().roc_auc is None


def test_condition_scores_count_absent_classes(spark):
    rng = random.Random(4)
    k, data = 5, []
    for _ in range(300):
        raw = [rng.choice([1, 1, 2, 3]) for _ in range(k)]
        data.append((rng.choice([0, 0, 1, 3]), [v / sum(raw) for v in raw]))
    got = metrics.evaluate_condition(
        spark.createDataFrame(data, "y INT, p ARRAY<DOUBLE>"), "y", "p", k).first()
    guess = [p.index(max(p)) for _, p in data]
    truth = [y for y, _ in data]
    f1 = []
    for c in range(k):
        hits = sum(y == c == g for y, g in zip(truth, guess))
        total = truth.count(c) + guess.count(c)
        f1.append(2 * hits / total if total else 0.0)
    n = len(data)
    assert got.accuracy == pytest.approx(sum(y == g for y, g in zip(truth, guess)) / n)
    assert got.macro_f1 == pytest.approx(sum(f1) / k)
    assert got.log_loss == pytest.approx(sum(-math.log(p[y]) for y, p in data) / n)
    assert got.baseline_majority_accuracy == pytest.approx(max(map(truth.count, range(k))) / n)
