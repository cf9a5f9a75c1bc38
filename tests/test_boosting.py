"""The booster against exhaustive search, in any number of blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stationcast.operators import boosting
from stationcast.operators.boosting import Bins, Ensemble, Spec


def spec(label="y", loss="squared", **other):
    return Spec(**({"key": "m", "label": label, "loss": loss, "outputs": 1, "rounds": 6, "depth": 3,
                    "step": 0.5, "min_weight": 1, "rows": 1.0, "columns": 1.0, "l2": 1.0} | other))


def make_rows(spark, n=400, seed=5):
    random = np.random.default_rng(seed)
    a, b = random.normal(size=n), random.integers(0, 6, n).astype(float)
    city = np.array(["ash", "birch", "cedar"])[random.integers(0, 3, n)]
    y = 2 * (a > 0.3) + b + 3 * (city == "birch") + random.normal(size=n) / 10
    a[random.random(n) < 0.2] = np.nan
    level = np.digitize(y, [2, 5]).astype(float)
    frame = pd.DataFrame({"city": city, "date": pd.date_range("2020-01-01", periods=n).date, "a": a, "b": b,
                          "y": y, "wet": (y > 4).astype(float), "level": level,
                          "split": np.where(np.arange(n) % 5 == 0, "validate", "train")})
    rows = frame.astype(object).where(frame.notna(), None)
    return frame, spark.createDataFrame(
        list(rows.itertuples(index=False, name=None)),
        "city STRING, date DATE, a DOUBLE, b DOUBLE, y DOUBLE, wet DOUBLE, level DOUBLE, split STRING")


@pytest.fixture(scope="module")
def made(spark):
    frame, rows = make_rows(spark)
    return frame, rows.cache()


def best_by_hand(frame, mask, bins, gradient, weight, s):
    """The largest gain over all columns, cuts, cities and directions of missing values."""
    g, h = gradient[mask].sum(), weight[mask].sum()
    best = 0.0
    numbers = [(frame[n].to_numpy(float), cuts) for n, cuts in zip(bins.names, bins.cuts)]
    sides = [(x <= c) | (np.isnan(x) & way) for x, cuts in numbers for c in [*cuts, np.inf]
             for way in (False, True)]
    sides += [(frame["city"] == c).to_numpy() for c in bins.cities]
    for left in sides:
        a, b = gradient[mask & left].sum(), weight[mask & left].sum()
        if min(b, h - b) >= s.min_weight:
            best = max(best, a * a / (b + s.l2) + (g - a) ** 2 / (h - b + s.l2) - g * g / (h + s.l2))
    return best


@pytest.mark.parametrize("label, loss", [("y", "squared"), ("wet", "logistic")])
def test_splits_are_the_best_there_are(spark, made, label, loss):
    frame, rows = made
    bins = boosting.fit_bins(rows.filter("split = 'train'"), ["a", "b"], True)
    s = spec(label, loss, rounds=2, l2=2.0, min_weight=3)
    fitted = boosting.boost(rows, bins, [s], 50)["m"]
    train = (frame["split"] == "train").to_numpy()
    truth = frame[label].to_numpy()
    margin = np.full(len(frame), fitted.start[0])
    binned = bins.bins(bins.numbers(frame[["a", "b"]].to_numpy(float),
                                    boosting.pa.array(frame["city"])))
    for (tree,) in fitted.growth.trees:
        p = boosting.probabilities(loss, margin)
        gradient, weight = p - truth, np.ones(len(frame)) if loss == "squared" else p * (1 - p)
        children = {int(c) + k: i for i, c in enumerate(tree["child"]) if tree["column"][i] >= 0
                    for k in (0, 1)}
        whole = boosting.descend(tree, binned)
        assert (tree["column"] >= 0).sum() > 1
        for node in range(len(tree["column"])):
            below = {node}
            for child in sorted(children):
                if children[child] in below:
                    below.add(child)
            mask = train & np.isin(whole, list(below))
            depth, up = 0, node
            while up in children:
                depth, up = depth + 1, children[up]
            if depth < s.depth:
                gain = best_by_hand(frame, mask, bins, gradient, weight, s)
                assert tree["gain"][node] == pytest.approx(gain, rel=1e-5, abs=1e-6)
            if tree["column"][node] < 0:
                value = -s.step * gradient[mask].sum() / (weight[mask].sum() + s.l2)
                assert tree["value"][node] == pytest.approx(value, rel=1e-5, abs=1e-7)
        margin = margin + tree["value"][whole]


def test_blocks_do_not_matter(spark, made):
    """One block without a shuffle, or many that meet in one: the same trees to the last bit."""
    _, rows = made
    bins = boosting.fit_bins(rows.filter("split = 'train'"), ["a", "b"], True)
    specs = [spec(key="t", rows=0.7, columns=0.67, rounds=15, seed=3),
             spec(key="c", label="level", loss="softmax", outputs=3, depth=2, rounds=14, rows=0.8)]
    one, many = (boosting.boost(rows, bins, specs, 50, block_rows=n) for n in (10_000, 60))
    for key in ("t", "c"):
        assert one[key].growth.curve == many[key].growth.curve
        for a, b in zip(one[key].growth.trees, many[key].growth.trees):
            for x, y in zip(a, b):
                assert all(np.array_equal(x[name], y[name]) for name in x)


def test_one_block_takes_many_levels_in_a_job(spark, made):
    """Levels do not cost a Spark job each, and how many a job takes does not change the trees."""
    _, rows = made
    bins = boosting.fit_bins(rows.filter("split = 'train'"), ["a", "b"], True)
    specs = [spec(key="t", rounds=20, rows=0.8, seed=3),
             spec(key="c", label="level", loss="softmax", outputs=3, depth=4, rounds=12, columns=0.67)]
    context = spark.sparkContext
    context.setJobGroup("one-block", "one block")
    found = boosting.boost(rows, bins, specs, 50)
    used = len(context.statusTracker().getJobIdsForGroup("one-block"))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert len(found["t"].growth.trees) == 20 and used < 20
    slowly = boosting.boost(rows, bins, specs, 50, slice_seconds=0)
    for key in found:
        assert found[key].growth.curve == slowly[key].growth.curve
        for a, b in zip(found[key].growth.trees, slowly[key].growth.trees, strict=True):
            for x, y in zip(a, b):
                assert all(np.array_equal(x[name], y[name]) for name in x)


def test_a_round_is_grown_once(spark, made, monkeypatch):
    _, rows = made
    bins = boosting.fit_bins(rows.filter("split = 'train'"), ["a", "b"])
    grown = []
    grow = boosting.Tree.grow

    def counted(tree, *args):
        grown.append((id(tree), tree.depth, tree))
        grow(tree, *args)

    monkeypatch.setattr(boosting.Tree, "grow", counted)
    s = spec(label="level", loss="softmax", outputs=3, rounds=30, depth=2)
    growth = boosting.boost(rows, bins, [s], 4)["m"].growth
    assert len({(i, d) for i, d, _ in grown}) == len(grown)
    # Every round up to patience, in each class; none after the curve has ended.
    assert len({i for i, _, _ in grown}) == 3 * len(growth.trees)
    assert len(growth.curve) == len(growth.trees) == min(30, growth.best + 5)


def test_directions_of_missing_values_beat_the_median(spark):
    """Where a value is missing says much: routing learns it, a median hides it."""
    random = np.random.default_rng(11)
    n = 1500
    x = random.normal(size=n)
    gone = random.random(n) < 0.4
    y = np.where(gone, 4.0, x) + random.normal(size=n) / 20
    split = np.where(np.arange(n) % 4 == 0, "validate", "train")
    days = pd.date_range("2000-01-01", periods=n).date

    def error(values):
        rows = spark.createDataFrame(
            [("c", d, None if v != v else float(v), float(t), str(p))
             for d, v, t, p in zip(days, values, y, split)],
            "city STRING, date DATE, x DOUBLE, y DOUBLE, split STRING")
        bins = boosting.fit_bins(rows.filter("split = 'train'"), ["x"])
        return min(boosting.boost(rows, bins, [spec(rounds=12)], 50)["m"].growth.curve)

    routed = error(np.where(gone, np.nan, x))
    filled = error(np.where(gone, np.median(x[~gone]), x))
    assert routed < 0.5 * filled


def test_classes_beat_the_majority(spark, made):
    frame, rows = made
    bins = boosting.fit_bins(rows.filter("split = 'train'"), ["a", "b"], True)
    fitted = boosting.boost(rows, bins, [spec(label="level", loss="softmax", outputs=3, rounds=12)], 5)
    model = Ensemble.of(fitted["m"], bins)
    scored = boosting.predicted(model, rows.filter("split = 'validate'"), "p").collect()
    assert all(sum(r.p) == pytest.approx(1) for r in scored)
    right = np.mean([int(np.argmax(r.p)) == r.level for r in scored])
    held = frame[frame["split"] == "validate"]["level"]
    assert right > held.value_counts(normalize=True).max() + 0.2


def test_predictions_follow_the_bins_and_survive_a_table(spark, made):
    frame, rows = made
    bins = boosting.fit_bins(rows.filter("split = 'train'"), ["a", "b"], True, max_bins=9)
    fitted = boosting.boost(rows, bins, [spec(rounds=8)], 50)["m"]
    model = Ensemble.of(fitted, bins)
    again = Ensemble.from_table(model.loss, model.start.tolist(), bins, model.table(spark))
    numbers = bins.numbers(frame[["a", "b"]].to_numpy(float), boosting.pa.array(frame["city"]))
    margin = np.full(len(frame), fitted.start[0])
    for (tree,) in fitted.growth.trees[:fitted.growth.best + 1]:
        margin += tree["value"][boosting.descend(tree, bins.bins(numbers))]
    assert np.allclose(model.predict(numbers)[:, 0], margin, atol=1e-12)
    assert np.array_equal(model.predict(numbers), again.predict(numbers))
    # An unknown city is no city of the training rows; all values may be missing.
    odd = bins.numbers(np.full((2, 2), np.nan), boosting.pa.array(["elsewhere", None]))
    assert np.isnan(odd).all() and np.isfinite(model.predict(odd)).all()


def test_odd_columns_and_tables(spark, made):
    _, rows = made
    odd = rows.withColumns({"empty": F.lit(None).cast("double"), "constant": F.lit(7.0),
                            "flag": (F.col("b") > 3).cast("int")})
    bins = boosting.fit_bins(odd.filter("split = 'train'"), ["empty", "constant", "flag"])
    assert [len(c) for c in bins.cuts] == [0, 1, 2]
    growth = boosting.boost(odd, bins, [spec(rounds=3)], 50)["m"].growth
    assert {int(c) for (t,) in growth.trees for c in t["column"]} <= {-1, 2}
    with pytest.raises(ValueError, match="no rows"):
        boosting.boost(rows.limit(0), bins, [spec()], 5)
    with pytest.raises(ValueError, match="two bins"):
        Bins(["a"], []) and boosting.fit_bins(rows, ["a"], max_bins=1)
