"""Gradient-boosted trees for many models at once, grown level by level over binned rows.

Columns are cut into quantile bins once; a row is one small number per column, 0 standing for a missing
value. Rows lie in blocks. One Spark job advances every model by one level: each block sums gradients per
(model, class, node, column, bin), the sums of all blocks meet in a shuffle, and the best split of each
node comes back, a few numbers. Rows and sums never reach the driver. A block that is the only one needs
no shuffle: every model is a task of its own then, and takes as many levels in a job as some seconds
allow. Margins are stored in the shared folder every few jobs; in between the trees grown since are
replayed, so that a lost executor costs a few levels.

Splits, leaf weights and stopping follow Chen and Guestrin, "XGBoost: A Scalable Tree Boosting System"
(2016): second-order gains with an L2 leaf weight, and at every split a learnt direction for missing
values. Gradients are rounded to multiples of 2**-24, so their sums do not depend on the order of
addition: the same rows give the same trees in any number of blocks.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from copy import deepcopy
from dataclasses import dataclass, field, replace
from functools import partial
from time import perf_counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.session import shared_dir

MAX_BINS = 64
BLOCK_ROWS = 1 << 16
STORE_EVERY = 12
SLICE_SECONDS = 15.0
GRAIN = float(1 << 24)
PARTS = ("train", "validate")


# --- columns to bins ----------------------------------------------------------------------------

@dataclass
class Bins:
    """How columns become bins: ascending cuts per numeric column, and the sorted cities.

    A number is in bin 1 + (cuts below it), a missing one in bin 0. The city is one column whose bins
    are the cities, bin 0 those that were not there in training; a split asks for one city.
    """

    names: list[str]
    cuts: list[np.ndarray]
    cities: list[str] = field(default_factory=list)

    @property
    def categorical(self) -> np.ndarray:
        return np.array([False] * len(self.names) + [True] * bool(self.cities))

    @property
    def sizes(self) -> np.ndarray:
        return np.array([len(c) + 2 for c in self.cuts]
                        + ([len(self.cities) + 1] if self.cities else []), np.int64)

    @property
    def offsets(self) -> np.ndarray:
        """Where each column's bins begin when the bins of all columns stand in one row."""
        return np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.int64)

    def numbers(self, values: np.ndarray, city: pa.Array | None) -> np.ndarray:
        """Column values of rows as numbers, cities by their place; NaN is missing."""
        if not self.cities:
            return values
        known = pa.array(self.cities, pa.string())
        places = pa.compute.index_in(city, value_set=known).cast(pa.float64())
        return np.column_stack([values, places.to_numpy(zero_copy_only=False)])

    def bins(self, numbers: np.ndarray) -> np.ndarray:
        out = np.empty(numbers.shape, np.uint32 if self.sizes.sum() > 0xFFFF else np.uint16)
        for j, (cuts, offset) in enumerate(zip([*self.cuts, None], self.offsets)):
            column = numbers[:, j]
            place = column if cuts is None else np.searchsorted(cuts, column)
            out[:, j] = offset + np.where(np.isnan(column), 0, 1 + np.nan_to_num(place))
        return out

    def labels(self) -> list[str]:
        """What a split can be about: the columns, and each city."""
        return [*self.names, *[f"city={city}" for city in self.cities]]


def fit_bins(train: DataFrame, names: list[str], city: bool = False,
             max_bins: int = MAX_BINS) -> Bins:
    """Quantile cuts of all columns in one pass of mergeable summaries, and the list of cities."""
    if max_bins < 2:
        raise ValueError("a column needs two bins at least")
    shares = [k / max_bins for k in range(1, max_bins)]
    cuts = []
    for start in range(0, len(names), 20):                # keeps the generated code small
        row = train.agg(*[F.percentile_approx(F.col(n).cast("double"), shares, 10_000).alias(f"c{i}")
                          for i, n in enumerate(names[start:start + 20])]).first()
        cuts += [np.unique(np.array(found if found is not None else [], float)) for found in row]
    cities = sorted(r[0] for r in train.select("city").dropna().distinct().collect()) if city else []
    return Bins(list(names), cuts, cities)


# --- what is fitted -----------------------------------------------------------------------------

@dataclass(frozen=True)
class Spec:
    """One model: the label, the loss (squared, logistic or softmax) and its settings."""

    key: str
    label: str
    loss: str
    outputs: int
    rounds: int
    depth: int
    step: float
    min_weight: float
    rows: float
    columns: float
    l2: float
    seed: int = 0

    def chosen_columns(self, number: int, total: int) -> np.ndarray:
        """The columns that round ``number`` may split on."""
        if self.columns >= 1:
            return np.arange(total)
        random = np.random.default_rng([self.seed, number])
        return np.sort(random.choice(total, max(1, int(total * self.columns)), replace=False))

    def chosen_rows(self, number: int, keys: np.ndarray) -> np.ndarray:
        """Whether round ``number`` learns from a row, by the row's own key."""
        if self.rows >= 1:
            return np.ones(len(keys), bool)
        salt = np.uint64((self.seed * 1_000_003 + number) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        x = keys ^ salt
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (x >> np.uint64(11)) < np.uint64(int(self.rows * (1 << 53)))


class Tree:
    """A growing tree. Node 0 is the root; the children of a node are neighbours."""

    def __init__(self):
        self.column, self.bin, self.missing_left = [-1], [0], [False]
        self.child, self.gradient, self.weight, self.gain = [0], [0.0], [0.0], [0.0]
        self.active, self.depth = [0], 0

    def grow(self, spec: Spec, found: dict[str, np.ndarray]) -> None:
        """Split the active nodes where that gains; their children are the next active ones."""
        active = []
        for i, node in enumerate(self.active):
            self.gradient[node], self.weight[node] = found["g"][i], found["h"][i]
            if not found["gain"][i] > 1e-9:
                continue
            first = len(self.column)
            self.column[node], self.bin[node] = int(found["column"][i]), int(found["bin"][i])
            self.missing_left[node], self.child[node] = bool(found["missing_left"][i]), first
            self.gain[node] = float(found["gain"][i])
            g, h = found["left_g"][i], found["left_h"][i]
            for grad, weight in ((g, h), (found["g"][i] - g, found["h"][i] - h)):
                if weight >= 2 * spec.min_weight and self.depth + 1 < spec.depth:
                    active.append(len(self.column))
                for values, value in ((self.column, -1), (self.bin, 0), (self.missing_left, False),
                                      (self.child, 0), (self.gradient, grad), (self.weight, weight),
                                      (self.gain, 0.0)):
                    values.append(value)
        if len(self.column) > 1:
            self.depth += 1
        self.active = active

    def arrays(self, spec: Spec, bins: tuple[np.ndarray, np.ndarray]) -> dict[str, np.ndarray]:
        """The nodes as arrays. A binned value goes left if it lies in ``low`` to ``bin``; a leaf sends
        every value to itself."""
        offsets, categorical = bins
        column, at = np.array(self.column, np.int32), np.array(self.bin, np.int64)
        inner, missing_left = column >= 0, np.array(self.missing_left)
        low = np.where(categorical[column], at, offsets[column] + ~missing_left)
        value = -np.array(self.gradient) / (np.array(self.weight) + spec.l2 + 1e-12) * spec.step
        return {"column": column, "bin": np.where(inner, at, 1 << 40), "low": np.where(inner, low, -1),
                "missing_left": missing_left,
                "child": np.where(inner, np.array(self.child), np.arange(len(column))),
                "value": np.where(inner, 0.0, value), "gain": np.array(self.gain),
                "depth": self.depth}


# --- in the tasks -------------------------------------------------------------------------------

def descend(tree: dict, bins: np.ndarray, node: np.ndarray | None = None) -> np.ndarray:
    """The node of each binned row, from the root or, one level on, from where the rows were."""
    flat, base = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
    steps = tree["depth"] if node is None else 1
    node = np.zeros(len(bins), np.int64) if node is None else node
    for _ in range(steps):
        x = flat.take(base + tree["column"].take(node), mode="wrap")
        left = (x <= tree["bin"].take(node)) & (x >= tree["low"].take(node))
        node = tree["child"].take(node) + ~left
    return node


def softmax(margin: np.ndarray) -> np.ndarray:
    e = np.exp(margin - margin.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def probabilities(loss: str, margin: np.ndarray) -> np.ndarray:
    """Predictions of margins (rows, outputs)."""
    if loss == "logistic":
        return 1 / (1 + np.exp(-margin))
    return softmax(margin) if loss == "softmax" else margin


def derivatives(spec: Spec, y: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """First and second derivatives of the loss; None where the second is 1 everywhere."""
    p = probabilities(spec.loss, margin)
    if spec.loss == "squared":
        return np.round((p - y[:, None]) * GRAIN) / GRAIN, None
    truth = (y[:, None] == np.arange(spec.outputs)) if spec.loss == "softmax" else y[:, None]
    h = p * (1 - p) * (2 if spec.loss == "softmax" else 1)
    return np.round((p - truth) * GRAIN) / GRAIN, np.round(h * GRAIN) / GRAIN


def losses(spec: Spec, y: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """Per row what the validation curve averages: absolute error or log loss."""
    p = probabilities(spec.loss, margin)
    if spec.loss == "squared":
        return np.abs(y - p[:, 0])
    hit = (p[np.arange(len(y)), y.astype(int)] if spec.loss == "softmax"
           else np.where(y == 1, p[:, 0], 1 - p[:, 0]))
    tiny = np.finfo(float).eps
    return -np.log(np.clip(hit, tiny, 1 - tiny))


def added(margin: np.ndarray, bins: np.ndarray, rounds: list[list[dict]]) -> np.ndarray:
    """The margins with the trees of some rounds."""
    margin = margin.copy()
    for trees in rounds:
        for k, tree in enumerate(trees):
            margin[:, k] += tree["value"].take(descend(tree, bins))
    return margin


def current_margin(unit: dict, key: str, order: dict) -> np.ndarray:
    """The stored margins with the trees finished since."""
    return added(unit["margins"][key], unit["bins"], order["finished"])


class Round:
    """What one round of a model learns from in one block."""

    def __init__(self, unit: dict, spec: Spec, number: int, margin: np.ndarray, offsets: np.ndarray,
                 sizes: np.ndarray):
        columns = spec.chosen_columns(number, len(sizes))
        self.number, self.width = number, len(columns)
        begin = np.concatenate([[0], np.cumsum(sizes[columns])])
        self.bins = int(begin[-1])
        rows = np.flatnonzero((unit["part"] == 0) & spec.chosen_rows(number, unit["keys"]))
        self.learnt = unit["bins"][rows]
        self.cells = self.learnt[:, columns].astype(np.int64) + (begin[:-1] - offsets[columns])
        self.g, self.h = derivatives(spec, unit["labels"][spec.label][rows], margin[rows])
        # Per class, the level before: its active nodes, their sums, and the node of each row.
        self.last: dict[int, tuple[list[int], np.ndarray, np.ndarray]] = {}

    def counted(self, k: int, at: np.ndarray, nodes: int) -> np.ndarray:
        """Sums of class ``k`` in ``nodes`` nodes; ``at`` is each row's, -1 for none."""
        inside = np.flatnonzero(at >= 0)
        if nodes == 1 and len(inside) == len(at):
            cells = self.cells.ravel()
        else:
            cells = self.cells.take(inside, axis=0)
            cells += (at.take(inside) * self.bins)[:, None]
            cells = cells.ravel()
        sums = np.empty((2, nodes * self.bins))
        sums[0] = np.bincount(cells, np.repeat(self.g[inside, k], self.width), nodes * self.bins)
        sums[1] = np.bincount(cells, None if self.h is None else np.repeat(
            self.h[inside, k], self.width), nodes * self.bins)
        return sums

    def sums(self, k: int, tree: dict, active: list[int]) -> np.ndarray:
        """Sums of the active nodes of a tree. Where the level before was summed here too, only the
        smaller child of each node is summed, the other is the rest: sums are exact, so it is the same."""
        size = len(tree["column"])
        place = np.full(size, -1)
        if k not in self.last:
            node = descend(tree, self.learnt)
            place[active] = np.arange(len(active))
            sums = self.counted(k, place.take(node), len(active))
        else:
            parents, above, node = self.last[k]
            node = descend(tree, self.learnt, node)
            rows = np.bincount(node, minlength=size)
            wanted = np.zeros(size, bool)
            wanted[active] = True
            parents = np.array(parents)
            first = tree["child"][parents]
            split = (tree["column"][parents] >= 0) & (wanted.take(first) | wanted.take(first + 1, mode="clip"))
            origin, first = np.flatnonzero(split), first[split]
            second = rows[first + 1] < rows[first]
            place[first + second] = np.arange(len(first))
            small = self.counted(k, place.take(node), len(first)).reshape(2, len(first), self.bins)
            rest = above.reshape(2, len(parents), self.bins)[:, origin] - small
            place[first + ~second] = np.arange(len(first)) + len(first)
            sums = np.concatenate([small, rest], axis=1)[:, place[active]].reshape(2, -1)
        self.last[k] = active, sums, node
        return sums


def validation_loss(unit: dict, spec: Spec, margin: np.ndarray) -> np.ndarray:
    """Loss and rows of the validation part of one block."""
    held = unit["part"] == 1
    each = np.round(losses(spec, unit["labels"][spec.label][held], margin[held]) * GRAIN) / GRAIN
    return np.array([each.sum(), len(each)])


def level_sums(units: Iterator, orders: dict, specs: dict[str, Spec], offsets: np.ndarray,
               sizes: np.ndarray) -> Iterator:
    """Gradient sums of the active nodes in one block: ((model, class), sums); once a round also
    ((model, -1), loss and rows of the validation part)."""
    for _, unit in units:
        for key in unit["margins"]:
            if key not in orders:
                continue
            order, spec = orders[key], specs[key]
            margin = current_margin(unit, key, order)
            if order["score"]:
                yield (key, -1), validation_loss(unit, spec, margin)
            if order["growing"] is None:
                continue
            learning = Round(unit, spec, order["round"], margin, offsets, sizes)
            for k, (tree, active) in enumerate(order["growing"]):
                if active:
                    yield (key, k), learning.sums(k, tree, active)


def levels(units: Iterator, models: dict[str, Growth], patience: int, seconds: float,
           offsets: np.ndarray, categorical: np.ndarray, sizes: np.ndarray) -> Iterator:
    """Models grown on the only block, one level after another for some seconds: (model, what each level
    found)."""
    for _, unit in units:
        for key, margin in unit["margins"].items():
            if key not in models:
                continue
            model, until = models[key], perf_counter() + seconds
            spec, found, learning = model.spec, [], None
            split = partial(best_splits, specs={key: spec}, offsets=offsets, categorical=categorical,
                            sizes=sizes)
            while not model.stopped and (not found or perf_counter() < until):
                order = model.order()
                if order["score"]:
                    result = {-1: validation_loss(unit, spec, margin)}
                else:
                    result = {}
                if order["growing"] is not None:
                    if learning is None or learning.number != order["round"]:
                        learning = Round(unit, spec, order["round"], margin, offsets, sizes)
                    for k, (tree, active) in enumerate(order["growing"]):
                        if active:
                            sums = learning.sums(k, tree, active)
                            result[k] = split(((key, k), sums), {key: order})[1]
                found.append(result)
                model.take(result, patience)
                if len(model.trees) > model.stored:
                    margin = added(margin, unit["bins"], model.trees[model.stored:])
                    model.stored = len(model.trees)
            yield key, found


def best_splits(item: tuple, orders: dict, specs: dict[str, Spec], offsets: np.ndarray,
                categorical: np.ndarray, sizes: np.ndarray) -> tuple:
    """The best split of each active node from the sums over all blocks."""
    (key, k), sums = item
    if k < 0:
        return item
    spec = specs[key]
    columns = spec.chosen_columns(orders[key]["round"], len(sizes))
    size = sizes[columns]
    begin = np.concatenate([[0], np.cumsum(size)])
    G, H = sums.reshape(2, -1, begin[-1])
    g, h = G[:, :size[0]].sum(axis=1), H[:, :size[0]].sum(axis=1)
    owner = np.repeat(np.arange(len(columns)), size)
    first = np.zeros(begin[-1], bool)
    first[begin[:-1]] = True

    def up_to(x: np.ndarray) -> np.ndarray:
        """Sums of a column's bins up to and with each; a city's own sum only. Without bin 0."""
        sums = np.cumsum(np.where(first, 0.0, x), axis=1)
        sums -= np.concatenate([np.zeros((len(x), 1)), sums], axis=1)[:, begin[:-1]][:, owner]
        return np.where(categorical[columns][owner], x, sums)

    left_g, left_h = up_to(G), up_to(H)
    parent = g * g / (h + spec.l2 + 1e-12)

    def gains(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        rest_g, rest_h = g[:, None] - a, h[:, None] - b
        gain = a * a / (b + spec.l2 + 1e-12) + rest_g * rest_g / (rest_h + spec.l2 + 1e-12)
        allowed = (b >= spec.min_weight) & (rest_h >= spec.min_weight) & ~first & (b > 0) & (rest_h > 0)
        return np.where(allowed, gain - parent[:, None], -np.inf)

    gain = gains(left_g, left_h)
    at = gain.argmax(axis=1)
    row = np.arange(len(g))
    best, a, b = gain[row, at], left_g[row, at], left_h[row, at]
    missing_left = np.zeros(len(g), bool)
    if H[:, begin[:-1]].any():
        # The same splits with the missing values on the left.
        gone_g, gone_h = G[:, begin[:-1]][:, owner], H[:, begin[:-1]][:, owner]
        other = np.where(categorical[columns][owner], -np.inf, gains(left_g + gone_g, left_h + gone_h))
        then = other.argmax(axis=1)
        missing_left = other[row, then] > best
        at = np.where(missing_left, then, at)
        best = np.where(missing_left, other[row, then], best)
        a = left_g[row, at] + np.where(missing_left, gone_g[row, at], 0.0)
        b = left_h[row, at] + np.where(missing_left, gone_h[row, at], 0.0)
    column = columns[owner[at]]
    return (key, k), {"gain": best, "column": column, "bin": at - begin[owner[at]] + offsets[column],
                      "missing_left": missing_left, "g": g, "h": h, "left_g": a, "left_h": b}


def store_margins(units: Iterator, orders: dict) -> Iterator:
    """Margins with all finished trees added; models that have stopped are left out."""
    for place, unit in units:
        margins = {key: current_margin(unit, key, orders[key])
                   for key in unit["margins"] if key in orders}
        if margins:
            yield place, unit | {"margins": margins}


# --- on the driver ------------------------------------------------------------------------------

@dataclass
class Growth:
    """How far a model is."""

    spec: Spec
    bins: tuple[np.ndarray, np.ndarray]       # offsets of the columns, which are categorical
    trees: list[list[dict]] = field(default_factory=list)
    growing: list[Tree] = field(default_factory=list)
    stored: int = 0
    curve: list[float] = field(default_factory=list)
    best: int = 0
    seconds: float = 0.0
    stopped: bool = False

    def order(self) -> dict:
        last = len(self.trees) >= self.spec.rounds
        return {"round": len(self.trees), "finished": self.trees[self.stored:],
                "score": len(self.curve) < len(self.trees),
                "growing": None if last else [(t.arrays(self.spec, self.bins), t.active) for t in self.growing]}

    def onward(self) -> Growth:
        """The same without its finished trees, to be grown further by a task that has them in its margins."""
        return replace(self, trees=[[]] * len(self.trees), stored=len(self.trees),
                       growing=deepcopy(self.growing), curve=list(self.curve))

    def take(self, results: dict, patience: int) -> None:
        """Continue with what a job found: the score of the last round, the splits of this one."""
        loss = results.get(-1)
        if loss is not None:
            self.curve.append(float(loss[0] / max(loss[1], 1)))
            if self.curve[-1] < self.curve[self.best]:
                self.best = len(self.curve) - 1
            over = len(self.curve) >= self.spec.rounds
            if over or len(self.curve) - 1 - self.best >= patience:
                self.stopped = True
                return
        for k, tree in enumerate(self.growing):
            if tree.active:
                if k in results:
                    tree.grow(self.spec, results[k])
                else:
                    tree.active = []                      # no row to learn from
        if not any(tree.active for tree in self.growing):
            self.trees.append([tree.arrays(self.spec, self.bins) for tree in self.growing])
            self.growing = [Tree() for _ in range(self.spec.outputs)]


class Fitted(NamedTuple):
    """How a model grew, and the margins it grew from."""

    growth: Growth
    start: np.ndarray


def first_margins(rows: DataFrame, specs: list[Spec]) -> dict[str, np.ndarray]:
    """Where each model starts: the mean, or the log odds of the classes, of the training part."""
    labels = {spec.label: spec for spec in specs}
    train = rows.filter("split = 'train'")
    found = {}
    for label, spec in labels.items():
        if spec.loss == "softmax":
            counts = dict(train.groupBy(F.col(label).cast("int")).count().collect())
            n = np.array([counts.get(k, 0) for k in range(spec.outputs)], float)
            found[label] = np.log((n + 0.5) / (n.sum() + 0.5 * spec.outputs))
        else:
            mean, n = train.agg(F.avg(F.col(label).cast("double")), F.count(label)).first()
            mean = round(mean, 9) if mean is not None else 0.0
            if spec.loss == "logistic":
                p = (mean * n + 0.5) / (n + 1)
                mean = float(np.log(p / (1 - p)))
            found[label] = np.array([mean])
    return found


def row_blocks(rows: DataFrame, bins: Bins, labels: list[str], blocks: int) -> RDD:
    """The training and validation rows as pickled arrays, one element per partition."""
    part = F.when(F.col("split") == "train", 0).when(F.col("split") == "validate", 1)
    city = F.col("city") if bins.cities else F.lit(None).cast("string")
    narrow = rows.select(
        part.cast("int").alias("part"), F.xxhash64("city", "date").alias("key"), city.alias("city"),
        F.array(*[F.col(n).cast("double") for n in bins.names]).alias("values"),
        *[F.col(label).cast("double").alias(f"label_{i}") for i, label in enumerate(labels)],
    ).filter("part IS NOT NULL").repartition(blocks, "key")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, keys, binned, ys = [], [], [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column("values").flatten().to_numpy(zero_copy_only=False)
            numbers = values.astype(float).reshape(batch.num_rows, len(bins.names))
            binned.append(bins.bins(bins.numbers(numbers, batch.column("city"))))
            parts.append(batch.column("part").to_numpy().astype(np.int8))
            keys.append(batch.column("key").to_numpy().view(np.uint64))
            ys.append([batch.column(f"label_{i}").to_numpy(zero_copy_only=False)
                       for i in range(len(labels))])
        if parts:
            unit = {"part": np.concatenate(parts), "keys": np.concatenate(keys),
                    "bins": np.concatenate(binned),
                    "labels": {label: np.concatenate([y[i] for y in ys])
                               for i, label in enumerate(labels)}}
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(unit, 5)], pa.binary())], ["unit"])

    return narrow.mapInArrow(packed, "unit binary").rdd.map(lambda row: pickle.loads(row[0]))


def boost(rows: DataFrame, bins: Bins, specs: list[Spec], patience: int,
          block_rows: int = BLOCK_ROWS, slice_seconds: float = SLICE_SECONDS) -> dict[str, Fitted]:
    """Fit all ``specs`` together on the rows of split train, each until its loss on the split validate
    has not improved for ``patience`` rounds; a round is grown once and never again.

    ``rows`` has city, date, split, the columns of ``bins`` and the labels, and should be stored: it is
    read twice. Rows whose label is null must be left out before. A task holds one block of about
    ``block_rows`` rows and the margins of a share of the models. On a table of one block each model is a
    task, which grows it for ``slice_seconds`` a job.
    """
    spark = rows.sparkSession
    shared_dir(spark)
    started = perf_counter()
    labels = sorted({spec.label for spec in specs})
    by_key = {spec.key: spec for spec in specs}
    total = rows.filter(F.col("split").isin(*PARTS)).count()
    if not total:
        raise ValueError("no rows to learn from")
    blocks = max(1, -(-total // block_rows))
    cores = spark.sparkContext.defaultParallelism
    alone = blocks == 1
    groups = len(specs) if alone else max(1, min(len(specs), -(-cores // blocks)))
    # Heavy models first, each to the group with the least to do.
    load, group_of = [0.0] * groups, {}
    for spec in sorted(specs, key=lambda s: -s.outputs * s.depth):
        lightest = load.index(min(load))
        load[lightest] += spec.outputs * spec.depth
        group_of[spec.key] = lightest
    start = first_margins(rows, specs)
    summed = partial(level_sums, specs=by_key, offsets=bins.offsets, sizes=bins.sizes)
    chosen = partial(best_splits, specs=by_key, offsets=bins.offsets, sizes=bins.sizes,
                     categorical=bins.categorical)

    def units(numbered):
        unit, block = numbered
        for group in range(groups):
            margins = {s.key: np.tile(start[s.label], (len(unit["part"]), 1))
                       for s in specs if group_of[s.key] == group}
            yield block * groups + group, unit | {"margins": margins}

    state = kept(row_blocks(rows, bins, labels, blocks).zipWithIndex().flatMap(units).partitionBy(
        blocks * groups, lambda number: number))
    shape = (bins.offsets, bins.categorical)
    models = {spec.key: Growth(spec, shape, growing=[Tree() for _ in range(spec.outputs)])
              for spec in specs}
    jobs, before = 0, None
    while live := [m for m in models.values() if not m.stopped]:
        if alone:
            found = dict(state.mapPartitions(partial(
                levels, models={m.spec.key: m.onward() for m in live}, patience=patience,
                seconds=slice_seconds, offsets=bins.offsets, categorical=bins.categorical,
                sizes=bins.sizes)).collect())
        else:
            orders = {m.spec.key: m.order() for m in live}
            sums = state.mapPartitions(partial(summed, orders=orders)).reduceByKey(
                np.add, min(blocks * groups, 4 * cores))
            found = {key: [{}] for key in orders}
            for (key, k), result in sums.map(partial(chosen, orders=orders)).collect():
                found[key][0][k] = result
        for model in live:
            for level in found[model.spec.key]:
                model.take(level, patience)
            if model.stopped:
                model.seconds = perf_counter() - started
        if before is not None:
            before.unpersist()                            # the newer state has been stored by now
            before = None
        jobs += 1
        if alone or jobs % STORE_EVERY == 0:
            before, state = state, next_state(state, [m for m in live if not m.stopped])
    state.unpersist()
    return {key: Fitted(growth, start[growth.spec.label]) for key, growth in models.items()}


def kept(state: RDD) -> RDD:
    """In memory, and in the shared folder once the next job has run on it."""
    state = state.persist(StorageLevel.MEMORY_AND_DISK)
    state.checkpoint()
    return state


def next_state(state: RDD, live: list[Growth]) -> RDD:
    """The state with the trees finished so far in its margins."""
    orders = {m.spec.key: m.order() for m in live}
    for model in live:
        model.stored = len(model.trees)
    return kept(state.mapPartitions(partial(store_margins, orders=orders), preservesPartitioning=True))


# --- fitted models ------------------------------------------------------------------------------

NODE_SCHEMA = ("round INT, output INT, node INT, column INT, place DOUBLE, missing_left BOOLEAN, "
               "child INT, value DOUBLE, gain DOUBLE")


@dataclass
class Ensemble:
    """A fitted model: its nodes as one table, and what turns a row into their numbers."""

    loss: str
    start: np.ndarray
    bins: Bins
    nodes: dict[str, np.ndarray]

    @classmethod
    def of(cls, fitted: Fitted, bins: Bins) -> Ensemble:
        """The rounds up to the best one."""
        growth, start = fitted
        parts = []
        for number, trees in enumerate(growth.trees[:growth.best + 1]):
            for output, tree in enumerate(trees):
                n = len(tree["column"])
                inner = tree["column"] >= 0
                column = np.where(inner, tree["column"], 0)
                place = tree["bin"] - bins.offsets[column] - 1
                cut = np.array([p if bins.categorical[c] else bins.cuts[c][p] if p < len(bins.cuts[c])
                                else np.inf for c, p in zip(column[inner], place[inner])], float)
                value = np.full(n, np.nan)
                value[inner] = cut
                parts.append({"round": np.full(n, number), "output": np.full(n, output),
                              "node": np.arange(n), "column": tree["column"], "place": value,
                              "missing_left": tree["missing_left"], "child": tree["child"],
                              "value": tree["value"], "gain": tree["gain"]})
        names = [column.split()[0] for column in NODE_SCHEMA.split(", ")]
        return cls(growth.spec.loss, start, bins,
                   {name: np.concatenate([p[name] for p in parts]) for name in names})

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(pa.table({
            name: pa.array(values) for name, values in self.nodes.items()})).selectExpr(*[
                f"CAST({c.split()[0]} AS {c.split()[1]}) AS {c.split()[0]}"
                for c in NODE_SCHEMA.split(", ")])

    @classmethod
    def from_table(cls, loss: str, start: list[float], bins: Bins, table: DataFrame) -> Ensemble:
        rows = table.orderBy("round", "output", "node").toArrow()
        return cls(loss, np.array(start), bins, {
            name: rows.column(name).to_numpy() for name in rows.column_names})

    def predict(self, numbers: np.ndarray) -> np.ndarray:
        """Predictions (rows, outputs) of rows of numbers, NaN for missing."""
        nodes, categorical = self.nodes, self.bins.categorical
        roots = np.flatnonzero(nodes["node"] == 0)
        output = nodes["output"][roots]
        base = np.repeat(roots, np.diff(np.append(roots, len(nodes["node"]))))
        child = base + nodes["child"]
        margin = np.tile(self.start, (len(numbers), 1)).astype(float)
        step = max(1, 1_000_000 // max(1, len(roots)))
        order = np.argsort(output, kind="stable")
        ends = np.searchsorted(output[order], np.arange(len(self.start) + 1))
        for low in range(0, len(numbers), step):
            some = numbers[low:low + step]
            at = np.tile(roots, (len(some), 1))
            rows = np.arange(len(some))[:, None]
            while True:
                column = nodes["column"][at]
                inner = column >= 0
                if not inner.any():
                    break
                x, place = some[rows, column], nodes["place"][at]
                left = np.where(categorical[column], x == place, x <= place)
                left = np.where(np.isnan(x), nodes["missing_left"][at], left)
                at = np.where(inner, child[at] + ~left, at)
            values = nodes["value"][at][:, order]
            for k in range(len(self.start)):
                margin[low:low + step, k] += values[:, ends[k]:ends[k + 1]].sum(axis=1)
        return probabilities(self.loss, margin)

    def importances(self, spark: SparkSession) -> DataFrame:
        """(position, feature, splits, gain, importance): the mean gain of the splits on a feature, as a
        share of the sum of all features' means. Features that no split uses have 0."""
        inner = self.nodes["column"] >= 0
        names = self.bins.labels()
        column, gain = self.nodes["column"][inner], self.nodes["gain"][inner]
        city = column >= len(self.bins.names)
        at = column + np.where(city, np.nan_to_num(self.nodes["place"][inner]), 0).astype(int)
        splits = np.bincount(at, minlength=len(names))
        total = np.bincount(at, gain, len(names))
        mean = total / np.maximum(splits, 1)
        return spark.createDataFrame(pa.table({
            "position": np.arange(len(names)), "feature": names, "splits": splits, "gain": total,
            "importance": mean / (mean.sum() or 1.0)}))


def predicted(model: Ensemble, rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with the model's predictions as array column ``name``, Arrow batches at a time."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<double>")
    def predict(values: pa.Array, city: pa.Array) -> pa.Array:
        model = shared.value
        numbers = values.flatten().to_numpy(zero_copy_only=False).astype(float)
        numbers = numbers.reshape(len(values), len(model.bins.names))
        out = model.predict(model.bins.numbers(numbers, city))
        ends = np.arange(len(values) + 1, dtype=np.int32) * out.shape[1]
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()))

    columns = F.array(*[F.col(n).cast("double") for n in model.bins.names])
    city = F.col("city") if model.bins.cities else F.lit("")
    return rows.withColumn(name, predict(columns, city))
