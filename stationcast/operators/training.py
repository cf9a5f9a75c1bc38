"""Boosted models for temperature, rain and sky condition, searched over a candidate grid.

All candidates of all targets grow together, see :mod:`stationcast.operators.boosting`: gradient-boosted
trees with an L2 leaf weight, softmax over the condition classes, learnt directions for missing values,
and rounds kept up to the best score on the validation rows.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationcast.operators import metrics
from stationcast.operators.boosting import Bins, Ensemble, Spec, boost, predicted
from stationcast.schemas import (
    BUNDLE_VERSION,
    CANDIDATES,
    PATIENCE,
    SEED,
    SELECTION_METRIC,
    TARGET_CONDITION,
    TARGET_TEMP,
    TARGET_WET,
)

TARGET_LABELS = {"temperature": TARGET_TEMP, "precipitation": TARGET_WET,
                 "condition": TARGET_CONDITION}
LOSSES = {"temperature": "squared", "precipitation": "logistic", "condition": "softmax"}


# --- feature matrix -----------------------------------------------------------------------------

def feature_matrix(features: DataFrame, names: list[str], output: str = "features") -> DataFrame:
    """``features`` with the model columns, in order, as one array of doubles; null where missing."""
    return features.withColumn(output, F.array(*[F.col(c).cast("double") for c in names]))


def matrix_cells(features: DataFrame, names: list[str], keys: list[str]) -> DataFrame:
    """The matrix as rows (keys, position, feature, value), position from 0."""
    rows = feature_matrix(features, names, "__values").select(*keys, F.posexplode("__values"))
    label = F.get(F.array(*map(F.lit, names)), F.col("pos"))
    return rows.select(*keys, F.col("pos").alias("position"), label.alias("feature"),
                       F.col("col").alias("value"))


# --- scoring ------------------------------------------------------------------------------------

def score(target: str, model: Ensemble, rows: DataFrame) -> DataFrame:
    """Add the target's prediction: ``p_temp``, ``p_wet``, or ``p_condition`` in class order."""
    if target == "condition":
        return predicted(model, rows, "p_condition")
    name = {"temperature": "p_temp", "precipitation": "p_wet"}[target]
    return predicted(model, rows, name).withColumn(name, F.get(name, F.lit(0)))


def evaluate(target: str, model: Ensemble, rows: DataFrame, classes: list[str]) -> dict[str, float]:
    scored = score(target, model, rows)
    if target == "temperature":
        table = metrics.evaluate_temperature(scored, TARGET_TEMP, "p_temp", "temp_mean_c")
    elif target == "precipitation":
        table = metrics.evaluate_precipitation(scored, TARGET_WET, "p_wet")
    else:
        table = metrics.evaluate_condition(scored, TARGET_CONDITION, "p_condition", len(classes))
    return table.first().asDict()


# --- search -------------------------------------------------------------------------------------

@dataclass
class Trial:
    target: str
    candidate: dict
    position: int
    model: Ensemble
    best_iteration: int
    capped: bool
    validate: dict
    score: float
    seconds: float
    curve: list[float]          # validation score after each round


def spec_of(target: str, candidate: dict, position: int, classes: int) -> Spec:
    return Spec(
        key=f"{target}/{position}", label=TARGET_LABELS[target], loss=LOSSES[target],
        outputs=classes if target == "condition" else 1, rounds=candidate["n_estimators"],
        depth=candidate["max_depth"], step=candidate["learning_rate"],
        min_weight=candidate["min_child_weight"], rows=candidate["subsample"],
        columns=candidate["colsample_bytree"], l2=candidate["reg_lambda"], seed=SEED)


def search(targets: list[str], rows: DataFrame, bins: Bins, classes: list[str], grid=CANDIDATES,
           patience: int = PATIENCE, parallel: int = 8, **options) -> dict[str, list[Trial]]:
    """Fit every candidate for every target, all of them together, and return the trials, best first;
    equal scores in grid order.

    ``rows`` are stored feature rows with split, labels and the columns of ``bins``. A trial's seconds
    are those until it stopped, since trials share their jobs. ``options`` go to ``boost``.
    """
    spark = rows.sparkSession
    units = [(t, c, i) for t in targets for i, c in enumerate(grid)]
    fitted = boost(rows, bins, [spec_of(t, c, i, len(classes)) for t, c, i in units], patience,
                   **options)
    validate = rows.filter("split = 'validate'")

    def trial(target: str, candidate: dict, position: int) -> Trial:
        found = fitted[f"{target}/{position}"]
        model = Ensemble.of(found, bins)
        scores = evaluate(target, model, validate, classes)
        growth = found.growth
        return Trial(target, candidate, position, model, growth.best,
                     growth.best + 1 >= candidate["n_estimators"], scores,
                     scores[SELECTION_METRIC[target]], growth.seconds, growth.curve)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(trial), *unit) for unit in units]
        done = [future.result() for future in running]
    return {target: sorted((t for t in done if t.target == target),
                           key=lambda t: (t.score, t.position)) for target in targets}


def ranked_trials(trials: DataFrame) -> DataFrame:
    """Trials (target, position, score, ...) with their rank in the target: best score first, equal
    scores in grid order."""
    order = Window.partitionBy("target").orderBy("score", "position")
    return trials.withColumn("rank", F.row_number().over(order))


def trials_table(spark: SparkSession, found: dict[str, list[Trial]]) -> DataFrame:
    """All trials with rank, score and the validation metrics as a map."""
    rows = [
        (target, t.candidate["name"], t.position, float(t.score), t.best_iteration, t.capped,
         {k: float(v) if v is not None else None for k, v in t.validate.items()},
         round(t.seconds, 1))
        for target, trials in found.items() for t in trials
    ]
    return ranked_trials(spark.createDataFrame(
        rows, "target STRING, name STRING, position INT, score DOUBLE, best_iteration INT, "
              "capped BOOLEAN, validate MAP<STRING, DOUBLE>, seconds DOUBLE"))


def scores_table(spark: SparkSession, scores: dict[str, float | None]) -> DataFrame:
    """The scores as one row, columns by name; one that is not defined, such as the ROC AUC of rows that
    are all wet, is null."""
    names = sorted(scores)
    return spark.createDataFrame([tuple(scores[name] for name in names)],
                                 ", ".join(f"{name} DOUBLE" for name in names))


def curves_table(spark: SparkSession, found: dict[str, list[Trial]]) -> DataFrame:
    """The validation score of every round of every trial; rounds count from 1."""
    rows = [(target, t.candidate["name"], number, float(value), number == t.best_iteration + 1)
            for target, trials in found.items() for t in trials
            for number, value in enumerate(t.curve, start=1)]
    return spark.createDataFrame(
        rows, "target STRING, name STRING, round INT, score DOUBLE, kept BOOLEAN")


# Fixed value: a sampled curve has about so many points.
CURVE_POINTS = 8


def sampled_curves(curves: DataFrame, points: int = CURVE_POINTS) -> DataFrame:
    """Each curve cut into ``points`` groups of equally many rounds, what is left over in more such
    groups: the first round of every group, and the kept round."""
    curve = Window.partitionBy("target", "name")
    length = F.greatest(F.lit(1), F.floor(F.count("*").over(curve) / points))
    group = F.floor((F.row_number().over(curve.orderBy("round")) - 1) / length)
    grouped = curves.withColumn("__group", group)
    first = F.row_number().over(Window.partitionBy("target", "name", "__group").orderBy("round"))
    return (grouped.withColumn("__first", first).filter("__first = 1 OR kept")
            .drop("__group", "__first"))


def top_features(importances: DataFrame, k: int = 12) -> DataFrame:
    """The ``k`` most important features, of equal ones the last in column order first."""
    return importances.orderBy(F.desc("importance"), F.desc("position")).limit(k)


def importances_table(spark: SparkSession, found: dict[str, list[Trial]]) -> DataFrame:
    """The importances of each target's best model, see ``Ensemble.importances``."""
    tables = [trials[0].model.importances(spark).select(F.lit(target).alias("target"), "*")
              for target, trials in found.items()]
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


# --- bundle -------------------------------------------------------------------------------------

@dataclass
class Bundle:
    """Everything serving needs: how columns become bins, the models, and what they were trained on."""

    bins: Bins
    temperature: Ensemble
    precipitation: Ensemble
    condition: Ensemble
    cities: DataFrame
    feature_names: list[str]
    classes: list[str]
    vocabulary: dict[str, str] = field(default_factory=dict)
    metrics: dict = field(default_factory=dict)
    split: str = ""
    source: str = ""
    trained_at: str = ""
    version: str = BUNDLE_VERSION

    _META = ("feature_names", "classes", "vocabulary", "metrics", "split", "source", "trained_at",
             "version")

    def model(self, target: str) -> Ensemble:
        return getattr(self, target)

    def save(self, path: str) -> None:
        """Models, cuts and cities as Parquet tables below ``path``, the rest as one JSON text."""
        spark = self.cities.sparkSession
        for target in TARGET_LABELS:
            self.model(target).table(spark).write.mode("overwrite").parquet(f"{path}/{target}")
        cuts = [(i, name, cut.tolist()) for i, (name, cut) in enumerate(zip(self.bins.names, self.bins.cuts))]
        spark.createDataFrame(cuts, "position INT, name STRING, cuts ARRAY<DOUBLE>").write.mode(
            "overwrite").parquet(f"{path}/bins")
        spark.createDataFrame([(c,) for c in self.bins.cities], "city STRING").write.mode(
            "overwrite").parquet(f"{path}/city_bins")
        self.cities.write.mode("overwrite").parquet(f"{path}/cities")
        meta = {name: getattr(self, name) for name in self._META}
        meta["models"] = {t: [self.model(t).loss, self.model(t).start.tolist()] for t in TARGET_LABELS}
        spark.createDataFrame([(json.dumps(meta),)], "meta STRING").write.mode(
            "overwrite").parquet(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Bundle:
        meta = json.loads(spark.read.parquet(f"{path}/meta").first().meta)
        cuts = spark.read.parquet(f"{path}/bins").orderBy("position").collect()
        bins = Bins([r["name"] for r in cuts], [np.array(r["cuts"], float) for r in cuts], sorted(
            r["city"] for r in spark.read.parquet(f"{path}/city_bins").collect()))
        models = {target: Ensemble.from_table(loss, start, bins, spark.read.parquet(f"{path}/{target}"))
                  for target, (loss, start) in meta.pop("models").items()}
        return cls(bins=bins, cities=spark.read.parquet(f"{path}/cities"), **models, **meta)

    def score(self, features: DataFrame) -> DataFrame:
        """Add ``p_temp``, ``p_wet`` and ``p_condition`` to feature rows."""
        for target in TARGET_LABELS:
            features = score(target, self.model(target), features)
        return features
