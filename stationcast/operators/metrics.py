"""Model scores and naive baselines, each from one grouped pass over the scored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationcast.operators.ordering import running_totals

# Probabilities are kept this far from 0 and 1 before taking logs (double precision epsilon).
EPSILON = 2.220446049250313e-16


def _clipped(p: Column) -> Column:
    return F.least(F.greatest(p, F.lit(EPSILON)), F.lit(1.0 - EPSILON))


def evaluate_temperature(scored: DataFrame, label: str, prediction: str,
                         persistence: str) -> DataFrame:
    """MAE, RMSE and R² of a prediction, and the MAE of "tomorrow is like today"."""
    y, error = F.col(label), F.col(label) - F.col(prediction)
    total = F.var_pop(label) * F.count(label)
    residual = F.sum(error * error)
    r2 = (F.when(total > 0, 1 - F.try_divide(residual, total))
          .when(residual == 0, 1.0).otherwise(0.0))
    return scored.filter(y.isNotNull()).agg(
        F.avg(F.abs(error)).alias("mae_c"),
        F.sqrt(F.avg(error * error)).alias("rmse_c"),
        r2.alias("r2"),
        F.avg(F.abs(y - F.col(persistence))).alias("baseline_persistence_mae_c"),
    )


def evaluate_precipitation(scored: DataFrame, label: str, probability: str) -> DataFrame:
    """Accuracy at 0.5, ROC AUC, log loss, Brier score and the majority baseline.

    All of them follow from the wet and dry counts per distinct probability, so rows are merged
    map-side and equal scores, however many, become one row. AUC is exact: each wet row wins
    against the dry rows scored below it and half-wins against those scored alike.
    """
    p = F.col("p")
    by_score = scored.filter(F.col(label).isNotNull()).groupBy(F.col(probability).alias("p")).agg(
        F.count_if(F.col(label) == 1).alias("wet"), F.count_if(F.col(label) != 1).alias("dry"))
    ranked = running_totals(by_score, ["p"], {"dry_below": "dry"})
    n = F.sum(F.col("wet") + F.col("dry"))
    right = F.sum(F.when(p >= 0.5, F.col("wet")).otherwise(F.col("dry")))
    loss = F.sum(-F.col("wet") * F.log(_clipped(p)) - F.col("dry") * F.log(1 - _clipped(p)))
    brier = F.sum(F.col("wet") * (1 - p) * (1 - p) + F.col("dry") * p * p)
    wins = F.sum(F.col("wet") * (F.col("dry_below") + F.col("dry") / 2))
    base = F.try_divide(F.sum("wet").cast("double"), n.cast("double"))
    return ranked.agg(
        F.try_divide(right.cast("double"), n).alias("accuracy"),
        F.try_divide(wins, F.sum("wet").cast("double") * F.sum("dry")).alias("roc_auc"),
        F.try_divide(loss, n).alias("log_loss"),
        F.try_divide(brier, n).alias("brier"),
        base.alias("base_rate"),
        F.greatest(base, 1 - base).alias("baseline_majority_accuracy"),
    )


def first_best(probabilities: Column) -> Column:
    """Zero-based index of the largest probability, the first one on ties."""
    return F.array_position(probabilities, F.array_max(probabilities)) - 1


def evaluate_condition(scored: DataFrame, label: str, probabilities: str,
                       classes: int) -> DataFrame:
    """Accuracy, macro-F1 over all classes (0 where undefined), log loss, majority baseline.

    The rows are reduced to (actual, predicted) cells, at most ``classes`` squared.
    """
    truth = F.col(label).cast("int")
    p = F.col(probabilities)
    loss = -F.log(_clipped(F.get(p, truth)))
    cells = scored.filter(truth.isNotNull()).groupBy(
        truth.alias("actual"), first_best(p).cast("int").alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(loss).alias("loss"))
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    sides = cells.select(F.inline(F.array(
        F.struct(F.col("actual").alias("c"), F.col("n").alias("support"), hit.alias("hits"),
                 zero.alias("guesses"), F.col("loss").alias("loss")),
        F.struct(F.col("predicted").alias("c"), zero.alias("support"), zero.alias("hits"),
                 F.col("n").alias("guesses"), F.lit(0.0).alias("loss")),
    )))
    per_class = sides.groupBy("c").agg(
        *[F.sum(x).alias(x) for x in ("support", "hits", "guesses", "loss")])
    # F1 = 2 hits / (rows of the class + guesses of the class)
    f1 = F.coalesce(F.try_divide(2.0 * F.col("hits"),
                                 (F.col("support") + F.col("guesses")).cast("double")), F.lit(0.0))
    n = F.sum("support").cast("double")
    return per_class.agg(
        F.try_divide(F.sum("hits").cast("double"), n).alias("accuracy"),
        (F.sum(f1) / F.lit(float(classes))).alias("macro_f1"),
        F.try_divide(F.sum("loss"), n).alias("log_loss"),
        F.try_divide(F.max("support").cast("double"), n).alias("baseline_majority_accuracy"),
    )


def climatology(split_rows: DataFrame, classes: list[str]) -> DataFrame:
    """Naive forecast for every row: the city's wet rate and class shares on the train split.

    Adds ``p_wet`` and ``p_condition`` (in class order). A city without training rows gets the
    rates of all training rows.
    """
    train = split_rows.filter(F.col("split") == "train")
    hits = {"wet": F.col("y_is_wet"),
            **{f"c{i}": (F.col("y_condition") == c).cast("double") for i, c in enumerate(classes)}}
    totals = train.groupBy("city").agg(
        F.count(F.lit(1)).cast("double").alias("n"), *[F.sum(v).alias(k) for k, v in hits.items()])

    def rates() -> list[Column]:
        share = {k: F.col(k) / F.col("n") for k in hits}
        return [share["wet"].alias("p_wet"),
                F.array(*[share[f"c{i}"] for i in range(len(classes))]).alias("p_condition")]

    # The overall rates add up the per-city totals, so the rows are aggregated once.
    overall = totals.agg(*[F.sum(k).alias(k) for k in ("n", *hits)]).select(
        F.struct(*rates()).alias("overall")).scalar()
    return (
        split_rows.join(totals.select("city", *rates()), "city", "left")
        .withColumn("__overall", overall)
        .withColumns({c: F.coalesce(c, f"__overall.{c}") for c in ("p_wet", "p_condition")})
        .drop("__overall")
    )
