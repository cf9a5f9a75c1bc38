"""Lag, rolling, seasonal and categorical features of city-day rows, and next-day labels.

Every history column uses one window definition (city, by date), so Spark plans one exchange and
one sort for all of them. The input holds at most one row per city-day, which bounds a city's group
by the calendar whatever share of the raw readings it owns. Frames count rows, not days: a gap in
the record does not break a lag or a rolling window, only a label.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationcast.functions.names import slug
from stationcast.functions.weather import (
    condition_flags,
    season,
    temp_range,
    wet_flag,
    wet_label,
    wmo_category,
)
from stationcast.schemas import LAGGED, LAGS, META, TARGET_TEMP, TARGET_WET, TARGETS, WINDOWS

WARMUP_COLUMN = f"temp_mean_c_roll{max(WINDOWS)}_mean"


def by_city():
    return Window.partitionBy("city").orderBy("date")


def rows_back(n: int):
    return by_city().rowsBetween(-(n - 1), 0)


def full_window(column: str, n: int, how) -> Column:
    """Aggregate over the last ``n`` rows; null unless all of them hold a value."""
    frame = rows_back(n)
    return F.when(F.count(column).over(frame) == n, how(column).over(frame))


def day_columns(days: DataFrame) -> DataFrame:
    """Row-local columns that the history features build on."""
    return days.withColumns({
        "condition": wmo_category(F.col("wmo_code")),
        "temp_range_c": temp_range(F.col("temp_max_c"), F.col("temp_min_c")),
        "is_wet": wet_flag(F.col("precip_mm")),
    })


def lag_columns() -> dict[str, Column]:
    return {f"{c}_lag{k}": F.lag(c, k).over(by_city()) for c in LAGGED for k in LAGS}


def rolling_mean_columns() -> dict[str, Column]:
    columns = {}
    for n in WINDOWS:
        for c in ("temp_mean_c", "precip_mm"):
            columns[f"{c}_roll{n}_mean"] = full_window(c, n, F.avg)
    columns["temp_range_c_roll7_mean"] = full_window("temp_range_c", 7, F.avg)
    return columns


def rolling_std_columns() -> dict[str, Column]:
    return {f"temp_mean_c_roll{n}_std": full_window("temp_mean_c", n, F.stddev_samp)
            for n in (7, 30)}


def rolling_sum_columns() -> dict[str, Column]:
    columns = {f"precip_mm_roll{n}_sum": full_window("precip_mm", n, F.sum) for n in (3, 7)}
    columns |= {f"wet_days_roll{n}": full_window("is_wet", n, F.sum) for n in (7, 30)}
    return columns


def label_columns() -> dict[str, Column]:
    """Next-day values, present only where the next row is exactly the next day."""
    consecutive = F.datediff(F.lead("date").over(by_city()), F.col("date")) == 1

    def tomorrow(column: str) -> Column:
        return F.when(consecutive, F.lead(column).over(by_city()))

    return {
        TARGET_TEMP: tomorrow("temp_mean_c"),
        "y_precip_mm": tomorrow("precip_mm"),
        "y_condition": tomorrow("condition"),
    }


def delta_columns() -> dict[str, Column]:
    """Today against its own recent past; needs the lag and rolling columns."""
    def gap(a: str, b: str) -> Column:
        return F.col(a) - F.col(b)

    return {
        "temp_delta_1d": gap("temp_mean_c", "temp_mean_c_lag1"),
        "temp_delta_3d": gap("temp_mean_c", "temp_mean_c_lag3"),
        "temp_anomaly_7d": gap("temp_mean_c", "temp_mean_c_roll7_mean"),
        "temp_anomaly_30d": gap("temp_mean_c", "temp_mean_c_roll30_mean"),
        "precip_delta_1d": gap("precip_mm", "precip_mm_lag1"),
    }


def _columns_of(parts: list[dict[str, Column]]) -> list[Column]:
    return [column.alias(name) for part in parts for name, column in part.items()]


def build_features(days: DataFrame, vocabulary: dict[str, str] | None = None,
                   keep_warmup: bool = False) -> DataFrame:
    """The feature frame: one row per servable city-day with features, labels and meta columns.

    ``days`` is unique by (city, date) and carries coordinates. ``vocabulary`` (city to column
    name, from :func:`city_vocabulary`) adds one 0/1 column per city.
    """
    base = day_columns(days)
    windowed = base.select("*", *_columns_of([
        lag_columns(), rolling_mean_columns(), rolling_std_columns(), rolling_sum_columns(),
        label_columns(),
    ]))
    if not keep_warmup:
        windowed = drop_warmup(windowed)
    labels = [TARGET_TEMP, "y_precip_mm", "y_condition"]
    history = [c for c in windowed.columns if c not in labels]
    return windowed.select(
        *history,
        *_columns_of([
            delta_columns(), condition_flags(F.col("condition")),
            season(F.col("date"), F.col("latitude")),
            city_flags(vocabulary or {}),
        ]),
        TARGET_TEMP, "y_precip_mm", wet_label(F.col("y_precip_mm")).alias(TARGET_WET),
        "y_condition",
    )


def drop_warmup(features: DataFrame) -> DataFrame:
    """Keep rows with a full 30-row temperature window; other features may still be null."""
    return features.filter(F.col(WARMUP_COLUMN).isNotNull())


def labelled(features: DataFrame) -> DataFrame:
    return features.dropna(subset=[TARGET_TEMP, TARGET_WET, "y_condition"])


def record_gaps(days: DataFrame) -> DataFrame:
    """Rows whose following row is not the next day, with the length of the gap."""
    following = F.lead("date").over(by_city())
    return (
        days.select("city", "date", following.alias("next_date"))
        .withColumn("gap_days", F.datediff("next_date", "date"))
        .filter("gap_days != 1")
    )


def city_vocabulary(days: DataFrame) -> dict[str, str]:
    """Sorted cities and their column names, for the 0/1 columns of a list of cities that may be
    named in a schema. :func:`city_vector` holds any number of cities."""
    rows = days.select("city").distinct().select("city", slug("city").alias("slug")).collect()
    return {row.city: f"city_{row.slug}" for row in sorted(rows, key=lambda row: row.city)}


def city_flags(vocabulary: dict[str, str]) -> dict[str, Column]:
    """One 0/1 column per known city. Cities whose names fold alike share a column, which then
    marks the last of them in sorted order."""
    return {name: (F.col("city") == city).cast("double") for city, name in vocabulary.items()}


def city_encoder(output: str) -> list:
    """Stages for a sparse one-hot vector over the alphabetical city list; cities that were not
    there when it was fitted share the last position."""
    return [
        StringIndexer(inputCol="city", outputCol="city_index", handleInvalid="keep",
                      stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCol="city_index", outputCol=output, dropLast=False),
    ]


def city_vector(days: DataFrame, output: str = "city_vec") -> DataFrame:
    """Add the sparse one-hot vector of the city, for any number of cities."""
    encoder = Pipeline(stages=city_encoder(output)).fit(days)
    return encoder.transform(days).drop("city_index")


def feature_names(features: DataFrame) -> list[str]:
    """Numeric columns that a model may see, in frame order."""
    excluded = {*META, *TARGETS}
    return [f.name for f in features.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in excluded]


def serving_tail(days: DataFrame, as_of, rows: int = max(WINDOWS)) -> DataFrame:
    """The newest ``rows`` city-days up to ``as_of``: all that one forecast per city reads.

    Spark limits each task to its newest rows per city before the shuffle, so little data moves.
    """
    newest = Window.partitionBy("city").orderBy(F.col("date").desc())
    return (
        days.filter(F.col("date") <= F.lit(as_of))
        .withColumn("__newest", F.row_number().over(newest))
        .filter(F.col("__newest") <= rows)
        .drop("__newest")
    )


def asked_history(days: DataFrame, asked: DataFrame, rows: int = max(WINDOWS)) -> DataFrame:
    """The city-days that forecasts for ``asked`` (city, as_of) read: per city the asked span and the
    ``rows`` - 1 days of its record before it.

    Cities that nobody asks for drop out in a join of one row per asked city.
    """
    spans = asked.dropna(subset=["city", "as_of"]).groupBy("city").agg(
        F.min("as_of").alias("__low"), F.max("as_of").alias("__high"))
    near = days.join(spans, "city").filter(F.col("date") <= F.col("__high"))
    before = Window.partitionBy("city", F.col("date") < F.col("__low")).orderBy(F.desc("date"))
    return (near.withColumn("__back", F.row_number().over(before))
            .filter((F.col("date") >= F.col("__low")) | (F.col("__back") < rows))
            .select(*days.columns))


def usable_days(days: DataFrame) -> DataFrame:
    """First and last servable day per city, from the temperature column alone."""
    full = F.count("temp_mean_c").over(rows_back(max(WINDOWS))) == max(WINDOWS)
    return days.select("city", "date", full.alias("full")).filter("full").groupBy("city").agg(
        F.min("date").alias("first_usable"), F.max("date").alias("last_usable"))


def serving_features(days: DataFrame, as_of, vocabulary: dict[str, str] | None = None) -> DataFrame:
    """Feature rows of exactly ``as_of``, built from the serving tail only."""
    tail = serving_tail(days, as_of)
    return build_features(tail, vocabulary).filter(F.col("date") == F.lit(as_of))
