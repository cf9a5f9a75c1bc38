"""The query catalogue: one callable per operator, over the fixture tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationcast import sources, streaming
from stationcast.operators import export, forecast, load, lookup, metrics, quality, rollup
from stationcast.operators import features as ft
from stationcast.operators import split, training, trailing
from stationcast.operators.rejects import RejectedRows
from stationcast.plans import jobs
from stationcast.plans.fixtures import Fixtures
from stationcast.schemas import UNKNOWN_CATEGORY, WMO_CATEGORIES
from stationcast.session import cut_lineage, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(build: Callable[[Fixtures], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Fixtures(spark, folder))
        return build
    return register


def rounded(df: DataFrame) -> DataFrame:
    """Round fractional columns to 6 places so that summation order does not show.

    The first step removes noise in the last bits, so that the second sees a tie as a tie.
    """
    def six(name: str):
        scaled = F.rint(F.col(name) * 1e9) / 1e9 * 1e6
        return F.signum(scaled) * F.floor(F.abs(scaled) + 0.5) / 1e6 + 0.0

    return df.select(*[
        six(f.name).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


def named(parts: dict) -> list:
    return [column.alias(name) for name, column in parts.items()]


# --- rollup and row-local expressions -----------------------------------------------------------

@query("daily_rollup")
def _(fx):
    return rounded(fx.obs)


@query("wmo_category")
def _(fx):
    return ft.day_columns(fx.obs).select("city", "date", "wmo_code", "condition")


@query("wet_flag")
def _(fx):
    return ft.day_columns(fx.obs).select("city", "date", "is_wet")


@query("temp_range")
def _(fx):
    return rounded(ft.day_columns(fx.obs).select("city", "date", "temp_range_c"))


@query("season_features")
def _(fx):
    return rounded(fx.located.select(
        "city", "date", *named(ft.season(F.col("date"), F.col("latitude")))))


@query("condition_one_hot")
def _(fx):
    return ft.day_columns(fx.obs).select(
        "city", "date", "condition", *named(ft.condition_flags(F.col("condition"))))


@query("city_one_hot")
def _(fx):
    return fx.obs.select("city", "date", *named(ft.city_flags(ft.city_vocabulary(fx.cities.select(
        F.col("city_name").alias("city"))))))


# --- row windows --------------------------------------------------------------------------------

def _history(fx, *parts: dict) -> DataFrame:
    return ft.day_columns(fx.obs).select(
        "city", "date", *[c for part in parts for c in named(part)])


@query("lag_features")
def _(fx):
    return rounded(_history(fx, ft.lag_columns()))


@query("rolling_means")
def _(fx):
    return rounded(_history(fx, ft.rolling_mean_columns()))


@query("rolling_std")
def _(fx):
    return rounded(_history(fx, ft.rolling_std_columns()))


@query("rolling_sums")
def _(fx):
    return rounded(_history(fx, ft.rolling_sum_columns()))


@query("delta_features")
def _(fx):
    frame = ft.build_features(fx.located, keep_warmup=True)
    return rounded(frame.select("city", "date", *ft.delta_columns()))


@query("next_day_labels")
def _(fx):
    frame = ft.build_features(fx.located, keep_warmup=True)
    return rounded(frame.select("city", "date", "y_temp_mean_c", "y_precip_mm", "y_is_wet",
                                "y_condition"))


@query("drop_warmup")
def _(fx):
    return rounded(ft.build_features(fx.located).select("city", "date", ft.WARMUP_COLUMN))


@query("labelled_rows")
def _(fx):
    return rounded(ft.labelled(ft.build_features(fx.located)).select(
        "city", "date", "y_temp_mean_c", "y_precip_mm", "y_is_wet", "y_condition"))


@query("feature_frame")
def _(fx):
    return rounded(feature_frame(fx))


def feature_frame(fx) -> DataFrame:
    """All features, one 0/1 column per city among them, without the rounding."""
    return ft.build_features(fx.located, ft.city_vocabulary(fx.located))


@query("record_gaps")
def _(fx):
    return ft.record_gaps(fx.obs)


# --- whole-table aggregates ---------------------------------------------------------------------

@query("dataset_profile")
def _(fx):
    return rounded(rollup.dataset_profile(fx.obs))


@query("usable_range_by_city")
def _(fx):
    return rollup.usable_range(ft.build_features(fx.located))


@query("city_listing")
def _(fx):
    return rollup.city_listing(ft.build_features(fx.located))


# --- time-range windows -------------------------------------------------------------------------

@query("trailing_30d_avg")
def _(fx):
    return rounded(trailing.trailing_averages(fx.wx_data))


@query("view_global_average")
def _(fx):
    return rounded(trailing.pair_weighted_averages(fx.wx_data))


@query("trailing_30d_as_written")
def _(fx):
    return rounded(trailing.trailing_as_written(fx.wx_data))


# --- sources and sinks --------------------------------------------------------------------------

@query("scan_observations_csv")
def _(fx):
    path = scratch_path(fx.spark, "observations")
    sources.export_csv(fx.located, path)
    return rounded(sources.scan_observations_csv(fx.spark, path))


@query("scan_star_schema")
def _(fx):
    path = scratch_path(fx.spark, "star")
    sources.write_star_schema({
        "states": fx.states, "admin_div_1": fx.admin_div_1, "cities": fx.cities,
        "wmo_codes": fx.wmo_codes,
        "wx_data": fx.wx_data.withColumn("dtg", F.col("dtg").cast("timestamp")),
    }, path)
    tables = sources.scan_star_schema(fx.spark, path)
    return tables["wx_data"].join(tables["cities"], "city_id").select(
        "data_id", "city_id", "city_name", F.col("dtg").cast("timestamp_ntz").alias("dtg"),
        *[F.col(c).cast("double").alias(c) for c in ("temp_c", "humidity", "precip_chance")],
        "precip_mm", "wmo_code")


@query("scan_geocode_map")
def _(fx):
    return sources.scan_geocode_map(fx.geocode_documents, order="doc")


@query("payload_to_rows")
def _(fx):
    path = scratch_path(fx.spark, "payloads")
    sources.export_json(fx.payloads, path)
    return rounded(sources.scan_payloads(fx.spark, path))


def _export(fx) -> DataFrame:
    return export.denormalised(fx.wx_data, fx.cities, fx.admin_div_1, fx.states, fx.wmo_codes)


def _plain_decimals(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


@query("export_denormalised")
def _(fx):
    return _plain_decimals(_export(fx))


@query("export_csv")
def _(fx):
    path, rows = scratch_path(fx.spark, "export-csv"), _export(fx)
    sources.export_csv(rows, path)
    return _plain_decimals(fx.spark.read.schema(rows.schema).option("header", True).csv(path))


@query("export_json")
def _(fx):
    path, rows = scratch_path(fx.spark, "export-json"), _export(fx)
    sources.export_json(rows, path)
    return _plain_decimals(fx.spark.read.schema(rows.schema).json(path))


@query("export_train_csv")
def _(fx):
    path = scratch_path(fx.spark, "train-csv")
    jobs.export_train_csv(_split(fx), path)
    back = fx.spark.read.schema(_supervised(fx).schema).option("header", True).csv(path)
    return rounded(back)


@query("trailing_years_filter")
def _(fx):
    return rounded(sources.trailing_years_filter(fx.obs, years=2, end=date(2000, 2, 29)))


@query("recent_since_cutoff")
def _(fx):
    return _plain_decimals(export.recent_since_cutoff(fx.wx_data, datetime(2001, 8, 1, 12), 365))


# --- loading ------------------------------------------------------------------------------------

@query("normalize_observations")
def _(fx):
    return rounded(load.normalize(fx.messy_obs, ingest_order="ingest_seq"))


@query("to_storage_rows")
def _(fx):
    ids = fx.cities.select("city_id", F.col("city_name").alias("city"))
    rows = load.to_storage_rows(fx.obs, ids)
    return _plain_decimals(rows.withColumn("dtg", F.col("dtg").cast("timestamp_ntz")))


@query("append_new_only")
def _(fx):
    stage = fx.wx_data.select("city_id", "dtg", "temp_c", "precip_mm", "wmo_code")
    return _plain_decimals(load.append_new_only(stage, fx.wx_data.filter("dtg < '1998-01-01'")))


@query("append_counts")
def _(fx):
    return load.load_counts(fx.wx_data, fx.wx_data.filter("dtg < '1998-01-01'"))


@query("replace_scope")
def _(fx):
    asia = fx.cities.filter("div1_id = 2").select("city_id")
    batch = fx.wx_data.filter("dtg >= '1997-01-01' AND dtg < '1998-01-01'").join(asia, "city_id")
    return _plain_decimals(load.outside_replace_scope(fx.wx_data, batch))


@query("stored_as_dry")
def _(fx):
    tenths = fx.obs.withColumn("precip_mm", F.col("precip_mm") / 10)
    return load.rounded_to_dry(tenths)


@query("dimension_get_or_create")
def _(fx):
    grown = load.load_reference(fx.place_batch, fx.loaded_places["states"],
                                fx.loaded_places["admin_div_1"], fx.loaded_places["cities"])
    return grown["cities"].join(grown["admin_div_1"], "div1_id").join(
        grown["states"], "state_id").select(
        "city_id", "city_name", "div1_id", "div1_name", "state_id", "state_abbr",
        "state_name_short")


@query("upsert_do_nothing")
def _(fx):
    texts = load.code_texts(fx.wx_data).dropna()
    early = load.code_texts(fx.wx_data.filter("dtg < '1995-01-03'")).dropna().select(
        "wmo_code", F.concat(F.lit("old: "), "wmo_text").alias("wmo_text"))
    return load.insert_missing(early, texts, ["wmo_code"])


@query("strict_code_lookup")
def _(fx):
    codes = load.code_texts(fx.wx_data).select(
        F.lit("wmo").alias("kind"), F.col("wmo_code").alias("code"),
        F.col("wmo_text").alias("text"))
    country = F.element_at(F.array(*map(F.lit, "US,GB,JP,AU,BR,CA,DE,FR,IN,MX,XX,YY".split(","))),
                           (F.col("c_nationkey") % 12 + 1).cast("int"))
    countries = fx.table("customer").select(country.alias("country_code")).distinct()
    return codes.unionByName(load.iso3_lookup(countries).select(
        F.lit("iso").alias("kind"), F.col("country_code").alias("code"),
        F.col("state_abbr").alias("text")))


@query("strict_code_rejects")
def _(fx):
    try:
        load.require_code_texts(fx.wx_data)
    except RejectedRows as refused:
        return refused.rows
    return fx.wx_data.select("wmo_code").limit(0)


@query("ingest_round_trip")
def _(fx):
    path = scratch_path(fx.spark, "warehouse")
    jobs.empty_star_schema(fx.spark, path)
    rain = F.when((F.dayofmonth("date") == 7) & (F.col("precip_mm") > 0),
                  -F.col("precip_mm") - 1).otherwise(F.col("precip_mm"))
    batch = fx.messy_obs.withColumn("precip_mm", rain)
    # Every city twice: the later place counts.
    cities = fx.cities.select(F.col("city_name").alias("city"), F.lit("Brazil").alias("country"),
                              F.lit("BR").alias("country_code"), F.lit("").alias("admin1"))
    places = cities.withColumn("position", F.lit(2)).unionByName(cities.withColumns({
        "position": F.lit(1), "country": F.lit("Japan"), "country_code": F.lit("JP")}))
    for _run in range(2):       # the second run inserts nothing
        jobs.ingest(fx.spark, batch, places, path, ingest_order="ingest_seq",
                    place_order="position", earliest="1996-01-01 00:00:00", strict_codes=False)
    tables = sources.scan_star_schema(fx.spark, path)
    return tables["wx_data"].join(tables["cities"], "city_id").select(
        "data_id", F.col("city_name").alias("city"), F.to_date("dtg").alias("date"),
        F.col("temp_c").cast("double").alias("temp_c"), "precip_mm")


# --- quality ------------------------------------------------------------------------------------

def _star(fx) -> dict[str, DataFrame]:
    return {"states": fx.states, "admin_div_1": fx.admin_div_1, "cities": fx.cities,
            "wmo_codes": fx.wmo_codes, "wx_data": fx.wx_data}


@query("constraint_violations")
def _(fx):
    return quality.constraint_violations(_star(fx), earliest="1996-01-01 00:00:00")


@query("quarantined_rows")
def _(fx):
    rows = quality.quarantine(fx.wx_data, _star(fx), earliest="1996-01-01 00:00:00")
    return rows.select("data_id", F.array_join("broken", ",").alias("broken"))


@query("city_name_clashes")
def _(fx):
    regions = fx.cities.join(fx.admin_div_1, "div1_id").select(
        "city_id", F.col("div1_name").alias("city_name"))
    return rollup.name_clashes(rollup.daily_rollup(fx.wx_data, regions))


@query("city_first_coordinates")
def _(fx):
    patchy = fx.located.withColumns({
        "latitude": F.when(F.dayofmonth("date") % 2 == 0, F.col("latitude") + F.month("date")),
        "longitude": F.when(F.dayofmonth("date") % 3 == 0, F.col("longitude") + F.month("date")),
    })
    return rollup.first_coordinates(patchy)


# --- lookups ------------------------------------------------------------------------------------

@query("attach_coordinates")
def _(fx):
    return rounded(lookup.attach_coordinates(fx.obs, fx.slugged_coordinates))


@query("match_city")
def _(fx):
    return lookup.match_city(fx.city_texts, fx.known_cities)


@query("requests_to_features")
def _(fx):
    days = cut_lineage(fx.located)
    features = ft.build_features(ft.asked_history(days, fx.requests))
    return rounded(lookup.requests_to_features(fx.requests, features, ft.usable_days(days)))


@query("point_lookup")
def _(fx):
    return _plain_decimals(lookup.point_lookup(fx.point_requests, fx.wx_data, fx.cities))


@query("gazetteer_pick")
def _(fx):
    return lookup.gazetteer_pick(fx.gazetteer)


# --- serving windows ----------------------------------------------------------------------------

AS_OF = date(2000, 6, 30)


@query("serving_tail")
def _(fx):
    return rounded(ft.serving_tail(fx.obs, AS_OF))


@query("serving_features")
def _(fx):
    rows = ft.serving_features(fx.located, AS_OF)
    return rounded(rows.drop("y_temp_mean_c", "y_precip_mm", "y_is_wet", "y_condition"))


# --- split, baselines, scores -------------------------------------------------------------------

def _supervised(fx) -> DataFrame:
    return ft.labelled(ft.build_features(fx.located))


def _split(fx) -> DataFrame:
    return split.split_64_16_20(_supervised(fx))


ALL_CLASSES = sorted([*WMO_CATEGORIES, UNKNOWN_CATEGORY])


def _climatology(fx) -> tuple[DataFrame, list[str]]:
    rows, classes = _split(fx), ALL_CLASSES
    coded = rows.withColumn("y_condition_code", F.array_position(
        F.array(*map(F.lit, classes)), F.col("y_condition")).cast("int") - 1)
    # Stored once: the rates and the rows they are joined to both read it.
    stored = cut_lineage(coded.select(
        "city", "date", "latitude", "longitude", "temp_mean_c", "temp_max_c", "temp_min_c",
        "precip_mm", "condition", "y_is_wet", "y_condition", "y_condition_code", "split"))
    return metrics.climatology(stored, classes), classes


@query("split_64_16_20")
def _(fx):
    return _split(fx).select("city", "date", "split")


@query("split_exact")
def _(fx):
    return split.split_64_16_20(_supervised(fx), exact=True).select("city", "date", "split")


@query("encode_condition")
def _(fx):
    return split.encode_condition(_supervised(fx)).select(
        "city", "date", "y_condition", "y_condition_code")


@query("climatology_forecast")
def _(fx):
    rows, classes = _climatology(fx)
    probabilities = [F.get("p_condition", F.lit(i)).alias(f"p_{name.lower()}")
                     for i, name in enumerate(classes)]
    return rounded(rows.select("city", "date", "split", "p_wet", *probabilities))


@query("evaluate_temperature")
def _(fx):
    return rounded(metrics.evaluate_temperature(
        _split(fx).filter("split = 'test'"), "y_temp_mean_c", ft.WARMUP_COLUMN, "temp_mean_c"))


@query("evaluate_precipitation")
def _(fx):
    rows, _classes = _climatology(fx)
    return rounded(metrics.evaluate_precipitation(
        rows.filter("split = 'test'"), "y_is_wet", "p_wet"))


@query("evaluate_condition")
def _(fx):
    rows, classes = _climatology(fx)
    return rounded(metrics.evaluate_condition(
        rows.filter("split = 'test'"), "y_condition_code", "p_condition", len(classes)))


# --- forecast documents -------------------------------------------------------------------------

@query("condition_ranking")
def _(fx):
    rows, classes = _climatology(fx)
    ranked = forecast.condition_ranking(F.col("p_condition"), classes)
    return rows.select(
        "city", "date", F.array_join(F.map_keys(ranked), ">").alias("ranking"),
        F.get(F.map_values(ranked), F.lit(0)).alias("best"),
        F.get(F.map_values(ranked), F.lit(1)).alias("second"))


@query("forecast_document")
def _(fx):
    rows, classes = _climatology(fx)
    trained = fx.coordinates.filter("latitude >= 0").select(
        "city", (F.col("latitude") + 0.25).alias("latitude"), "longitude")
    documents = forecast.forecast_documents(
        rows.withColumn("p_temp", F.col("temp_mean_c")), classes, trained, 1.23456,
        {"bundle_version": "1.0", "trained_at": "2001-01-01T00:00:00+00:00", "split": "hash",
         "configs": {"temperature": "persistence"}})
    parsed = F.from_json(forecast.to_json(), documents.schema["forecast"].dataType.simpleString())
    d = documents.select(parsed.alias("d"))
    fields = {
        "city": "city", "as_of_date": "as_of_date", "target_date": "target_date",
        "latitude": "location.latitude", "longitude": "location.longitude",
        "mean_c": "temperature.mean_c", "mean_f": "temperature.mean_f",
        "expected_error_c": "temperature.expected_error_c",
        "probability": "precipitation.probability",
        "will_precipitate": "precipitation.will_precipitate",
        "threshold_mm": "precipitation.threshold_mm",
        "category": "condition.category", "confidence": "condition.confidence",
        "observed_max_c": "observed_on_as_of_date.temp_max_c",
        "observed_precip_mm": "observed_on_as_of_date.precip_mm",
        "observed_condition": "observed_on_as_of_date.condition",
        "api_version": "model.api_version", "split": "model.split",
    }
    return rounded(d.select(
        *[F.col(f"d.{path}").alias(name) for name, path in fields.items()],
        F.array_join(F.map_keys("d.condition.probabilities"), ">").alias("ranking"),
        F.col("d.model.configs")["temperature"].alias("config")))


# --- streaming ----------------------------------------------------------------------------------

@query("streaming_daily_rollup")
def _(fx):
    base = scratch_path(fx.spark, "stream")
    fx.wx_data.withColumn("dtg", F.col("dtg").cast("timestamp")).repartition(4).write.parquet(
        f"{base}/in")
    # One file a batch, in no order of time.
    readings = streaming.read_readings(fx.spark, f"{base}/in", files_per_batch=1)
    streaming.run_available(readings, f"{base}/sums", f"{base}/state")
    return rounded(streaming.merged_days(fx.spark, f"{base}/sums", fx.cities))


# --- training -----------------------------------------------------------------------------------

#: One search per session and input rows: the whole grid for all three targets.
_SEARCHED: dict[tuple, tuple] = {}


def searched(fx):
    rows = cut_lineage(fx.located)
    print_of_rows = rows.agg(F.count("*"), F.sum(F.xxhash64("*").cast("decimal(38,0)"))).first()
    key = (fx.spark.sparkContext.applicationId, *print_of_rows)
    if key not in _SEARCHED:
        _SEARCHED[key] = jobs.train(rows)
    return _SEARCHED[key]


@query("assemble_features")
def _(fx):
    days = cut_lineage(fx.located)
    rows, names, _classes = jobs.supervised_rows(days, ft.city_vocabulary(days))
    return rounded(training.matrix_cells(rows, names, ["city", "date", "split"]))


def _tested(fx, target: str) -> DataFrame:
    """Scores of the best of all candidates on the test rows."""
    bundle, _ = searched(fx)
    return training.scores_table(fx.spark, bundle.metrics[target]["test"])


@query("train_temperature")
def _(fx):
    return _tested(fx, "temperature")


@query("train_precipitation")
def _(fx):
    return _tested(fx, "precipitation")


@query("train_condition")
def _(fx):
    return _tested(fx, "condition")


@query("grid_search")
def _(fx):
    return training.trials_table(fx.spark, searched(fx)[1])


@query("trial_ranking")
def _(fx):
    """Days of a month as trials of the month, by their mean temperature: whole degrees, so they tie."""
    days = fx.obs.where("temp_mean_c IS NOT NULL")
    return training.ranked_trials(days.select(
        F.concat_ws("|", "city", F.date_format("date", "yyyy-MM")).alias("target"),
        F.dayofmonth("date").alias("position"), F.floor("temp_mean_c").cast("double").alias("score")))


@query("curve_sampling")
def _(fx):
    """Each city's days as the rounds of a curve, the warmest kept."""
    days = fx.obs.where("temp_mean_c IS NOT NULL")
    city = Window.partitionBy("city")
    curve = days.select(
        F.lit("temperature").alias("target"), F.col("city").alias("name"),
        F.row_number().over(city.orderBy("date")).alias("round"), F.col("temp_mean_c").alias("score"),
        (F.row_number().over(city.orderBy(F.desc("temp_mean_c"), "date")) == 1).alias("kept"))
    return rounded(training.sampled_curves(curve))


@query("learning_curves")
def _(fx):
    return training.sampled_curves(training.curves_table(fx.spark, searched(fx)[1]))


@query("feature_importances")
def _(fx):
    return training.importances_table(fx.spark, searched(fx)[1])


@query("batch_forecast")
def _(fx):
    asked = fx.requests.select("data_id", F.lower("city").alias("query"), "as_of")
    answered = jobs.forecast(searched(fx)[0], fx.located, asked)
    return answered.select("data_id", "query", "as_of", "city", "reason",
                           forecast.to_json().alias("forecast"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
