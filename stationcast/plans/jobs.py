"""Whole jobs: ingest, train, forecast and export, composed from the operators."""

from __future__ import annotations

from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.operators import features as ft
from stationcast.operators import load, quality, training
from stationcast.operators.boosting import fit_bins
from stationcast.operators.export import denormalised, recent_since_cutoff
from stationcast.operators.forecast import forecast_documents
from stationcast.operators.lookup import match_city, requests_to_features
from stationcast.operators.rejects import refuse
from stationcast.operators.rollup import first_coordinates
from stationcast.operators.split import (
    condition_encoder,
    require_enough_rows,
    split_64_16_20,
    split_by_time,
)
from stationcast.schemas import CANDIDATES, EARLIEST_READING, PATIENCE, TARGET_CONDITION
from stationcast.session import cut_lineage
from stationcast.sources import (
    export_csv,
    export_json,
    scan_payloads,
    trailing_years_filter,
)
from stationcast.sources.warehouse import Warehouse

SPLIT_NAMES = {"hash": "hash 64/16/20 by city and date",
               "exact": "hash 64/16/20 by city and date, exact sizes",
               "time": "64/16/20 in order of time"}


def supervised_rows(days: DataFrame, vocabulary: dict[str, str] | None, how: str = "hash"):
    """Labelled feature rows with class index and split; returns (rows, feature names, classes).

    The rows are stored once: encoding, splitting and binning all read them again.
    """
    rows = cut_lineage(ft.labelled(ft.build_features(days, vocabulary)))
    names = ft.feature_names(rows)
    encoder = condition_encoder(require_enough_rows(rows))
    coded = encoder.transform(rows).withColumn(
        TARGET_CONDITION, F.col(TARGET_CONDITION).cast("int"))
    if how not in SPLIT_NAMES:
        raise ValueError(f"unknown split {how!r}; expected one of: {', '.join(SPLIT_NAMES)}")
    parts = split_by_time(coded) if how == "time" else split_64_16_20(coded, exact=how == "exact")
    return parts, names, list(encoder.labels)


def training_rows(rows: DataFrame, names: list[str], city: bool = False):
    """Bins fitted on the train split, and the rows that training reads, stored once."""
    bins = fit_bins(rows.filter("split = 'train'"), names, city)
    kept = list(dict.fromkeys(["city", "date", "split", "temp_mean_c", "y_temp_mean_c", "y_is_wet",
                               TARGET_CONDITION, *names]))
    return bins, cut_lineage(rows.select(*kept))


def train(days: DataFrame, grid=CANDIDATES, patience: int = PATIENCE, source: str = "csv",
          split: str = "hash", parallel: int = 8, cities: str = "vector"):
    """Search all targets, keep the best model of each; returns (bundle, trials).

    ``cities`` names the form of the city: one column with a bin per city for any number of them
    (``vector``), or 0/1 ``columns`` by name. ``split`` is ``hash``, ``exact`` or ``time``.
    """
    if cities not in ("vector", "columns"):
        raise ValueError("cities is 'vector' or 'columns'")
    days = cut_lineage(days)
    vocabulary = ft.city_vocabulary(days) if cities == "columns" else {}
    rows, names, classes = supervised_rows(days, vocabulary, split)
    bins, rows = training_rows(rows, names, city=cities == "vector")
    found = training.search(list(training.TARGET_LABELS), rows, bins, classes, grid, patience, parallel)
    test = rows.filter("split = 'test'")
    best = {target: trials[:1] for target, trials in found.items()}
    curves = training.sampled_curves(training.curves_table(days.sparkSession, best)).collect()
    scores = {}
    for target, (trial, *_) in found.items():
        scores[target] = {
            "config": trial.candidate["name"], "params": trial.candidate,
            "best_iteration": trial.best_iteration, "validate": trial.validate,
            "test": training.evaluate(target, trial.model, test, classes),
            "learning_curve": sorted((r["round"], r["score"]) for r in curves
                                     if r["target"] == target),
        }
    bundle = training.Bundle(
        bins=bins, **{target: trials[0].model for target, trials in found.items()},
        cities=first_coordinates(days), feature_names=names, classes=classes,
        vocabulary=vocabulary, metrics=scores, split=SPLIT_NAMES[split], source=source,
        trained_at=datetime.now(timezone.utc).isoformat(timespec="seconds"))
    return bundle, found


def export_train_csv(split_rows: DataFrame, path: str) -> None:
    """The train split as CSV."""
    export_csv(split_rows.filter("split = 'train'").drop("split"), path)


def forecast(bundle: training.Bundle, days: DataFrame, requests: DataFrame) -> DataFrame:
    """Forecast every request (query, as_of) at once.

    The city-days are stored once. Features are built only for what was asked: per city the span of
    its requests and the window before it. Each city-day asked for is scored once. Returns the request columns with ``city``, ``reason`` (why a request was refused) and the
    nested ``forecast`` (null when refused).
    """
    days = cut_lineage(days)
    usable = cut_lineage(ft.usable_days(days))
    resolved = cut_lineage(match_city(requests, usable).withColumn("as_of", F.to_date("as_of")))
    features = ft.build_features(ft.asked_history(days, resolved), bundle.vocabulary)
    # However often a city-day is asked for, it is scored once.
    asked = resolved.filter("city IS NOT NULL").select("city", "as_of").distinct()
    # Stored, because answered and refused city-days take different ways from here.
    joined = cut_lineage(requests_to_features(asked, features, usable))
    ok = joined.filter("reason IS NULL")
    info = {"bundle_version": bundle.version, "trained_at": bundle.trained_at,
            "split": bundle.split,
            "configs": {t: entry["config"] for t, entry in bundle.metrics.items()}}
    error = bundle.metrics.get("temperature", {}).get("test", {}).get("mae_c", float("nan"))
    documents = forecast_documents(
        bundle.score(ok), bundle.classes, bundle.cities, error, info, day="as_of")
    key = [F.col("city").alias("__city"), F.col("as_of").alias("__as_of"),
           F.col("reason").alias("__reason")]
    answers = cut_lineage(documents.select(*key, "forecast").unionByName(
        joined.filter("reason IS NOT NULL").select(*key), allowMissingColumns=True))
    same = (F.col("city") == F.col("__city")) & F.col("as_of").eqNullSafe(F.col("__as_of"))
    return resolved.join(answers, same, "left").select(
        *requests.columns, "city", F.coalesce("reason", "__reason").alias("reason"), "forecast")


class Ingested(NamedTuple):
    """What a load did: rows inserted, already there, held back, and with rain stored as 0."""

    inserted: int
    skipped: int
    quarantined: int
    stored_as_dry: int


def ingest(spark: SparkSession, obs: DataFrame, places: DataFrame, path: str,
           replace: bool = False, natural_key: str = "reference",
           ingest_order: str | None = None, place_order: str | None = None,
           earliest: str = EARLIEST_READING, strict_codes: bool = True) -> Ingested:
    """Load city-days into the star schema at ``path``.

    Of several copies of a city-day the first in ``ingest_order`` counts, of several places of a city
    the last in ``place_order``; without these columns, copies that differ are refused. Rows that
    break a constraint are appended to the table quarantine with what they break and never become
    facts; a code without text is an error, or with ``strict_codes`` off such a row is held back too.

    The batch is stored once, since every step reads it. All tables change in one commit, see
    :mod:`stationcast.sources.warehouse`: a load that dies changes nothing and can be run again, and of
    two at once the second to commit is an error.
    """
    days = cut_lineage(load.normalize(obs, ingest_order, strict=True))
    used = days.select(F.col("wmo_code").cast("int").cast("string").alias("wmo_code"))
    codes = load.require_code_texts(used) if strict_codes else load.code_texts(used).dropna()
    warehouse = Warehouse(spark, path)
    tables, change = warehouse.tables(), warehouse.begin()
    named = cut_lineage(days.select("city").distinct().join(
        load.one_place_per_city(places, place_order), "city", "left").select(
        "city", F.col("country_code").isNotNull().alias("known"), "country", "country_code",
        "admin1"))
    refuse(named.filter("NOT known").select("city"), "no geocoding entry for", "city")
    grown = load.load_reference(named, tables["states"], tables["admin_div_1"],
                                tables["cities"], natural_key)
    ids = cut_lineage(grown.pop("city_ids"))
    grown["wmo_codes"] = load.insert_missing(tables["wmo_codes"], codes, ["wmo_code"])
    for name, df in grown.items():
        key = quality.PRIMARY_KEYS[name]
        added = cut_lineage(df.join(tables[name].select(key), key, "left_anti").select(*df.columns))
        if not added.isEmpty():
            change.append(name, added.coalesce(1))
        tables[name] = tables[name].unionByName(added)

    stage = cut_lineage(load.to_storage_rows(days, ids))
    broken = cut_lineage(quality.quarantine(
        stage, {"cities": tables["cities"], "wmo_codes": tables["wmo_codes"]}, earliest))
    held = broken.count()
    if held:
        change.append("quarantine", broken)
        # One row per city-day, so the key tells good rows from bad ones.
        stage = cut_lineage(stage.join(broken.select(*load.FACT_KEY), load.FACT_KEY, "left_anti"))
    dry = load.rounded_to_dry(days).first()["stored_as_dry"]
    if replace:
        done = load.replace_facts(stage, change)[1], 0
    else:
        done = load.load_facts(stage, change)
    change.commit()
    return Ingested(*done, held, dry)


def load_payloads(spark: SparkSession, folder: str, places: DataFrame, path: str,
                  years: int = 5, end=None, **options) -> Ingested:
    """Landed payload files to the star schema: rows per day, the trailing years, then ``ingest``."""
    days = trailing_years_filter(scan_payloads(spark, folder), years, end)
    return ingest(spark, days, places, path, **options)


def export(tables: dict[str, DataFrame], path: str, days: int | None = None, now=None,
           form: str = "csv") -> bool:
    """Save the denormalised readings of the last ``days`` days as CSV or JSON lines.

    Returns False, and writes nothing, when there are none.
    """
    if form not in ("csv", "json"):
        raise ValueError(f"unknown export form {form!r}; expected csv or json")
    facts = tables["wx_data"]
    if days is not None:
        facts = recent_since_cutoff(facts, now or datetime.now(timezone.utc), days)
    if facts.isEmpty():
        return False
    rows = denormalised(facts, tables["cities"], tables["admin_div_1"], tables["states"],
                        tables["wmo_codes"])
    (export_csv if form == "csv" else export_json)(rows, path)
    return True


def empty_star_schema(spark: SparkSession, path: str) -> None:
    """Create a warehouse of five empty tables at ``path``."""
    Warehouse.create(spark, path)
