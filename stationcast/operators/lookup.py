"""Joins by name: coordinates, loosely spelled cities, requests, gazetteer candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.functions.names import slug
from stationcast.operators.rejects import refuse


def attach_coordinates(days: DataFrame, coordinates: DataFrame, strict: bool = True) -> DataFrame:
    """Add latitude and longitude by folded city name, as second and third column.

    ``coordinates`` has one row per ``slug`` (see ``sources.scan_geocode_map``). Names are folded
    once per distinct city. A city without coordinates is an error unless ``strict`` is off; the
    check is a job of its own, so pass stored rows when the days are costly to compute.
    """
    names = days.select("city").distinct().withColumn("slug", slug("city"))
    located = names.join(coordinates.select("slug", "latitude", "longitude"), "slug", "left")
    if strict:
        refuse(located.filter("latitude IS NULL").select("city"), "no coordinates for", "city")
    others = [c for c in days.columns if c != "city"]
    return days.join(located.drop("slug"), "city", "left").select(
        "city", "latitude", "longitude", *others)


def city_keys(cities: DataFrame) -> DataFrame:
    """Every spelling key a city answers to: (key, exact, prefixed, city).

    A name of n characters has n + 1 prefixes, so the table stays within 61 rows per city and
    prefix matching becomes an equi join instead of a comparison of all pairs. ``exact`` is the
    first city that folds to the key; ``prefixed`` counts the cities whose fold starts with it.
    """
    folded = cities.select("city").distinct().withColumn("slug", slug("city"))
    prefixes = folded.select(
        "city", "slug",
        F.explode(F.transform(F.sequence(F.lit(0), F.length("slug")),
                              lambda n: F.substring("slug", F.lit(1), n))).alias("key"))
    return prefixes.groupBy("key").agg(
        F.min(F.when(F.col("slug") == F.col("key"), F.col("city"))).alias("exact"),
        F.count(F.lit(1)).alias("prefixed"),
        F.min("city").alias("only"),
        F.max("city").alias("last"),
    )


def match_city(requests: DataFrame, cities: DataFrame, text: str = "query") -> DataFrame:
    """Resolve request text to a city: the exact fold first, else the only city it is a prefix of.

    Adds ``city`` (null when refused) and ``reason``, which says how many cities an
    ambiguous name fits and the first and last of them. Each distinct text is folded and matched once, then joined back.
    """
    texts = requests.select(F.col(text).alias("__text")).distinct().withColumn(
        "__key", slug("__text"))
    resolved = texts.join(city_keys(cities).withColumnRenamed("key", "__key"), "__key", "left")
    found = requests.join(resolved, F.col(text).eqNullSafe(F.col("__text")), "left")
    city = F.coalesce("exact", F.when(F.col("prefixed") == 1, F.col("only")))
    return found.withColumn("city", city).withColumn(
        "reason",
        F.when(F.col("city").isNotNull(), F.lit(None))
        .when(F.col("prefixed") > 1, F.concat(
            F.lit("ambiguous city: "), F.col("prefixed").cast("string"), F.lit(" fit, from "),
            F.col("only"), F.lit(" to "), F.col("last")))
        .otherwise("unknown city"),
    ).select(*requests.columns, "city", "reason")


def requests_to_features(requests: DataFrame, features: DataFrame,
                         usable: DataFrame | None = None) -> DataFrame:
    """Join resolved requests (city, as_of) to their feature row.

    Requests without one keep null features and a ``reason`` that names the usable dates: those of
    ``usable`` (city, first_usable, last_usable), or else of the features.
    """
    if usable is None:
        usable = features.groupBy("city").agg(
            F.min("date").alias("first_usable"), F.max("date").alias("last_usable"))
    usable = usable.select("city", F.col("first_usable").alias("__first"),
                           F.col("last_usable").alias("__last"))
    rows = features.withColumn("__found", F.lit(True)).withColumnRenamed("date", "as_of")
    joined = requests.withColumn("as_of", F.to_date("as_of")).join(
        rows, ["city", "as_of"], "left").join(usable, "city", "left")
    refusal = F.concat(
        F.lit("no usable history for "), "city", F.lit(" on "), F.col("as_of").cast("string"),
        F.lit("; available dates run "), F.col("__first").cast("string"), F.lit(" to "),
        F.col("__last").cast("string"))
    given = F.col("reason") if "reason" in requests.columns else F.lit(None).cast("string")
    reason = F.coalesce(given, F.when(F.col("__found").isNull(), refusal))
    return joined.withColumn("reason", reason).select(
        *[c for c in requests.columns if c != "reason"],
        *[c for c in features.columns if c not in ("city", "date")
          and c not in requests.columns],
        "reason")


LOOKED_UP = ("temp_c", "humidity", "precip_chance", "precip_mm")


def point_lookup(requests: DataFrame, readings: DataFrame, cities: DataFrame) -> DataFrame:
    """Readings at an exact city and time, for a table of requests (city, dtg).

    A request without city or time is refused in ``status``; one without readings is reported as
    not found. Hits come from an inner join, which Spark can split on both sides where many
    readings share a key; misses from an anti join against the distinct keys.
    """
    ids = cities.select("city_id", F.col("city_name").alias("city"))
    facts = readings.select("city_id", "dtg", *LOOKED_UP).join(ids, "city_id").drop("city_id")
    key = ["city", "dtg"]
    hits = requests.join(facts, key).select(
        *requests.columns, *LOOKED_UP, F.lit("ok").alias("status"))
    status = (F.when(F.col("city").isNull(), "no city given")
              .when(F.col("dtg").isNull(), "no dtg given").otherwise("not found"))
    misses = requests.join(facts.select(*key).distinct(), key, "left_anti").select(
        *requests.columns, status.alias("status"))
    return hits.unionByName(misses, allowMissingColumns=True)


def gazetteer_pick(candidates: DataFrame) -> DataFrame:
    """Best place per query: the best-ranked one in the wanted country, else the best-ranked.

    ``candidates``: query, wanted_country, rank, country_code and place columns. An empty wanted
    country accepts every candidate. Missing text fields get their defaults (the query as name,
    UTC, empty). One mergeable ``min`` per query, no sorting of groups.
    """
    open_choice = F.coalesce(F.col("wanted_country"), F.lit("")) == ""
    elsewhere = ~(open_choice | F.coalesce(
        F.col("country_code") == F.col("wanted_country"), F.lit(False)))
    place = [c for c in candidates.columns if c not in ("query", "wanted_country", "rank")]
    best = F.min(F.struct(elsewhere.alias("elsewhere"), F.col("rank"), *place)).alias("best")
    absent = {"name": F.col("query"), "timezone": F.lit("UTC"), "country": F.lit(""),
              "country_code": F.lit(""), "admin1": F.lit("")}

    def picked(column: str):
        value = F.col(f"best.{column}")
        return F.coalesce(value, absent[column]) if column in absent else value

    return candidates.groupBy("query", "wanted_country").agg(best).select(
        "query", "wanted_country", F.col("best.rank").alias("rank"),
        *[picked(c).alias(c) for c in place])
