"""Idempotent loading of city-days into the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationcast.functions.numbers import round_half_even
from stationcast.operators.ordering import dense_numbers
from stationcast.operators.rejects import refuse
from stationcast.schemas import ISO3, LONG_NAME, REQUIRED_OBS, SHORT_NAME, WMO_TEXT
from stationcast.session import cut_lineage, fixed_table


def normalize(obs: DataFrame, ingest_order: str | None = None,
              origin: str = "the observations", strict: bool = False) -> DataFrame:
    """One row per (city, date): checked columns, real dates, the first-ingested row kept.

    The first row is found with a mergeable ``min`` over (ingest order, row), so any number of
    copies of one city-day collapses before the shuffle. Without an ingest order, ties are broken
    by the row's own values, which keeps the result repeatable; ``strict`` then refuses city-days
    whose copies differ, since which came first is not known.
    """
    missing = sorted(set(REQUIRED_OBS) - set(obs.columns))
    if missing:
        raise ValueError(f"{origin} is missing column(s): {', '.join(missing)}")
    values = [c for c in obs.columns if c not in ("city", "date", ingest_order)]
    clean = obs.select(
        "city", F.to_date("date").alias("date"),
        *[_no_nan(obs, c) for c in values],
        *([ingest_order] if ingest_order else []))
    order = [ingest_order] if ingest_order else []
    struct = F.struct(*order, *values)
    days = clean.groupBy("city", "date").agg(F.min(struct).alias("row"), F.max(struct).alias("last"))
    if strict and not ingest_order:
        refuse(days.filter("row <> last").select(
            F.concat_ws(" ", "city", "date").alias("city_day")),
            f"{origin} differ in copies of a city-day and have no ingest order:", "city_day")
    kept = days.select(
        "city", "date", *[F.col(f"row.{c}").alias(c) for c in values])
    return kept.select(*[c for c in obs.columns if c != ingest_order])


def _no_nan(df: DataFrame, column: str):
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(column), F.col(column)).alias(column)
    return F.col(column)


def to_storage_rows(obs: DataFrame, city_ids: DataFrame) -> DataFrame:
    """City-days as fact rows: midnight UTC, temperature to one decimal, whole millimetres."""
    return obs.join(city_ids.select("city", "city_id"), "city").select(
        "city_id",
        F.col("date").cast("timestamp").alias("dtg"),
        round_half_even(F.col("temp_mean_c"), 1).cast("decimal(4,1)").alias("temp_c"),
        round_half_even(F.col("precip_mm"), 0).cast("int").alias("precip_mm"),
        F.col("wmo_code").cast("int").cast("string").alias("wmo_code"),
    )


# --- dimensions ---------------------------------------------------------------------------------

def get_or_create(existing: DataFrame, wanted: DataFrame, key: list[str], id_column: str,
                  first_seen: str) -> DataFrame:
    """``existing`` plus a numbered row for every new natural key in ``wanted``.

    Several wanted rows with one key give one row, the one with the smallest ``first_seen``; new
    ids continue after the largest existing id in ``first_seen`` order.
    """
    columns = [c for c in wanted.columns if c not in (*key, first_seen)]
    distinct = wanted.groupBy(*key).agg(
        F.min(F.struct(first_seen, *columns)).alias("row")
    ).select(*key, *[F.col(f"row.{c}").alias(c) for c in [first_seen, *columns]])
    new = distinct.join(existing.select(*key), key, "left_anti")
    last = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("last")).scalar()
    numbered = dense_numbers(new, [first_seen], id_column, last)
    return existing.unionByName(
        numbered.drop(first_seen).withColumn(
            id_column, F.col(id_column).cast(existing.schema[id_column].dataType)),
        allowMissingColumns=True)


def one_place_per_city(places: DataFrame, order: str | None = None) -> DataFrame:
    """One row per city: the last in ``order``. Without an order, places that differ are refused."""
    values = [c for c in places.columns if c not in ("city", order)]
    row = F.struct(*([order] if order else []), *values)
    picked = places.groupBy("city").agg(F.max(row).alias("row"), F.min(row).alias("other"))
    if not order:
        refuse(picked.filter("row <> other").select("city"),
               "different places and no order for", "city")
    return picked.select("city", *[F.col(f"row.{c}").alias(c) for c in values])


def load_reference(places: DataFrame, states: DataFrame, divisions: DataFrame,
                   cities: DataFrame, natural_key: str = "reference") -> dict[str, DataFrame]:
    """Extend the three location dimensions with the places of a batch.

    ``places`` holds one row per city: city, country, country_code, admin1. With the ``reference``
    key a division is known by its name alone, so equal names in two countries share a row; the
    ``composite`` key includes the parent. Returns the dimensions and ``city_ids``.
    """
    if natural_key not in ("reference", "composite"):
        raise ValueError("natural_key is 'reference' or 'composite'")
    composite = natural_key == "composite"
    coded = cut_lineage(require_iso3(places).select(
        F.substring("city", 1, LONG_NAME).alias("city_name"),
        "city", "country", "state_abbr",
        F.substring(F.coalesce(F.nullif("admin1", F.lit("")), F.nullif("country", F.lit("")),
                               F.col("city")), 1, LONG_NAME).alias("div1_name")))

    states = get_or_create(
        states,
        coded.select("state_abbr", F.substring("country", 1, LONG_NAME).alias("state_name_long"),
                     F.substring("country", 1, SHORT_NAME).alias("state_name_short"), "city"),
        ["state_abbr"], "state_id", "city")
    by_abbr = states.groupBy("state_abbr").agg(F.min("state_id").alias("state_id"))
    placed = coded.join(by_abbr, "state_abbr")

    div_key = ["div1_name", "state_id"] if composite else ["div1_name"]
    divisions = get_or_create(
        divisions, placed.select("div1_name", "state_id", "city"), div_key, "div1_id", "city")
    by_name = divisions.groupBy(*div_key).agg(F.min("div1_id").alias("div1_id"))
    placed = placed.join(by_name, div_key)

    city_key = ["city_name", "div1_id"] if composite else ["city_name"]
    cities = get_or_create(
        cities, placed.select("city_name", "div1_id", "city"), city_key, "city_id", "city")
    ids = cities.groupBy(*city_key).agg(F.min("city_id").alias("city_id"))
    return {
        "states": states, "admin_div_1": divisions, "cities": cities,
        "city_ids": placed.join(ids, city_key).groupBy("city").agg(
            F.min("city_id").alias("city_id")),
    }


def iso3_lookup(places: DataFrame) -> DataFrame:
    """Add ``state_abbr``, null where the two-letter code is not known."""
    table = fixed_table(places.sparkSession, "country_code STRING, state_abbr STRING",
                        list(ISO3.items()))
    return places.join(F.broadcast(table), "country_code", "left")


def require_iso3(places: DataFrame) -> DataFrame:
    looked_up = iso3_lookup(places)
    refuse(looked_up.filter("state_abbr IS NULL").select("country_code").distinct(),
           "no ISO 3-letter code known for", "country_code")
    return looked_up


def code_texts(codes: DataFrame) -> DataFrame:
    """Distinct WMO codes with their text; the text is null for codes that are not known."""
    table = fixed_table(codes.sparkSession, "wmo_code STRING, wmo_text STRING",
                        [(str(code), text) for code, text in WMO_TEXT.items()])
    used = codes.select(
        F.nullif(F.trim("wmo_code"), F.lit("")).alias("wmo_code")).dropna().distinct()
    return used.join(F.broadcast(table), "wmo_code", "left").withColumn(
        "wmo_text", F.substring("wmo_text", 1, SHORT_NAME))


def require_code_texts(codes: DataFrame) -> DataFrame:
    texts = code_texts(codes)
    refuse(texts.filter("wmo_text IS NULL").select("wmo_code"), "no wmo_text for code(s)",
           "wmo_code")
    return texts


def insert_missing(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """``existing`` plus the rows of ``new`` whose key it lacks (insert, on conflict do nothing)."""
    return existing.unionByName(new.join(existing.select(*key), key, "left_anti"))


# --- facts --------------------------------------------------------------------------------------

FACT_KEY = ["city_id", "dtg"]


def append_new_only(stage: DataFrame, target: DataFrame) -> DataFrame:
    """Staged rows whose (city_id, dtg) the target lacks; copies within the stage all stay.

    Target keys are made distinct first, so copies collapse before they are shuffled; the staged
    rows are the left side of the anti join, which AQE can split where one key is hot.
    """
    return stage.join(target.select(*FACT_KEY).distinct(), FACT_KEY, "left_anti")


def load_counts(stage: DataFrame, target: DataFrame) -> DataFrame:
    """One row: how many staged rows a load would insert and skip."""
    present = target.select(*FACT_KEY).distinct().withColumn("present", F.lit(True))
    keyed = stage.groupBy(*FACT_KEY).agg(F.count(F.lit(1)).alias("rows"))
    return keyed.join(present, FACT_KEY, "left").agg(
        F.coalesce(F.sum(F.when(F.col("present").isNull(), F.col("rows"))), F.lit(0))
        .alias("inserted"),
        F.coalesce(F.sum(F.when(F.col("present"), F.col("rows"))), F.lit(0)).alias("skipped"))


def outside_replace_scope(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Target rows that survive a replace: all but the box of batch cities and batch time span."""
    span = batch.agg(F.struct(F.min("dtg").alias("low"), F.max("dtg").alias("high")).alias("s"))
    cities = batch.select("city_id").distinct().withColumn("__hit", F.lit(True))
    flagged = target.withColumn("__span", span.scalar()).join(cities, "city_id", "left")
    boxed = F.coalesce(F.col("__hit"), F.lit(False)) & F.col("dtg").between(
        F.col("__span.low"), F.col("__span.high"))
    return flagged.filter(~F.coalesce(boxed, F.lit(False))).select(*target.columns)


def rounded_to_dry(obs: DataFrame) -> DataFrame:
    """How many city-days carry rain that whole millimetres store as 0."""
    return obs.agg(F.count_if((F.col("precip_mm") > 0) & (F.col("precip_mm") < 0.5))
                   .alias("stored_as_dry"))


def number_facts(rows: DataFrame, start: int) -> DataFrame:
    """Give fact rows the ``data_id`` values after ``start``, in key order."""
    return dense_numbers(rows, FACT_KEY, "data_id", start)


def load_facts(stage: DataFrame, load) -> tuple[int, int]:
    """Append the staged rows the facts lack to a warehouse ``load``; returns (inserted, skipped).

    Only fact files that may hold a staged key are read for the comparison. Nothing is visible before
    the load commits.
    """
    staged, near = stage.count(), load.base.near(stage)
    if near:
        stage = cut_lineage(append_new_only(stage, load.base.read("wx_data", near)))
    rows = stage.count() if near else staged
    if rows:
        load.append_facts(number_facts(stage, load.base.last_id()))
    return rows, staged - rows


def replace_facts(stage: DataFrame, load) -> tuple[int, int]:
    """Replace the batch's box in a warehouse ``load`` by the batch; returns (deleted, inserted).

    Only the files that reach into the box are written anew, without its rows.
    """
    span = stage.agg(F.min("dtg").alias("low"), F.max("dtg").alias("high"),
                     F.count(F.lit(1)).alias("rows")).first()
    if span.rows == 0:
        return 0, 0
    box = stage.select("city_id").distinct().select("city_id", F.explode(F.array(
        F.lit(span.low), F.lit(span.high))).alias("dtg"))
    touched = load.base.near(box)
    deleted, content = 0, number_facts(stage, load.base.last_id())
    if touched:
        before = load.base.read("wx_data", touched)
        kept = cut_lineage(outside_replace_scope(before, stage).drop("year"))
        deleted = before.count() - kept.count()
        content = content.unionByName(kept, allowMissingColumns=True)
    load.drop_facts(touched)
    load.append_facts(content)
    return deleted, span.rows
