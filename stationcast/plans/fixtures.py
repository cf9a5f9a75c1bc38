"""Weather-shaped tables derived from the driver's order tables.

``orders`` joined with ``customer`` plays the sub-daily fact table, the nations are the cities and
the order dates are the observation days, so every series has natural gaps, nulls and odd codes.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.functions.names import slug
from stationcast.operators.rollup import daily_rollup
from stationcast.schemas import WMO_TEXT
from stationcast.session import fixed_table

CODE_CYCLE = ("0,1,2,3,45,48,51,53,55,56,57,61,63,65,66,67,71,73,75,77,80,81,82,85,86,95,96,99,7"
              ).split(",")


class Fixtures:
    """Lazily planned fixture tables over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def wx_data(self) -> DataFrame:
        key = F.col("o_orderkey")
        cents = F.col("cents")
        code = F.element_at(F.array(*map(F.lit, CODE_CYCLE)), (cents % 29 + 1).cast("int"))
        orders = self.table("orders").select(
            "o_orderkey", "o_custkey", "o_orderdate",
            F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
        customers = self.table("customer").select("c_custkey", "c_nationkey")
        return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
            key.alias("data_id"),
            F.col("c_nationkey").alias("city_id"),
            (F.col("o_orderdate") + F.make_dt_interval(hours=(key % 24).cast("int"))).alias("dtg"),
            F.when(key % 17 != 0, ((cents % 551 - 150) / 10.0).cast("decimal(4,1)"))
            .alias("temp_c"),
            ((F.col("o_custkey") % 101) / 100.0).cast("decimal(3,2)").alias("humidity"),
            ((cents % 101) / 100.0).cast("decimal(3,2)").alias("precip_chance"),
            F.when(key % 23 != 0, F.when(cents % 3 == 0, (cents % 20).cast("int")).otherwise(0))
            .alias("precip_mm"),
            F.when(key % 29 == 0, F.lit(None)).when(key % 31 == 0, "  ").otherwise(code)
            .alias("wmo_code"),
        )

    @cached_property
    def cities(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city_name"),
            F.col("n_regionkey").alias("div1_id"))

    @cached_property
    def admin_div_1(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").alias("div1_id"), F.col("r_name").alias("div1_name"),
            (F.col("r_regionkey") % 2).alias("state_id"))

    @cached_property
    def states(self) -> DataFrame:
        return fixed_table(
            self.spark,
            "state_id INT, state_name_long STRING, state_name_short STRING, state_abbr STRING",
            [(0, "Evenland", "Evenland", "EVN"), (1, "Oddland", "Oddland", "ODD")])

    @cached_property
    def wmo_codes(self) -> DataFrame:
        return fixed_table(self.spark, "wmo_code STRING, wmo_text STRING",
                           [(str(code), text) for code, text in WMO_TEXT.items()])

    @cached_property
    def coordinates(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city"),
            ((F.col("n_nationkey") - 12) * 5).cast("double").alias("latitude"),
            (F.col("n_nationkey") * 10 - 120).cast("double").alias("longitude"))

    @cached_property
    def obs(self) -> DataFrame:
        return daily_rollup(self.wx_data, self.cities)

    @cached_property
    def located(self) -> DataFrame:
        """The rollup with coordinates, in the canonical column order."""
        return self.obs.join(self.coordinates.drop("city_id"), "city").select(
            "city", "latitude", "longitude", "date", "temp_mean_c", "temp_max_c", "temp_min_c",
            "precip_mm", "wmo_code")

    @cached_property
    def messy_obs(self) -> DataFrame:
        """City-days with a later, wrong copy of every fifth day of the month."""
        copies = self.obs.filter(F.dayofmonth("date") % 5 == 0).withColumn(
            "temp_mean_c", F.col("temp_mean_c") + 100)
        return self.obs.withColumn("ingest_seq", F.lit(1)).unionByName(
            copies.withColumn("ingest_seq", F.lit(2)))

    @cached_property
    def slugged_coordinates(self) -> DataFrame:
        return self.coordinates.select(slug("city").alias("slug"), "latitude", "longitude")

    @cached_property
    def named_readings(self) -> DataFrame:
        return self.wx_data.join(self.cities.select("city_id", "city_name"), "city_id")

    @cached_property
    def geocode_documents(self) -> DataFrame:
        """JSON maps of ten suppliers each; some lack a coordinate, some share a name."""
        key = F.col("s_suppkey")
        place = F.struct(
            F.when(key % 8 == 3, F.concat(F.lit("Supplier#"), F.lpad(
                (key - 3).cast("string"), 9, "0"))).otherwise(F.col("s_name")).alias("name"),
            F.when(key % 11 != 5, (key % 181 - 90).cast("double")).alias("latitude"),
            F.when(key % 13 != 6, (key % 361 - 180).cast("double")).alias("longitude"),
            F.lit("UTC").alias("timezone"),
            F.concat(F.lit("Land "), F.col("s_nationkey").cast("string")).alias("country"),
            F.lit("US").alias("country_code"), F.lit("").alias("admin1"))
        entry = F.struct(F.format_string("%012d|US", "s_suppkey").alias("key"),
                         place.alias("value"))
        entries = F.array_sort(F.collect_list(entry))
        return self.table("supplier").groupBy(F.expr("s_suppkey div 10").alias("doc")).agg(
            F.to_json(F.map_from_entries(entries)).alias("json"))

    @cached_property
    def payloads(self) -> DataFrame:
        """One archive payload per city and year, some arrays cut short, emptied or left out."""
        day = F.struct("date", "temp_mean_c", "temp_max_c", "temp_min_c", "precip_mm", "wmo_code")
        years = self.located.groupBy(
            "city", "latitude", "longitude", F.year("date").alias("y")
        ).agg(F.array_sort(F.collect_list(day)).alias("d"))
        n = F.size("d")
        daily = F.struct(
            F.transform("d", lambda x: x["date"].cast("string")).alias("time"),
            F.col("d.temp_mean_c").alias("temperature_2m_mean"),
            F.when(F.col("y") % 4 == 1, F.array().cast("array<double>"))
            .otherwise(F.col("d.temp_max_c")).alias("temperature_2m_max"),
            F.col("d.temp_min_c").alias("temperature_2m_min"),
            F.slice("d.precip_mm", F.lit(1), F.greatest(n - 5, F.lit(0)))
            .alias("precipitation_sum"),
            F.when(F.col("y") % 3 != 0, F.col("d.wmo_code")).alias("weather_code"))
        return years.select("city", "latitude", "longitude",
                            F.to_json(F.struct(daily.alias("daily"))).alias("payload"))

    @cached_property
    def place_batch(self) -> DataFrame:
        """Suppliers as cities to load, with country and first-level division."""
        codes = F.array(*map(F.lit, "US,GB,JP,AU,BR,CA,DE,FR,IN,MX".split(",")))
        index = (F.col("s_nationkey") % 10 + 1).cast("int")
        return self.table("supplier").select(
            F.col("s_name").alias("city"),
            F.concat(F.lit("Country "), F.element_at(codes, index)).alias("country"),
            F.element_at(codes, index).alias("country_code"),
            F.when(F.col("s_nationkey") >= 20, "").otherwise(
                F.concat(F.lit("Division "), (F.col("s_suppkey") % 50).cast("string")))
            .alias("admin1"))

    @cached_property
    def loaded_places(self) -> dict[str, DataFrame]:
        """Dimensions as an earlier load left them: suppliers in debt are there already."""
        cities = self.table("supplier").filter("s_acctbal < 0").select(
            (F.col("s_suppkey") + 1).cast("int").alias("city_id"),
            F.col("s_name").alias("city_name"), F.lit(1).alias("div1_id"))
        divisions = fixed_table(
            self.spark, "div1_id INT, div1_name STRING, state_id INT", [(1, "Division 1", 1)])
        states = fixed_table(
            self.spark,
            "state_id INT, state_name_long STRING, state_name_short STRING, state_abbr STRING",
            [(1, "Country US", "Country US", "USA")])
        return {"states": states, "admin_div_1": divisions, "cities": cities}

    @cached_property
    def city_texts(self) -> DataFrame:
        """Per customer, a city spelled loosely: by prefix, exactly, ambiguously or not at all."""
        kind, nation = F.col("c_custkey") % 5, F.col("c_nationkey").cast("string")
        return self.table("customer").join(
            self.known_cities, F.col("c_nationkey") == F.col("n_nationkey")).select(
            "c_custkey",
            F.when(kind == 0, F.concat(F.lit("nation "), nation))
            .when(kind == 1, F.replace(F.upper("city"), F.lit(" "), F.lit("-")))
            .when(kind == 2, F.concat(F.lit("Atlantis "), nation))
            .when(kind == 3, F.concat(F.lit("Nation_"),
                                      (F.col("c_nationkey") % 3).cast("string")))
            .otherwise(F.concat(F.lit("  "), F.substring("city", 1, 10))).alias("query"))

    @cached_property
    def known_cities(self) -> DataFrame:
        return self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        ).select("n_nationkey", F.concat_ws(" ", "n_name", "r_name").alias("city"))

    @cached_property
    def requests(self) -> DataFrame:
        """A forecast request per reading; every seventh asks for a day far off the record."""
        shift = F.when(F.col("data_id") % 7 == 0, 4000).otherwise(0)
        return self.named_readings.select(
            "data_id", F.col("city_name").alias("city"),
            F.date_add(F.to_date("dtg"), shift).alias("as_of"))

    @cached_property
    def point_requests(self) -> DataFrame:
        """Distinct (city, time) lookups: most hit, some are an hour off, some lack a part."""
        key = F.col("data_id")
        return self.named_readings.select(
            F.when(key % 13 != 0, F.col("city_name")).alias("city"),
            F.when(key % 19 != 0, F.when(key % 5 == 0, F.col("dtg") + F.expr("INTERVAL 30 MINUTES"))
                   .otherwise(F.col("dtg"))).alias("dtg")).distinct()

    @cached_property
    def gazetteer(self) -> DataFrame:
        """Every customer is a candidate place for a query of its segment and nation."""
        countries = F.array(*map(F.lit, ["US", "GB", "JP"]))
        nation = F.col("c_nationkey")
        return self.table("customer").select(
            F.concat_ws(" ", "c_mktsegment", nation.cast("string")).alias("query"),
            F.when(nation % 4 == 0, "").when(nation % 4 == 1, "BR")
            .otherwise("GB").alias("wanted_country"),
            F.col("c_custkey").alias("rank"),
            F.element_at(countries, (F.col("c_custkey") % 3 + 1).cast("int"))
            .alias("country_code"),
            F.col("c_name").alias("name"), F.col("c_acctbal").alias("latitude"))
