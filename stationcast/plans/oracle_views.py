"""DuckDB fixture views and SQL fragments of the expected results.

Written from the operator definitions (row windows, guarded frames, plain range joins), not from
the Spark plans. Every statement inlines the fixture views it needs.
"""

from __future__ import annotations

import re

VIEWS = {
    "fx_wx_data": """
        SELECT o_orderkey AS data_id, c_nationkey AS city_id,
          o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT) AS dtg,
          CASE WHEN o_orderkey % 17 = 0 THEN NULL
               ELSE CAST(((cents % 551) - 150) / 10.0 AS DECIMAL(4,1)) END AS temp_c,
          CAST((o_custkey % 101) / 100.0 AS DECIMAL(3,2)) AS humidity,
          CAST((cents % 101) / 100.0 AS DECIMAL(3,2)) AS precip_chance,
          CASE WHEN o_orderkey % 23 = 0 THEN NULL
               WHEN cents % 3 = 0 THEN CAST(cents % 20 AS INT) ELSE 0 END AS precip_mm,
          CASE WHEN o_orderkey % 29 = 0 THEN NULL
               WHEN o_orderkey % 31 = 0 THEN '  '
               ELSE split_part('0,1,2,3,45,48,51,53,55,56,57,61,63,65,66,67,71,73,75,77,80,81,82,85,86,95,96,99,7',
                               ',', CAST(cents % 29 AS INT) + 1) END AS wmo_code
        FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders) o
        JOIN customer ON o_custkey = c_custkey""",
    "fx_cities": """
        SELECT n_nationkey AS city_id, n_name AS city_name, n_regionkey AS div1_id FROM nation""",
    "fx_admin_div_1": """
        SELECT r_regionkey AS div1_id, r_name AS div1_name, r_regionkey % 2 AS state_id
        FROM region""",
    "fx_states": """
        SELECT 0 AS state_id, 'Evenland' AS state_name_short, 'EVN' AS state_abbr
        UNION ALL SELECT 1, 'Oddland', 'ODD'""",
    "fx_wmo_codes": """
        SELECT * FROM (VALUES
          ('0','Clear sky'),('1','Mainly clear'),('2','Partly cloudy'),('3','Overcast'),
          ('45','Fog'),('48','Depositing rime fog'),('51','Light drizzle'),
          ('53','Moderate drizzle'),('55','Dense drizzle'),('56','Light freezing drizzle'),
          ('57','Dense freezing drizzle'),('61','Slight rain'),('63','Moderate rain'),
          ('65','Heavy rain'),('66','Light freezing rain'),('67','Heavy freezing rain'),
          ('71','Slight snow fall'),('73','Moderate snow fall'),('75','Heavy snow fall'),
          ('77','Snow grains'),('80','Slight rain showers'),('81','Moderate rain showers'),
          ('82','Violent rain showers'),('85','Slight snow showers'),
          ('86','Heavy snow showers'),('95','Thunderstorm'),
          ('96','Thunderstorm with slight hail'),('99','Thunderstorm with heavy hail')
        ) AS w(wmo_code, wmo_text)""",
    "fx_coordinates": """
        SELECT n_nationkey AS city_id, n_name AS city,
          CAST((n_nationkey - 12) * 5 AS DOUBLE) AS latitude,
          CAST(n_nationkey * 10 - 120 AS DOUBLE) AS longitude
        FROM nation""",
    "fx_obs": """
        SELECT c.city_name AS city, CAST(w.dtg AS DATE) AS date,
          CAST(SUM(w.temp_c) AS DOUBLE) / COUNT(w.temp_c) AS temp_mean_c,
          CAST(MAX(w.temp_c) AS DOUBLE) AS temp_max_c,
          CAST(MIN(w.temp_c) AS DOUBLE) AS temp_min_c,
          CAST(SUM(w.precip_mm) AS DOUBLE) AS precip_mm,
          MAX(CAST(NULLIF(TRIM(w.wmo_code), '') AS INT)) AS wmo_code
        FROM fx_wx_data w JOIN fx_cities c ON c.city_id = w.city_id
        GROUP BY c.city_id, c.city_name, CAST(w.dtg AS DATE)
        HAVING COUNT(w.temp_c) >= 1""",
    "fx_messy_obs": """
        SELECT *, 1 AS ingest_seq FROM fx_obs
        UNION ALL
        SELECT city, date, temp_mean_c + 100, temp_max_c, temp_min_c, precip_mm, wmo_code, 2
        FROM fx_obs WHERE day(date) % 5 = 0""",
    # Row-local columns of a city-day.
    "days": """
        SELECT o.*, k.latitude, k.longitude,
          temp_max_c - temp_min_c AS temp_range_c,
          CASE WHEN precip_mm > 0.1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_wet,
          CASE WHEN wmo_code IN (0,1) THEN 'Clear' WHEN wmo_code IN (2,3) THEN 'Cloudy'
               WHEN wmo_code IN (45,48) THEN 'Fog'
               WHEN wmo_code IN (51,53,55,56,57) THEN 'Drizzle'
               WHEN wmo_code IN (61,63,65,66,67,80,81,82) THEN 'Rain'
               WHEN wmo_code IN (71,73,75,77,85,86) THEN 'Snow'
               WHEN wmo_code IN (95,96,99) THEN 'Thunderstorm' ELSE 'Unknown' END AS condition
        FROM fx_obs o JOIN fx_coordinates k ON k.city = o.city""",
    # Labels and the warm-up flag for every city-day.
    "lab": """
        SELECT *,
          CASE WHEN cnt30 = 30 THEN avg30 END AS roll30,
          CASE WHEN consecutive THEN next_temp END AS y_temp_mean_c,
          CASE WHEN consecutive THEN next_precip END AS y_precip_mm,
          CASE WHEN consecutive AND next_precip IS NOT NULL
               THEN CASE WHEN next_precip > 0.1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS y_is_wet,
          CASE WHEN consecutive THEN next_condition END AS y_condition
        FROM (SELECT *,
            COUNT(temp_mean_c) OVER (PARTITION BY city ORDER BY date
                                     ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS cnt30,
            AVG(temp_mean_c) OVER (PARTITION BY city ORDER BY date
                                   ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS avg30,
            LEAD(date) OVER (PARTITION BY city ORDER BY date) = date + 1 AS consecutive,
            LEAD(temp_mean_c) OVER (PARTITION BY city ORDER BY date) AS next_temp,
            LEAD(precip_mm) OVER (PARTITION BY city ORDER BY date) AS next_precip,
            LEAD(condition) OVER (PARTITION BY city ORDER BY date) AS next_condition
          FROM days)""",
    "supervised": """
        SELECT * FROM lab
        WHERE roll30 IS NOT NULL AND y_temp_mean_c IS NOT NULL AND y_is_wet IS NOT NULL
          AND y_condition IS NOT NULL""",
    "split_rows": """
        SELECT *, CASE WHEN h >= 'cccccccc' THEN 'test' WHEN h >= 'a3d70a3d' THEN 'validate'
                       ELSE 'train' END AS split
        FROM (SELECT *, substr(md5(concat(city, '|', CAST(date AS VARCHAR), '|', '42')), 1, 8) AS h
              FROM supervised)""",
    "named_readings": """
        SELECT w.*, c.city_name FROM fx_wx_data w JOIN fx_cities c ON c.city_id = w.city_id""",
    "rates": """
        SELECT city AS rate_city, AVG(y_is_wet) AS p_wet,
          AVG(CASE WHEN y_condition = 'Clear' THEN 1.0::DOUBLE ELSE 0 END) AS p_clear,
          AVG(CASE WHEN y_condition = 'Cloudy' THEN 1.0::DOUBLE ELSE 0 END) AS p_cloudy,
          AVG(CASE WHEN y_condition = 'Drizzle' THEN 1.0::DOUBLE ELSE 0 END) AS p_drizzle,
          AVG(CASE WHEN y_condition = 'Fog' THEN 1.0::DOUBLE ELSE 0 END) AS p_fog,
          AVG(CASE WHEN y_condition = 'Rain' THEN 1.0::DOUBLE ELSE 0 END) AS p_rain,
          AVG(CASE WHEN y_condition = 'Snow' THEN 1.0::DOUBLE ELSE 0 END) AS p_snow,
          AVG(CASE WHEN y_condition = 'Thunderstorm' THEN 1.0::DOUBLE ELSE 0 END)
            AS p_thunderstorm,
          AVG(CASE WHEN y_condition = 'Unknown' THEN 1.0::DOUBLE ELSE 0 END) AS p_unknown
        FROM split_rows WHERE split = 'train' GROUP BY city""",
    "overall": """
        SELECT AVG(y_is_wet) AS a_wet,
          AVG(CASE WHEN y_condition = 'Clear' THEN 1.0::DOUBLE ELSE 0 END) AS a_clear,
          AVG(CASE WHEN y_condition = 'Cloudy' THEN 1.0::DOUBLE ELSE 0 END) AS a_cloudy,
          AVG(CASE WHEN y_condition = 'Drizzle' THEN 1.0::DOUBLE ELSE 0 END) AS a_drizzle,
          AVG(CASE WHEN y_condition = 'Fog' THEN 1.0::DOUBLE ELSE 0 END) AS a_fog,
          AVG(CASE WHEN y_condition = 'Rain' THEN 1.0::DOUBLE ELSE 0 END) AS a_rain,
          AVG(CASE WHEN y_condition = 'Snow' THEN 1.0::DOUBLE ELSE 0 END) AS a_snow,
          AVG(CASE WHEN y_condition = 'Thunderstorm' THEN 1.0::DOUBLE ELSE 0 END)
            AS a_thunderstorm,
          AVG(CASE WHEN y_condition = 'Unknown' THEN 1.0::DOUBLE ELSE 0 END) AS a_unknown
        FROM split_rows WHERE split = 'train'""",
    "climate": """
        SELECT *, [p_clear, p_cloudy, p_drizzle, p_fog, p_rain, p_snow, p_thunderstorm,
                   p_unknown] AS p_condition,
          ['Clear', 'Cloudy', 'Drizzle', 'Fog', 'Rain', 'Snow', 'Thunderstorm', 'Unknown']
            AS class_names
        FROM (SELECT s.*, COALESCE(p_wet, a_wet) AS p_wet, COALESCE(p_clear, a_clear) AS p_clear,
                COALESCE(p_cloudy, a_cloudy) AS p_cloudy,
                COALESCE(p_drizzle, a_drizzle) AS p_drizzle, COALESCE(p_fog, a_fog) AS p_fog,
                COALESCE(p_rain, a_rain) AS p_rain, COALESCE(p_snow, a_snow) AS p_snow,
                COALESCE(p_thunderstorm, a_thunderstorm) AS p_thunderstorm,
                COALESCE(p_unknown, a_unknown) AS p_unknown
              FROM split_rows s CROSS JOIN overall LEFT JOIN rates r ON r.rate_city = s.city)""",
    "ranked": """
        SELECT city, date, string_agg(name, '>' ORDER BY p DESC, i) AS ranking,
          CAST(format('{:.4f}', max(CASE WHEN place = 1 THEN p END)) AS DOUBLE) AS best,
          CAST(format('{:.4f}', max(CASE WHEN place = 2 THEN p END)) AS DOUBLE) AS second
        FROM (SELECT *, row_number() OVER (PARTITION BY city, date ORDER BY p DESC, i) AS place
              FROM (SELECT city, date, unnest(p_condition) AS p, unnest(class_names) AS name,
                           generate_subscripts(class_names, 1) AS i FROM climate))
        GROUP BY city, date""",
    "loaded_cities": """
        SELECT CAST(s_suppkey + 1 AS INT) AS city_id, s_name AS city_name, 1 AS div1_id
        FROM supplier WHERE s_acctbal < 0""",
    "places": """
        SELECT s_name AS city,
          'Country ' || split_part('US,GB,JP,AU,BR,CA,DE,FR,IN,MX', ',', s_nationkey % 10 + 1)
            AS country,
          split_part('USA,GBR,JPN,AUS,BRA,CAN,DEU,FRA,IND,MEX', ',', s_nationkey % 10 + 1)
            AS state_abbr,
          CASE WHEN s_nationkey >= 20
               THEN 'Country ' || split_part('US,GB,JP,AU,BR,CA,DE,FR,IN,MX', ',',
                                             s_nationkey % 10 + 1)
               ELSE 'Division ' || CAST(s_suppkey % 50 AS VARCHAR) END AS div1_name
        FROM supplier""",
    "all_states": """
        SELECT 1 AS state_id, 'USA' AS state_abbr, 'Country US' AS state_name_short
        UNION ALL
        SELECT 1 + row_number() OVER (ORDER BY first_city), state_abbr, country
        FROM (SELECT state_abbr, MIN(country) AS country, MIN(city) AS first_city FROM places
              WHERE state_abbr <> 'USA' GROUP BY state_abbr)""",
    "all_divisions": """
        SELECT 1 AS div1_id, 'Division 1' AS div1_name, 1 AS state_id
        UNION ALL
        SELECT 1 + row_number() OVER (ORDER BY first_city), div1_name, state_id
        FROM (SELECT div1_name, MIN(city) AS first_city, arg_min(state_id, city) AS state_id
              FROM places JOIN all_states USING (state_abbr)
              WHERE div1_name <> 'Division 1' GROUP BY div1_name)""",
    "all_cities": """
        SELECT city_id, city_name, div1_id FROM loaded_cities
        UNION ALL
        SELECT (SELECT COALESCE(MAX(city_id), 0) FROM loaded_cities)
                 + row_number() OVER (ORDER BY city), city, div1_id
        FROM places JOIN all_divisions USING (div1_name)
        WHERE city NOT IN (SELECT city_name FROM loaded_cities)""",
    "exported": """
        SELECT w.dtg, c.city_name, a.div1_name AS admin_region,
          s.state_name_short AS state_country, s.state_abbr, CAST(w.temp_c AS DOUBLE) AS temp_c,
          CAST(w.humidity AS DOUBLE) AS humidity, CAST(w.precip_chance AS DOUBLE) AS precip_chance,
          w.precip_mm, k.wmo_text AS weather_condition
        FROM fx_wx_data w JOIN fx_cities c ON w.city_id = c.city_id
        JOIN fx_admin_div_1 a ON c.div1_id = a.div1_id
        JOIN fx_states s ON a.state_id = s.state_id
        LEFT JOIN fx_wmo_codes k ON w.wmo_code = k.wmo_code""",
}


def with_views(body: str) -> str:
    """Prefix ``body`` with the CTEs it names, directly or through other views."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(VIEWS[name])

    visit(body)
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in needed)
    body = body.strip()
    if not ctes:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def rnd(expression: str, name: str, digits: int = 6) -> str:
    """Rounded output column without last-bit noise and negative zero."""
    return f"round(round({expression}, 9), {digits}) + 0.0::DOUBLE AS {name}"


BY_CITY = "PARTITION BY city ORDER BY date"


def guarded(function: str, column: str, n: int) -> str:
    frame = f"OVER ({BY_CITY} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN COUNT({column}) {frame} = {n} THEN {function}({column}) {frame} END"


LAG_SQL = [
    rnd(f"LAG({c}, {k}) OVER ({BY_CITY})", f"{c}_lag{k}")
    for c in ("temp_mean_c", "temp_max_c", "temp_min_c", "precip_mm", "temp_range_c")
    for k in (1, 2, 3, 7)
]
MEAN_SQL = [
    rnd(guarded("AVG", c, n), f"{c}_roll{n}_mean")
    for c, n in [(c, n) for c in ("temp_mean_c", "precip_mm") for n in (3, 7, 14, 30)]
    + [("temp_range_c", 7)]
]
STD_SQL = [rnd(guarded("STDDEV_SAMP", "temp_mean_c", n), f"temp_mean_c_roll{n}_std")
           for n in (7, 30)]
SUM_SQL = (
    [rnd(guarded("SUM", "precip_mm", n), f"precip_mm_roll{n}_sum") for n in (3, 7)]
    + [rnd(guarded("SUM", "is_wet", n), f"wet_days_roll{n}") for n in (7, 30)]
)
DELTA_SQL = [
    rnd(f"temp_mean_c - LAG(temp_mean_c, 1) OVER ({BY_CITY})", "temp_delta_1d"),
    rnd(f"temp_mean_c - LAG(temp_mean_c, 3) OVER ({BY_CITY})", "temp_delta_3d"),
    rnd(f"temp_mean_c - {guarded('AVG', 'temp_mean_c', 7)}", "temp_anomaly_7d"),
    rnd(f"temp_mean_c - {guarded('AVG', 'temp_mean_c', 30)}", "temp_anomaly_30d"),
    rnd(f"precip_mm - LAG(precip_mm, 1) OVER ({BY_CITY})", "precip_delta_1d"),
]
SEASON_SQL = [
    "CAST(date + 1 AS DATE) AS target_date",
    rnd("sin(2 * pi() * dayofyear(date + 1) / 365.25)", "target_doy_sin"),
    rnd("cos(2 * pi() * dayofyear(date + 1) / 365.25)", "target_doy_cos"),
    "CAST(month(date + 1) AS DOUBLE) AS target_month",
    rnd("sin(2 * pi() * dayofyear(date + 1) / 365.25) * sign(latitude)", "hemisphere_doy_sin"),
]
COND_SQL = [
    f"CASE WHEN condition = '{c}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS cond_today_{c.lower()}"
    for c in ("Clear", "Cloudy", "Fog", "Drizzle", "Rain", "Snow", "Thunderstorm")
]
LABEL_SQL = [
    rnd("y_temp_mean_c", "y_temp_mean_c"), rnd("y_precip_mm", "y_precip_mm"),
    "y_is_wet", "y_condition",
]
DAY_SQL = [
    "city", "date", rnd("temp_mean_c", "temp_mean_c"), rnd("temp_max_c", "temp_max_c"),
    rnd("temp_min_c", "temp_min_c"), rnd("precip_mm", "precip_mm"), "wmo_code",
]


def pick(columns: list[str], source: str) -> str:
    return f"SELECT {', '.join(columns)} FROM {source}"


FEATURE_SQL = [
    "city", "date", "latitude", "longitude", *DAY_SQL[2:],
    "condition", rnd("temp_range_c", "temp_range_c"), "is_wet",
    *LAG_SQL, *MEAN_SQL, *STD_SQL, *SUM_SQL, *DELTA_SQL, *COND_SQL, *SEASON_SQL, *LABEL_SQL,
]
