"""Expected results of the source, load, lookup, score and document queries, in DuckDB SQL."""

from __future__ import annotations

from stationcast.plans.oracle_views import DAY_SQL, FEATURE_SQL, guarded, pick, rnd

FACT_SQL = """data_id, city_id, dtg, CAST(temp_c AS DOUBLE) AS temp_c,
          CAST(humidity AS DOUBLE) AS humidity, CAST(precip_chance AS DOUBLE) AS precip_chance,
          precip_mm, wmo_code"""

NOT_NULL_COLUMNS = [
    ("states", "state_id"), ("states", "state_abbr"), ("admin_div_1", "div1_id"),
    ("admin_div_1", "div1_name"), ("admin_div_1", "state_id"), ("cities", "city_id"),
    ("cities", "city_name"), ("cities", "div1_id"), ("wmo_codes", "wmo_code"),
    ("wmo_codes", "wmo_text"), ("wx_data", "data_id"), ("wx_data", "city_id"), ("wx_data", "dtg"),
]
BROKEN_RANGES = [
    ("dtg", "dtg < TIMESTAMP '1996-01-01'"), ("temp", "temp_c < -150 OR temp_c > 100"),
    ("precipch", "precip_chance < 0 OR precip_chance > 1"), ("precipmm", "precip_mm < 0"),
]
KEYS = [("states", "state_id"), ("admin_div_1", "div1_id"), ("cities", "city_id"),
        ("wmo_codes", "wmo_code"), ("wx_data", "data_id")]
REFERENCES = [("wx_data", "city_id", "cities"), ("wx_data", "wmo_code", "wmo_codes"),
              ("cities", "div1_id", "admin_div_1"), ("admin_div_1", "state_id", "states")]

CONSTRAINTS = "\nUNION ALL\n".join(
    [f"SELECT '{t}_{c}_not_null' AS \"constraint\", "
     f"COUNT(*) FILTER (WHERE {c} IS NULL) AS violations FROM fx_{t}"
     for t, c in NOT_NULL_COLUMNS]
    + ["SELECT 'states_state_name_long_not_null', "
       "COUNT(*) FILTER (WHERE state_name_short IS NULL) FROM fx_states"]
    + [f"SELECT 'wx_data_{n}_range', COUNT(*) FILTER (WHERE {broken}) FROM fx_wx_data"
       for n, broken in BROKEN_RANGES]
    + [f"SELECT '{t}_pk', COUNT(*) FROM (SELECT {k} FROM fx_{t} WHERE {k} IS NOT NULL "
       f"GROUP BY {k} HAVING COUNT(*) > 1)" for t, k in KEYS]
    + [f"SELECT '{t}_{k}_{u}_fk', COUNT(*) FROM fx_{t} x WHERE x.{k} IS NOT NULL "
       f"AND NOT EXISTS (SELECT 1 FROM fx_{u} y WHERE y.{k} = x.{k})"
       for t, k, u in REFERENCES])

CLIMATE_COLUMNS = ("p_wet", "p_clear", "p_cloudy", "p_drizzle", "p_fog", "p_rain", "p_snow",
                   "p_thunderstorm", "p_unknown")

ORACLES: dict[str, str] = {
    # 2.1 sources and sinks
    "scan_observations_csv": pick(
        ["city", "latitude", "longitude", *DAY_SQL[1:-1],
         "CAST(wmo_code AS DOUBLE) AS wmo_code"], "days"),
    "scan_star_schema": f"SELECT {FACT_SQL}, city_name FROM named_readings",
    "scan_geocode_map": """
        SELECT replace(lower(name), '#', '_') AS slug, name, latitude, longitude
        FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY s_suppkey DESC) AS newest
              FROM (SELECT s_suppkey,
                      CASE WHEN s_suppkey % 8 = 3
                           THEN 'Supplier#' || lpad(CAST(s_suppkey - 3 AS VARCHAR), 9, '0')
                           ELSE s_name END AS name,
                      CAST(s_suppkey % 181 - 90 AS DOUBLE) AS latitude,
                      CAST(s_suppkey % 361 - 180 AS DOUBLE) AS longitude
                    FROM supplier WHERE s_suppkey % 11 <> 5 AND s_suppkey % 13 <> 6))
        WHERE newest = 1""",
    "payload_to_rows": f"""
        SELECT city, latitude, longitude, date, {rnd('temp_mean_c', 'temp_mean_c')},
          CASE WHEN year(date) % 4 <> 1 THEN temp_max_c END AS temp_max_c, temp_min_c,
          CASE WHEN rn <= n - 5 THEN precip_mm END AS precip_mm,
          CASE WHEN year(date) % 3 <> 0 THEN wmo_code END AS wmo_code
        FROM (SELECT *, row_number() OVER (PARTITION BY city, year(date) ORDER BY date) AS rn,
                     COUNT(*) OVER (PARTITION BY city, year(date)) AS n FROM days)""",
    "export_denormalised": "SELECT * FROM exported",
    "export_csv": "SELECT * FROM exported",
    "export_json": "SELECT * FROM exported",
    "export_train_csv": f"""
        SELECT f.* FROM ({pick(FEATURE_SQL, 'lab')}) f
        JOIN (SELECT city, date FROM split_rows WHERE split = 'train') t USING (city, date)""",
    "trailing_years_filter": pick(
        DAY_SQL, "fx_obs WHERE date BETWEEN DATE '1998-02-28' AND DATE '2000-02-29'"),
    "recent_since_cutoff":
        f"SELECT {FACT_SQL} FROM fx_wx_data WHERE dtg >= TIMESTAMP '2000-08-01 12:00:00'",
    # 2.2, 2.3 loading
    "normalize_observations": pick(
        DAY_SQL, "(SELECT *, row_number() OVER (PARTITION BY city, date ORDER BY ingest_seq) AS r "
                 "FROM fx_messy_obs) WHERE r = 1"),
    "to_storage_rows": """
        SELECT c.city_id, CAST(o.date AS TIMESTAMP) AS dtg,
          CAST(format('{:.1f}', temp_mean_c) AS DOUBLE) + 0.0::DOUBLE AS temp_c,
          CAST(round_even(precip_mm, 0) AS INT) AS precip_mm, CAST(wmo_code AS VARCHAR) AS wmo_code
        FROM fx_obs o JOIN fx_cities c ON c.city_name = o.city""",
    "append_new_only": """
        SELECT city_id, dtg, CAST(temp_c AS DOUBLE) AS temp_c, precip_mm, wmo_code
        FROM fx_wx_data s
        WHERE NOT EXISTS (SELECT 1 FROM fx_wx_data w
                          WHERE w.dtg < TIMESTAMP '1998-01-01' AND w.city_id = s.city_id
                            AND w.dtg = s.dtg)""",
    "append_counts": """
        SELECT COUNT(*) FILTER (WHERE NOT present) AS inserted,
               COUNT(*) FILTER (WHERE present) AS skipped
        FROM (SELECT EXISTS (SELECT 1 FROM fx_wx_data w
                             WHERE w.dtg < TIMESTAMP '1998-01-01' AND w.city_id = s.city_id
                               AND w.dtg = s.dtg) AS present
              FROM fx_wx_data s)""",
    "replace_scope": f"""
        WITH batch AS (SELECT w.* FROM fx_wx_data w JOIN fx_cities c ON c.city_id = w.city_id
                       WHERE c.div1_id = 2 AND w.dtg >= TIMESTAMP '1997-01-01'
                         AND w.dtg < TIMESTAMP '1998-01-01')
        SELECT {FACT_SQL} FROM fx_wx_data
        WHERE NOT (city_id IN (SELECT city_id FROM batch)
                   AND dtg BETWEEN (SELECT MIN(dtg) FROM batch) AND (SELECT MAX(dtg) FROM batch))""",
    "stored_as_dry": """
        SELECT COUNT(*) FILTER (WHERE precip_mm > 0 AND precip_mm / 10 < 0.5) AS stored_as_dry
        FROM fx_obs""",
    "dimension_get_or_create": """
        SELECT CAST(city_id AS INT) AS city_id, city_name, CAST(div1_id AS INT) AS div1_id,
          div1_name, CAST(state_id AS INT) AS state_id, state_abbr, state_name_short
        FROM all_cities JOIN all_divisions USING (div1_id) JOIN all_states USING (state_id)""",
    "upsert_do_nothing": """
        SELECT k.wmo_code,
          CASE WHEN k.wmo_code IN (SELECT trim(wmo_code) FROM fx_wx_data
                                   WHERE dtg < TIMESTAMP '1995-01-03' AND wmo_code IS NOT NULL)
               THEN 'old: ' || wmo_text ELSE wmo_text END AS wmo_text
        FROM fx_wmo_codes k
        WHERE k.wmo_code IN (SELECT wmo_code FROM fx_wx_data WHERE wmo_code IS NOT NULL)""",
    "strict_code_lookup": """
        SELECT 'wmo' AS kind, u.wmo_code AS code, k.wmo_text AS text
        FROM (SELECT DISTINCT trim(wmo_code) AS wmo_code FROM fx_wx_data
              WHERE trim(wmo_code) <> '') u
        LEFT JOIN fx_wmo_codes k ON k.wmo_code = u.wmo_code
        UNION ALL
        SELECT DISTINCT 'iso',
          split_part('US,GB,JP,AU,BR,CA,DE,FR,IN,MX,XX,YY', ',', c_nationkey % 12 + 1),
          NULLIF(split_part('USA,GBR,JPN,AUS,BRA,CAN,DEU,FRA,IND,MEX,,', ',',
                            c_nationkey % 12 + 1), '')
        FROM customer""",
    "strict_code_rejects": """
        SELECT u.wmo_code FROM (SELECT DISTINCT trim(wmo_code) AS wmo_code FROM fx_wx_data
                                WHERE trim(wmo_code) <> '') u
        WHERE u.wmo_code NOT IN (SELECT wmo_code FROM fx_wmo_codes)""",
    # the messy rows once each, the first copy kept, those that break a CHECK held back
    "ingest_round_trip": """
        SELECT row_number() OVER (ORDER BY city, date) AS data_id, city, date,
          CAST(format('{:.1f}', temp_mean_c) AS DOUBLE) + 0.0::DOUBLE AS temp_c,
          CAST(round_even(precip_mm, 0) AS INT) AS precip_mm
        FROM fx_obs o
        WHERE date >= DATE '1996-01-01' AND NOT coalesce(day(date) = 7 AND precip_mm > 0, FALSE)
          AND (wmo_code IS NULL
               OR CAST(wmo_code AS VARCHAR) IN (SELECT wmo_code FROM fx_wmo_codes))""",
    # data quality
    "constraint_violations": CONSTRAINTS,
    "quarantined_rows": """
        SELECT data_id, concat_ws(',',
            CASE WHEN early THEN 'wx_data_dtg_range' END,
            CASE WHEN odd_code THEN 'wx_data_wmo_code_wmo_codes_fk' END) AS broken
        FROM (SELECT data_id, dtg < TIMESTAMP '1996-01-01' AS early,
                     w.wmo_code IS NOT NULL AND k.wmo_code IS NULL AS odd_code
              FROM fx_wx_data w LEFT JOIN fx_wmo_codes k ON k.wmo_code = w.wmo_code)
        WHERE early OR odd_code""",
    "city_name_clashes": """
        SELECT city, COUNT(*) AS clashing_days, MAX(n) AS max_rows
        FROM (SELECT div1_name AS city, day, COUNT(*) AS n
              FROM (SELECT DISTINCT a.div1_name, c.city_id, CAST(dtg AS DATE) AS day
                    FROM fx_wx_data w JOIN fx_cities c ON c.city_id = w.city_id
                    JOIN fx_admin_div_1 a ON a.div1_id = c.div1_id
                    WHERE w.temp_c IS NOT NULL)
              GROUP BY div1_name, day HAVING COUNT(*) > 1)
        GROUP BY city""",
    "city_first_coordinates": """
        SELECT city,
          arg_min(latitude + month(date), date) FILTER (WHERE day(date) % 2 = 0) AS latitude,
          arg_min(longitude + month(date), date) FILTER (WHERE day(date) % 3 = 0) AS longitude
        FROM days GROUP BY city""",
    # lookups
    "attach_coordinates": pick(["city", "latitude", "longitude", *DAY_SQL[1:]], "days"),
    "match_city": """
        WITH known AS (SELECT n_nationkey, n_name || ' ' || r_name AS city
                       FROM nation JOIN region ON n_regionkey = r_regionkey),
        slugs AS (SELECT city, replace(lower(city), ' ', '_') AS slug FROM known),
        asked AS (
          SELECT c_custkey,
            CASE c_custkey % 5
              WHEN 0 THEN 'nation ' || c_nationkey
              WHEN 1 THEN replace(upper(city), ' ', '-')
              WHEN 2 THEN 'Atlantis ' || c_nationkey
              WHEN 3 THEN 'Nation_' || (c_nationkey % 3)
              ELSE '  ' || left(city, 10) END AS query
          FROM customer JOIN known ON c_nationkey = n_nationkey),
        folded AS (SELECT *, trim(regexp_replace(lower(query), '[^0-9a-z]', '_', 'g'), '_') AS s
                   FROM asked),
        found AS (
          SELECT f.c_custkey, f.query, MIN(CASE WHEN k.slug = f.s THEN k.city END) AS exact,
                 COUNT(k.city) AS n, MIN(k.city) AS lone, MAX(k.city) AS final
          FROM folded f LEFT JOIN slugs k ON starts_with(k.slug, f.s)
          GROUP BY f.c_custkey, f.query)
        SELECT c_custkey, query,
          COALESCE(exact, CASE WHEN n = 1 THEN lone END) AS city,
          CASE WHEN exact IS NOT NULL OR n = 1 THEN NULL
               WHEN n > 1 THEN 'ambiguous city: ' || n || ' fit, from ' || lone || ' to ' || final
               ELSE 'unknown city' END AS reason
        FROM found""",
    "requests_to_features": f"""
        WITH asked AS (SELECT data_id, city_name AS city,
                         CAST(CAST(dtg AS DATE) + CASE WHEN data_id % 7 = 0 THEN 4000 ELSE 0 END
                              AS DATE) AS as_of FROM named_readings),
        usable AS (SELECT city, MIN(date) AS lo, MAX(date) AS hi FROM lab
                   WHERE roll30 IS NOT NULL GROUP BY city),
        frame AS (SELECT * FROM ({pick(FEATURE_SQL, 'lab')})
                  WHERE temp_mean_c_roll30_mean IS NOT NULL)
        SELECT a.data_id, a.city, a.as_of, l.* EXCLUDE (city, date),
          CASE WHEN l.city IS NULL
               THEN 'no usable history for ' || a.city || ' on ' || a.as_of
                    || '; available dates run ' || u.lo || ' to ' || u.hi END AS reason
        FROM asked a
        LEFT JOIN frame l ON l.city = a.city AND l.date = a.as_of
        LEFT JOIN usable u ON u.city = a.city""",
    "point_lookup": """
        WITH asked AS (
          SELECT DISTINCT CASE WHEN data_id % 13 <> 0 THEN city_name END AS city,
            CASE WHEN data_id % 19 = 0 THEN NULL
                 WHEN data_id % 5 = 0 THEN dtg + INTERVAL 30 MINUTES ELSE dtg END AS dtg
          FROM named_readings)
        SELECT a.city, a.dtg, CAST(temp_c AS DOUBLE) AS temp_c,
          CAST(humidity AS DOUBLE) AS humidity, CAST(precip_chance AS DOUBLE) AS precip_chance,
          precip_mm,
          CASE WHEN a.city IS NULL THEN 'no city given' WHEN a.dtg IS NULL THEN 'no dtg given'
               WHEN w.data_id IS NULL THEN 'not found' ELSE 'ok' END AS status
        FROM asked a LEFT JOIN named_readings w ON w.city_name = a.city AND w.dtg = a.dtg""",
    "gazetteer_pick": """
        WITH candidates AS (
          SELECT c_mktsegment || ' ' || c_nationkey AS query,
            CASE c_nationkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'BR' ELSE 'GB' END AS wanted_country,
            c_custkey AS rank, split_part('US,GB,JP', ',', CAST(c_custkey % 3 AS INT) + 1)
              AS country_code,
            c_name AS name, c_acctbal AS latitude
          FROM customer)
        SELECT query, wanted_country, rank, country_code, name, latitude
        FROM (SELECT *, row_number() OVER (
                PARTITION BY query
                ORDER BY CASE WHEN wanted_country = '' OR country_code = wanted_country
                              THEN 0 ELSE 1 END, rank) AS choice
              FROM candidates)
        WHERE choice = 1""",
    # serving windows
    "serving_tail": pick(
        DAY_SQL, "(SELECT *, row_number() OVER (PARTITION BY city ORDER BY date DESC) AS newest "
                 "FROM fx_obs WHERE date <= DATE '2000-06-30') WHERE newest <= 30"),
    "serving_features": "SELECT * EXCLUDE (y_temp_mean_c, y_precip_mm, y_is_wet, y_condition) "
                        f"FROM ({pick(FEATURE_SQL, 'lab')}) WHERE date = DATE '2000-06-30' "
                        "AND temp_mean_c_roll30_mean IS NOT NULL",
    # streaming: all days, however the files fall into batches
    "streaming_daily_rollup": pick(DAY_SQL, "fx_obs"),
    # split, baselines, scores
    "split_64_16_20": "SELECT city, date, split FROM split_rows",
    "split_exact": """
        WITH ordered AS (
          SELECT city, date,
            row_number() OVER (ORDER BY md5(concat(city, '|', CAST(date AS VARCHAR), '|', '42'))
                               DESC) AS place,
            ceil(0.2::DOUBLE * COUNT(*) OVER ()) AS tests, COUNT(*) OVER () AS n
          FROM supervised)
        SELECT city, date,
          CASE WHEN place <= tests THEN 'test'
               WHEN place <= tests + ceil(0.2::DOUBLE * (n - tests)) THEN 'validate'
               ELSE 'train' END AS split
        FROM ordered""",
    "encode_condition": """
        SELECT city, date, y_condition,
          CAST(dense_rank() OVER (ORDER BY y_condition) - 1 AS INT) AS y_condition_code
        FROM supervised""",
    "climatology_forecast":
        pick(["city", "date", "split", *[rnd(c, c) for c in CLIMATE_COLUMNS]], "climate"),
    "evaluate_temperature": f"""
        SELECT {rnd('AVG(abs(y_temp_mean_c - roll30))', 'mae_c')},
          {rnd('sqrt(AVG((y_temp_mean_c - roll30) ** 2))', 'rmse_c')},
          {rnd('1 - SUM((y_temp_mean_c - roll30) ** 2) / SUM((y_temp_mean_c - m) ** 2)', 'r2')},
          {rnd('AVG(abs(y_temp_mean_c - temp_mean_c))', 'baseline_persistence_mae_c')}
        FROM (SELECT *, AVG(y_temp_mean_c) OVER () AS m FROM split_rows WHERE split = 'test')""",
    "evaluate_precipitation": f'''
        WITH t AS (SELECT y_is_wet AS y, p_wet AS p,
                     rank() OVER (ORDER BY p_wet) + (COUNT(*) OVER (PARTITION BY p_wet) - 1)
                       / 2.0::DOUBLE AS mean_rank
                   FROM climate WHERE split = 'test'),
        u AS (SELECT SUM(CASE WHEN y = 1 THEN mean_rank END) AS wet_ranks, SUM(y) AS wet,
                     SUM(1 - y) AS dry FROM t)
        SELECT {rnd('AVG(CASE WHEN (p >= 0.5) = (y = 1) THEN 1.0::DOUBLE ELSE 0 END)', 'accuracy')},
          {rnd('(SELECT (wet_ranks - wet * (wet + 1) / 2) / (wet * dry) FROM u)', 'roc_auc')},
          {rnd("""AVG(-y * ln(least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16))
                  - (1 - y) * ln(1 - least(greatest(p, 2.220446049250313e-16),
                                           1 - 2.220446049250313e-16)))""", 'log_loss')},
          {rnd('AVG((p - y) ** 2)', 'brier')}, {rnd('AVG(y)', 'base_rate')},
          {rnd('greatest(AVG(y), 1 - AVG(y))', 'baseline_majority_accuracy')}
        FROM t''',
    "evaluate_condition": f"""
        WITH t AS (SELECT y_condition AS y,
                     class_names[list_position(p_condition, list_max(p_condition))] AS guess,
                     p_condition[list_position(class_names, y_condition)] AS p
                   FROM climate WHERE split = 'test'),
        classes AS (SELECT unnest(['Clear', 'Cloudy', 'Drizzle', 'Fog', 'Rain', 'Snow',
                                   'Thunderstorm', 'Unknown']) AS c),
        f AS (SELECT c, COALESCE(
                2.0::DOUBLE * (SELECT COUNT(*) FROM t WHERE y = c AND guess = c)
                / NULLIF((SELECT COUNT(*) FROM t WHERE y = c)
                         + (SELECT COUNT(*) FROM t WHERE guess = c), 0), 0) AS f1 FROM classes),
        s AS (SELECT COUNT(*) AS n FROM t GROUP BY y)
        SELECT {rnd('(SELECT AVG(CASE WHEN y = guess THEN 1.0::DOUBLE ELSE 0 END) FROM t)',
                    'accuracy')},
          {rnd('(SELECT AVG(f1) FROM f)', 'macro_f1')},
          {rnd('(SELECT AVG(-ln(greatest(p, 2.220446049250313e-16))) FROM t)', 'log_loss')},
          {rnd('(SELECT MAX(n) / SUM(n)::DOUBLE FROM s)', 'baseline_majority_accuracy')}""",
    # forecast documents
    "condition_ranking": "SELECT city, date, ranking, best, second FROM ranked",
    "forecast_document": """
        SELECT c.city, strftime(c.date, '%Y-%m-%d') AS as_of_date,
          strftime(c.date + 1, '%Y-%m-%d') AS target_date,
          CASE WHEN latitude >= 0 THEN latitude + 0.25 ELSE latitude END AS latitude, longitude,
          CAST(format('{:.1f}', temp_mean_c) AS DOUBLE) + 0.0::DOUBLE AS mean_c,
          CAST(format('{:.1f}', temp_mean_c * 9 / 5 + 32) AS DOUBLE) + 0.0::DOUBLE AS mean_f,
          1.23::DOUBLE AS expected_error_c,
          CAST(format('{:.4f}', p_wet) AS DOUBLE) AS probability,
          p_wet >= 0.5 AS will_precipitate, 0.1::DOUBLE AS threshold_mm,
          class_names[list_position(p_condition, list_max(p_condition))] AS category,
          r.best AS confidence, temp_max_c AS observed_max_c, precip_mm AS observed_precip_mm,
          condition AS observed_condition, '1.0' AS api_version, 'hash' AS split,
          r.ranking, 'persistence' AS config
        FROM climate c JOIN ranked r ON r.city = c.city AND r.date = c.date""",
}
