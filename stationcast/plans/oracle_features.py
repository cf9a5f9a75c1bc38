"""Expected results of the rollup, feature and time-window queries, in DuckDB SQL."""

from __future__ import annotations

from stationcast.plans.oracle_views import (
    COND_SQL,
    DAY_SQL,
    DELTA_SQL,
    FEATURE_SQL,
    LABEL_SQL,
    LAG_SQL,
    MEAN_SQL,
    SEASON_SQL,
    STD_SQL,
    SUM_SQL,
    pick,
    rnd,
)

CITY_SQL = [f"CASE WHEN city = 'NATION_{i}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END "
            f"AS city_nation_{i}" for i in range(25)]

# The columns a model sees: all numbers of the feature frame but the labels, then the cities by name.
MODEL_COLUMNS = [name for name in (column.rsplit(" AS ", 1)[-1] for column in FEATURE_SQL)
                 if name not in ("city", "date", "target_date", "condition")
                 and not name.startswith("y_")]
# The frame holds the means by window, then by column.
MEANS = [f"{c}_roll{n}_mean" for n in (3, 7, 14, 30) for c in ("temp_mean_c", "precip_mm")]
FIRST_MEAN = MODEL_COLUMNS.index(MEANS[0])
MODEL_COLUMNS[FIRST_MEAN:FIRST_MEAN + len(MEANS)] = MEANS
MODEL_COLUMNS += sorted((f"city_nation_{i}" for i in range(25)), key=lambda name: name.upper())
CELLS_SQL = ", ".join(f"{{'position': {i}, 'feature': '{name}', 'value': CAST({name} AS DOUBLE)}}"
                      for i, name in enumerate(MODEL_COLUMNS))

ORACLES: dict[str, str] = {
    # 2.4 rollup and 2.2 projections
    "daily_rollup": pick(DAY_SQL, "fx_obs"),
    "wmo_category": pick(["city", "date", "wmo_code", "condition"], "days"),
    "wet_flag": pick(["city", "date", "is_wet"], "days"),
    "temp_range": pick(["city", "date", rnd("temp_range_c", "temp_range_c")], "days"),
    "season_features": pick(["city", "date", *SEASON_SQL], "days"),
    "condition_one_hot": pick(["city", "date", "condition", *COND_SQL], "days"),
    "delta_features": pick(["city", "date", *DELTA_SQL], "days"),
    "lag_features": pick(["city", "date", *LAG_SQL], "days"),
    "rolling_means": pick(["city", "date", *MEAN_SQL], "days"),
    "rolling_std": pick(["city", "date", *STD_SQL], "days"),
    "rolling_sums": pick(["city", "date", *SUM_SQL], "days"),
    "next_day_labels": pick(["city", "date", *LABEL_SQL], "lab"),
    "drop_warmup": pick(["city", "date", rnd("roll30", "temp_mean_c_roll30_mean")],
                        "lab WHERE roll30 IS NOT NULL"),
    "labelled_rows": pick(["city", "date", *LABEL_SQL], "supervised"),
    "feature_frame": f"SELECT * FROM ({pick([*FEATURE_SQL, *CITY_SQL], 'lab')}) "
                     "WHERE temp_mean_c_roll30_mean IS NOT NULL",
    "assemble_features": f"""
        SELECT city, date, split, cell.position, cell.feature, cell.value
        FROM (SELECT city, date, split, unnest([{CELLS_SQL}]) AS cell
              FROM ({pick([*FEATURE_SQL, *CITY_SQL], 'lab')})
              JOIN (SELECT city, date, split FROM split_rows) USING (city, date))""",
    "city_one_hot": pick(["city", "date", *CITY_SQL], "days"),
    "record_gaps": """
        SELECT city, date, next_date, CAST(next_date - date AS INT) AS gap_days
        FROM (SELECT city, date, LEAD(date) OVER (PARTITION BY city ORDER BY date) AS next_date
              FROM fx_obs) WHERE next_date - date <> 1""",
    "dataset_profile": f"""
        SELECT COUNT(*) AS rows, COUNT(DISTINCT city) AS cities, MIN(date) AS first_date,
               MAX(date) AS last_date, {rnd('AVG(is_wet)', 'wet_day_rate')} FROM days""",
    "usable_range_by_city": """
        SELECT city, MIN(date) AS first_usable, MAX(date) AS last_usable FROM lab
        WHERE roll30 IS NOT NULL GROUP BY city""",
    "city_listing": """
        SELECT row_number() OVER (ORDER BY city) AS position, city, first_usable, last_usable
        FROM (SELECT city, MIN(date) AS first_usable, MAX(date) AS last_usable FROM lab
              WHERE roll30 IS NOT NULL GROUP BY city)""",
    "trial_ranking": """
        SELECT *, CAST(row_number() OVER (PARTITION BY target ORDER BY score, position) AS INT) AS rank
        FROM (SELECT city || '|' || strftime(date, '%Y-%m') AS target, CAST(day(date) AS INT) AS position,
                CAST(floor(temp_mean_c) AS DOUBLE) AS score
              FROM fx_obs WHERE temp_mean_c IS NOT NULL)""",
    "curve_sampling": f"""
        WITH curve AS (
          SELECT city, temp_mean_c, row_number() OVER (PARTITION BY city ORDER BY date) AS k,
            row_number() OVER (PARTITION BY city ORDER BY temp_mean_c DESC, date) = 1 AS kept,
            COUNT(*) OVER (PARTITION BY city) AS n
          FROM fx_obs WHERE temp_mean_c IS NOT NULL)
        SELECT 'temperature' AS target, city AS name, CAST(k AS INT) AS round,
          {rnd('temp_mean_c', 'score')}, kept
        FROM curve WHERE kept OR (k - 1) % greatest(1, n // 8) = 0""",
    # 2.5 time-range windows
    "trailing_30d_avg": f"""
        SELECT data_id, city_id, dtg,
          {rnd('CAST(SUM(temp_c) OVER w AS DOUBLE) / NULLIF(COUNT(temp_c) OVER w, 0)', 'avg_temp_c_30day')},
          {rnd('CAST(SUM(humidity) OVER w AS DOUBLE) / NULLIF(COUNT(humidity) OVER w, 0)', 'avg_humidity_30day')},
          {rnd('CAST(SUM(precip_mm) OVER w AS DOUBLE) / NULLIF(COUNT(precip_mm) OVER w, 0)', 'avg_precip_mm_30day')}
        FROM fx_wx_data
        WINDOW w AS (PARTITION BY city_id ORDER BY dtg
                     RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW)""",
    "view_global_average": f"""
        WITH criteria AS (SELECT dtg AS end_date, dtg - INTERVAL 30 DAYS AS begin_date, city_id
                          FROM fx_wx_data)
        SELECT {rnd('AVG(d.temp_c)', 'avg_temp_c_30day')},
               {rnd('AVG(d.humidity)', 'avg_humidity_30day')},
               {rnd('AVG(d.precip_mm)', 'avg_precip_mm_30day')}
        FROM fx_wx_data d JOIN criteria c
          ON d.city_id = c.city_id AND d.dtg BETWEEN c.begin_date AND c.end_date""",
    "trailing_30d_as_written": f"""
        WITH criteria AS (SELECT data_id, dtg AS end_date, dtg - INTERVAL 30 DAYS AS begin_date,
                                 city_id FROM fx_wx_data),
        averages AS (
          SELECT {rnd('AVG(d.temp_c)', 'avg_temp_c_30day')},
                 {rnd('AVG(d.humidity)', 'avg_humidity_30day')},
                 {rnd('AVG(d.precip_mm)', 'avg_precip_mm_30day')}
          FROM fx_wx_data d JOIN criteria c
            ON d.city_id = c.city_id AND d.dtg BETWEEN c.begin_date AND c.end_date)
        SELECT c.data_id, c.city_id, c.end_date AS dtg, a.* FROM criteria c, averages a""",
}
