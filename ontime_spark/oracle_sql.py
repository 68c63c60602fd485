"""DuckDB oracle SQL for the registered queries (same column names, same rounding).

Only the driver's base tables exist as views in DuckDB, so every statement starts from the
shared CTEs below.
"""

from __future__ import annotations

import re
from math import factorial

FLIGHTS_CTE = """flights AS (
SELECT l.l_orderkey, l.l_linenumber, CAST(l.l_shipdate AS DATE) AS fl_date,
  'C'||CAST(l.l_suppkey % 10 AS VARCHAR) AS carrier, so.n_name AS origin, de.n_name AS dest,
  CAST((5 + l.l_partkey % 19)*100 + l.l_linenumber*5 AS INT) AS crs_dep_time,
  CASE WHEN l.l_orderkey % 97 = 0 THEN NULL ELSE l.l_quantity - 23.0
       + (CASE WHEN l.l_partkey % 19 >= 12 THEN 6.0 ELSE 0.0 END) END AS arr_delay,
  CASE WHEN l.l_returnflag='R' AND l.l_linenumber=7 THEN 1 ELSE 0 END AS cancelled,
  CAST(100 + 200*ABS(s.s_nationkey - c.c_nationkey) AS INT) AS distance,
  CASE WHEN l.l_partkey % 89 = 0 THEN NULL ELSE l.l_tax*500.0 END AS origin_wind_speed,
  CAST((l.l_orderkey*7 + l.l_linenumber) % 151 AS DOUBLE)/10 AS origin_visibility,
  CAST((l.l_orderkey*37 + l.l_partkey) % 30001 AS INT) AS origin_ceiling,
  CASE WHEN l.l_partkey % 20 = 0 THEN 1 ELSE 0 END AS origin_has_thunderstorm,
  CASE WHEN l.l_partkey % 13 = 0 THEN 1 ELSE 0 END AS origin_has_snow,
  CASE WHEN l.l_suppkey % 10 = 3 THEN 1 ELSE 0 END AS origin_has_fog,
  CAST(10 + l.l_partkey % 90 AS DOUBLE) AS origin_temp,
  CAST(l.l_orderkey % 50 AS DOUBLE)/100 AS origin_precip,
  l.l_discount*400.0 AS dest_wind_speed,
  CAST((l.l_orderkey*11 + l.l_linenumber*3) % 151 AS DOUBLE)/10 AS dest_visibility,
  CAST((l.l_orderkey*41 + l.l_partkey*3) % 30001 AS INT) AS dest_ceiling,
  CAST(10 + l.l_suppkey*7 % 90 AS DOUBLE) AS dest_temp,
  CAST(l.l_partkey % 40 AS DOUBLE)/100 AS dest_precip,
  CASE WHEN l.l_partkey % 21 = 0 THEN 1 ELSE 0 END AS dest_has_thunderstorm,
  CASE WHEN l.l_partkey % 17 = 0 THEN 1 ELSE 0 END AS dest_has_snow,
  CASE WHEN l.l_suppkey % 10 = 4 THEN 1 ELSE 0 END AS dest_has_fog,
  CAST((l.l_partkey*31 + l.l_orderkey*7) % 1000 AS DOUBLE)/1000 AS p
FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey JOIN customer c ON o.o_custkey=c.c_custkey
JOIN supplier s ON l.l_suppkey=s.s_suppkey JOIN nation so ON s.s_nationkey=so.n_nationkey
JOIN nation de ON c.c_nationkey=de.n_nationkey WHERE s.s_nationkey<>c.c_nationkey)"""

SQL: dict[str, str] = {}


def with_ctes(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


SQL["flights_view"] = with_ctes("SELECT * FROM flights", FLIGHTS_CTE)

SQL["a9_delay_rate_by_carrier"] = with_ctes("""
SELECT carrier,
  ROUND(AVG(CASE WHEN arr_delay >= 15 THEN 1.0 ELSE 0.0 END)::DOUBLE * 100, 6) AS delay_rate_pct
FROM flights GROUP BY carrier""", FLIGHTS_CTE)

# ------------------------------------------------------------------ shared CTEs
PRE_CTE = """kept AS (SELECT * FROM flights WHERE cancelled = 0),
med AS (SELECT median(arr_delay) AS m_arr, median(origin_wind_speed) AS m_wind FROM kept),
pre AS (SELECT l_orderkey, l_linenumber, fl_date, carrier, origin, dest, crs_dep_time,
  COALESCE(arr_delay, m_arr) AS arr_delay, cancelled, CAST(distance AS DOUBLE) AS distance,
  COALESCE(origin_wind_speed, m_wind) AS origin_wind_speed, origin_visibility,
  CAST(origin_ceiling AS DOUBLE) AS origin_ceiling, origin_has_thunderstorm, origin_has_snow,
  origin_has_fog, origin_temp, origin_precip, dest_wind_speed, dest_visibility,
  CAST(dest_ceiling AS DOUBLE) AS dest_ceiling, dest_temp, dest_precip, dest_has_thunderstorm,
  dest_has_snow, dest_has_fog, p,
  CASE WHEN arr_delay >= 15 THEN 1 ELSE 0 END AS is_delayed
  FROM kept, med)"""

HUBS_SQL = ("('NATION_1','NATION_3','NATION_6','NATION_8','NATION_11','NATION_13','NATION_16',"
            "'NATION_18','NATION_21','NATION_23')")


def holiday_sql(d: str) -> str:
    """US federal holiday rule (observed days included) as a DuckDB boolean expression."""
    y, mo, dom, wd = f"year({d})", f"month({d})", f"day({d})", f"(isodow({d}) - 1)"

    def fixed(m: int, dd: int) -> str:
        return (f"(({mo}={m} AND {dom}={dd}) OR ({mo}={m} AND {dom}={dd - 1} AND {wd}=4)"
                f" OR ({mo}={m} AND {dom}={dd + 1} AND {wd}=0))")

    parts = [
        f"(({mo}=1 AND {dom}=1) OR ({mo}=1 AND {dom}=2 AND {wd}=0) OR ({mo}=12 AND {dom}=31 AND {wd}=4))",
        f"({y}>=1986 AND {mo}=1 AND {wd}=0 AND {dom} BETWEEN 15 AND 21)",
        f"({mo}=2 AND {wd}=0 AND {dom} BETWEEN 15 AND 21)",
        f"({mo}=5 AND {wd}=0 AND {dom}>=25)",
        f"({y}>=2021 AND {fixed(6, 19)})",
        fixed(7, 4),
        f"({mo}=9 AND {wd}=0 AND {dom}<=7)",
        f"({mo}=10 AND {wd}=0 AND {dom} BETWEEN 8 AND 14)",
        fixed(11, 11),
        f"({mo}=11 AND {wd}=3 AND {dom} BETWEEN 22 AND 28)",
        fixed(12, 25),
    ]
    return "(" + " OR ".join(parts) + ")"


HOUR_SQL = "CAST(LEAST(FLOOR(crs_dep_time / 100), 23) AS INT)"

TEMPORAL_CTE = f"""tmp AS (SELECT *, {HOUR_SQL} AS hour_of_day,
  CAST(isodow(fl_date) - 1 AS INT) AS day_of_week, CAST(month(fl_date) AS INT) AS month,
  CASE WHEN isodow(fl_date) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN {holiday_sql('fl_date')} THEN 1 ELSE 0 END AS is_holiday
  FROM pre),
tmp2 AS (SELECT *, sin(2 * pi() * hour_of_day / 24) AS hour_sin,
  cos(2 * pi() * hour_of_day / 24) AS hour_cos, sin(2 * pi() * month / 12) AS month_sin,
  cos(2 * pi() * month / 12) AS month_cos FROM tmp)"""


def rolling_cte(side: str, name: str, src: str = "pre") -> str:
    return f"""daily_{side} AS (SELECT {side}, fl_date, AVG(is_delayed::DOUBLE) AS daily_rate
  FROM {src} GROUP BY {side}, fl_date),
roll_{side} AS (SELECT {side}, fl_date, daily_rate, AVG(daily_rate) OVER (PARTITION BY {side}
  ORDER BY fl_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS {name} FROM daily_{side})"""


# ------------------------------------------------------------------ cleaning
SQL["p1_cast_types"] = with_ctes("""
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE fl_date END AS fl_date, carrier, origin, dest,
  arr_delay, CASE WHEN l_orderkey % 103 = 0 THEN NULL ELSE CAST(distance AS DOUBLE) END AS distance,
  crs_dep_time, origin_wind_speed, CASE WHEN l_orderkey % 71 <> 0 THEN origin_visibility END AS origin_visibility,
  CAST(origin_ceiling AS DOUBLE) AS origin_ceiling, origin_temp, origin_precip, dest_wind_speed, dest_visibility,
  CAST(dest_ceiling AS DOUBLE) AS dest_ceiling, dest_temp, dest_precip
FROM flights""", FLIGHTS_CTE)

SQL["p2_filter_cancelled"] = with_ctes(
    "SELECT l_orderkey, l_linenumber, fl_date, cancelled FROM flights WHERE cancelled = 0",
    FLIGHTS_CTE)

SQL["p3_delay_label"] = with_ctes("""
SELECT l_orderkey, l_linenumber, arr_delay, CASE WHEN arr_delay >= 15 THEN 1 ELSE 0 END AS is_delayed
FROM (SELECT * REPLACE (CASE WHEN l_orderkey % 71 <> 0 THEN arr_delay END AS arr_delay) FROM flights) f WHERE cancelled = 0""", FLIGHTS_CTE)

SQL["p4_fill_missing"] = with_ctes("""
SELECT l_orderkey, l_linenumber, carrier, ROUND(COALESCE(arr_delay, m_arr), 6) AS arr_delay,
  ROUND(COALESCE(origin_wind_speed, m_wind), 6) AS origin_wind_speed,
  ROUND(origin_visibility, 6) AS origin_visibility
FROM flights, (SELECT median(arr_delay) AS m_arr, median(origin_wind_speed) AS m_wind FROM flights) m""",
                               FLIGHTS_CTE)

SQL["l1_preprocess"] = with_ctes("""
SELECT l_orderkey, l_linenumber, fl_date, carrier, origin, dest, crs_dep_time,
  ROUND(arr_delay, 6) AS arr_delay, cancelled, ROUND(distance, 6) AS distance,
  ROUND(origin_wind_speed, 6) AS origin_wind_speed, ROUND(origin_visibility, 6) AS origin_visibility,
  ROUND(origin_ceiling, 6) AS origin_ceiling, origin_has_thunderstorm, origin_has_snow, origin_has_fog,
  ROUND(origin_temp, 6) AS origin_temp, ROUND(origin_precip, 6) AS origin_precip,
  ROUND(dest_wind_speed, 6) AS dest_wind_speed, ROUND(dest_visibility, 6) AS dest_visibility,
  ROUND(dest_ceiling, 6) AS dest_ceiling, ROUND(dest_temp, 6) AS dest_temp,
  ROUND(dest_precip, 6) AS dest_precip, dest_has_thunderstorm, dest_has_snow, dest_has_fog,
  ROUND(p, 6) AS p, is_delayed
FROM pre""", FLIGHTS_CTE, PRE_CTE)

_A6_COLS = ("arr_delay", "distance", "crs_dep_time", "origin_wind_speed", "origin_visibility",
            "origin_ceiling", "origin_temp", "origin_precip", "dest_wind_speed", "dest_visibility",
            "dest_ceiling", "dest_temp", "dest_precip")
SQL["a6_missing_profile"] = with_ctes("\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS n_missing, "
    f"ROUND(median({c}::DOUBLE), 6) AS median FROM (SELECT * REPLACE (CASE WHEN l_orderkey % 71 <> 0 THEN dest_temp END AS dest_temp) FROM flights) f"
    for c in _A6_COLS), FLIGHTS_CTE)

SQL["a11_profile_from_footers"] = with_ctes("""
SELECT COUNT(*) AS n_rows, MIN(fl_date) AS min_date, MAX(fl_date) AS max_date, COUNT(*) - COUNT(arr_delay) AS arr_delay_missing,
  COUNT(*) - COUNT(origin_wind_speed) AS origin_wind_speed_missing, COUNT(*) - COUNT(distance) AS distance_missing FROM flights""", FLIGHTS_CTE)

SQL["a11_profile"] = with_ctes("""
SELECT COUNT(*) AS n_rows, 28 AS n_cols, MIN(fl_date) AS min_date, MAX(fl_date) AS max_date FROM pre""",
                               FLIGHTS_CTE, PRE_CTE)

# ------------------------------------------------------------------ insights
SQL["a8_delay_rate_by_hour"] = with_ctes("""
SELECT CAST(FLOOR(crs_dep_time / 100) AS INT) AS hour,
  ROUND(AVG(CASE WHEN arr_delay >= 15 THEN 1.0 ELSE 0.0 END)::DOUBLE * 100, 6) AS delay_rate_pct
FROM flights GROUP BY 1""", FLIGHTS_CTE)

SQL["a10_airport_months"] = with_ctes("""
SELECT origin AS airport, CAST(year(fl_date) AS INT) AS year, CAST(month(fl_date) AS INT) AS month,
  COUNT(*) AS n_flights FROM pre GROUP BY 1, 2, 3""", FLIGHTS_CTE, PRE_CTE)

SQL["a10_distinct_airports"] = with_ctes(
    "SELECT COUNT(DISTINCT origin) AS n_airports FROM flights", FLIGHTS_CTE)

# ------------------------------------------------------------------ scalar groups
SQL["l2_temporal_features"] = with_ctes(f"""
SELECT l_orderkey, l_linenumber, fl_date, crs_dep_time, hour_of_day, day_of_week, month, is_weekend,
  is_holiday, ROUND(hour_sin, 6) AS hour_sin, ROUND(hour_cos, 6) AS hour_cos,
  ROUND(month_sin, 6) AS month_sin, ROUND(month_cos, 6) AS month_cos,
  CASE WHEN hour_of_day >= 5 AND hour_of_day < 8 THEN 'early_morning'
       WHEN hour_of_day >= 8 AND hour_of_day < 12 THEN 'morning'
       WHEN hour_of_day >= 12 AND hour_of_day < 17 THEN 'afternoon'
       WHEN hour_of_day >= 17 AND hour_of_day < 21 THEN 'evening' ELSE 'night' END AS time_block,
  CASE WHEN {holiday_sql('fl_date')} OR {holiday_sql('(fl_date - 1)')}
            OR {holiday_sql('(fl_date + 1)')} THEN 1 ELSE 0 END AS is_near_holiday
FROM tmp2""", FLIGHTS_CTE, PRE_CTE, TEMPORAL_CTE)


def _wx(side: str) -> str:
    return f"""CASE WHEN {side}_ceiling < 1000 OR {side}_visibility < 3 THEN 1 ELSE 0 END AS ifr_conditions_{side},
  CASE WHEN {side}_wind_speed < 10 THEN 'calm'
       WHEN {side}_wind_speed >= 10 AND {side}_wind_speed <= 25 THEN 'moderate'
       ELSE 'strong' END AS {side}_wind_category,
  CASE WHEN COALESCE({side}_has_thunderstorm, 1) <> 0 OR COALESCE({side}_has_snow, 1) <> 0
            OR COALESCE({side}_wind_speed > 35, false) THEN 1 ELSE 0 END AS severe_weather_{side}"""


SQL["l3_weather_features"] = with_ctes(
    f"SELECT l_orderkey, l_linenumber, {_wx('origin')}, {_wx('dest')} FROM flights", FLIGHTS_CTE)

SQL["p5_ensure_weather_columns"] = with_ctes("""
SELECT l_orderkey, l_linenumber, 8.0::DOUBLE AS dest_wind_speed, 10.0::DOUBLE AS dest_visibility,
  25000 AS dest_ceiling, 60.0::DOUBLE AS dest_temp, 0.0::DOUBLE AS dest_precip,
  0 AS dest_has_thunderstorm, 0 AS dest_has_snow, 0 AS dest_has_fog FROM flights""", FLIGHTS_CTE)

SQL["c12_c13_route_columns"] = with_ctes("""
SELECT l_orderkey, l_linenumber, origin || '-' || dest AS route, distance,
  CASE WHEN distance < 500 THEN 'short' WHEN distance >= 500 AND distance <= 1500 THEN 'medium'
       ELSE 'long' END AS distance_category FROM flights""", FLIGHTS_CTE)

SQL["p6_camelcase_twins"] = with_ctes("""
SELECT l_orderkey, l_linenumber, fl_date AS FlightDate, crs_dep_time AS CRSDepTime, origin AS Origin,
  dest AS Dest, distance AS Distance, cancelled AS Cancelled FROM flights""", FLIGHTS_CTE)

# ------------------------------------------------------------------ airport group
SQL["a1_flights_per_hour"] = with_ctes(f"""
SELECT origin, fl_date, {HOUR_SQL} AS hour_of_day, COUNT(*) AS n FROM pre GROUP BY 1, 2, 3""",
                                       FLIGHTS_CTE, PRE_CTE)

SQL["a2_daily_delay_rate"] = with_ctes("""
SELECT dest, fl_date, ROUND(AVG(is_delayed::DOUBLE), 6) AS daily_rate FROM pre GROUP BY 1, 2""",
                                       FLIGHTS_CTE, PRE_CTE)

SQL["w1_rolling_rate_active"] = with_ctes("""
SELECT origin, fl_date, ROUND(daily_rate, 6) AS daily_rate,
  ROUND(origin_delay_rate_rolling, 6) AS origin_delay_rate_rolling FROM roll_origin""",
                                          FLIGHTS_CTE, PRE_CTE,
                                          rolling_cte("origin", "origin_delay_rate_rolling"))

SQL["w1_rolling_rate_dense"] = with_ctes("""
SELECT origin, fl_date, ROUND(daily_rate, 6) AS daily_rate,
  ROUND(origin_delay_rate_rolling, 6) AS origin_delay_rate_rolling
FROM (SELECT g.origin, g.fl_date, d.daily_rate,
        AVG(d.daily_rate) OVER (PARTITION BY g.origin ORDER BY g.fl_date
                                ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS origin_delay_rate_rolling
      FROM (SELECT a.origin, b.fl_date FROM (SELECT DISTINCT origin FROM pre) a
            CROSS JOIN (SELECT DISTINCT fl_date FROM pre) b) g
      LEFT JOIN daily d ON d.origin = g.origin AND d.fl_date = g.fl_date) x
WHERE daily_rate IS NOT NULL""", FLIGHTS_CTE, PRE_CTE,
    "daily AS (SELECT origin, fl_date, AVG(is_delayed::DOUBLE) AS daily_rate FROM pre GROUP BY 1, 2)")

APT_CTE = f"""apt AS (SELECT t.*,
  CAST(COUNT(*) OVER (PARTITION BY t.origin, t.fl_date, t.hour_of_day) AS INT) AS origin_flights_per_hour,
  CAST(COUNT(*) OVER (PARTITION BY t.dest, t.fl_date, t.hour_of_day) AS INT) AS dest_flights_per_hour,
  COALESCE(ro.r_o, 0.0) AS origin_delay_rate_rolling, COALESCE(rd.r_d, 0.0) AS dest_delay_rate_rolling,
  CASE WHEN t.origin IN {HUBS_SQL} THEN 1 ELSE 0 END AS is_origin_hub,
  CASE WHEN t.dest IN {HUBS_SQL} THEN 1 ELSE 0 END AS is_dest_hub
  FROM tmp2 t LEFT JOIN roll_origin ro ON ro.origin = t.origin AND ro.fl_date = t.fl_date
  LEFT JOIN roll_dest rd ON rd.dest = t.dest AND rd.fl_date = t.fl_date)"""
AIRPORT_CTE = f"""{rolling_cte('origin', 'r_o')},
{rolling_cte('dest', 'r_d')},
{APT_CTE}"""

SQL["l4_airport_features"] = with_ctes("""
SELECT l_orderkey, l_linenumber, origin, dest, fl_date, hour_of_day, origin_flights_per_hour,
  dest_flights_per_hour, ROUND(origin_delay_rate_rolling, 6) AS origin_delay_rate_rolling,
  ROUND(dest_delay_rate_rolling, 6) AS dest_delay_rate_rolling, is_origin_hub, is_dest_hub
FROM apt""", FLIGHTS_CTE, PRE_CTE, TEMPORAL_CTE, AIRPORT_CTE)

TRAIN_WHERE = "month(fl_date) BETWEEN 1 AND 10"
TEST_WHERE = "month(fl_date) IN (11, 12)"

# Rates of flights after the training months: the last seven history days before each date.
def future_cte(side: str, name: str, grid: str = "active", roll: str | None = None) -> str:
    roll = roll or f"roll_{side}"
    days = {"active": f"""SELECT k.{side}, k.fl_date, d.daily_rate, row_number() OVER (
      PARTITION BY k.{side}, k.fl_date ORDER BY d.fl_date DESC) AS rn
    FROM asked_{roll} k JOIN hist_{roll} d ON d.{side} = k.{side} AND d.fl_date < k.fl_date""",
            "dense": f"""SELECT q.{side}, q.fl_date, d.daily_rate, q.rn FROM (
      SELECT k.{side}, k.fl_date, g.fl_date AS g, row_number() OVER (
        PARTITION BY k.{side}, k.fl_date ORDER BY g.fl_date DESC) AS rn
      FROM asked_{roll} k JOIN (SELECT DISTINCT fl_date FROM hist_{roll}) g ON g.fl_date < k.fl_date) q
    JOIN hist_{roll} d ON d.{side} = q.{side} AND d.fl_date = q.g"""}[grid]
    return f"""asked_{roll} AS (SELECT DISTINCT {side}, fl_date FROM pre WHERE {TEST_WHERE}),
hist_{roll} AS (SELECT {side}, fl_date, AVG(is_delayed::DOUBLE) AS daily_rate FROM pre
  WHERE {TRAIN_WHERE} GROUP BY 1, 2),
{roll} AS (SELECT {side}, fl_date, AVG(daily_rate) AS {name} FROM ({days}) x WHERE rn <= 7 GROUP BY 1, 2)"""


# ------------------------------------------------------------------ encoders and feature table


def encoder_ctes(src_where: str | None) -> str:
    where = f"WHERE {src_where}" if src_where else ""
    return f"""enc_src AS (SELECT * FROM pre {where}),
g AS (SELECT AVG(is_delayed::DOUBLE) AS gm FROM enc_src),
re AS (SELECT origin || '-' || dest AS route, COUNT(*) AS n, AVG(is_delayed::DOUBLE) AS mean,
  (COUNT(*) * AVG(is_delayed::DOUBLE) + 100 * gm) / (COUNT(*) + 100) AS v
  FROM enc_src, g GROUP BY 1, gm),
ce AS (SELECT carrier, COUNT(*) AS n, AVG(is_delayed::DOUBLE) AS mean,
  (COUNT(*) * AVG(is_delayed::DOUBLE) + 100 * gm) / (COUNT(*) + 100) AS v
  FROM enc_src, g GROUP BY 1, gm)"""


FEAT_CTE = """feat AS (SELECT *,
  CASE WHEN origin_ceiling < 1000 OR origin_visibility < 3 THEN 1 ELSE 0 END AS ifr_conditions_origin,
  CASE WHEN dest_ceiling < 1000 OR dest_visibility < 3 THEN 1 ELSE 0 END AS ifr_conditions_dest
  FROM apt)"""

_R = lambda c: f"ROUND({c}, 6) AS {c}"
FEATURE_SELECT = ", ".join([
    "hour_of_day", "day_of_week", "month", "is_weekend", "is_holiday",
    _R("hour_sin"), _R("hour_cos"), _R("month_sin"), _R("month_cos"),
    _R("origin_wind_speed"), _R("origin_visibility"), _R("origin_ceiling"),
    _R("origin_temp"), _R("origin_precip"),
    "origin_has_thunderstorm", "origin_has_snow", "origin_has_fog",
    _R("dest_wind_speed"), _R("dest_visibility"), _R("dest_ceiling"), _R("dest_temp"),
    _R("dest_precip"), "dest_has_thunderstorm", "dest_has_snow", "dest_has_fog",
    "ifr_conditions_origin", "ifr_conditions_dest",
    "origin_flights_per_hour", "dest_flights_per_hour",
    _R("origin_delay_rate_rolling"), _R("dest_delay_rate_rolling"), "is_origin_hub", "is_dest_hub",
    _R("distance"), _R("route_avg_delay"), _R("carrier_delay_rate"), "carrier", "origin", "dest",
])


def feature_table_ctes(enc_where: str | None, out_where: str | None) -> list[str]:
    """CTEs ending with ``ft``: keys, label and the 39 features (doubles rounded)."""
    where = f"WHERE {out_where}" if out_where else ""
    return [FLIGHTS_CTE, PRE_CTE, TEMPORAL_CTE, AIRPORT_CTE, FEAT_CTE, encoder_ctes(enc_where),
            f"""ft AS (SELECT l_orderkey, l_linenumber, is_delayed, {FEATURE_SELECT}
FROM (SELECT f.*, COALESCE(re.v, g.gm) AS route_avg_delay, COALESCE(ce.v, g.gm) AS carrier_delay_rate
      FROM feat f CROSS JOIN g LEFT JOIN re ON re.route = f.origin || '-' || f.dest
      LEFT JOIN ce ON ce.carrier = f.carrier) x {where})"""]


def feature_table_sql(enc_where: str | None, out_where: str | None) -> str:
    return with_ctes("SELECT * FROM ft", *feature_table_ctes(enc_where, out_where))


SQL["a3_global_mean"] = with_ctes(
    "SELECT ROUND(AVG(is_delayed::DOUBLE), 6) AS global_mean FROM pre", FLIGHTS_CTE, PRE_CTE)

SQL["a4_route_encoding"] = with_ctes(
    "SELECT route, n, ROUND(mean, 6) AS mean, ROUND(v, 6) AS value FROM re",
    FLIGHTS_CTE, PRE_CTE, encoder_ctes(None))

SQL["a4_carrier_encoding"] = with_ctes(
    "SELECT carrier, n, ROUND(mean, 6) AS mean, ROUND(v, 6) AS value FROM ce",
    FLIGHTS_CTE, PRE_CTE, encoder_ctes(None))

_ROUTE_OUT = """SELECT t.l_orderkey, t.l_linenumber, t.origin || '-' || t.dest AS route,
  CASE WHEN t.distance < 500 THEN 'short' WHEN t.distance >= 500 AND t.distance <= 1500 THEN 'medium'
       ELSE 'long' END AS distance_category,
  ROUND(COALESCE(re.v, g.gm), 6) AS route_avg_delay, ROUND(COALESCE(ce.v, g.gm), 6) AS carrier_delay_rate
FROM pre t CROSS JOIN g LEFT JOIN re ON re.route = t.origin || '-' || t.dest
LEFT JOIN ce ON ce.carrier = t.carrier"""

SQL["l5_route_features"] = with_ctes(_ROUTE_OUT, FLIGHTS_CTE, PRE_CTE, encoder_ctes(None))

SQL["a5_encoder_train_to_test"] = with_ctes(
    _ROUTE_OUT + f" WHERE {TEST_WHERE.replace('fl_date', 't.fl_date')}",
    FLIGHTS_CTE, PRE_CTE, encoder_ctes(TRAIN_WHERE))

SQL["a5_encoder_merged"] = SQL["a5_encoder_train_to_test"]
SQL["a2_daily_rate_merged"] = SQL["a2_daily_delay_rate"]

SQL["p12_temporal_split_test"] = with_ctes(
    f"SELECT l_orderkey, l_linenumber, fl_date FROM pre WHERE {TEST_WHERE}", FLIGHTS_CTE, PRE_CTE)

SQL["a7_class_weights"] = with_ctes(f"""
SELECT is_delayed, n, ROUND((SUM(n) OVER ())::DOUBLE / (2.0 * n)::DOUBLE, 6) AS weight,
  ROUND((SUM(CASE WHEN is_delayed = 0 THEN n END) OVER ())::DOUBLE
        / (SUM(CASE WHEN is_delayed = 1 THEN n END) OVER ())::DOUBLE, 6) AS scale_pos_weight
FROM (SELECT is_delayed, COUNT(*) AS n FROM pre WHERE {TRAIN_WHERE} GROUP BY 1) c""",
                                    FLIGHTS_CTE, PRE_CTE)


def _codes(c: str) -> str:
    return (f"codes_{c} AS (SELECT {c} AS cat, CAST(ROW_NUMBER() OVER (ORDER BY {c}) - 1 AS INT) AS code"
            f" FROM (SELECT DISTINCT {c} FROM pre WHERE {TRAIN_WHERE} AND {c} IS NOT NULL))")


SQL["m5_ordinal_encoding"] = with_ctes(f"""
SELECT t.l_orderkey, t.l_linenumber, COALESCE(a.code, -1) AS carrier, COALESCE(b.code, -1) AS origin,
  COALESCE(c.code, -1) AS dest
FROM pre t LEFT JOIN codes_carrier a ON a.cat = t.carrier LEFT JOIN codes_origin b ON b.cat = t.origin
LEFT JOIN codes_dest c ON c.cat = t.dest WHERE {TEST_WHERE.replace('fl_date', 't.fl_date')}""",
                                       FLIGHTS_CTE, PRE_CTE, _codes("carrier"), _codes("origin"),
                                       _codes("dest"))

SQL["l6_build_features"] = feature_table_sql(None, None)
SQL["l7_featurizer_train_to_test"] = feature_table_sql(TRAIN_WHERE, TEST_WHERE)

# ------------------------------------------------------------------ weather, stations, as-of
ISD_CTE = """isd AS (SELECT event_id, '0000'||LPAD(CAST(700000 + user_id AS VARCHAR),6,'0')
  ||LPAD(CAST(user_id*13 % 100000 AS VARCHAR),5,'0')
  ||'20240115'||LPAD(CAST(event_id % 24 * 100 + event_id % 60 AS VARCHAR),4,'0')||RPAD('',33,' ')||'18019'
  ||LPAD(CASE WHEN event_id % 50 = 0 THEN '9999' ELSE CAST(event_id % 400 AS VARCHAR) END,4,'0')||'1'
  ||LPAD(CASE WHEN event_id % 7 = 0 THEN '99999' ELSE CAST(event_id*31 % 9000 AS VARCHAR) END,5,'0')||'19N'
  ||LPAD(CASE WHEN event_id % 9 = 0 THEN '999999' ELSE CAST(event_id*53 % 16000 AS VARCHAR) END,6,'0')||'1N9'
  ||CASE WHEN event_id % 40 = 0 THEN '+9999' WHEN event_id % 3 = 0 THEN '-'||LPAD(CAST(event_id % 200 AS VARCHAR),4,'0')
         ELSE '+'||LPAD(CAST(event_id % 350 AS VARCHAR),4,'0') END||'1'||'+0012'||'1'||'101321' AS line
  FROM events)"""

ISD_LEGACY_CTE = """isd AS (SELECT event_id, '0000'||LPAD(CAST(700000 + user_id AS VARCHAR),6,'0')
  ||LPAD(CAST(user_id*13 % 100000 AS VARCHAR),5,'0')
  ||'20240115'||LPAD(CAST(event_id % 24 * 100 + event_id % 60 AS VARCHAR),4,'0')||RPAD('',33,' ')||'18019'
  ||LPAD(CASE WHEN event_id % 50 = 0 THEN '9999' ELSE CAST(event_id % 400 AS VARCHAR) END,4,'0')||'10000019N'
  ||LPAD(CASE WHEN event_id % 7 = 0 THEN '99999' ELSE CAST(event_id*31 % 9000 AS VARCHAR) END,5,'0')||'1'
  ||CASE WHEN event_id % 40 = 0 OR event_id % 3 = 0 THEN '   ' ELSE LPAD(CAST(event_id*53 % 1000 AS VARCHAR),3,'0') END
  ||CASE WHEN event_id % 40 = 0 THEN '+9999' WHEN event_id % 3 = 0 THEN '-'||LPAD(CAST(event_id % 200 AS VARCHAR),4,'0')
         ELSE LPAD(CAST(event_id % 350 AS VARCHAR),5,'0') END||'1'||'+0012'||'1'||'101321' AS line
  FROM events)"""

_ISD_LAYOUTS = {
    "public": {"wind": (65, 4), "ceil": (70, 5), "vis": (78, 6), "temp": (87, 5), "dew": (93, 5)},
    "legacy": {"wind": (65, 4), "ceil": (78, 5), "vis": (84, 6), "temp": (87, 5), "dew": (93, 5)},
}
_ISD_SENT = {"wind": "('9999')", "ceil": "('99999')", "vis": "('999999')",
             "temp": "('+9999','-9999','9999')", "dew": "('+9999','-9999','9999')"}


def isd_parse_sql(layout: str) -> str:
    lay = _ISD_LAYOUTS[layout]
    raws = ",\n  ".join(
        f"CASE WHEN TRIM(SUBSTRING(line, {s + 1}, {n})) IN ('', {_ISD_SENT[k][1:-1]}) THEN NULL "
        f"ELSE TRIM(SUBSTRING(line, {s + 1}, {n})) END AS r_{k}" for k, (s, n) in lay.items())
    ok = " AND ".join(f"NOT (r_{k} IS NOT NULL AND TRY_CAST(r_{k} AS DOUBLE) IS NULL)" for k in lay)
    return f"""raw AS (SELECT line, {raws},
  TRY_STRPTIME(SUBSTRING(line, 16, 8) || SUBSTRING(line, 24, 4), '%Y%m%d%H%M') AS ts FROM isd),
obs AS (SELECT SUBSTRING(line, 5, 6) || '-' || SUBSTRING(line, 11, 5) AS station_id,
  SUBSTRING(line, 5, 6) AS usaf, SUBSTRING(line, 11, 5) AS wban,
  ts AS "timestamp", TRY_CAST(r_temp AS DOUBLE) / 10 AS temp_c,
  TRY_CAST(r_dew AS DOUBLE) / 10 AS dew_point_c, TRY_CAST(r_wind AS DOUBLE) / 10 AS wind_speed_ms,
  NULL::DOUBLE AS wind_gust_ms, TRY_CAST(r_vis AS DOUBLE) AS visibility_m,
  TRY_CAST(r_ceil AS DOUBLE) AS ceiling_m, NULL::DOUBLE AS precip_mm, NULL::VARCHAR AS present_weather
  FROM raw WHERE length(line) >= 105 AND {ok} AND ts IS NOT NULL)"""


SQL["s6_isd_parse"] = with_ctes("SELECT * FROM obs", ISD_CTE, isd_parse_sql("public"))
SQL["s6_isd_parse_legacy_layout"] = with_ctes("SELECT * FROM obs", ISD_LEGACY_CTE, isd_parse_sql("legacy"))

SQL["c11_weather_units"] = with_ctes("""
SELECT station_id, ROUND(wind_speed_ms * (3600.0::DOUBLE / 1852.0::DOUBLE), 6) AS wind_speed,
  ROUND(COALESCE(visibility_m / 1609.344::DOUBLE, 10.0::DOUBLE), 6) AS visibility,
  ROUND(COALESCE(ceiling_m / 0.3048::DOUBLE, 25000.0::DOUBLE), 6) AS ceiling,
  ROUND(temp_c * 9.0::DOUBLE / 5.0::DOUBLE + 32.0::DOUBLE, 6) AS temp, 0.0::DOUBLE AS precip,
  0 AS has_thunderstorm, 0 AS has_snow, 0 AS has_fog FROM obs""", ISD_CTE, isd_parse_sql("public"))

STATIONS_CTE = """airports AS (SELECT n_name AS iata, 'K'||CAST(n_nationkey AS VARCHAR) AS icao,
  n_nationkey AS k, CAST(25 + n_nationkey AS DOUBLE) AS lat, CAST(-120 + 2*n_nationkey AS DOUBLE) AS lon
  FROM nation),
stations AS (SELECT LPAD(CAST(700000 + s_suppkey AS VARCHAR),6,'0') AS usaf,
  LPAD(CAST(s_suppkey*13 % 100000 AS VARCHAR),5,'0') AS wban,
  CASE WHEN s_suppkey % 11 = 0 THEN 'CA' ELSE 'US' END AS ctry,
  CASE WHEN s_suppkey % 2 = 0 AND s_nationkey % 5 <> 0 THEN 'K'||CAST(s_nationkey AS VARCHAR) END AS icao,
  CASE WHEN s_suppkey % 17 = 0 THEN NULL ELSE 25 + CAST(s_suppkey*37 % 2500 AS DOUBLE)/100 END AS lat,
  -120 + CAST(s_suppkey*53 % 5000 AS DOUBLE)/100 AS lon FROM supplier),
us AS (SELECT * FROM stations WHERE ctry = 'US' AND lat IS NOT NULL AND lon IS NOT NULL),
exact AS (SELECT iata, usaf || '-' || wban AS station_id FROM (
  SELECT a.iata, s.usaf, s.wban, ROW_NUMBER() OVER (PARTITION BY a.iata ORDER BY s.usaf, s.wban) AS rn
  FROM airports a JOIN us s ON s.icao = UPPER(a.icao)) WHERE rn = 1),
nearest AS (SELECT iata, station_id FROM (
  SELECT a.iata, s.usaf || '-' || s.wban AS station_id,
    ROW_NUMBER() OVER (PARTITION BY a.iata ORDER BY (s.lat - a.lat) * (s.lat - a.lat)
                       + (s.lon - a.lon) * (s.lon - a.lon), s.usaf, s.wban) AS rn
  FROM airports a CROSS JOIN us s WHERE a.iata NOT IN (SELECT iata FROM exact)) WHERE rn = 1),
smap AS (SELECT iata, station_id, 'icao' AS method FROM exact
         UNION ALL SELECT iata, station_id, 'nearest' AS method FROM nearest)"""

SQL["s5_station_inventory"] = with_ctes("""
SELECT usaf AS USAF, wban AS WBAN, ctry AS CTRY, icao AS ICAO, ROUND(lat, 6) AS LAT, ROUND(lon, 6) AS LON FROM stations""", STATIONS_CTE)
SQL["p14_filter_month"] = "SELECT event_id FROM events WHERE month(ts) = 1"
SQL["j4_station_exact_icao"] = with_ctes("SELECT * FROM exact", STATIONS_CTE)
SQL["j5_station_map"] = with_ctes("SELECT * FROM smap", STATIONS_CTE)
SQL["j7_needed_station_months"] = with_ctes("""
SELECT c.airport, c.year, c.month, m.station_id FROM
  (SELECT DISTINCT unnest([origin, dest]) AS airport, CAST(year(fl_date) AS INT) AS year,
          CAST(month(fl_date) AS INT) AS month FROM pre) c
JOIN smap m ON m.iata = c.airport""", FLIGHTS_CTE, PRE_CTE, STATIONS_CTE)


def asof_sql(direction: str) -> str:
    cond = {"nearest": "", "backward": " AND o.t <= d.t", "forward": " AND o.t >= d.t"}[direction]
    return f"""
WITH dep AS (SELECT event_id AS dep_id, user_id % 25 AS airport, epoch_us(ts) AS t
             FROM events WHERE event_type = 'purchase'),
obs AS (SELECT event_id AS obs_id, user_id % 25 AS airport, epoch_us(ts) AS t, value
        FROM events WHERE event_type = 'view'),
m AS (SELECT d.dep_id, o.obs_id, o.value, o.t - d.t AS dt,
        ROW_NUMBER() OVER (PARTITION BY d.dep_id ORDER BY ABS(o.t - d.t), o.t, o.obs_id) AS rn
      FROM dep d JOIN obs o ON o.airport = d.airport AND ABS(o.t - d.t) <= 3600000000{cond})
SELECT d.dep_id, m.obs_id, ROUND(m.value, 6) AS obs_value,
  ROUND(m.dt::DOUBLE / 1000000.0::DOUBLE, 6) AS dt_seconds
FROM dep d LEFT JOIN m ON m.dep_id = d.dep_id AND m.rn = 1"""


def _nearest_obs(side: str) -> str:
    """The observation nearest to the departure at one end of each flight (r), six hours away at most."""
    return f"""{side}_bk AS (SELECT f.r, f.t, o.t AS ot, o.* EXCLUDE (airport, t) FROM timed f ASOF JOIN seen o ON o.airport = f.{side} AND o.t <= f.t),
{side}_fw AS (SELECT f.r, f.t, o.t AS ot, o.* EXCLUDE (airport, t) FROM timed f ASOF JOIN seen o ON o.airport = f.{side} AND o.t >= f.t),
{side}_obs AS (SELECT * FROM (SELECT * FROM {side}_bk UNION SELECT * FROM {side}_fw) WHERE abs(epoch(ot) - epoch(t)) <= 21600
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY abs(epoch(ot) - epoch(t)), ot) = 1)"""


SQL["j6_enrich_flights"] = with_ctes(f"""
SELECT l_orderkey, l_linenumber, origin, dest, {', '.join(
    f"ROUND({s}.{c}, 6) AS {side}_{c}" for side, s in (("origin", "a"), ("dest", "b")) for c in ("wind_speed", "visibility", "ceiling", "temp", "precip"))}
FROM timed f LEFT JOIN origin_obs a ON a.r = f.r LEFT JOIN dest_obs b ON b.r = f.r""", FLIGHTS_CTE, STATIONS_CTE, """timed AS (SELECT row_number() OVER () AS r, *,
  CAST(fl_date AS TIMESTAMP) + to_minutes(CAST(crs_dep_time // 100 * 60 + crs_dep_time % 100 AS BIGINT)) AS t FROM flights),
ends AS (SELECT DISTINCT unnest([origin, dest]) AS airport, year(fl_date) AS y, month(fl_date) AS m FROM flights),
taken AS (SELECT s.station_id, CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey * 37 % 86400) AS t, (o_orderkey % 300) / 10.0::DOUBLE * 3600.0::DOUBLE / 1852.0::DOUBLE AS wind_speed,
  COALESCE((o_orderkey % 160) * 100.0::DOUBLE / 1609.344::DOUBLE, 10.0) AS visibility,
  CASE WHEN o_orderkey % 7 <> 0 THEN (o_orderkey % 9000)::DOUBLE / 0.3048::DOUBLE ELSE 25000.0::DOUBLE END AS ceiling,
  ((o_orderkey % 500) / 10.0::DOUBLE - 10) * 9.0::DOUBLE / 5.0::DOUBLE + 32.0::DOUBLE AS temp, 0.0::DOUBLE AS precip
  FROM orders JOIN airports a ON a.k = o_custkey % 25 JOIN smap s ON s.iata = a.iata),
seen AS (SELECT m.iata AS airport, t.* EXCLUDE (station_id) FROM taken t JOIN smap m USING (station_id)
  WHERE EXISTS (SELECT 1 FROM ends e WHERE e.airport = m.iata AND e.y = year(t.t) AND e.m = month(t.t)))""", _nearest_obs("origin"), _nearest_obs("dest"))

SQL["j6_asof_nearest"] = asof_sql("nearest")
SQL["j6_asof_backward"] = asof_sql("backward")
SQL["j6_asof_forward"] = asof_sql("forward")

# ------------------------------------------------------------------ ADS-B
ADSB_CTE = """adsb AS (SELECT LPAD(LOWER(HEX(user_id)), 6, '0') AS icao24,
  'C' || CAST(user_id % 10 AS VARCHAR) || LPAD(CAST(event_id % 10000 AS VARCHAR), 4, '0') AS callsign,
  'K' || CAST(user_id % 25 AS VARCHAR) AS estDepartureAirport,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE 'K' || CAST(event_id % 25 AS VARCHAR) END AS estArrivalAirport,
  make_timestamp(CAST(FLOOR(epoch_us(ts) / 1000000) AS BIGINT) * 1000000) AS firstSeen,
  make_timestamp((CAST(FLOOR(epoch_us(ts) / 1000000) AS BIGINT) + 600 + event_id % 7200) * 1000000) AS lastSeen,
  CAST(event_id * 7 % 5000 AS INT) AS estDepartureAirportHorizDistance,
  CAST(event_id * 3 % 900 AS INT) AS estDepartureAirportVertDistance,
  CAST(event_id * 11 % 5000 AS INT) AS estArrivalAirportHorizDistance,
  CAST(event_id * 5 % 900 AS INT) AS estArrivalAirportVertDistance,
  CAST(event_id % 4 AS INT) AS departureAirportCandidatesCount,
  CAST(event_id % 3 AS INT) AS arrivalAirportCandidatesCount
  FROM events)"""

SQL["s7_adsb_records"] = with_ctes("SELECT * FROM adsb", ADSB_CTE)
SQL["a12_adsb_route_hour"] = with_ctes("""
SELECT estDepartureAirport AS dep, estArrivalAirport AS arr, date_trunc('hour', firstSeen) AS hour,
  COUNT(*) AS n_flights FROM adsb GROUP BY 1, 2, 3""", ADSB_CTE)
SQL["a12_adsb_movements"] = with_ctes("""
SELECT airport, SUM(d)::BIGINT AS departures, SUM(a)::BIGINT AS arrivals FROM (
  SELECT estDepartureAirport AS airport, 1 AS d, 0 AS a FROM adsb
  UNION ALL SELECT estArrivalAirport AS airport, 0 AS d, 1 AS a FROM adsb) x
WHERE airport IS NOT NULL GROUP BY airport""", ADSB_CTE)
SQL["j8_bbox_congestion"] = with_ctes("""
SELECT a.icao, COUNT(s.state_id) AS n_aircraft FROM airports a
LEFT JOIN (SELECT event_id AS state_id, 25 + CAST(event_id*37 % 2500 AS DOUBLE)/100 AS lat,
                  -120 + CAST(event_id*53 % 5000 AS DOUBLE)/100 AS lon FROM events) s
  ON s.lat BETWEEN a.lat - 0.5 AND a.lat + 0.5 AND s.lon BETWEEN a.lon - 0.5 AND a.lon + 0.5
GROUP BY a.icao""", STATIONS_CTE)

SQL["j8_snapshot_congestion"] = with_ctes("""
SELECT a.icao, t.time, COUNT(s.state_id) AS n_aircraft FROM airports a CROSS JOIN (SELECT DISTINCT CAST(epoch(ts) AS BIGINT) // 3600 * 3600 AS time FROM events) t
LEFT JOIN (SELECT event_id AS state_id, CAST(epoch(ts) AS BIGINT) // 3600 * 3600 AS time, 25 + CAST(event_id*37 % 2500 AS DOUBLE)/100 AS lat,
                  -120 + CAST(event_id*53 % 5000 AS DOUBLE)/100 AS lon FROM events) s
  ON s.time = t.time AND s.lat BETWEEN a.lat - 0.5 AND a.lat + 0.5 AND s.lon BETWEEN a.lon - 0.5 AND a.lon + 0.5
GROUP BY a.icao, t.time""", STATIONS_CTE)

# ------------------------------------------------------------------ evaluation on a score table
SCORED_CTE = "scored AS (SELECT is_delayed AS label, p AS score FROM pre)"
HIST_CTE = """hist AS (SELECT score, SUM(label)::DOUBLE AS tp, SUM(1 - label)::DOUBLE AS fp
  FROM scored GROUP BY score),
cum AS (SELECT score, tp, fp,
  SUM(tp) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_tp,
  SUM(fp) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_fp
  FROM hist),
tot AS (SELECT SUM(tp) AS p, SUM(fp) AS n FROM hist)"""
_EV = [FLIGHTS_CTE, PRE_CTE, SCORED_CTE, HIST_CTE]

SQL["m6_classification_metrics"] = with_ctes("""
SELECT ROUND((tp_ + (n - fp_)) / (p + n), 6) AS accuracy,
  ROUND(CASE WHEN tp_ + fp_ > 0 THEN tp_ / (tp_ + fp_) ELSE 0 END, 6) AS precision,
  ROUND(CASE WHEN p > 0 THEN tp_ / p ELSE 0 END, 6) AS recall,
  ROUND(CASE WHEN 2 * tp_ + fp_ + (p - tp_) > 0 THEN 2 * tp_ / (2 * tp_ + fp_ + (p - tp_)) ELSE 0 END, 6) AS f1,
  ROUND(auc / (p * n), 6) AS roc_auc, ROUND(ap / p, 6) AS pr_auc
FROM (SELECT SUM(CASE WHEN score > 0.5 THEN tp ELSE 0 END) AS tp_,
             SUM(CASE WHEN score > 0.5 THEN fp ELSE 0 END) AS fp_,
             SUM(fp * (cum_tp - tp / 2)) AS auc, SUM(tp * cum_tp / (cum_tp + cum_fp)) AS ap
      FROM cum) a, tot""", *_EV)

SQL["m8_confusion_matrix"] = with_ctes("""
SELECT label, prediction, n, ROUND(n::DOUBLE / SUM(n) OVER (PARTITION BY label), 6) AS rate
FROM (SELECT CAST(label AS INT) AS label, CAST(score > 0.5 AS INT) AS prediction, COUNT(*) AS n
      FROM scored GROUP BY 1, 2) c""", *_EV)

SWEEP_CTE = """sweep AS (SELECT t.threshold,
  SUM(CASE WHEN s.score >= t.threshold AND s.label = 1 THEN 1 ELSE 0 END)::DOUBLE AS tp,
  SUM(CASE WHEN s.score >= t.threshold AND s.label = 0 THEN 1 ELSE 0 END)::DOUBLE AS fp,
  SUM(s.label)::DOUBLE AS p
  FROM (SELECT i::DOUBLE / 100.0::DOUBLE AS threshold FROM range(10, 91) r(i)) t
  CROSS JOIN scored s GROUP BY t.threshold),
sweep_m AS (SELECT threshold,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
  CASE WHEN p > 0 THEN tp / p ELSE 0 END AS recall,
  CASE WHEN 2 * tp + fp + (p - tp) > 0 THEN 2 * tp / (2 * tp + fp + (p - tp)) ELSE 0 END AS f1
  FROM sweep)"""

SQL["m9_threshold_sweep"] = with_ctes("""
SELECT ROUND(threshold, 6) AS threshold, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall,
  ROUND(f1, 6) AS f1 FROM sweep_m""", FLIGHTS_CTE, PRE_CTE, SCORED_CTE, SWEEP_CTE)

SQL["t4_best_thresholds"] = with_ctes("""
SELECT metric, ROUND(threshold, 6) AS threshold, ROUND(value, 6) AS value FROM (
  SELECT metric, threshold, value,
    ROW_NUMBER() OVER (PARTITION BY metric ORDER BY value DESC, threshold ASC) AS rn
  FROM (SELECT 'f1' AS metric, threshold, f1 AS value FROM sweep_m
        UNION ALL SELECT 'precision', threshold, precision FROM sweep_m
        UNION ALL SELECT 'recall', threshold, recall FROM sweep_m) u) x WHERE rn = 1""",
                                      FLIGHTS_CTE, PRE_CTE, SCORED_CTE, SWEEP_CTE)

SQL["w2_roc_points"] = with_ctes("""
SELECT ROUND(score, 6) AS score, ROUND(cum_tp, 6) AS cum_tp, ROUND(cum_fp, 6) AS cum_fp,
  ROUND(cum_tp / p, 6) AS tpr, ROUND(cum_fp / n, 6) AS fpr FROM cum, tot""", *_EV)

SQL["w2_roc_corners"] = with_ctes("""
SELECT ROUND(score, 6) AS score, ROUND(cum_tp / p, 6) AS tpr, ROUND(cum_fp / n, 6) AS fpr FROM (
  SELECT *, row_number() OVER w AS k, lead(tp) OVER w AS tp1, lead(fp) OVER w AS fp1 FROM cum WINDOW w AS (ORDER BY score DESC)) c, tot
WHERE k = 1 OR tp1 IS NULL OR tp1 <> tp OR fp1 <> fp
UNION ALL SELECT NULL, 0.0, 0.0""", *_EV)

SQL["w3_pr_points"] = with_ctes("""
SELECT ROUND(score, 6) AS score, ROUND(cum_tp / (cum_tp + cum_fp), 6) AS precision,
  ROUND(cum_tp / p, 6) AS recall, ROUND(p / (p + n), 6) AS base_rate FROM cum, tot""", *_EV)

# ------------------------------------------------------------------ explanation
_NUMERIC = [f.strip() for f in """hour_of_day day_of_week month is_weekend is_holiday hour_sin hour_cos
month_sin month_cos origin_wind_speed origin_visibility origin_ceiling origin_temp origin_precip
origin_has_thunderstorm origin_has_snow origin_has_fog dest_wind_speed dest_visibility dest_ceiling
dest_temp dest_precip dest_has_thunderstorm dest_has_snow dest_has_fog ifr_conditions_origin
ifr_conditions_dest origin_flights_per_hour dest_flights_per_hour origin_delay_rate_rolling
dest_delay_rate_rolling is_origin_hub is_dest_hub distance route_avg_delay carrier_delay_rate""".split()]
_COEF = [(0.1 + 0.13 * (j % 5)) * (1 if j % 2 == 0 else -1) for j in range(len(_NUMERIC))]


def _contrib(j: int) -> str:
    return f"({_COEF[j]!r}::DOUBLE * COALESCE(CAST({_NUMERIC[j]} AS DOUBLE), 0.0))"


# The features of the Spark side are not rounded before attribution: use unrounded ones here.
def _unrounded_feature_ctes() -> list[str]:
    ctes = feature_table_ctes(TRAIN_WHERE, TEST_WHERE)
    ctes[-1] = ctes[-1].replace(FEATURE_SELECT, FEATURE_SELECT_RAW)
    return ctes


FEATURE_SELECT_RAW = re.sub(r"ROUND\((\w+), 6\) AS \w+", r"\1", FEATURE_SELECT)

ATTR_CTE = f"""attr AS (SELECT *, ROW_NUMBER() OVER () AS rid,
  -0.5 + (0.0 + {' + '.join(_contrib(j) for j in range(len(_NUMERIC)))}) AS raw_margin FROM ft),
contribs AS ({' UNION ALL '.join(
    f"SELECT rid, '{f}' AS feature, {j} AS idx, {_contrib(j)} AS value FROM attr"
    for j, f in enumerate(_NUMERIC))})"""

SQL["m11_linear_attribution"] = with_ctes("""
SELECT l_orderkey, l_linenumber, -0.5::DOUBLE AS base_value, ROUND(raw_margin, 6) AS raw_margin,
  ROUND(1 / (1 + exp(-raw_margin)), 6) AS probability FROM attr""",
                                          *_unrounded_feature_ctes(), ATTR_CTE)

_READABLE = " ".join(f"WHEN '{f}' THEN '{f.replace('_', ' ').title()}'" for f in _NUMERIC)

SQL["m13_c18_explanations"] = with_ctes(f"""
SELECT a.l_orderkey, a.l_linenumber, t.top_features,
  CASE WHEN t.total > 0 THEN 'This flight is likely delayed because:'
       ELSE 'This flight is likely on time because:' END || chr(10) || t.bullets AS explanation,
  CASE WHEN p < 0.3 THEN 'ON TIME' WHEN p < 0.6 THEN 'MODERATE DELAY RISK' ELSE 'HIGH DELAY RISK' END
    AS risk_band,
  CAST(p >= 0.5 AS INT) AS predicted_delayed
FROM (SELECT *, 1 / (1 + exp(-raw_margin)) AS p FROM attr) a
JOIN (SELECT rid, string_agg(feature, ',' ORDER BY rn) AS top_features, SUM(value) AS total,
        string_agg('  • ' || (CASE feature {_READABLE} END)
                   || CASE WHEN value > 0 THEN ' increases delay risk (contribution: +'
                           ELSE ' decreases delay risk (contribution: ' END
                   || printf('%.3f', value) || ')', chr(10) ORDER BY rn) AS bullets
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY rid ORDER BY ABS(value) DESC, idx DESC) AS rn
            FROM contribs) r WHERE rn <= 5 GROUP BY rid) t ON t.rid = a.rid""",
                                        *_unrounded_feature_ctes(), ATTR_CTE)

SQL["m14_global_attribution"] = with_ctes("""
SELECT feature, ROUND(AVG(ABS(value)), 6) AS mean_abs_contribution,
  ROUND(AVG(value), 6) AS mean_contribution FROM contribs GROUP BY feature""",
                                          *_unrounded_feature_ctes(), ATTR_CTE)

# ------------------------------------------------------------------ BTS mapping
SQL["s4_bts_to_canonical"] = with_ctes("""
SELECT l_orderkey, l_linenumber, carrier, fl_date, origin, dest, crs_dep_time,
  ROUND(arr_delay, 6) AS arr_delay, cancelled, ROUND(CAST(distance AS DOUBLE), 6) AS distance
FROM flights""", FLIGHTS_CTE)

# ------------------------------------------------------------------ scoring input
_SIDE_DEFAULTS = ("8.0::DOUBLE AS {s}_wind_speed, 10.0::DOUBLE AS {s}_visibility, "
                  "25000 AS {s}_ceiling, 60.0::DOUBLE AS {s}_temp, 0.0::DOUBLE AS {s}_precip, "
                  "0 AS {s}_has_thunderstorm, 0 AS {s}_has_snow, 0 AS {s}_has_fog")
SCORING_CTE = (f"scoring AS (SELECT l_orderkey, l_linenumber, fl_date, carrier, origin, dest, "
               f"crs_dep_time, distance, {_SIDE_DEFAULTS.format(s='origin')}, "
               f"{_SIDE_DEFAULTS.format(s='dest')} FROM pre WHERE {TEST_WHERE})")

SQL["p15_scoring_features"] = with_ctes(f"""
SELECT l_orderkey, l_linenumber, {FEATURE_SELECT.replace('ROUND(origin_ceiling, 6) AS origin_ceiling', 'origin_ceiling').replace('ROUND(dest_ceiling, 6) AS dest_ceiling', 'dest_ceiling')}
FROM (SELECT f.*, COALESCE(re.v, g.gm) AS route_avg_delay, COALESCE(ce.v, g.gm) AS carrier_delay_rate
      FROM feat f CROSS JOIN g LEFT JOIN re ON re.route = f.origin || '-' || f.dest
      LEFT JOIN ce ON ce.carrier = f.carrier) x""",
    FLIGHTS_CTE, PRE_CTE, SCORING_CTE, TEMPORAL_CTE.replace("FROM pre)", "FROM scoring)"),
    future_cte("origin", "r_o"), future_cte("dest", "r_d"), APT_CTE, FEAT_CTE, encoder_ctes(TRAIN_WHERE))

SQL["l9_future_rates"] = with_ctes("""
SELECT t.l_orderkey, t.l_linenumber, t.fl_date, """ + ", ".join(
    f"ROUND(COALESCE({s}_{g}.r, 0.0), 6) AS {s}_rate_{g}" for g in ("active", "dense") for s in ("origin", "dest")) + """
FROM pre t """ + " ".join(
    f"LEFT JOIN {s}_{g} ON {s}_{g}.{s} = t.{s} AND {s}_{g}.fl_date = t.fl_date"
    for g in ("active", "dense") for s in ("origin", "dest")) + f" WHERE {TEST_WHERE.replace('fl_date', 't.fl_date')}",
    FLIGHTS_CTE, PRE_CTE, *[future_cte(s, "r", g, f"{s}_{g}") for g in ("active", "dense") for s in ("origin", "dest")])

SQL["s9_featurizer_round_trip"] = SQL["l7_featurizer_train_to_test"]

# ------------------------------------------------------------------ files
SQL["s1_csv_preprocess"] = with_ctes("""
SELECT l_orderkey, l_linenumber, fl_date, carrier, origin, dest, crs_dep_time,
  ROUND(arr_delay, 6) AS arr_delay, cancelled, ROUND(distance, 6) AS distance,
  ROUND(origin_wind_speed, 6) AS origin_wind_speed,
  ROUND(COALESCE(CASE WHEN l_orderkey % 97 <> 0 THEN origin_has_snow::DOUBLE END,
    (SELECT median(origin_has_snow) FROM pre WHERE l_orderkey % 97 <> 0)), 6) AS origin_has_snow,
  is_delayed FROM pre""", FLIGHTS_CTE, PRE_CTE)

SQL["s2_s3_bts_by_name"] = with_ctes("""
SELECT l_orderkey, l_linenumber, carrier, fl_date, origin, dest, crs_dep_time,
  ROUND(arr_delay, 6) AS arr_delay, cancelled,
  CASE WHEN l_orderkey % 2 = 0 THEN ROUND(CAST(distance AS DOUBLE), 6) END AS distance
FROM flights""", FLIGHTS_CTE)

SQL["s8_write_and_split"] = with_ctes(f"""
SELECT l_orderkey, l_linenumber, fl_date, carrier, ROUND(arr_delay, 6) AS arr_delay,
  year(fl_date) AS year, month(fl_date) AS month FROM flights WHERE {TEST_WHERE}""", FLIGHTS_CTE)

# ------------------------------------------------------------------ tree attribution
SQL["m12_tree_attribution"] = with_ctes(f"""
SELECT l_orderkey, l_linenumber, true AS adds_up FROM pre WHERE {TEST_WHERE}""", FLIGHTS_CTE, PRE_CTE)


# ------------------------------------------------------------------ second-order boosting (M3), one round
BOOSTED = ("hour_of_day", "day_of_week", "month", "distance", "origin_temp", "origin_has_snow")


def _boost_level(k: int) -> str:
    """CTEs of a level: the cells of its nodes, their best splits, and the rows with their next node.
    Nodes are places in a full tree (children 2i+1, 2i+2); null where a row's node has no split."""
    score = "CASE WHEN abs({g}) > 0.1 THEN pow(abs({g}) - 0.1, 2) / ({h} + 1.0) ELSE 0 END"
    left, right, both = (score.format(g=g, h=h) for g, h in (("gl", "hl"), ("(gt - gl)", "(ht - hl)"), ("gt", "ht")))
    child = f"2 * r.node + CASE WHEN [{', '.join(BOOSTED)}][b.f + 1] <= b.v THEN 1 ELSE 2 END"
    return f"""cell{k} AS (SELECT node, f, v, sum(g) AS g, sum(h) AS h FROM (
    SELECT node, unnest(range({len(BOOSTED)})) AS f, unnest([{', '.join(BOOSTED)}]) AS v, g, h FROM row{k} WHERE node IS NOT NULL) GROUP BY ALL),
run{k} AS (SELECT node, f, v, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER (PARTITION BY node, f) AS gt, sum(h) OVER (PARTITION BY node, f) AS ht
    FROM cell{k} WINDOW w AS (PARTITION BY node, f ORDER BY v)),
best{k} AS (SELECT * FROM (SELECT *, round({left} + {right} - {both}, 6) AS gain FROM run{k}) WHERE hl >= 3 AND ht - hl >= 3 AND gain > 0
    QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, v) = 1),
row{k + 1} AS (SELECT r.* REPLACE (CASE WHEN b.node IS NOT NULL THEN {child} END AS node, CASE WHEN b.node IS NOT NULL THEN {child} ELSE place END AS place)
    FROM row{k} r LEFT JOIN best{k} b ON r.node = b.node)"""


BOOST_CTES = (FLIGHTS_CTE, f"""x AS (SELECT l_orderkey, l_linenumber, CASE WHEN arr_delay >= 15 THEN 1 ELSE 0 END AS y, {HOUR_SQL}::DOUBLE AS hour_of_day,
    (isodow(fl_date) - 1)::DOUBLE AS day_of_week, month(fl_date)::DOUBLE AS month, distance::DOUBLE AS distance, origin_temp::DOUBLE AS origin_temp,
    origin_has_snow::DOUBLE AS origin_has_snow FROM flights WHERE cancelled = 0),
row0 AS (SELECT x.*, 0 AS node, 0 AS place, CASE WHEN y = 1 THEN -0.5 * s ELSE 0.5 END AS g, CASE WHEN y = 1 THEN 0.25 * s ELSE 0.25 END AS h
    FROM x, (SELECT (count(*) - sum(y)) / sum(y)::DOUBLE AS s FROM x))""", _boost_level(0), _boost_level(1),
    """node AS (SELECT node AS place, sum(g) AS g, sum(h) AS h FROM (SELECT node, g, h FROM row0 UNION ALL SELECT node, g, h FROM row1 UNION ALL SELECT node, g, h FROM row2)
    WHERE node IS NOT NULL GROUP BY node),
tree AS (SELECT place, b.f, b.v AS threshold, b.gain, -0.1 * sign(g) * greatest(abs(g) - 0.1, 0) / (h + 1.0) AS value, h AS cover
    FROM node LEFT JOIN (SELECT * FROM best0 UNION ALL SELECT * FROM best1) b ON b.node = place)""")

SQL["m3_boosted_splits"] = with_ctes(f"""
SELECT place, [{', '.join(repr(c) for c in BOOSTED)}][f + 1] AS feature, round(threshold, 4) AS threshold, round(gain, 4) AS gain, round(value, 4) AS value,
  round(cover, 4) AS cover FROM tree""", *BOOST_CTES)


def _given(place: int) -> str:
    """Output of the subtree at ``place`` (two levels) when the features in the set ``m`` (bits) are known:
    the others' splits are averaged by Hessian."""
    at, left, right = place + 1, 2 * place + 2, 2 * place + 3
    if place > 2:
        return f"value[{at}]"
    a, b = _given(2 * place + 1), _given(2 * place + 2)
    return (f"CASE WHEN f[{at}] IS NULL THEN value[{at}] WHEN (m >> f[{at}]) & 1 = 1 THEN CASE WHEN x[f[{at}] + 1] <= threshold[{at}] THEN {a} ELSE {b} END "
            f"ELSE (cover[{left}] * ({a}) + cover[{right}] * ({b})) / cover[{at}] END")


def _shapley(i: int, digits: int = 6) -> str:
    """Mean gain of knowing feature ``i`` over all orders of the features, from the outputs ``o`` of all sets."""
    n = len(BOOSTED)
    terms = [f"{factorial(m.bit_count()) * factorial(n - 1 - m.bit_count()) / factorial(n)!r} * (o[{(m | 1 << i) + 1}] - o[{m + 1}])"
             for m in range(1 << n) if not m >> i & 1]
    return "round(" + " + ".join(terms) + f", {digits}) AS {BOOSTED[i]}"


def _shap_ctes(rows: str = "x") -> str:
    """The outputs of all sets of features for each flight of ``rows``."""
    return f"""lists AS (SELECT list(f ORDER BY place) AS f, list(threshold ORDER BY place) AS threshold, list(value ORDER BY place) AS value,
    list(cover ORDER BY place) AS cover FROM (SELECT * FROM range(7) r(place) LEFT JOIN tree USING (place))),
sets AS (SELECT *, unnest(range({1 << len(BOOSTED)})) AS m FROM (
    SELECT row_number() OVER () AS r, l_orderkey, l_linenumber, [{', '.join(BOOSTED)}] AS x FROM {rows})),
outputs AS (SELECT r, l_orderkey, l_linenumber, x, list(out ORDER BY m) AS o FROM (SELECT sets.*, {_given(0)} AS out FROM sets, lists) GROUP BY ALL)"""

SQL["m12_boosted_contributions"] = with_ctes(f"""
SELECT l_orderkey, l_linenumber, {', '.join(_shapley(i) for i in range(len(BOOSTED)))}, round(o[1], 6) AS base_value, round(o[{1 << len(BOOSTED)}], 6) AS raw_margin
FROM outputs""", *BOOST_CTES, _shap_ctes("x WHERE month > 10"))

SQL["m10_boosted_predictions"] = with_ctes("""
SELECT l_orderkey, l_linenumber, round(1 / (1 + exp(-value)), 6) AS probability_delayed, CAST(value > 0 AS INT) AS predicted
FROM row2 JOIN tree USING (place)""", *BOOST_CTES)

SQL["t2_boosted_importances"] = with_ctes(f"""
SELECT feature, round(coalesce(gain, 0) / sum(gain) OVER (), 6) AS importance
FROM (SELECT unnest(range({len(BOOSTED)})) AS f, unnest([{', '.join(repr(c) for c in BOOSTED)}]) AS feature) n LEFT JOIN (SELECT f, avg(gain) AS gain FROM tree WHERE f IS NOT NULL GROUP BY f) t USING (f)""",
                                        *BOOST_CTES)

_BINS = "[" + ", ".join(str(k / 20) for k in range(1, 20)) + "]"
SQL["m14_beeswarm"] = with_ctes("""
SELECT feature, value_bin, contrib_bin, count(*) AS n, round(avg(v), 6) AS mean_value, round(avg(c), 6) AS mean_contrib
FROM (SELECT feature, v, c, CAST(len(list_filter(ve, lambda e: v > e)) AS INT) AS value_bin, CAST(len(list_filter(ce, lambda e: c > e)) AS INT) AS contrib_bin
  FROM long JOIN edges USING (feature)) GROUP BY ALL""", *BOOST_CTES, _shap_ctes(), f"""phi AS (SELECT x, {', '.join(_shapley(i, 9) for i in range(len(BOOSTED)))}
  FROM outputs),
long AS (SELECT unnest([{', '.join(repr(c) for c in BOOSTED)}]) AS feature, unnest(x) AS v, unnest([{', '.join(BOOSTED)}]) AS c FROM phi),
edges AS (SELECT feature, quantile_disc(v, {_BINS}) AS ve, quantile_disc(c, {_BINS}) AS ce FROM long GROUP BY feature)""")
