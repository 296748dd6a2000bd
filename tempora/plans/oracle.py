"""Independent SQL (DuckDB dialect) for every catalog entry.

Written from the query semantics, not generated from the Spark plans. Two
helpers make numbers comparable to the last bit:

* ``xmean(e)`` — HALF_UP mean to 2 dp in integer cents (exact; sign restored
  so negative means round away from zero like Spark's decimal ``round``).
* ``sround(e, d)`` — Spark's ``round`` on a double: HALF_UP on the value's
  shortest decimal text.
"""

from __future__ import annotations


def xmean(e: str) -> str:
    cents = f"CAST(round(({e}) * 100) AS BIGINT)"
    return (
        f"(CAST(sign(sum({cents})) * ((2 * abs(sum({cents})) + count({e})) // (2 * count({e}))) AS DOUBLE) / 100.0)"
    )


def xavg(e: str) -> str:
    """Unrounded mean: one division of the exact sum of cents by the count."""
    return f"(CAST(sum(CAST(round(({e}) * 100) AS BIGINT)) AS DOUBLE) / CAST(count({e}) * 100 AS DOUBLE))"


def sround(e: str, d: int) -> str:
    return f"CAST(round(CAST(CAST(({e}) AS VARCHAR) AS DECIMAL(38,15)), {d}) AS DOUBLE)"


def pct(part: str, whole: str) -> str:
    return f"(CAST((2 * ({part}) * 10000 + ({whole})) // (2 * ({whole})) AS DOUBLE) / 100.0)"


# --------------------------------------------------------------- historical

ORDERS_FAULTY = """
orders_raw AS (
  SELECT
    CASE WHEN o_orderkey % 11 = 0 THEN 'not-a-date' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS dt,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL
         WHEN o_orderkey % 19 = 0 THEN 'n/a'
         ELSE CAST(o_totalprice AS VARCHAR) END AS "AverageTemperature",
    CAST(NULL AS DOUBLE) AS "AverageTemperatureUncertainty",
    CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_custkey END AS "City",
    CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderpriority END AS "Country",
    o_orderstatus AS "Latitude",
    CAST(o_orderkey AS VARCHAR) AS "Longitude",
    CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 19 = 0 THEN NULL ELSE o_totalprice END AS temperature
  FROM orders
),
orders_parsed AS (
  SELECT *, CAST(try_strptime(dt, '%Y-%m-%d') AS DATE) AS date FROM orders_raw
),
orders_clean AS (
  SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
         temperature, "AverageTemperatureUncertainty" AS uncertainty,
         "City" AS city, "Country" AS country, "Latitude" AS latitude, "Longitude" AS longitude
  FROM orders_parsed
  WHERE temperature IS NOT NULL AND "City" IS NOT NULL AND "Country" IS NOT NULL AND date IS NOT NULL
)"""

ORDERS_CLEAN = """
oc AS (
  SELECT CAST(o_orderdate AS DATE) AS date, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(month(o_orderdate) AS INTEGER) AS month, o_totalprice AS temperature,
         CAST(NULL AS DOUBLE) AS uncertainty, o_custkey AS city, o_orderpriority AS country,
         o_orderstatus AS latitude, CAST(o_orderkey AS VARCHAR) AS longitude
  FROM orders
)"""

LINE_CLEAN = """
lc AS (
  SELECT l_extendedprice AS temperature, l_tax AS uncertainty, l_partkey AS city, l_returnflag AS country
  FROM lineitem WHERE l_shipdate IS NOT NULL
)"""

EVENTS_CLEAN = """
ec AS (
  SELECT CAST(ts AS DATE) AS date, value AS temperature, user_id AS city, event_type AS country,
         CAST(event_id AS VARCHAR) AS latitude, props AS longitude
  FROM events
)"""

EXTREME = "(temperature < 0.1 OR temperature > 200.0)"


def _by(keys_sel: str, keys_grp: str, src: str, order: str, extra: str = "") -> str:
    return (
        f"SELECT {keys_sel}, {xmean('temperature')} AS avg_temperature{extra}, count(*) AS num_records "
        f"FROM {src} GROUP BY {keys_grp} ORDER BY {order}"
    )


MEAN_BY_YEAR = f"WITH {ORDERS_CLEAN} " + _by("year", "year", "oc", "year")

CITY_MEANS = (
    f"WITH {LINE_CLEAN} SELECT city, country, {xmean('temperature')} AS avg_temperature, count(*) AS num_records "
    "FROM lc GROUP BY city, country HAVING count(*) > 10"
)

SUPPLIER_MEANS = (
    f"SELECT l_suppkey AS city, l_returnflag AS country, {xmean('l_extendedprice')} AS avg_temperature, "
    "count(*) AS num_records FROM lineitem WHERE l_shipdate IS NOT NULL "
    "GROUP BY l_suppkey, l_returnflag HAVING count(*) > 100"
)

EXTREME_ROWS = f"WITH {EVENTS_CLEAN} SELECT date, city, country, temperature, latitude, longitude FROM ec WHERE {EXTREME}"

YEARLY = (
    f"SELECT o_custkey AS \"City\", o_orderpriority AS \"Country\", CAST(year(o_orderdate) AS INTEGER) AS year, "
    f"{xmean('o_totalprice')} AS temperature_moyenne, 'batch' AS source FROM orders "
    "GROUP BY o_custkey, o_orderpriority, year(o_orderdate)"
)

# ---------------------------------------------------------------- streaming

RECORDS = """
rec AS (
  SELECT ts, event_type AS city, 'events' AS country, value AS t,
         CAST(user_id AS DOUBLE) AS wind, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS hum,
         CAST(1000 + event_id % 50 AS DOUBLE) AS pres
  FROM events
),
win AS (
  SELECT date_trunc('minute', ts) AS window_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
         city, country, count(*) AS nb_mesures, """ + xmean("t") + """ AS temperature_moyenne,
         max(t) AS temp_max, min(t) AS temp_min, avg(wind) AS vent_moyen_kmh,
         avg(hum) AS humidite_moyenne, avg(pres) AS pression_moyenne
  FROM rec GROUP BY date_trunc('minute', ts), city, country
),
closed AS (
  SELECT * FROM win WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 2 MINUTE
)"""

STREAM_UNIFIED = (
    f"WITH {RECORDS} SELECT CAST(city AS VARCHAR) AS \"City\", CAST(country AS VARCHAR) AS \"Country\", "
    "CAST(year(window_start) AS INTEGER) AS year, temperature_moyenne, 'streaming' AS source FROM closed"
)

UNIFIED = f"""
u AS (
  SELECT CAST("City" AS VARCHAR) AS "City", CAST("Country" AS VARCHAR) AS "Country", year, temperature_moyenne, source
  FROM ({YEARLY}) b
  UNION ALL
  SELECT * FROM ({STREAM_UNIFIED}) s
)"""

LATEST_PER_USER = """SELECT user_id, ts, event_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id
                               ORDER BY ts DESC, event_id DESC, event_type DESC, value DESC, props DESC) AS rn
  FROM events) WHERE rn = 1"""

# ------------------------------------------------------------------ payloads

LINE_CTX = (
    "l_orderkey * 8 + l_linenumber AS record_id, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS timestamp, "
    "l_returnflag AS city, l_linestatus AS country, CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS DOUBLE) AS lon"
)

POINT_FIELDS = (
    f"CASE WHEN l_linenumber = 7 THEN NULL ELSE {sround('(l_quantity + 250.0) - 273.15', 2)} END AS temperature_celsius, "
    f"{sround('sqrt(u * u + v * v) * 3.6', 2)} AS wind_speed_kmh, "
    "CASE WHEN u = 0 AND v = 0 THEN 0 "
    "ELSE CAST(trunc((atan2(u, v) * 180.0 / pi() + 180.0) % 360.0) AS INTEGER) END AS wind_direction_deg, "
    f"{sround('l_linenumber * 12.5', 1)} AS humidity_percent, "
    f"{sround('l_extendedprice / 100.0', 1)} AS pressure_hpa"
)
POINT_SRC = "(SELECT *, round(l_discount * 100) - 5 AS u, round(l_tax * 100) - 4 AS v FROM lineitem)"

CURRENT_FIELDS = (
    "CAST(l_quantity - 20.5 AS DOUBLE) AS temperature_celsius, CAST(l_discount * 100 AS DOUBLE) AS wind_speed_kmh, "
    "CAST(l_partkey % 360 AS INTEGER) AS wind_direction_deg, CAST(l_linenumber * 10.0 AS DOUBLE) AS humidity_percent, "
    "CAST(l_quantity + 1000.0 AS DOUBLE) AS pressure_hpa"
)

MAIN_FIELDS = (
    f"{sround('l_quantity - 10.25', 2)} AS temperature_celsius, "
    f"CASE WHEN l_linenumber = 7 THEN NULL ELSE {sround('(l_discount * 100) * 3.6', 2)} END AS wind_speed_kmh, "
    "CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_partkey % 360 AS INTEGER) END AS wind_direction_deg, "
    f"{sround('l_tax * 1000', 1)} AS humidity_percent, "
    f"{sround('l_discount * 100 + 990', 1)} AS pressure_hpa"
)


def _payload(fields: str, src: str, source: str, where: str = "") -> str:
    return f"SELECT {LINE_CTX}, {fields}, '{source}' AS source FROM {src} {where}"


# ----------------------------------------------------------------- the set

YEAR_MONTHS = f"""SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS year,
       {xmean('o_totalprice')} AS avg_temperature, count(*) AS num_records FROM orders GROUP BY 1"""

# Events as the multi-batch streams see them; late ones lie in the first quarter of the time range.
EVENT_RANGE = "(SELECT min(epoch(date_trunc('second', ts))) AS lo, max(epoch(date_trunc('second', ts))) AS hi FROM events)"
IS_LATE = "(event_id % 10 = 0 AND (epoch(date_trunc('second', ts)) - lo) * 4 / greatest(1, hi - lo + 1) < 1)"
NOT_LATE = f"(SELECT e.* FROM events e, {EVENT_RANGE} r WHERE NOT {IS_LATE})"
WITH_TIME = "(SELECT * FROM events WHERE event_id % 9 <> 0)"
RECORDS_NOT_LATE = RECORDS.replace("FROM events", f"FROM {NOT_LATE}", 1)
RECORDS_WITH_TIME = RECORDS.replace("FROM events", f"FROM {WITH_TIME}")


SQL: dict[str, str] = {
    "null_profile": f"""WITH {ORDERS_FAULTY}
SELECT count(CASE WHEN dt IS NULL THEN 1 END) AS dt,
       count(CASE WHEN "AverageTemperature" IS NULL THEN 1 END) AS "AverageTemperature",
       count(CASE WHEN "AverageTemperatureUncertainty" IS NULL THEN 1 END) AS "AverageTemperatureUncertainty",
       count(CASE WHEN "City" IS NULL THEN 1 END) AS "City",
       count(CASE WHEN "Country" IS NULL THEN 1 END) AS "Country",
       count(CASE WHEN "Latitude" IS NULL THEN 1 END) AS "Latitude",
       count(CASE WHEN "Longitude" IS NULL THEN 1 END) AS "Longitude"
FROM orders_raw""",
    "clean_counts": f"""WITH {ORDERS_FAULTY},
c AS (SELECT count(*) AS rows_before,
             count(CASE WHEN temperature IS NOT NULL AND "City" IS NOT NULL AND "Country" IS NOT NULL
                        AND date IS NOT NULL THEN 1 END) AS rows_after
      FROM orders_parsed)
SELECT rows_before, rows_after, rows_before - rows_after AS rows_removed,
       {pct('rows_before - rows_after', 'rows_before')} AS removal_pct
FROM c""",
    "clean_rows": f"WITH {ORDERS_FAULTY} SELECT * FROM orders_clean",
    "mean_by_country": f"WITH {LINE_CLEAN} "
    + _by("country", "country", "lc", "avg_temperature DESC NULLS LAST, country ASC NULLS FIRST LIMIT 10",
          f", {xmean('uncertainty')} AS avg_uncertainty"),
    "mean_by_country_many": f"""WITH l AS (SELECT l_suppkey AS country, l_extendedprice AS temperature, l_tax AS uncertainty FROM lineitem)
SELECT country, {xmean('temperature')} AS avg_temperature, {xmean('uncertainty')} AS avg_uncertainty, count(*) AS num_records
FROM l GROUP BY country ORDER BY avg_temperature DESC NULLS LAST, country LIMIT 10""",
    "mean_by_country_ref": f"""SELECT l_returnflag AS country, {sround('avg(l_extendedprice)', 2)} AS avg_temperature,
       {sround('avg(l_tax)', 2)} AS avg_uncertainty, count(*) AS num_records
FROM lineitem GROUP BY l_returnflag ORDER BY avg_temperature DESC, country LIMIT 10""",
    "mean_by_year": MEAN_BY_YEAR,
    "mean_by_year_ref": f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, {sround('avg(o_totalprice)', 2)} AS avg_temperature,
       count(*) AS num_records FROM orders GROUP BY year(o_orderdate)""",
    "first_months": f"{YEAR_MONTHS} ORDER BY year ASC LIMIT 10",
    "last_months": f"{YEAR_MONTHS} ORDER BY year DESC LIMIT 10",
    "first_years": f"WITH {ORDERS_CLEAN} " + _by("year", "year", "oc", "year ASC LIMIT 10"),
    "last_years": f"WITH {ORDERS_CLEAN} " + _by("year", "year", "oc", "year DESC LIMIT 10"),
    "hottest": f"{CITY_MEANS} ORDER BY avg_temperature DESC NULLS LAST, city, country LIMIT 10",
    "coldest": f"{CITY_MEANS} ORDER BY avg_temperature ASC NULLS FIRST, city, country LIMIT 10",
    "hottest_ref": f"{SUPPLIER_MEANS} ORDER BY avg_temperature DESC NULLS LAST, city, country LIMIT 10",
    "coldest_ref": f"{SUPPLIER_MEANS} ORDER BY avg_temperature ASC NULLS FIRST, city, country LIMIT 10",
    "mean_by_month": f"WITH {ORDERS_CLEAN} " + _by("month", "month", "oc", "month"),
    "global_stats": f"""WITH {EVENTS_CLEAN}
SELECT {xmean('temperature')} AS global_mean_temperature, min(temperature) AS global_min_temperature,
       max(temperature) AS global_max_temperature,
       count(CASE WHEN {EXTREME} THEN 1 END) AS extreme_observations
FROM ec""",
    "global_stats_ref": f"""WITH {EVENTS_CLEAN}
SELECT {xmean('temperature')} AS global_mean_temperature, min(temperature) AS global_min_temperature,
       max(temperature) AS global_max_temperature,
       count(CASE WHEN temperature < -20.0 OR temperature > 40.0 THEN 1 END) AS extreme_observations
FROM ec""",
    "extremes": f"{EXTREME_ROWS} ORDER BY temperature DESC",
    "extremes_high": f"{EXTREME_ROWS} ORDER BY temperature DESC, date, city, country, latitude, longitude LIMIT 10",
    "extremes_low": f"{EXTREME_ROWS} ORDER BY temperature ASC, date, city, country, latitude, longitude LIMIT 10",
    "mean_by_period": f"""WITH {ORDERS_CLEAN},
p AS (SELECT *, CASE WHEN year >= 1996 AND year < 1998 THEN '1996-1997'
                     WHEN year >= 1998 AND year < 2000 THEN '1998-1999'
                     WHEN year >= 2000 THEN '2000+' END AS period FROM oc)
SELECT period, {xmean('temperature')} AS avg_temperature, count(*) AS num_records
FROM p WHERE period IS NOT NULL GROUP BY period ORDER BY period""",
    "mean_by_period_ref": f"""WITH {ORDERS_CLEAN},
p AS (SELECT *, CASE WHEN year >= 1900 AND year < 1950 THEN '1900-1949'
                     WHEN year >= 1950 AND year < 2000 THEN '1950-1999'
                     WHEN year >= 2000 THEN '2000+' END AS period FROM oc)
SELECT period, {xmean('temperature')} AS avg_temperature, count(*) AS num_records
FROM p WHERE period IS NOT NULL GROUP BY period ORDER BY period""",
    "mean_by_decade": f"""WITH {ORDERS_CLEAN},
d AS (SELECT *, CAST((year // 10) * 10 AS INTEGER) AS decade FROM oc)
SELECT decade, {xmean('temperature')} AS avg_temperature, count(*) AS num_records
FROM d GROUP BY decade ORDER BY decade""",
    "yearly_mean": YEARLY,
    "run_report": f"""WITH {ORDERS_FAULTY},
v AS (SELECT *, (temperature IS NOT NULL AND "City" IS NOT NULL AND "Country" IS NOT NULL
                 AND date IS NOT NULL) AS ok FROM orders_parsed),
r AS (SELECT count(*) AS rows_before_cleaning, count(CASE WHEN ok THEN 1 END) AS rows_after_cleaning,
             {xmean('CASE WHEN ok THEN temperature END')} AS global_mean_temperature,
             {sround('min(CASE WHEN ok THEN temperature END)', 2)} AS global_min_temperature,
             {sround('max(CASE WHEN ok THEN temperature END)', 2)} AS global_max_temperature,
             count(CASE WHEN ok AND (temperature < 5000.0 OR temperature > 495000.0) THEN 1 END) AS extreme_observations
      FROM v)
SELECT *, rows_before_cleaning AS rows_extracted, CAST(7 AS INTEGER) AS columns,
       rows_before_cleaning - rows_after_cleaning AS rows_removed,
       {pct('rows_before_cleaning - rows_after_cleaning', 'rows_before_cleaning')} AS removal_percentage
FROM r""",
    "batch_ordered": f"""WITH {ORDERS_FAULTY},
means AS (SELECT CAST("City" AS VARCHAR) AS "City", "Country", CAST(year(date) AS INTEGER) AS year, {xmean('temperature')} AS temperature_moyenne
  FROM orders_parsed WHERE temperature IS NOT NULL AND "City" IS NOT NULL AND "Country" IS NOT NULL AND date IS NOT NULL GROUP BY 1, 2, 3)
SELECT *, 'batch' AS source, row_number() OVER (ORDER BY "Country", "City", year) AS position FROM means""",
    "batch_rerun": f"""SELECT CAST(o_custkey AS VARCHAR) AS "City", o_orderpriority AS "Country", CAST(year(o_orderdate) AS INTEGER) AS year,
  {xmean('o_totalprice')} AS temperature_moyenne, 'batch' AS source FROM orders
WHERE year(o_orderdate) <> 1997 OR o_orderkey % 2 = 0 GROUP BY 1, 2, 3""",
    "batch_job_csv": f"""WITH {ORDERS_FAULTY}
SELECT CAST("City" AS VARCHAR) AS "City", "Country", CAST(year(date) AS INTEGER) AS year,
       {xmean('temperature')} AS temperature_moyenne, 'batch' AS source
FROM orders_parsed
WHERE temperature IS NOT NULL AND "City" IS NOT NULL AND "Country" IS NOT NULL AND date IS NOT NULL
GROUP BY "City", "Country", year(date)""",
    "notebook_report": f"""WITH {ORDERS_FAULTY},
v AS (SELECT *, (temperature IS NOT NULL AND "City" IS NOT NULL AND "Country" IS NOT NULL
                 AND date IS NOT NULL) AS ok FROM orders_parsed),
r AS (SELECT count(*) AS rows_before_cleaning, count(CASE WHEN ok THEN 1 END) AS rows_after_cleaning,
             {xmean('CASE WHEN ok THEN temperature END')} AS global_mean_temperature,
             {sround('min(CASE WHEN ok THEN temperature END)', 2)} AS global_min_temperature,
             {sround('max(CASE WHEN ok THEN temperature END)', 2)} AS global_max_temperature,
             count(CASE WHEN ok AND (temperature < 5000.0 OR temperature > 495000.0) THEN 1 END) AS extreme_observations
      FROM v)
SELECT rows_before_cleaning, rows_after_cleaning, rows_before_cleaning - rows_after_cleaning AS rows_removed,
       CAST(7 AS BIGINT) AS columns,
       {pct('rows_before_cleaning - rows_after_cleaning', 'rows_before_cleaning')} AS removal_percentage,
       global_mean_temperature, global_min_temperature, global_max_temperature, extreme_observations,
       CAST(7 AS BIGINT) AS datasets_saved
FROM r""",
    "preaggregate": f"""SELECT l_partkey AS city, l_returnflag AS country, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
  count(*) AS num_records, {xmean('l_extendedprice')} AS avg_temperature, {xmean('l_tax')} AS avg_uncertainty,
  min(l_extendedprice) AS temperature_min, max(l_extendedprice) AS temperature_max FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1, 2, 3, 4""",
    "rollup_incremental": YEARLY.replace("'batch' AS source", "'batch' AS source, count(*) AS n"),
    "rollup_summaries": f"""WITH {ORDERS_CLEAN},
keyed AS (SELECT temperature, unnest([{{'summary': 'country', 'key': country}}, {{'summary': 'year', 'key': CAST(year AS VARCHAR)}},
    {{'summary': 'month', 'key': CAST(month AS VARCHAR)}}, {{'summary': 'decade', 'key': CAST(year // 10 * 10 AS VARCHAR)}},
    {{'summary': 'period', 'key': CASE WHEN year >= 1996 AND year < 1998 THEN '1996-1997' WHEN year >= 1998 AND year < 2000 THEN '1998-1999' WHEN year >= 2000 THEN '2000+' END}}
  ]) AS k FROM oc)
SELECT k.summary AS summary, k.key AS key, {xmean('temperature')} AS avg_temperature, count(*) AS num_records FROM keyed WHERE k.key IS NOT NULL GROUP BY 1, 2
UNION ALL SELECT 'extreme', 'all', {xmean('temperature')}, count(*) FILTER (temperature < 5000 OR temperature > 495000) FROM oc""",
    "stream_windows": f"WITH {RECORDS} SELECT * FROM closed",
    "stream_csv_windows": f"WITH {RECORDS} SELECT * FROM closed",
    "stream_late": f"WITH {RECORDS_NOT_LATE} SELECT * FROM closed",
    "stream_null_time": f"WITH {RECORDS_WITH_TIME} SELECT * FROM closed",
    "stream_restart": f"WITH {RECORDS} SELECT * FROM closed",
    "stream_update_batches": f"WITH {RECORDS} SELECT * FROM win",
    "stream_late_account": f"""SELECT (SELECT count(*) FROM events) AS n_read, count(*) AS groups_dropped, true AS complete
FROM (SELECT DISTINCT date_trunc('minute', ts), event_type FROM events e, {EVENT_RANGE} r WHERE {IS_LATE})""",
    "stream_trigger": f"WITH {RECORDS} SELECT * FROM closed",
    "stream_two_queries": f"""WITH {RECORDS} SELECT window_start, window_end, city, country, nb_mesures, temperature_moyenne,
  window_end <= (SELECT max(ts) FROM events) - INTERVAL 2 MINUTE AS closed, true AS agree FROM win""",
    "stream_lateness": """SELECT count(*) AS n_rows, count(*) FILTER (ts IS NULL) AS no_event_time, true AS several_batches,
  true AS one_clock_per_batch, true AS clock_of_each_batch, true AS spans_the_events FROM events""",
    "stream_unified": STREAM_UNIFIED,
    "stream_update": f"WITH {RECORDS} SELECT * FROM win",
    "unified": f"WITH {UNIFIED} SELECT * FROM u",
    "source_stats": f"""WITH {UNIFIED}
SELECT source, count(*) AS nb_lignes, min(year) AS annee_min, max(year) AS annee_max FROM u GROUP BY source""",
    "source_filter": f"WITH {UNIFIED} SELECT * FROM u WHERE source = 'streaming'",
    "distinct_counts": f"""WITH {UNIFIED}
SELECT count(DISTINCT "City") AS nb_villes, count(DISTINCT "Country") AS nb_pays FROM u""",
    "distinct_sketches": f"""WITH {UNIFIED}
SELECT count(DISTINCT "City") AS nb_villes, count(DISTINCT "Country") AS nb_pays, true AS cities_near, true AS countries_near, true AS merges_agree FROM u""",
    "distinct_sources": f"WITH {UNIFIED} SELECT DISTINCT source FROM u",
    "recent_top5": f"""WITH {UNIFIED}
SELECT "City", "Country", {xmean('temperature_moyenne')} AS temp_moy FROM u WHERE year >= 2000
GROUP BY "City", "Country" ORDER BY temp_moy DESC NULLS LAST, "City", "Country" LIMIT 5""",
    "source_compare": f"""WITH {UNIFIED}
SELECT source, count(*) AS nb_enregistrements, {xmean('temperature_moyenne')} AS temp_moyenne_globale
FROM u GROUP BY source HAVING (SELECT count(DISTINCT source) FROM u) > 1""",
    "source_compare_one": f"""WITH {UNIFIED}
SELECT source, count(*) AS nb_enregistrements, {xmean('temperature_moyenne')} AS temp_moyenne_globale
FROM u WHERE source = 'batch' GROUP BY source HAVING (SELECT count(DISTINCT source) FROM u WHERE source = 'batch') > 1""",
    "source_compare_ref": f"""WITH {UNIFIED}
SELECT source, count(*) AS nb_enregistrements, {xavg('temperature_moyenne')} AS temp_moyenne_globale
FROM u GROUP BY source HAVING (SELECT count(DISTINCT source) FROM u) > 1""",
    "recent_top5_ref": f"""WITH {UNIFIED}
SELECT "City", "Country", {xavg('temperature_moyenne')} AS temp_moy FROM u WHERE year >= 2000
GROUP BY "City", "Country" ORDER BY temp_moy DESC NULLS LAST, "City", "Country" LIMIT 5""",
    "stream_latest_per_key": LATEST_PER_USER,
    "latest_per_key": LATEST_PER_USER,
    "stream_compacted": f"WITH {RECORDS} SELECT * FROM closed",
    "stream_latest_expiring": LATEST_PER_USER,
    "stream_stats_expiring": f"""SELECT event_type, {xmean('value')} AS mean_value, max(value) AS max_value,
       min(value) AS min_value, count(*) AS n FROM events GROUP BY event_type""",
    "stream_stats_per_key": f"""SELECT event_type, {xmean('value')} AS mean_value, max(value) AS max_value,
       min(value) AS min_value, count(*) AS n FROM events GROUP BY event_type""",
    "stats_per_key": f"""SELECT event_type, {xmean('value')} AS mean_value, max(value) AS max_value,
       min(value) AS min_value, count(*) AS n FROM events GROUP BY event_type""",
    "evolution": f"""WITH d AS (
  SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, event_type,
         {xmean('value')} AS mean_value, count(*) AS n
  FROM events GROUP BY date_trunc('day', ts), event_type)
SELECT *, CAST(CAST(mean_value AS DECIMAL(20,2))
               - CAST(lag(mean_value) OVER (PARTITION BY event_type ORDER BY window_start) AS DECIMAL(20,2))
          AS DOUBLE) AS change
FROM d""",
    "rank_by_mean": f"""WITH m AS (SELECT event_type, {xmean('value')} AS mean_value FROM events GROUP BY event_type)
SELECT event_type, mean_value, CAST(rank() OVER (ORDER BY mean_value DESC) AS INTEGER) AS rank FROM m""",
    "json_payload": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "normalise_point": _payload(POINT_FIELDS, POINT_SRC, "point"),
    "normalise_current": _payload(CURRENT_FIELDS, "lineitem", "current"),
    "normalise_main": _payload(MAIN_FIELDS, "lineitem", "main_wind"),
    "normalise_routed": " UNION ALL ".join(
        [
            _payload(POINT_FIELDS, POINT_SRC, "point", "WHERE l_linenumber % 4 = 0"),
            _payload(CURRENT_FIELDS, "lineitem", "current", "WHERE l_linenumber % 4 = 1"),
            _payload(MAIN_FIELDS, "lineitem", "main_wind", "WHERE l_linenumber % 4 = 2"),
        ]
    ),
    "normalise_rejects": "SELECT l_orderkey * 8 + l_linenumber AS record_id, 'unknown' AS vendor, '{}' AS payload "
    "FROM lineitem WHERE l_linenumber % 4 = 3",
    "normalise_point_zero": _payload(POINT_FIELDS, POINT_SRC, "point"),
    "normalise_broken": """SELECT l_orderkey * 8 + l_linenumber AS record_id,
       CASE l_linenumber % 4 WHEN 0 THEN 'point' WHEN 1 THEN 'current' WHEN 2 THEN 'main_wind' ELSE 'unknown' END AS vendor,
       CASE WHEN l_orderkey % 5 = 0 THEN '{"current": {' ELSE '{}' END AS payload
FROM lineitem WHERE l_linenumber % 4 = 3 OR l_orderkey % 5 = 0""",
    "normalise_routed_broken": " UNION ALL ".join(
        [
            _payload(POINT_FIELDS, POINT_SRC, "point", "WHERE l_linenumber % 4 = 0 AND l_orderkey % 5 <> 0"),
            _payload(CURRENT_FIELDS, "lineitem", "current", "WHERE l_linenumber % 4 = 1 AND l_orderkey % 5 <> 0"),
            _payload(MAIN_FIELDS, "lineitem", "main_wind", "WHERE l_linenumber % 4 = 2 AND l_orderkey % 5 <> 0"),
        ]
    ),
    "roundtrip_parquet": f"WITH {ORDERS_CLEAN} SELECT * FROM oc",
    "roundtrip_csv": MEAN_BY_YEAR,
    "roundtrip_json": f"{CITY_MEANS} ORDER BY avg_temperature DESC NULLS LAST, city, country LIMIT 10",
    "roundtrip_extremes": f"{EXTREME_ROWS} ORDER BY temperature DESC",
}
