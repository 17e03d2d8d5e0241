"""SQL counterpart of every registered query that SQL can express.

The CTEs restate the adapters; each query below them restates one operator.
"""

from __future__ import annotations

_READINGS = """
readings AS (
  SELECT e.event_id, e.user_id, n.n_name AS city, r.r_name AS country,
         CAST(n.n_nationkey AS DOUBLE) AS latitude, CAST(n.n_regionkey AS DOUBLE) AS longitude,
         CASE WHEN e.event_id % 89 <> 0 THEN e.value END AS temperature,
         CASE WHEN e.event_id % 97 <> 0
              THEN CAST(json_extract_string(e.props, '$.k') AS DOUBLE) * 0.5 END AS windspeed,
         CAST(e.event_id % 101 AS DOUBLE) AS humidity,
         CAST(CASE e.event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2
                                WHEN 'signup' THEN 3 WHEN 'view' THEN 4 END AS INTEGER) AS weathercode,
         e.ts AS event_time
  FROM events e
  JOIN customer c ON c.c_custkey = e.user_id
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey
),
classified AS (
  SELECT *,
         CASE WHEN windspeed < 10 THEN 'level_0' WHEN windspeed BETWEEN 10 AND 20 THEN 'level_1'
              WHEN windspeed > 20 THEN 'level_2' ELSE 'unknown' END AS wind_alert_level,
         CASE WHEN temperature < 25 THEN 'level_0' WHEN temperature BETWEEN 25 AND 35 THEN 'level_1'
              WHEN temperature > 35 THEN 'level_2' ELSE 'unknown' END AS heat_alert_level
  FROM readings
),
transformed AS (
  SELECT *, temperature * 9 / 5 + 32 AS temp_f,
         COALESCE(windspeed, 0.0) > 10 AS high_wind_alert
  FROM readings
),
named AS (
  SELECT * REPLACE (CASE WHEN event_id % 83 <> 0 THEN city END AS city,
                    CASE WHEN event_id % 79 = 0 THEN 'Unknown' ELSE country END AS country)
  FROM classified
),
located AS (
  SELECT *, COALESCE(country, 'Unknown') = 'Unknown' OR COALESCE(city, 'Unknown') = 'Unknown' AS nameless
  FROM named
  WHERE wind_alert_level <> 'level_0' OR heat_alert_level <> 'level_0'
),
stored AS (
  SELECT CASE WHEN nameless THEN 'coord_' || CAST(latitude AS VARCHAR) ELSE country END AS country,
         CASE WHEN nameless THEN 'coord_' || CAST(longitude AS VARCHAR) ELSE city END AS city,
         latitude, longitude, event_time, temperature, windspeed,
         wind_alert_level, heat_alert_level, weathercode, humidity
  FROM located
),
nested AS (
  SELECT event_id, latitude, longitude, 'UTC' AS timezone,
         CAST(event_id % 7 * 100 AS DOUBLE) AS elevation,
         event_id % 73 <> 0 AS has_current,
         strftime(event_time, '%Y-%m-%dT%H:%M') AS time,
         temperature, windspeed, weathercode, humidity
  FROM readings
)
"""

_DAILY = """
daily AS (
  SELECT n.n_name AS city, r.r_name AS country, substr(r.r_name, 1, 2) AS country_code,
         CAST(n.n_nationkey AS DOUBLE) AS latitude, CAST(n.n_regionkey AS DOUBLE) AS longitude,
         CAST(o.o_orderdate AS DATE) AS date,
         max(o.o_totalprice) AS temp_max,
         CASE WHEN min(o.o_orderkey) % 53 <> 0 THEN min(o.o_totalprice) END AS temp_min,
         max(c.c_acctbal) AS wind_max,
         CAST(count(*) * 0.5 AS DOUBLE) AS precipitation
  FROM orders o
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey
  GROUP BY n.n_nationkey, n.n_name, r.r_name, n.n_regionkey, o.o_orderdate
),
complete AS (
  SELECT * FROM daily
  WHERE temp_max IS NOT NULL AND temp_min IS NOT NULL AND wind_max IS NOT NULL AND precipitation IS NOT NULL
),
ranked AS (
  SELECT *,
         row_number() OVER (PARTITION BY city, country, country_code, latitude, longitude
                            ORDER BY temp_max DESC, date) AS hot_rank,
         row_number() OVER (PARTITION BY city, country, country_code, latitude, longitude
                            ORDER BY temp_min, date) AS cold_rank,
         row_number() OVER (PARTITION BY city, country, country_code, latitude, longitude
                            ORDER BY wind_max DESC, date) AS wind_rank
  FROM complete
),
records AS (
  SELECT city, country, country_code, latitude, longitude,
         max(temp_max) AS hottest_temp, min(temp_min) AS coldest_temp, max(wind_max) AS strongest_wind,
         max(precipitation) AS max_daily_precipitation,
         round(sum(precipitation), 6) AS total_precipitation,
         max(CASE WHEN hot_rank = 1 THEN date END) AS hottest_day,
         max(CASE WHEN cold_rank = 1 THEN date END) AS coldest_day,
         max(CASE WHEN wind_rank = 1 THEN date END) AS windiest_day
  FROM ranked
  GROUP BY city, country, country_code, latitude, longitude
)
"""

_RIDES = """
rides AS (
  SELECT event_id, user_id AS id, ts AS date,
         CASE WHEN event_type IN ('click', 'view') THEN TRUE
              WHEN event_type <> 'error' THEN FALSE END AS sur_velo_bool
  FROM events
),
lagged AS (
  SELECT *, lag(sur_velo_bool) OVER (PARTITION BY id ORDER BY date, event_id) AS previous FROM rides
),
changed AS (
  SELECT *, CASE WHEN previous IS NULL THEN 0
                 WHEN sur_velo_bool IS DISTINCT FROM previous THEN 1 ELSE 0 END AS changement
  FROM lagged
),
started AS (
  SELECT *, CASE WHEN changement = 1 AND sur_velo_bool THEN 1 ELSE 0 END AS debut_trajet FROM changed
),
numbered AS (
  SELECT event_id, id, date, sur_velo_bool, CAST(changement AS INTEGER) AS changement,
         CAST(debut_trajet AS INTEGER) AS debut_trajet,
         CASE WHEN sur_velo_bool THEN CAST(sum(debut_trajet) OVER (
           PARTITION BY id ORDER BY date RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
         END AS numero_de_trajet
  FROM started
),
trips AS (
  SELECT id, numero_de_trajet, min(date) AS debut_trajet_date, max(date) AS fin_trajet_date,
         (floor(epoch(max(date))) - floor(epoch(min(date)))) / 60 AS duree_trajet_minutes
  FROM numbered
  WHERE sur_velo_bool AND numero_de_trajet IS NOT NULL
  GROUP BY id, numero_de_trajet
)
"""

_CLIMATE = """
climate AS (
  SELECT l_suppkey AS station, l_shipdate AS date,
         CASE WHEN l_orderkey % 101 <> 0 THEN l_quantity END AS temperature,
         l_extendedprice AS precipitation
  FROM lineitem
),
parts AS (
  SELECT *, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
         CAST(day(date) AS INTEGER) AS day, temperature > 30 AS is_hot
  FROM climate
),
stations AS (
  SELECT s.s_suppkey AS station, n.n_name AS country
  FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey
)
"""

_PLACES = """
wanted AS (
  SELECT * FROM (VALUES (0, 'urgent'), (1, 'High'), (2, 'MEDIUM'), (3, 'specified'), (4, 'low')) w(i, word)
),
requests AS (
  SELECT c_custkey AS request_id, 'place ' || CAST(c_custkey AS VARCHAR) AS requested_city,
         CASE WHEN c_custkey % 17 <> 0 THEN word END AS requested_country
  FROM customer JOIN wanted ON i = c_custkey % 5
),
candidates AS (
  SELECT 'place ' || CAST(o_custkey AS VARCHAR) AS requested_city,
         CASE WHEN o_custkey % 17 <> 0 THEN word END AS requested_country,
         o_orderkey AS position, 'order ' || CAST(o_orderkey AS VARCHAR) AS name, o_orderpriority AS country,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS country_code,
         o_totalprice AS latitude, -o_totalprice AS longitude,
         CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey END AS population
  FROM orders JOIN wanted ON i = o_custkey % 5
),
best AS (
  SELECT *, row_number() OVER (
    PARTITION BY requested_city, requested_country
    ORDER BY CASE WHEN contains(lower(country), lower(requested_country)) THEN 0 ELSE 1 END, position) AS pick
  FROM candidates
),
resolved AS (
  SELECT requested_city, requested_country, name AS city, country, COALESCE(country_code, '') AS country_code,
         latitude, longitude, '' AS admin1, COALESCE(population, 0) AS population, '' AS timezone
  FROM best WHERE pick = 1
)
"""

_HISTORY = _DAILY + """,
placed AS (
  SELECT *, row_number() OVER (PARTITION BY city, country, country_code, latitude, longitude ORDER BY date) AS day,
         count(*) OVER (PARTITION BY city, country, country_code, latitude, longitude) AS days
  FROM daily
)
"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


_WINDOW_MEASURES = """
       round(avg(temperature), 6) AS avg_temperature, min(temperature) AS min_temperature,
       max(temperature) AS max_temperature, round(avg(windspeed), 6) AS avg_windspeed,
       min(windspeed) AS min_windspeed, max(windspeed) AS max_windspeed,
       count(*) FILTER (wind_alert_level = 'level_1') AS wind_level1_count,
       count(*) FILTER (wind_alert_level = 'level_2') AS wind_level2_count,
       count(*) FILTER (heat_alert_level = 'level_1') AS heat_level1_count,
       count(*) FILTER (heat_alert_level = 'level_2') AS heat_level2_count,
       count(*) FILTER (wind_alert_level IN ('level_1', 'level_2')) AS total_wind_alerts,
       count(*) FILTER (heat_alert_level IN ('level_1', 'level_2')) AS total_heat_alerts,
       count(*) AS total_measurements, round(avg(humidity), 6) AS avg_humidity,
       count(weathercode) AS weather_reports
"""


def _series(measure: str) -> str:
    return _with(
        _READINGS,
        f"""
        SELECT COALESCE(city, 'Unknown') || ', ' || COALESCE(country, 'Unknown') AS label,
               event_time AS time, {measure} AS value
        FROM named WHERE event_time IS NOT NULL AND {measure} IS NOT NULL""",
    )


_COLDEST = _with(
    _CLIMATE,
    """SELECT year, round(avg(temperature), 6) AS avg_temperature FROM parts
       GROUP BY year ORDER BY avg(temperature), year LIMIT 1""",
)
_BUSIEST = _with(
    _CLIMATE,
    """SELECT station, count(*) AS n_records FROM climate
       GROUP BY station ORDER BY n_records DESC, station LIMIT 1""",
)
_RECORDS = _with(_DAILY, "SELECT * FROM records")

ORACLE: dict[str, str] = {
    "flatten_reading": _with(
        _READINGS,
        """SELECT latitude, longitude, timezone, elevation,
                  CASE WHEN has_current THEN time END AS event_time,
                  CASE WHEN has_current THEN temperature END AS temperature,
                  CASE WHEN has_current THEN windspeed END AS windspeed,
                  CASE WHEN has_current THEN weathercode END AS weathercode,
                  CASE WHEN has_current THEN humidity END AS humidity,
                  CASE WHEN has_current THEN temperature - 1 END AS apparent_temperature,
                  CAST(event_id AS VARCHAR) AS fetched_at
           FROM nested""",
    ),
    "basic_messages": _with(
        _READINGS,
        """SELECT latitude, longitude, timezone, elevation, time AS fetched_at, temperature, windspeed,
                  CAST(weathercode AS DOUBLE) AS weathercode, humidity, temperature - 1 AS apparent_temperature
           FROM nested WHERE has_current""",
    ),
    "incomplete_messages": _with(_READINGS, "SELECT event_id FROM nested WHERE NOT has_current"),
    "classify_alerts": _with(
        _READINGS,
        "SELECT event_id, temperature, windspeed, wind_alert_level, heat_alert_level FROM classified",
    ),
    "classify_alerts_half_open": _with(
        _READINGS,
        """SELECT event_id, temperature, windspeed,
                  CASE WHEN windspeed < 10 THEN 'level_0' WHEN windspeed < 20 THEN 'level_1'
                       ELSE 'level_2' END AS wind_alert_level,
                  CASE WHEN temperature < 25 THEN 'level_0' WHEN temperature < 35 THEN 'level_1'
                       ELSE 'level_2' END AS heat_alert_level
           FROM readings""",
    ),
    "flat_transform": _with(
        _READINGS, "SELECT event_id, round(temp_f, 6) AS temp_f, high_wind_alert FROM transformed"
    ),
    "high_wind_alerts": _with(_READINGS, "SELECT event_id, windspeed FROM transformed WHERE high_wind_alert"),
    "stored_alerts": _with(
        _READINGS,
        """SELECT *, replace(replace(country, ' ', '_'), '/', '_') AS country_path,
                  replace(replace(city, ' ', '_'), '/', '_') AS city_path
           FROM stored""",
    ),
    "alerts_per_city": _with(
        _READINGS, "SELECT country, city, count(*) AS alerts FROM stored GROUP BY country, city"
    ),
    "coordinate_keys": _with(
        _READINGS,
        "SELECT event_id, CAST(latitude AS VARCHAR) || '_' || CAST(longitude AS VARCHAR) AS key FROM readings",
    ),
    "sliding_agg": _with(
        _READINGS,
        f"""
        SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, latitude, longitude,
               {_WINDOW_MEASURES.strip()}
        FROM (SELECT *, time_bucket(INTERVAL 1 MINUTE, event_time) - r.i * INTERVAL 1 MINUTE AS window_start
              FROM classified, range(5) r(i))
        GROUP BY window_start, latitude, longitude""",
    ),
    "tumbling_agg": _with(
        _READINGS,
        """SELECT time_bucket(INTERVAL 1 MINUTE, event_time) AS window_start,
                  time_bucket(INTERVAL 1 MINUTE, event_time) + INTERVAL 1 MINUTE AS window_end,
                  round(avg(temperature), 6) AS avg_temp_c, count(high_wind_alert) AS alert_count,
                  count(*) FILTER (high_wind_alert) AS high_wind_count
           FROM transformed GROUP BY 1, 2""",
    ),
    "alert_level_counts": _with(
        _READINGS,
        """SELECT level,
                  (SELECT count(*) FROM classified WHERE wind_alert_level = level) AS wind_count,
                  (SELECT count(*) FROM classified WHERE heat_alert_level = level) AS heat_count
           FROM (VALUES ('level_0'), ('level_1'), ('level_2')) l(level)""",
    ),
    "top_weathercode_by_country": _with(
        _READINGS,
        """SELECT country, weathercode, n FROM (
             SELECT COALESCE(country, 'Unknown') AS country, weathercode, count(*) AS n,
                    row_number() OVER (PARTITION BY COALESCE(country, 'Unknown')
                                       ORDER BY count(*) DESC, weathercode) AS pick
             FROM named WHERE weathercode IS NOT NULL GROUP BY 1, 2)
           WHERE pick = 1""",
    ),
    "country_counts": _with(
        _READINGS, "SELECT COALESCE(country, 'Unknown') AS country, count(*) AS n FROM named GROUP BY 1"
    ),
    "top_cities": _with(
        _READINGS,
        """SELECT COALESCE(city, 'Unknown') AS city, count(*) AS n FROM named
           GROUP BY 1 ORDER BY n DESC, city LIMIT 10""",
    ),
    "place_totals": _with(
        _READINGS,
        """SELECT count(DISTINCT COALESCE(country, 'Unknown')) AS n_countries,
                  count(DISTINCT COALESCE(city, 'Unknown')) AS n_cities FROM named""",
    ),
    "reading_stats": _with(
        _READINGS,
        """SELECT round(avg(temperature), 1) AS avg_temperature, round(min(temperature), 1) AS min_temperature,
                  round(max(temperature), 1) AS max_temperature, round(avg(windspeed), 1) AS avg_windspeed,
                  round(min(windspeed), 1) AS min_windspeed, round(max(windspeed), 1) AS max_windspeed
           FROM readings""",
    ),
    "temperature_series": _series("temperature"),
    "temperature_arrays": _with(
        _READINGS,
        """SELECT COALESCE(city, 'Unknown') || ', ' || COALESCE(country, 'Unknown') AS label, CAST(event_time AS DATE) AS day,
                  count(*) AS n, string_agg(strftime(event_time, '%H:%M:%S'), ' ' ORDER BY event_time, temperature) AS times,
                  string_agg(CAST(CAST(round(temperature * 100) AS BIGINT) AS VARCHAR), ' ' ORDER BY event_time, temperature) AS "values"
           FROM named WHERE event_time IS NOT NULL AND temperature IS NOT NULL GROUP BY 1, 2""",
    ),
    "wind_series": _series("windspeed"),
    "resolve_city": _with(
        _PLACES,
        """SELECT request_id, resolved.* FROM requests JOIN resolved
           ON requests.requested_city = resolved.requested_city
              AND requests.requested_country IS NOT DISTINCT FROM resolved.requested_country""",
    ),
    "enrich_readings": _with(
        _PLACES,
        """SELECT e.event_id, p.requested_city, p.requested_country,
                  CASE WHEN e.event_id % 89 <> 0 THEN e.value END AS temperature,
                  CASE WHEN e.event_id % 97 <> 0
                       THEN CAST(json_extract_string(e.props, '$.k') AS DOUBLE) * 0.5 END AS windspeed,
                  p.city, p.country, p.country_code, p.admin1 AS region, p.population
           FROM events e JOIN resolved p ON p.requested_city = 'place ' || CAST(e.user_id AS VARCHAR)""",
    ),
    "json_round_trip": """
        SELECT CASE WHEN event_id % 71 <> 0 THEN event_id END AS event_id,
               CASE WHEN event_id % 71 <> 0 THEN event_type END AS event_type,
               CASE WHEN event_id % 71 <> 0 THEN value END AS value,
               CASE WHEN event_id % 71 <> 0 THEN props END AS props,
               CASE WHEN event_id % 71 = 0 THEN '{"event_id": ' END AS reject
        FROM events""",
    "classified_messages": _with(
        _READINGS,
        """SELECT CAST(event_id AS VARCHAR) AS latitude, temperature, wind AS windspeed,
                  CASE WHEN wind < 10 THEN 'level_0' WHEN wind < 20 THEN 'level_1' ELSE 'level_2' END AS wind_alert_level,
                  CASE WHEN temperature < 25 THEN 'level_0' WHEN temperature < 35 THEN 'level_1'
                       ELSE 'level_2' END AS heat_alert_level
           FROM (SELECT *, CASE WHEN event_id % 67 <> 0 THEN windspeed END AS wind FROM readings)
           WHERE event_id % 71 <> 0""",
    ),
    "dead_letters": """
        SELECT '{"latitude": ' || CAST(event_id AS VARCHAR) AS value FROM events WHERE event_id % 71 = 0""",
    "encoded_messages": _with(
        _READINGS,
        """SELECT CAST(event_id AS VARCHAR) AS latitude, round(temp_f, 6) AS temp_f,
                  CASE WHEN event_id % 67 <> 0 THEN high_wind_alert ELSE FALSE END AS high_wind_alert
           FROM transformed WHERE event_id % 71 <> 0""",
    ),
    "topic_tail_rows": """
        SELECT event_id AS "offset", CAST(user_id AS VARCHAR) AS key, CAST(json(props) AS VARCHAR) AS value
        FROM events""",
    "explode_history": _with(
        _HISTORY,
        """SELECT city, country, country_code, latitude, longitude, date, temp_max, temp_min, wind_max,
                  CASE WHEN day <= days - 3 THEN precipitation END AS precipitation
           FROM placed""",
    ),
    "history_days": _with(
        _DAILY,
        "SELECT city, country, CAST(count(*) AS INTEGER) AS days FROM daily GROUP BY city, country",
    ),
    "history_message_fields": _with(
        _DAILY,
        """SELECT country_code || '_' || city AS key, city, country, '' AS region, latitude, 'UTC' AS timezone,
                  string_agg(CAST(date AS VARCHAR), ',' ORDER BY date) AS days,
                  round(sum(temp_max), 2) AS max_total,
                  CAST(greatest(count(*) - 3, 0) AS INTEGER) AS precipitation_days
           FROM daily GROUP BY city, country, country_code, latitude""",
    ),
    "recent_daily": _with(
        _DAILY,
        "SELECT * FROM daily WHERE date BETWEEN DATE '2001-12-31' - 1095 AND DATE '2001-12-31'",
    ),
    "climate_records": _RECORDS,
    "records_join_form": _RECORDS,
    "record_documents": _with(
        _DAILY,
        """SELECT city, country_code, CAST(hottest_day AS VARCHAR) AS hottest_date, hottest_temp AS hottest,
                  CAST(coldest_day AS VARCHAR) AS coldest_date, coldest_temp AS coldest,
                  CAST(windiest_day AS VARCHAR) AS windiest_date, strongest_wind AS windiest,
                  max_daily_precipitation AS max_daily, total_precipitation AS total_period
           FROM records""",
    ),
    "record_messages": _with(
        _DAILY,
        """SELECT country_code || '_' || city AS key, CAST(hottest_day AS VARCHAR) AS hottest_date,
                  hottest_temp AS hottest, CAST(coldest_day AS VARCHAR) AS coldest_date, coldest_temp AS coldest,
                  CAST(windiest_day AS VARCHAR) AS windiest_date, strongest_wind AS windiest,
                  max_daily_precipitation AS max_daily, CAST(NULL AS VARCHAR) AS total_period
           FROM records""",
    ),
    "first_day_per_city": _with(
        _DAILY,
        """SELECT city, date, temp_max FROM (
             SELECT *, row_number() OVER (PARTITION BY city ORDER BY date) AS pick FROM daily)
           WHERE pick = 1""",
    ),
    "trip_numbers": _with(_RIDES, "SELECT * FROM numbered"),
    "trip_durations": _with(
        _RIDES, "SELECT * REPLACE (round(duree_trajet_minutes, 6) AS duree_trajet_minutes) FROM trips"
    ),
    "riding_totals": _with(
        _RIDES,
        "SELECT id, round(sum(duree_trajet_minutes), 6) AS duree_trajet_minutes FROM trips GROUP BY id",
    ),
    "trips_of_id": _with(
        _RIDES,
        """SELECT * REPLACE (round(duree_trajet_minutes, 6) AS duree_trajet_minutes)
           FROM trips WHERE id = (SELECT min(id) FROM trips)""",
    ),
    "distinct_ids_approximate": "SELECT count(DISTINCT user_id) AS nb_ids_uniques, TRUE AS within_error FROM events",
    "distinct_ids": "SELECT count(DISTINCT user_id) AS nb_ids_uniques FROM events",
    "ordered_rides": _with(_RIDES, "SELECT * FROM rides"),
    "first_rides": _with(_RIDES, "SELECT * FROM rides ORDER BY id, date, event_id LIMIT 10"),
    "row_count": "SELECT count(*) AS n_rows FROM events",
    "column_mean": "SELECT round(avg(value), 6) AS mean_value FROM events",
    "group_means": """
        SELECT c_mktsegment, round(avg(c_acctbal), 6) AS mean_c_acctbal,
               round(avg(c_nationkey), 6) AS mean_c_nationkey, max(c_acctbal) AS max_c_acctbal
        FROM customer GROUP BY c_mktsegment""",
    "describe_col": """
        SELECT 'count' AS summary, round(CAST(count(c_acctbal) AS DOUBLE), 4) AS c_acctbal FROM customer
        UNION ALL SELECT 'mean', round(avg(c_acctbal), 4) FROM customer
        UNION ALL SELECT 'stddev', round(stddev_samp(c_acctbal), 4) FROM customer
        UNION ALL SELECT 'min', round(min(c_acctbal), 4) FROM customer
        UNION ALL SELECT 'max', round(max(c_acctbal), 4) FROM customer""",
    "summary_count_max": """
        WITH t AS (SELECT c_custkey, c_name, n_name, c_mktsegment
                   FROM customer JOIN nation ON n_nationkey = c_nationkey)
        SELECT 'count' AS summary, CAST(count(c_custkey) AS VARCHAR) AS c_custkey,
               CAST(count(c_name) AS VARCHAR) AS c_name, CAST(count(n_name) AS VARCHAR) AS n_name,
               CAST(count(c_mktsegment) AS VARCHAR) AS c_mktsegment FROM t
        UNION ALL
        SELECT 'max', CAST(max(c_custkey) AS VARCHAR), max(c_name), max(n_name), max(c_mktsegment) FROM t""",
    "quantiles": """
        SELECT CAST(0 AS DOUBLE) AS relative_error, CAST(p AS DOUBLE) AS probability,
               (SELECT value FROM (SELECT value, row_number() OVER (ORDER BY value) AS rn FROM events)
                WHERE rn = CAST(ceil(p * (SELECT count(value) FROM events)) AS BIGINT)) AS quantile
        FROM (VALUES (0.25), (0.5), (0.75)) q(p)""",
    "quantiles_approximate": """
        SELECT CAST(e AS DOUBLE) AS relative_error, CAST(p AS DOUBLE) AS probability, TRUE AS within_error
        FROM (VALUES (0.25), (0.5), (0.75)) q(p), (VALUES (0.05), (0.01)) r(e)""",
    "summary_all": "UNION ALL".join(
        f"""
        SELECT '{name}' AS summary, round(CAST({form.format(c='c_custkey')} AS DOUBLE), 4) AS c_custkey,
               {text.format(c='c_name')} AS c_name, round(CAST({form.format(c='c_nationkey')} AS DOUBLE), 4) AS c_nationkey,
               round(CAST({form.format(c='c_acctbal')} AS DOUBLE), 4) AS c_acctbal, {text.format(c='c_mktsegment')} AS c_mktsegment
        FROM customer """
        for name, form, text in (
            ("count", "count({c})", "CAST(count({c}) AS VARCHAR)"), ("mean", "avg({c})", "NULL"),
            ("stddev", "stddev_samp({c})", "NULL"), ("min", "min({c})", "min({c})"),
            ("25%", "quantile_disc({c}, 0.25)", "NULL"), ("50%", "quantile_disc({c}, 0.5)", "NULL"),
            ("75%", "quantile_disc({c}, 0.75)", "NULL"), ("max", "max({c})", "max({c})"),
        )
    ),
    "sample_1pct": """
        SELECT event_id, event_type, value FROM events
        WHERE CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 6) AS BIGINT) % 100 < 1""",
    "schema_rows": """
        SELECT column_name AS name,
               CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END AS type,
               "null" = 'YES' AS nullable
        FROM (DESCRIBE customer)""",
    "quantiles_of_merged_sketches": """
        SELECT CAST(0.01 AS DOUBLE) AS relative_error, CAST(p AS DOUBLE) AS probability, TRUE AS within_error
        FROM (VALUES (0.25), (0.5), (0.75)) q(p)""",
    "corr_cov": """
        SELECT round(corr(value, user_id), 6) AS corr, round(covar_samp(value, user_id), 6) AS covar_samp
        FROM events""",
    "filter_category": "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'",
    "concat_cols": _with(
        _RIDES,
        """SELECT event_id, CASE WHEN sur_velo_bool IS NOT NULL
                                 THEN CAST(id AS VARCHAR) || CAST(sur_velo_bool AS VARCHAR) END AS id_sur_velo
           FROM rides""",
    ),
    "self_join": """
        SELECT a.c_custkey, a.c_name, a.c_acctbal, b.c_name AS right_c_name, b.c_acctbal AS right_c_acctbal
        FROM customer a JOIN customer b ON a.c_custkey = b.c_custkey""",
    "union_by_name": """
        SELECT c_custkey, c_mktsegment FROM customer
        UNION ALL SELECT c_custkey, c_mktsegment FROM customer""",
    "except_all": """
        SELECT user_id, event_type FROM events
        EXCEPT ALL SELECT user_id, event_type FROM events WHERE value > 50""",
    "missing_by_column": _with(
        _READINGS,
        """SELECT 'city' AS "column", count(*) - count(city) AS missing FROM readings
           UNION ALL SELECT 'temperature', count(*) - count(temperature) FROM readings
           UNION ALL SELECT 'windspeed', count(*) - count(windspeed) FROM readings
           UNION ALL SELECT 'humidity', count(*) - count(humidity) FROM readings""",
    ),
    "clean_count": _with(
        _READINGS,
        "SELECT count(*) AS n_rows FROM readings WHERE temperature IS NOT NULL AND windspeed IS NOT NULL",
    ),
    "parse_times": """
        SELECT o_orderkey, TRY_CAST(o_orderpriority AS TIMESTAMP) AS not_a_time,
               try_strptime(strftime(o_orderdate, '%Y-%m-%dT%H:%M'), '%Y-%m-%dT%H:%M') AS minute_form,
               try_strptime(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%dT%H:%M:%SZ') AS zulu_form,
               try_strptime(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS ride_form
        FROM orders""",
    "default_values": _with(
        _PLACES,
        """SELECT name, COALESCE(country_code, '') AS country_code, COALESCE(population, 0) AS population
           FROM candidates""",
    ),
    "date_parts": _with(
        _CLIMATE, "SELECT year, month, day, is_hot, count(*) AS n FROM parts GROUP BY year, month, day, is_hot"
    ),
    "climate_clean_count": _with(
        _CLIMATE,
        """SELECT count(*) AS n_rows FROM climate
           WHERE date IS NOT NULL AND station IS NOT NULL AND temperature IS NOT NULL""",
    ),
    "first_parsed_days": _with(
        _CLIMATE,
        """SELECT date, station, temperature, precipitation, year FROM parts
           ORDER BY date NULLS FIRST, station NULLS FIRST, temperature NULLS FIRST, precipitation NULLS FIRST
           LIMIT 5""",
    ),
    "years_stations": _with(
        _CLIMATE,
        "SELECT count(DISTINCT year) AS n_years, count(DISTINCT station) AS n_stations FROM parts",
    ),
    "stations_of_periods": _with(
        _CLIMATE,
        """SELECT CAST(year // 3 * 3 AS INTEGER) AS first_year, count(DISTINCT station) AS n_stations, TRUE AS within_error
           FROM parts GROUP BY 1""",
    ),
    "hot_day_total": _with(_CLIMATE, "SELECT count(*) FILTER (is_hot) AS hot_days FROM parts"),
    "hot_days_by_year": _with(
        _CLIMATE, "SELECT year, count(*) FILTER (is_hot) AS hot_days FROM parts GROUP BY year"
    ),
    "mean_by_year": _with(
        _CLIMATE, "SELECT year, round(avg(temperature), 6) AS avg_temperature FROM parts GROUP BY year"
    ),
    "mean_one_year": _with(
        _CLIMATE,
        """SELECT CAST(1999 AS INTEGER) AS year, round(avg(temperature), 6) AS avg_temperature
           FROM parts WHERE year = 1999""",
    ),
    "top5_stations": _with(
        _CLIMATE,
        """SELECT station, round(m, 6) AS avg_temperature, country
           FROM (SELECT station, avg(temperature) AS m FROM climate GROUP BY station
                 ORDER BY m DESC, station LIMIT 5) LEFT JOIN stations USING (station)""",
    ),
    "coldest_year": _COLDEST,
    "coldest_year_sql": _COLDEST,
    "busiest_station": _BUSIEST,
    "busiest_station_sql": _BUSIEST,
    "precip_series": _with(
        _CLIMATE,
        """SELECT year, round(sum(precipitation), 2) AS total_precipitation,
                  round(avg(precipitation), 2) AS avg_precipitation FROM parts GROUP BY year""",
    ),
    "precip_trend_world": _with(
        _CLIMATE,
        """SELECT year, round(sum(precipitation), 2) AS total_precipitation,
                  round(avg(precipitation), 2) AS avg_precipitation
           FROM parts WHERE year > (SELECT max(year) FROM parts) - 3 GROUP BY year""",
    ),
    "precip_trend_country": _with(
        _CLIMATE,
        """SELECT country, year, round(sum(precipitation), 2) AS total_precipitation,
                  round(avg(precipitation), 2) AS avg_precipitation
           FROM parts JOIN stations USING (station)
           WHERE country = 'NATION_7' AND year > (SELECT max(year) FROM parts) - 3
           GROUP BY country, year""",
    ),
    "precip_slope_world": _with(
        _CLIMATE,
        """SELECT round(regr_slope(total, year), 4) AS slope, round(regr_r2(total, year), 4) AS r2, count(total) AS n_years
           FROM (SELECT year, sum(precipitation) AS total FROM parts GROUP BY year)""",
    ),
    "precip_slope_by_country": _with(
        _CLIMATE,
        """SELECT country, round(regr_slope(total, year), 4) AS slope, round(regr_r2(total, year), 4) AS r2, count(total) AS n_years
           FROM (SELECT country, year, sum(precipitation) AS total FROM parts JOIN stations USING (station) GROUP BY country, year)
           GROUP BY country""",
    ),
    "temp_pct_by_year": _with(
        _CLIMATE,
        """SELECT year, round(avg(temperature), 6) AS avg_temperature,
                  round(100.0 * (avg(temperature) - (SELECT avg(temperature) FROM climate))
                        / (SELECT avg(temperature) FROM climate), 6) AS pct_vs_world
           FROM parts GROUP BY year""",
    ),
    "temp_pct_by_country": _with(
        _CLIMATE,
        """SELECT country, round(avg(temperature), 6) AS avg_temperature,
                  round(100.0 * (avg(temperature) - (SELECT avg(temperature) FROM climate))
                        / (SELECT avg(temperature) FROM climate), 6) AS pct_vs_world
           FROM parts JOIN stations USING (station) GROUP BY country""",
    ),
}
ORACLE["sliding_agg_stream_form"] = ORACLE["sliding_agg"]
