"""Statistics and the weather job."""

from pyspark.sql import functions as F

from tessera.catalog import load, query
from tessera.catalog.trips import HOURLY_TRIPS_SQL, cleaned
from tessera.operators.stats import pearson, welch
from tessera.plans import weather as WX

WEATHER_RAW_SQL = """
  SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') AS DATE,
         CASE WHEN k % 10 = 1 THEN 'SOD' WHEN k % 10 = 2 THEN 'FM-16' WHEN k % 10 = 3 THEN 'SOM'
              ELSE 'FM-15' END AS REPORT_TYPE,
         CASE WHEN k % 7 = 0 THEN '*' WHEN k % 11 = 0 THEN ''
              ELSE CAST(CAST(floor(value / 5) - 10 AS INT) AS VARCHAR) END AS HourlyDryBulbTemperature,
         CASE WHEN k % 5 = 0 THEN 'T' WHEN k % 13 = 0 THEN ''
              WHEN k % 3 = 0 THEN '0.' || lpad(CAST(CAST(floor(value) AS INT) % 100 AS VARCHAR), 2, '0') || 's'
              ELSE '0.' || lpad(CAST(CAST(floor(value) AS INT) % 100 AS VARCHAR), 2, '0') END AS HourlyPrecipitation
  FROM (SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS INT) AS k FROM events) e"""
HOURLY_WEATHER_SQL = f"""
  SELECT obs_hour, avg(temperature_f) AS temperature_f, sum(precipitation_in) AS precipitation_in FROM (
    SELECT CASE WHEN regexp_matches(HourlyDryBulbTemperature, '^-?\\d+$')
                THEN TRY_CAST(HourlyDryBulbTemperature AS DOUBLE) END AS temperature_f,
           CASE WHEN HourlyPrecipitation IN ('T', '') THEN 0.0
                ELSE TRY_CAST(regexp_replace(HourlyPrecipitation, 's$', '') AS DOUBLE) END AS precipitation_in,
           date_trunc('hour', strptime(DATE, '%Y-%m-%dT%H:%M:%S')) AS obs_hour
    FROM ({WEATHER_RAW_SQL}) r WHERE contains(REPORT_TYPE, 'FM-15')) o
  GROUP BY obs_hour"""
JOINED_SQL = f"""
  SELECT h.obs_hour, h.trip_count, w.temperature_f, w.precipitation_in
  FROM ({HOURLY_TRIPS_SQL}) h JOIN ({HOURLY_WEATHER_SQL}) w ON h.obs_hour = w.obs_hour"""


def weather_raw(spark, sf):
    return WX.weather_from_events(load(spark, sf, "events"))


def joined(spark, sf):
    return WX.weather_joined(cleaned(spark, sf), weather_raw(spark, sf))


@query("weather_raw", f"SELECT * FROM ({WEATHER_RAW_SQL}) r")
def q_weather_raw(spark, sf):
    return weather_raw(spark, sf)


@query("hourly_weather", f"""
  SELECT obs_hour, round(temperature_f, 9) AS temperature_f, round(precipitation_in, 9) AS precipitation_in
  FROM ({HOURLY_WEATHER_SQL}) w""")
def q_hourly_weather(spark, sf):
    w = WX.hourly_weather(weather_raw(spark, sf))
    return w.select("obs_hour", F.round("temperature_f", 9).alias("temperature_f"),
                    F.round("precipitation_in", 9).alias("precipitation_in"))


@query("value_profile_reports", f"""
  SELECT REPORT_TYPE, count(*) AS n FROM ({WEATHER_RAW_SQL}) r
  WHERE NOT coalesce(regexp_matches(REPORT_TYPE, '^FM-15$'), false) GROUP BY 1""")
def q_value_profile_reports(spark, sf):
    from tessera.operators.aggregates import value_profile
    return value_profile(weather_raw(spark, sf), "REPORT_TYPE", "^FM-15$")


@query("weather_joined", f"""
  SELECT obs_hour, trip_count, round(temperature_f, 9) AS temperature_f,
         round(precipitation_in, 9) AS precipitation_in FROM ({JOINED_SQL}) j""")
def q_weather_joined(spark, sf):
    j = joined(spark, sf)
    return j.select("obs_hour", "trip_count", F.round("temperature_f", 9).alias("temperature_f"),
                    F.round("precipitation_in", 9).alias("precipitation_in"))


@query("weather_stats", f"""
  WITH c AS (SELECT * FROM ({JOINED_SQL}) j
             WHERE trip_count IS NOT NULL AND temperature_f IS NOT NULL AND precipitation_in IS NOT NULL),
  a AS (SELECT count(*) AS hours, corr(temperature_f, trip_count) AS temp_corr,
               corr(precipitation_in, trip_count) AS precip_corr,
               avg(trip_count) FILTER (WHERE precipitation_in > 0) AS m1,
               var_samp(trip_count) FILTER (WHERE precipitation_in > 0) AS v1,
               count(trip_count) FILTER (WHERE precipitation_in > 0) AS n1,
               avg(trip_count) FILTER (WHERE precipitation_in = 0) AS m2,
               var_samp(trip_count) FILTER (WHERE precipitation_in = 0) AS v2,
               count(trip_count) FILTER (WHERE precipitation_in = 0) AS n2 FROM c)
  SELECT hours, round(temp_corr, 9) AS temp_corr, round(precip_corr, 9) AS precip_corr,
         round(m1, 9) AS rainy_hours_avg_trips, n1 AS rainy_hours,
         round(m2, 9) AS dry_hours_avg_trips, n2 AS dry_hours,
         round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), 9) AS ttest_statistic,
         round((v1 / n1 + v2 / n2) ^ 2 / ((v1 / n1) ^ 2 / (n1 - 1) + (v2 / n2) ^ 2 / (n2 - 1)), 6) AS ttest_dof
  FROM a""")
def q_weather_stats(spark, sf):
    s = WX.weather_stats(joined(spark, sf), with_p=False)
    r9 = ["temp_corr", "precip_corr", "rainy_hours_avg_trips", "dry_hours_avg_trips", "ttest_statistic"]
    return s.withColumns({c: F.round(c, 9) for c in r9}).withColumn("ttest_dof", F.round("ttest_dof", 6))


def t_tail_sql(source: str, tests) -> str:
    """DuckDB SQL for ``k, p`` of a relation: the two-sided Student-t tail of each
    (key, t, degrees of freedom) by the continued fraction of the incomplete beta,
    one recursion step per pair of its terms."""
    rows = " UNION ALL ".join(f"SELECT {k} AS k, ({t})::DOUBLE AS t, ({dof})::DOUBLE AS dof FROM {source}" for k, t, dof in tests)
    return f"""
  (WITH RECURSIVE s AS (SELECT k, dof / 2 AS a, dof / (dof + t * t) AS x, t * t / (dof + t * t) AS y FROM ({rows}) r),
  q AS (SELECT k, CASE WHEN flip THEN 0.5::DOUBLE ELSE a END AS a, CASE WHEN flip THEN a ELSE 0.5::DOUBLE END AS b,
               CASE WHEN flip THEN y ELSE x END AS x, CASE WHEN flip THEN x ELSE y END AS y, flip
        FROM (SELECT *, x >= (a + 1) / (a + 2.5) AS flip FROM s) f),
  cf AS (SELECT k, 0 AS m, a, b, x, 1.0::DOUBLE AS c, 1 / (1 - (a + b) * x / (a + 1)) AS d,
                1 / (1 - (a + b) * x / (a + 1)) AS h, 2.0::DOUBLE AS step FROM q
         UNION ALL
         SELECT k, m, a, b, x, c, d, h * half * c * d, c * d
         FROM (SELECT k, m, a, b, x, h, c * d AS half, 1 + odd / c AS c, 1 / (1 + odd * d) AS d
               FROM (SELECT k, m, a, b, x, h, 1 + even / c AS c, 1 / (1 + even * d) AS d,
                            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)) AS odd
                     FROM (SELECT k, m + 1 AS m, a, b, x, c, d, h,
                                  (m + 1) * (b - (m + 1)) * x / ((a - 1 + 2 * (m + 1)) * (a + 2 * (m + 1))) AS even
                           FROM cf WHERE abs(step - 1) > 1e-15 AND m < 5000) u) v) w),
  i AS (SELECT q.k, flip, exp(lgamma(q.a + q.b) - lgamma(q.a) - lgamma(q.b) + q.a * ln(q.x) + q.b * ln(q.y)) * h / q.a AS i
        FROM q JOIN (SELECT k, arg_max(h, m) AS h FROM cf GROUP BY k) e ON e.k = q.k)
  SELECT k, CASE WHEN flip THEN 1 - i ELSE i END AS p FROM i)"""


WEATHER_TESTS_SQL = f"""
  (SELECT *, temp_corr * sqrt((hours - 2) / (1 - temp_corr ^ 2)) AS temp_t, precip_corr * sqrt((hours - 2) / (1 - precip_corr ^ 2)) AS precip_t,
          (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS t,
          (v1 / n1 + v2 / n2) ^ 2 / ((v1 / n1) ^ 2 / (n1 - 1) + (v2 / n2) ^ 2 / (n2 - 1)) AS dof
   FROM (SELECT count(*) AS hours, corr(temperature_f, trip_count) AS temp_corr,
                corr(precipitation_in, trip_count) AS precip_corr,
                avg(trip_count) FILTER (WHERE precipitation_in > 0) AS m1,
                var_samp(trip_count) FILTER (WHERE precipitation_in > 0) AS v1,
                count(trip_count) FILTER (WHERE precipitation_in > 0) AS n1,
                avg(trip_count) FILTER (WHERE precipitation_in = 0) AS m2,
                var_samp(trip_count) FILTER (WHERE precipitation_in = 0) AS v2,
                count(trip_count) FILTER (WHERE precipitation_in = 0) AS n2
         FROM ({JOINED_SQL}) j WHERE trip_count IS NOT NULL AND temperature_f IS NOT NULL AND precipitation_in IS NOT NULL) c) w"""
WEATHER_TAILS_SQL = t_tail_sql(WEATHER_TESTS_SQL, [("'temp'", "temp_t", "hours - 2"), ("'precip'", "precip_t", "hours - 2"), ("'rain'", "t", "dof")])


@query("weather_pvalues", f"""
  SELECT hours, round(temp_corr, 9) AS temp_corr, round(precip_corr, 9) AS precip_corr,
         round(m1, 9) AS rainy_hours_avg_trips, n1 AS rainy_hours, round(m2, 9) AS dry_hours_avg_trips, n2 AS dry_hours,
         round(t, 9) AS ttest_statistic, round(dof, 6) AS ttest_dof, round(p1.p, 9) AS temp_pvalue,
         round(p2.p, 9) AS precip_pvalue, round(p3.p, 9) AS ttest_pvalue
  FROM {WEATHER_TESTS_SQL}
  LEFT JOIN {WEATHER_TAILS_SQL} p1 ON p1.k = 'temp'
  LEFT JOIN {WEATHER_TAILS_SQL} p2 ON p2.k = 'precip'
  LEFT JOIN {WEATHER_TAILS_SQL} p3 ON p3.k = 'rain'""")
def q_weather_pvalues(spark, sf):
    s = WX.weather_stats(joined(spark, sf), with_p=True)
    return s.withColumns({c: F.round(c, 6 if c == "ttest_dof" else 9) for c, kind in s.dtypes if kind == "double"})


@query("pearson", """
  SELECT c_mktsegment, count(*) AS n, round(corr(c_acctbal, c_nationkey), 9) AS r FROM customer GROUP BY 1""")
def q_pearson(spark, sf):
    p = pearson(load(spark, sf, "customer"), "c_acctbal", "c_nationkey", keys="c_mktsegment", with_p=False)
    return p.select("c_mktsegment", "n", F.round("r", 9).alias("r"))


PEARSON_TESTS_SQL = """
  (SELECT *, r * sqrt((n - 2) / (1 - r ^ 2)) AS t FROM (
     SELECT l_returnflag, count(*) AS n, corr(l_extendedprice, l_quantity) AS r FROM lineitem
     WHERE l_extendedprice IS NOT NULL AND l_quantity IS NOT NULL GROUP BY 1) c) w"""


@query("pearson_p", f"""
  SELECT l_returnflag, n, round(r, 9) AS r, round(t, 6) AS t, round(p, 9) AS p
  FROM {PEARSON_TESTS_SQL} LEFT JOIN {t_tail_sql(PEARSON_TESTS_SQL, [("l_returnflag", "t", "n - 2")])} p ON k = l_returnflag""")
def q_pearson_p(spark, sf):
    p = pearson(load(spark, sf, "lineitem"), "l_extendedprice", "l_quantity", keys="l_returnflag")
    return p.withColumns({"r": F.round("r", 9), "t": F.round("t", 6), "p": F.round("p", 9)})


@query("welch_t", """
  WITH a AS (SELECT o_orderpriority,
               avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS m1,
               var_samp(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS v1,
               count(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS n1,
               avg(o_totalprice) FILTER (WHERE o_orderstatus <> 'F') AS m2,
               var_samp(o_totalprice) FILTER (WHERE o_orderstatus <> 'F') AS v2,
               count(o_totalprice) FILTER (WHERE o_orderstatus <> 'F') AS n2 FROM orders GROUP BY 1)
  SELECT o_orderpriority, n1 AS n_true, n2 AS n_false,
         round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), 9) AS t,
         round((v1 / n1 + v2 / n2) ^ 2 / ((v1 / n1) ^ 2 / (n1 - 1) + (v2 / n2) ^ 2 / (n2 - 1)), 6) AS dof
  FROM a""")
def q_welch_t(spark, sf):
    w = welch(load(spark, sf, "orders"), F.col("o_orderstatus") == "F", "o_totalprice", keys="o_orderpriority",
              with_p=False)
    return w.select("o_orderpriority", "n_true", "n_false", F.round("t", 9).alias("t"),
                    F.round("dof", 6).alias("dof"))


WELCH_TESTS_SQL = """
  (SELECT *, (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS t,
          (v1 / n1 + v2 / n2) ^ 2 / ((v1 / n1) ^ 2 / (n1 - 1) + (v2 / n2) ^ 2 / (n2 - 1)) AS dof
   FROM (SELECT o_orderpriority,
               avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS m1,
               var_samp(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS v1,
               count(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS n1,
               avg(o_totalprice) FILTER (WHERE o_orderstatus <> 'F') AS m2,
               var_samp(o_totalprice) FILTER (WHERE o_orderstatus <> 'F') AS v2,
               count(o_totalprice) FILTER (WHERE o_orderstatus <> 'F') AS n2 FROM orders GROUP BY 1) a) w"""


@query("welch_p", f"""
  SELECT o_orderpriority, n1 AS n_true, round(m1, 6) AS mean_true, round(v1, 2) AS var_true, n2 AS n_false,
         round(m2, 6) AS mean_false, round(v2, 2) AS var_false, round(t, 9) AS t, round(dof, 6) AS dof, round(p, 9) AS p
  FROM {WELCH_TESTS_SQL} LEFT JOIN {t_tail_sql(WELCH_TESTS_SQL, [("o_orderpriority", "t", "dof")])} p ON k = o_orderpriority""")
def q_welch_p(spark, sf):
    w = welch(load(spark, sf, "orders"), F.col("o_orderstatus") == "F", "o_totalprice", keys="o_orderpriority")
    digits = {"mean_true": 6, "mean_false": 6, "var_true": 2, "var_false": 2, "t": 9, "dof": 6, "p": 9}
    return w.withColumns({c: F.round(c, n) for c, n in digits.items()})
