"""Trip, weather and demand-gap jobs over the ``events`` stand-in."""

from pyspark.sql import functions as F

from tessera.catalog import load, query
from tessera.plans import trips as T
from tessera.plans.demand_gap import demand_gap, excluded_zones

# Shared SQL fragments: the same stand-in mapping and cleaning as the Spark side.
TRIPS_SQL = """
  SELECT event_id AS trip_id, ts AS tpep_pickup_datetime,
         ts + to_microseconds(CAST(round(value * 60000000) AS BIGINT)) AS tpep_dropoff_datetime,
         CASE WHEN event_type <> 'error'
              THEN CAST(floor(CAST(regexp_extract(props, '(\\d+)', 1) AS INT) / 20) + 1 AS DOUBLE) END
           AS passenger_count,
         value AS trip_distance, CAST(user_id AS INT) AS PULocationID, event_type AS service
  FROM events"""
CLEAN_SQL = f"""
  SELECT * FROM (
    SELECT trip_id, tpep_pickup_datetime, tpep_dropoff_datetime,
           CAST(coalesce(passenger_count, 1) AS INT) AS passenger_count,
           trip_distance, PULocationID, service,
           (epoch_us(tpep_dropoff_datetime) // 1000000 - epoch_us(tpep_pickup_datetime) // 1000000) / 60.0
             AS trip_duration_minutes
    FROM ({TRIPS_SQL}) r) c
  WHERE trip_duration_minutes > 0 AND trip_duration_minutes <= 1440
    AND trip_distance > 0 AND trip_distance <= 100
    AND tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL"""


def cleaned(spark, sf):
    return T.clean_trips(T.trips_from_events(load(spark, sf, "events")))


@query("clean_trips", f"SELECT * FROM ({CLEAN_SQL}) t")
def q_clean_trips(spark, sf):
    return cleaned(spark, sf)


@query("retention_audit", f"""
  SELECT count(*) AS raw_count,
         count(*) FILTER (WHERE d > 0 AND d <= 1440 AND trip_distance > 0 AND trip_distance <= 100
                            AND tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL)
           AS kept_count,
         round(count(*) FILTER (WHERE d > 0 AND d <= 1440 AND trip_distance > 0 AND trip_distance <= 100
                            AND tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL)
               / count(*), 6) AS kept_ratio
  FROM (SELECT *, (epoch_us(tpep_dropoff_datetime) // 1000000 - epoch_us(tpep_pickup_datetime) // 1000000) / 60.0 AS d
        FROM ({TRIPS_SQL}) r) x""")
def q_retention_audit(spark, sf):
    out = T.clean_audit(T.trips_from_events(load(spark, sf, "events")))
    return out.withColumn("kept_ratio", F.round("kept_ratio", 6))


@query("trip_metrics", f"""
  SELECT round(avg(trip_duration_minutes), 2) AS avg_trip_duration_minutes,
         round(avg(trip_distance), 2) AS avg_trip_distance_miles, count(*) AS trip_count
  FROM ({CLEAN_SQL}) t""")
def q_trip_metrics(spark, sf):
    return T.trip_metrics(cleaned(spark, sf))


PEAK_SQL = f"""
  WITH h AS (SELECT hour(tpep_pickup_datetime) AS pickup_hour, count(*) AS trip_count
             FROM ({CLEAN_SQL}) t GROUP BY 1),
       best AS (SELECT pickup_hour FROM h ORDER BY trip_count DESC, pickup_hour ASC LIMIT 1)
  SELECT CAST(h.pickup_hour AS INT) AS pickup_hour, h.trip_count,
         h.pickup_hour = (SELECT pickup_hour FROM best) AS is_peak
  FROM h"""


@query("peak_hours", PEAK_SQL)
def q_peak_hours(spark, sf):
    return T.peak_hours(cleaned(spark, sf))


HOURLY_TRIPS_SQL = f"""
  SELECT date_trunc('hour', tpep_pickup_datetime) AS obs_hour, count(*) AS trip_count
  FROM ({CLEAN_SQL}) t GROUP BY 1"""


@query("hourly_counts", f"SELECT * FROM ({HOURLY_TRIPS_SQL}) h")
def q_hourly_counts(spark, sf):
    from tessera.operators.aggregates import hourly_counts
    return hourly_counts(cleaned(spark, sf), T.PICKUP, "obs_hour", "trip_count")


GAP_SQL = f"""
  SELECT service, trip_id, tpep_pickup_datetime,
         CASE WHEN hour(tpep_pickup_datetime) >= 22 OR hour(tpep_pickup_datetime) < 6
              THEN 'night' ELSE 'day' END AS time_bucket
  FROM ({CLEAN_SQL}) t"""


@query("gap_minutes", f"""
  SELECT service, time_bucket, trip_id, tpep_pickup_datetime,
         lag(tpep_pickup_datetime) OVER w AS prev_pickup,
         (epoch_us(tpep_pickup_datetime) // 1000000
          - epoch_us(lag(tpep_pickup_datetime) OVER w) // 1000000) / 60.0 AS gap_minutes
  FROM ({GAP_SQL}) g
  WINDOW w AS (PARTITION BY service, time_bucket ORDER BY tpep_pickup_datetime)""")
def q_gap_minutes(spark, sf):
    # zone = service type: five zones, each a fifth of all rows (the hot-key case)
    t = cleaned(spark, sf).select("service", "trip_id", T.PICKUP)
    from tessera.functions.scalars import day_night
    from tessera.operators.windows import lag_gap
    t = t.withColumn("time_bucket", day_night(T.PICKUP))
    return lag_gap(t, ["service", "time_bucket"], T.PICKUP, out="gap_minutes", prev="prev_pickup")


def demand_gap_sql(zone_expr: str, min_trips: int) -> str:
    return f"""
  WITH g AS (
    SELECT {zone_expr} AS LocationID, time_bucket,
           (epoch_us(tpep_pickup_datetime) // 1000000
            - epoch_us(lag(tpep_pickup_datetime) OVER (PARTITION BY {zone_expr}, time_bucket
                                                       ORDER BY tpep_pickup_datetime)) // 1000000) / 60.0
             AS gap_minutes
    FROM (SELECT *, CASE WHEN hour(tpep_pickup_datetime) >= 22 OR hour(tpep_pickup_datetime) < 6
                         THEN 'night' ELSE 'day' END AS time_bucket FROM ({CLEAN_SQL}) t) x),
  z AS (
    SELECT LocationID,
           count(*) FILTER (WHERE time_bucket = 'day') AS day_trip_count,
           round(quantile_disc(gap_minutes, 0.9) FILTER (WHERE time_bucket = 'day'), 2) AS day_gap_p90_minutes,
           count(*) FILTER (WHERE time_bucket = 'night') AS night_trip_count,
           round(quantile_disc(gap_minutes, 0.9) FILTER (WHERE time_bucket = 'night'), 2) AS night_gap_p90_minutes
    FROM g GROUP BY 1)
  SELECT *, day_trip_count >= {min_trips} AND night_trip_count >= {min_trips} AS has_enough_data,
         CASE WHEN day_trip_count >= {min_trips} AND night_trip_count >= {min_trips}
              THEN round(night_gap_p90_minutes / nullif(day_gap_p90_minutes, 0), 3) END AS night_day_gap_ratio
  FROM z"""


# zone = service type: a handful of hot zones, reference threshold of 500 trips
@query("demand_gap", demand_gap_sql("service", 500))
def q_demand_gap(spark, sf):
    t = cleaned(spark, sf)
    return demand_gap(t, zone="service", min_trips=500)


# zone = user: many small zones, threshold scaled to the stand-in's ~60 trips per zone
@query("demand_gap_zones", demand_gap_sql("PULocationID", 20))
def q_demand_gap_zones(spark, sf):
    return demand_gap(cleaned(spark, sf), zone="PULocationID", min_trips=20)


@query("gap_excluded", f"""
  SELECT count(*) AS zones, count(*) FILTER (WHERE NOT has_enough_data) AS held_back
  FROM ({demand_gap_sql('PULocationID', 20)}) d""")
def q_gap_excluded(spark, sf):
    return excluded_zones(demand_gap(cleaned(spark, sf), zone="PULocationID", min_trips=20))
