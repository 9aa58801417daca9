"""P5: demand gap by zone - gap between consecutive pickups, day vs night."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalars import day_night, safe_ratio
from tessera.operators.aggregates import percentile_by
from tessera.operators.joins import bucket_pivot
from tessera.operators.windows import lag_gap, lag_gap_sliced

PICKUP = "tpep_pickup_datetime"
MIN_TRIPS_PER_BUCKET = 500


def pickup_gaps(trips: DataFrame, zone: str = "PULocationID", ts: str = PICKUP,
                slice_unit: str | None = None) -> DataFrame:
    """F3 per (zone, day/night bucket). The gap of a bucket's first pickup of a
    night is measured from the previous night's last pickup, as in the source.
    ``slice_unit`` (e.g. ``'day'``) picks the time-sliced window instead of the
    range exchange, for data with a known bound per (zone, slice)."""
    df = trips.select(zone, ts).withColumn("time_bucket", day_night(ts))
    if slice_unit:
        return lag_gap_sliced(df, [zone, "time_bucket"], ts, slice_unit, out="gap_minutes", prev="prev_pickup")
    return lag_gap(df, [zone, "time_bucket"], ts, out="gap_minutes", prev="prev_pickup")


def demand_gap(trips: DataFrame, zone: str = "PULocationID", min_trips: int = MIN_TRIPS_PER_BUCKET,
               p: float = 0.9, exact: bool = True, slice_unit: str | None = None) -> DataFrame:
    """Per zone: trip counts and p90 gap for day and night, sample flag, ratio.
    Percentiles are exact (``percentile_by``; ``exact=False``: the sketch)."""
    gaps = pickup_gaps(trips, zone, slice_unit=slice_unit)
    counts = bucket_pivot(trips.select(zone, day_night(PICKUP).alias("time_bucket")), F.col(zone).alias("LocationID"),
                          "time_bucket", ["day", "night"], {"trip_count": lambda m: F.count_if(m)})
    found = percentile_by(gaps, [zone, "time_bucket"], "gap_minutes", p, "p90", exact, once=True)
    p90 = bucket_pivot(found, F.col(zone).alias("_zone"), "time_bucket", ["day", "night"],
                       {"gap_p90_minutes": lambda m: F.round(F.max(F.when(m, F.col("p90"))), 2)})
    zones = counts.join(p90, F.col("LocationID").eqNullSafe(F.col("_zone")), "left").drop("_zone")
    enough = (F.col("day_trip_count") >= min_trips) & (F.col("night_trip_count") >= min_trips)
    return (zones.withColumn("has_enough_data", enough)
            .withColumn("night_day_gap_ratio",
                        F.when(F.col("has_enough_data"),
                               F.round(safe_ratio("night_gap_p90_minutes", "day_gap_p90_minutes"), 3)))
            .select("LocationID", "day_trip_count", "day_gap_p90_minutes", "night_trip_count",
                    "night_gap_p90_minutes", "has_enough_data", "night_day_gap_ratio"))


def excluded_zones(zones: DataFrame) -> DataFrame:
    """Total zones and zones held back for too few trips."""
    return zones.agg(F.count(F.lit(1)).alias("zones"),
                     F.count_if(~F.col("has_enough_data")).alias("held_back"))
