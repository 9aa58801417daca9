"""Weather vs demand - hourly trips joined to hourly weather, correlation and t-test."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalars import hour_start, integer_temperature, precipitation
from tessera.operators.aggregates import hourly_counts
from tessera.functions.stats import t_pvalue


def weather_from_events(events: DataFrame) -> DataFrame:
    """Stand-in weather CSV rows (all strings, like the raw file), one per event:
    report type, temperature and precipitation text with the
    file's markers ('*', blank, 'T', trailing 's')."""
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    temp = (F.floor(F.col("value") / 5) - 10).cast("int").cast("string")
    precip = F.concat(F.lit("0."), F.lpad((F.floor(F.col("value")).cast("int") % 100).cast("string"), 2, "0"))
    return events.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("DATE"),
        F.when(k % 10 == 1, "SOD").when(k % 10 == 2, "FM-16").when(k % 10 == 3, "SOM")
         .otherwise("FM-15").alias("REPORT_TYPE"),
        F.when(k % 7 == 0, "*").when(k % 11 == 0, "").otherwise(temp).alias("HourlyDryBulbTemperature"),
        F.when(k % 5 == 0, "T").when(k % 13 == 0, "").when(k % 3 == 0, F.concat(precip, F.lit("s")))
         .otherwise(precip).alias("HourlyPrecipitation"))


def hourly_weather(raw: DataFrame, blank_as_zero: bool = False) -> DataFrame:
    """Hourly (FM-15) observations, markers cleaned, averaged/summed per hour;
    a row whose DATE is no timestamp is dropped."""
    obs = raw.filter(F.col("REPORT_TYPE").contains("FM-15")).select(
        integer_temperature("HourlyDryBulbTemperature").alias("temperature_f"),
        precipitation("HourlyPrecipitation", blank_as_zero).alias("precipitation_in"),
        hour_start(F.col("DATE").try_cast("timestamp_ntz")).alias("obs_hour")).filter(F.col("obs_hour").isNotNull())
    return obs.groupBy("obs_hour").agg(F.avg("temperature_f").alias("temperature_f"),
                                       F.sum("precipitation_in").alias("precipitation_in"))


def weather_joined(trips: DataFrame, weather_raw: DataFrame, ts: str = "tpep_pickup_datetime") -> DataFrame:
    """Trips per calendar hour inner-joined with hourly weather."""
    return hourly_counts(trips, ts, "obs_hour", "trip_count").join(hourly_weather(weather_raw), "obs_hour")


def complete(joined: DataFrame) -> DataFrame:
    return joined.select("trip_count", "temperature_f", "precipitation_in").na.drop()


def weather_stats(joined: DataFrame, with_p: bool = True) -> DataFrame:
    """One row: temperature and precipitation correlation with trips, and the
    rainy vs dry Welch test, on hours with complete data - all from a single
    aggregate pass; t, dof and p are expressions over that one row."""
    c = complete(joined)
    trips = F.col("trip_count").cast("double")
    rainy = F.col("precipitation_in") > 0
    dry = F.col("precipitation_in") == 0
    a = c.agg(F.count(F.lit(1)).alias("hours"),
              F.corr("temperature_f", trips).alias("temp_corr"),
              F.corr("precipitation_in", trips).alias("precip_corr"),
              F.avg(F.when(rainy, trips)).alias("rainy_hours_avg_trips"),
              F.count(F.when(rainy, trips)).alias("rainy_hours"),
              F.var_samp(F.when(rainy, trips)).alias("_v1"),
              F.avg(F.when(dry, trips)).alias("dry_hours_avg_trips"),
              F.count(F.when(dry, trips)).alias("dry_hours"),
              F.var_samp(F.when(dry, trips)).alias("_v2"))
    s1 = F.col("_v1") / F.col("rainy_hours")
    s2 = F.col("_v2") / F.col("dry_hours")
    out = a.withColumns({
        "ttest_statistic": F.try_divide(F.col("rainy_hours_avg_trips") - F.col("dry_hours_avg_trips"),
                                        F.sqrt(s1 + s2)),
        "ttest_dof": F.try_divide((s1 + s2) * (s1 + s2),
                                  s1 * s1 / (F.col("rainy_hours") - 1) + s2 * s2 / (F.col("dry_hours") - 1))})
    if with_p:
        n2 = (F.col("hours") - 2).cast("double")

        def r_t(r):
            return F.col(r) * F.sqrt(F.try_divide(n2, 1 - F.col(r) * F.col(r)))

        out = out.withColumns({"temp_pvalue": t_pvalue(r_t("temp_corr"), n2),
                               "precip_pvalue": t_pvalue(r_t("precip_corr"), n2),
                               "ttest_pvalue": t_pvalue(F.col("ttest_statistic"), F.col("ttest_dof"))})
    return out.drop("_v1", "_v2")
