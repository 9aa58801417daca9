"""Scalar functions (J), plus single-purpose queries named in the survey's
checklist (E12, E15, E27, D14, I2, I6, J8, J26)."""

import uuid

from pyspark.sql import functions as F

from tessera.catalog import load, query
from tessera.catalog.trips import CLEAN_SQL, GAP_SQL, cleaned
from tessera.functions import scalars as S
from tessera.functions.text import html_unescape
from tessera.operators import aggregates as E
from tessera.operators.changes import create_as, insert_rows
from tessera.operators.joins import join_on_hour
from tessera.session import checkpoint_dir


@query("scalar_string", """
  SELECT p_partkey, lower(p_name) AS lower_name, trim('  ' || p_brand || ' ') AS trimmed,
         split_part(p_brand, '#', 2) AS brand_no, concat_ws('-', p_type, p_brand) AS joined,
         translate(p_brand, '#', '') AS no_hash, regexp_replace(p_name, '[aeiou]', '*', 'g') AS masked,
         array_to_string(regexp_extract_all(p_name, '[a-z]+'), '|') AS words,
         p_type IN ('SMALL', 'PROMO') AS is_small_or_promo
  FROM part""")
def q_scalar_string(spark, sf):
    p = load(spark, sf, "part")
    return p.select(
        "p_partkey", F.lower("p_name").alias("lower_name"),
        F.trim(F.concat(F.lit("  "), "p_brand", F.lit(" "))).alias("trimmed"),
        F.get(F.split("p_brand", "#"), 1).alias("brand_no"),
        F.concat_ws("-", "p_type", "p_brand").alias("joined"),
        S.strip_chars("p_brand", "#").alias("no_hash"),
        F.regexp_replace("p_name", "[aeiou]", "*").alias("masked"),
        F.array_join(F.regexp_extract_all("p_name", F.lit("([a-z]+)"), 1), "|").alias("words"),
        F.col("p_type").isin("SMALL", "PROMO").alias("is_small_or_promo"))


@query("scalar_null", """
  SELECT c_custkey, coalesce(seg, 'UNKNOWN') AS seg_filled, nullif(c_nationkey, 0) AS nation_or_null,
         CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN c_mktsegment END AS marker_cleaned
  FROM (SELECT *, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS seg FROM customer) c
  WHERE c_nationkey IS NOT NULL AND c_mktsegment IS NOT NULL""")
def q_scalar_null(spark, sf):
    c = load(spark, sf, "customer").withColumn("seg", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")))
    c = c.na.drop(subset=["c_nationkey", "c_mktsegment"]).na.fill({"seg": "UNKNOWN"})
    return c.select("c_custkey", F.col("seg").alias("seg_filled"),
                    F.nullif("c_nationkey", F.lit(0)).alias("nation_or_null"),
                    S.marker_to_null("c_mktsegment", ["BUILDING", "MACHINERY"]).alias("marker_cleaned"))


@query("scalar_date", """
  SELECT event_id, TRY_CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS parsed,
         TRY_CAST('not a time' AS TIMESTAMP) AS bad,
         CAST(hour(ts) AS INT) AS hour, date_trunc('hour', ts) AS hour_start,
         strftime(ts, '%Y-%m-%d-%H-%M-%S') AS formatted,
         (epoch_us(ts + INTERVAL 90 MINUTE) // 1000000 - epoch_us(ts) // 1000000) / 60.0 AS minutes
  FROM events""")
def q_scalar_date(spark, sf):
    e = load(spark, sf, "events")
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return e.select(
        "event_id", F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz").alias("parsed"),
        F.try_to_timestamp(F.lit("not a time")).cast("timestamp_ntz").alias("bad"),
        F.hour("ts").alias("hour"), S.hour_start("ts").alias("hour_start"),
        F.date_format("ts", "yyyy-MM-dd-HH-mm-ss").alias("formatted"),
        S.minutes_between(F.col("ts"), F.col("ts") + F.expr("INTERVAL 90 MINUTES")).alias("minutes"))


@query("scalar_math", """
  SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) + l_tax AS arith,
         l_quantity / nullif(l_tax, 0) AS safe_div, round(l_extendedprice / 7, 2) AS rounded,
         CASE WHEN regexp_matches(trim(CAST(l_quantity AS VARCHAR)), '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$')
              THEN TRY_CAST(trim(CAST(l_quantity AS VARCHAR)) AS DOUBLE) END AS parsed
  FROM lineitem""")
def q_scalar_math(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) + F.col("l_tax")).alias("arith"),
        S.safe_ratio("l_quantity", "l_tax").alias("safe_div"),
        F.round(F.col("l_extendedprice") / 7, 2).alias("rounded"),
        S.tolerant_number(F.col("l_quantity").cast("string")).alias("parsed"))


@query("day_night", """
  SELECT CASE WHEN hour(ts) >= 22 OR hour(ts) < 6 THEN 'night' ELSE 'day' END AS bucket, count(*) AS n
  FROM events GROUP BY 1""")
def q_day_night(spark, sf):
    e = load(spark, sf, "events")
    return e.groupBy(S.day_night("ts").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("html_unescape", """
  SELECT page_id, replace(replace(replace(replace(replace(regexp_extract(html, '<title>(.*?)</title>', 1),
           '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS title
  FROM pages""")
def q_html_unescape(spark, sf):
    p = load(spark, sf, "pages")
    return p.select("page_id", html_unescape(F.regexp_extract("html", "<title>(.*?)</title>", 1)).alias("title"))


@query("insert_select", """
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
  UNION ALL SELECT l_orderkey + 10000000, NULL, 'N', l_extendedprice, NULL, NULL FROM lineitem WHERE l_quantity = 50""")
def q_insert_select(spark, sf):
    new = load(spark, sf, "lineitem").filter(F.col("l_quantity") == 50).select(
        (F.col("l_orderkey") + 10000000).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"),
        F.col("l_extendedprice").alias("o_totalprice"))
    return insert_rows(load(spark, sf, "orders"), new)


@query("create_as", """
  SELECT o.o_orderkey, c.c_name, o.o_totalprice FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE o.o_orderstatus = 'F'""")
def q_create_as(spark, sf):
    o, c = load(spark, sf, "orders"), load(spark, sf, "customer")
    q = o.filter(F.col("o_orderstatus") == "F").join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", "c_name", "o_totalprice")
    name = f"orders_f_{uuid.uuid4().hex[:12]}"
    return create_as(q, name, path=f"{checkpoint_dir(spark)}/tables/{name}")


@query("hourly_profile", f"""
  SELECT CAST(hour(tpep_pickup_datetime) AS INT) AS pickup_hour, count(*) AS trip_count
  FROM ({CLEAN_SQL}) t GROUP BY 1""")
def q_hourly_profile(spark, sf):
    return E.hourly_profile(cleaned(spark, sf), "tpep_pickup_datetime")


@query("gap_p90", f"""
  SELECT service, time_bucket, quantile_disc(gap_minutes, 0.9) AS p90 FROM (
    SELECT service, time_bucket,
           (epoch_us(tpep_pickup_datetime) // 1000000
            - epoch_us(lag(tpep_pickup_datetime) OVER (PARTITION BY service, time_bucket
                                                       ORDER BY tpep_pickup_datetime)) // 1000000) / 60.0 AS gap_minutes
    FROM ({GAP_SQL}) g) x GROUP BY 1, 2""")
def q_gap_p90(spark, sf):
    from tessera.catalog.trips import q_gap_minutes
    return E.percentile_by(q_gap_minutes(spark, sf), ["service", "time_bucket"], "gap_minutes", 0.9, "p90")


@query("join_hourly", """
  SELECT v.obs_hour, v.views, c.others FROM
    (SELECT date_trunc('hour', ts) AS obs_hour, count(*) AS views FROM events WHERE event_type = 'view' GROUP BY 1) v
  JOIN (SELECT date_trunc('hour', ts) AS obs_hour, count(*) AS others FROM events WHERE event_type <> 'view' GROUP BY 1) c
  ON v.obs_hour = c.obs_hour""")
def q_join_hourly(spark, sf):
    e = load(spark, sf, "events")
    views = E.hourly_counts(e.filter(F.col("event_type") == "view"), "ts", "h", "views")
    others = E.hourly_counts(e.filter(F.col("event_type") != "view"), "ts", "h", "others")
    return join_on_hour(views, "h", others, "h").select("obs_hour", "views", "others")


@query("zone_profile", """
  SELECT l_suppkey, count(*) AS segment_count, count(*) FILTER (WHERE l_returnflag = 'R') AS flagged,
         round(avg(l_discount), 9) AS avg_discount, round(avg(l_quantity), 9) AS avg_quantity
  FROM lineitem GROUP BY 1""")
def q_zone_profile(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("segment_count"), F.count_if(F.col("l_returnflag") == "R").alias("flagged"),
        F.round(F.avg("l_discount"), 9).alias("avg_discount"), F.round(F.avg("l_quantity"), 9).alias("avg_quantity"))
