"""Spatial join (D17), road suitability (P6), priority score (P7), zone report."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.catalog import load, query
from tessera.catalog.trips import cleaned, demand_gap_sql
from tessera.operators.spatial import within
from tessera.plans import roads as R
from tessera.plans.demand_gap import demand_gap
from tessera.session import checkpoint_dir
from tessera.sources.sinks import write_csv

NX, NY, W, H = 9, 11, 6.0, 10.0
NOTCH = repr(H * 2 / 3)

ROADS_SQL = """
  SELECT l_quantity AS v0x, l_extendedprice / 1000 AS v0y,
         l_quantity + l_discount * 10 AS v1x, l_extendedprice / 1000 + l_tax * 10 AS v1y,
         l_quantity + 1 AS v2x, l_extendedprice / 1000 AS v2y,
         lpad(CASE WHEN l_returnflag = 'R' THEN '3' ELSE '1' END, 2, ' ') AS RW_TYPE,
         CASE WHEN l_linenumber = 7 THEN ' 9' ELSE ' 2' END AS Status,
         rpad(CASE WHEN l_linenumber % 4 = 1 THEN 'T' WHEN l_linenumber % 4 = 2 THEN 'W'
                   WHEN l_linenumber % 4 = 3 THEN 'A' ELSE 'P' END, 2, ' ') AS TrafDir,
         CASE WHEN l_tax = 0 THEN '  ' ELSE lpad(CAST(CAST(l_tax * 100 AS INT) AS VARCHAR), 2, ' ') END
           AS Number_Travel_Lanes,
         l_discount * 300 + 10 AS StreetWidth_Min
  FROM lineitem"""
POINTS_SQL = f"""
  SELECT row_number() OVER () AS pid, *,
         CASE WHEN tot > 0 THEN (0.0 + l1 * (v0x + v1x) / 2 + l2 * (v1x + v2x) / 2) / tot ELSE v0x END AS px,
         CASE WHEN tot > 0 THEN (0.0 + l1 * (v0y + v1y) / 2 + l2 * (v1y + v2y) / 2) / tot ELSE v0y END AS py
  FROM (SELECT *, 0.0 + l1 + l2 AS tot FROM (
          SELECT *, sqrt((v1x - v0x) * (v1x - v0x) + (v1y - v0y) * (v1y - v0y)) AS l1,
                    sqrt((v2x - v1x) * (v2x - v1x) + (v2y - v1y) * (v2y - v1y)) AS l2,
                 TRY_CAST(trim(Number_Travel_Lanes) AS DOUBLE) AS travel_lanes,
                 trim(TrafDir) IN ('W', 'A') AS is_one_way
          FROM ({ROADS_SQL}) r
          WHERE trim(RW_TYPE) = '1' AND trim(Status) = '2' AND trim(TrafDir) IN ('T', 'W', 'A')) a) b"""
ZONES_SQL = f"""
  SELECT CAST(id AS INT) AS LocationID, (id % {NX}) * {W} AS x0, floor(id / {NX}) * {H} AS y0
  FROM (SELECT range AS id FROM range(0, {NX * NY})) g"""
VERTS_SQL = f"""
  SELECT LocationID, k, vx, vy FROM (
    SELECT LocationID, 0 AS k, x0 AS vx, y0 AS vy FROM ({ZONES_SQL}) z UNION ALL
    SELECT LocationID, 1, x0 + {W}, y0 FROM ({ZONES_SQL}) z UNION ALL
    SELECT LocationID, 2, x0 + {W}, y0 + {H} FROM ({ZONES_SQL}) z UNION ALL
    SELECT LocationID, 3, x0 + {W} / 2, y0 + CAST('{NOTCH}' AS DOUBLE) FROM ({ZONES_SQL}) z UNION ALL
    SELECT LocationID, 4, x0, y0 + {H} FROM ({ZONES_SQL}) z) v"""
EDGES_SQL = f"""
  SELECT a.LocationID, a.vx AS ax, a.vy AS ay, b.vx AS bx, b.vy AS by
  FROM ({VERTS_SQL}) a JOIN ({VERTS_SQL}) b ON a.LocationID = b.LocationID AND b.k = (a.k + 4) % 5"""
WITHIN_SQL = f"""
  SELECT p.pid, e.LocationID FROM ({POINTS_SQL}) p
  JOIN ({ZONES_SQL}) z ON p.px BETWEEN z.x0 AND z.x0 + {W} AND p.py BETWEEN z.y0 AND z.y0 + {H}
  JOIN ({EDGES_SQL}) e ON e.LocationID = z.LocationID
  GROUP BY p.pid, e.LocationID
  HAVING sum(CASE WHEN ((e.ay > p.py) <> (e.by > p.py))
                   AND p.px < (e.bx - e.ax) * (p.py - e.ay) / nullif(e.by - e.ay, 0) + e.ax THEN 1 ELSE 0 END) % 2 = 1
     AND NOT bool_or((e.bx - e.ax) * (p.py - e.ay) - (e.by - e.ay) * (p.px - e.ax) = 0
                     AND p.px >= least(e.ax, e.bx) AND p.px <= greatest(e.ax, e.bx)
                     AND p.py >= least(e.ay, e.by) AND p.py <= greatest(e.ay, e.by))"""
ROAD_SQL = f"""
  WITH j AS (SELECT w.LocationID, p.* FROM ({WITHIN_SQL}) w JOIN ({POINTS_SQL}) p ON w.pid = p.pid),
  prof AS (SELECT LocationID, count(*) AS segment_count, count(*) FILTER (WHERE is_one_way) AS one_way_segment_count,
                  avg(StreetWidth_Min) AS avg_street_width_ft, avg(travel_lanes) AS avg_travel_lanes
           FROM j GROUP BY 1)
  SELECT z.LocationID, coalesce(segment_count, 0) AS segment_count,
         round(avg_street_width_ft, 1) AS avg_street_width_ft, round(avg_travel_lanes, 2) AS avg_travel_lanes,
         round(coalesce(one_way_segment_count, 0) / nullif(coalesce(segment_count, 0), 0), 3) AS one_way_ratio,
         coalesce(segment_count, 0) >= 15 AS has_enough_road_data
  FROM ({ZONES_SQL}) z LEFT JOIN prof ON z.LocationID = prof.LocationID"""
LOOKUP_SQL = """
  SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone
  FROM nation JOIN region ON n_regionkey = r_regionkey"""
SCORE_SQL = f"""
  WITH m AS (SELECT d.*, r.segment_count, r.avg_street_width_ft, r.avg_travel_lanes, r.one_way_ratio,
                    r.has_enough_road_data, l.Borough, l.Zone
             FROM ({demand_gap_sql('PULocationID', 20)}) d JOIN ({ROAD_SQL}) r ON d.LocationID = r.LocationID
             LEFT JOIN ({LOOKUP_SQL}) l ON d.LocationID = l.LocationID),
  s AS (SELECT * FROM m WHERE coalesce(has_enough_data, false) AND coalesce(has_enough_road_data, false)),
  z AS (SELECT *, (night_day_gap_ratio - avg(night_day_gap_ratio) OVER ()) / nullif(stddev_pop(night_day_gap_ratio) OVER (), 0) AS demand_gap_z,
               (avg_street_width_ft - avg(avg_street_width_ft) OVER ()) / nullif(stddev_pop(avg_street_width_ft) OVER (), 0) AS width_z,
               (avg_travel_lanes - avg(avg_travel_lanes) OVER ()) / nullif(stddev_pop(avg_travel_lanes) OVER (), 0) AS lanes_z,
               (one_way_ratio - avg(one_way_ratio) OVER ()) / nullif(stddev_pop(one_way_ratio) OVER (), 0) AS one_way_z
        FROM s),
  r AS (SELECT *, 1.0 * width_z + 1.0 * lanes_z - 0.5 * one_way_z AS road_suitability_score FROM z),
  r2 AS (SELECT *, (road_suitability_score - avg(road_suitability_score) OVER ())
                   / nullif(stddev_pop(road_suitability_score) OVER (), 0) AS road_suitability_z FROM r),
  f AS (SELECT *, 1.0 * demand_gap_z + road_suitability_z AS final_priority_score FROM r2)
  SELECT row_number() OVER (ORDER BY final_priority_score DESC NULLS LAST, LocationID) AS priority_rank,
         LocationID, Zone, Borough, round(final_priority_score, 6) AS final_priority_score, night_day_gap_ratio,
         day_trip_count, night_trip_count, avg_street_width_ft, avg_travel_lanes, one_way_ratio,
         round(demand_gap_z, 6) AS demand_gap_z, round(road_suitability_z, 6) AS road_suitability_z
  FROM f"""


def roads(spark, sf):
    return R.roads_from_lineitem(load(spark, sf, "lineitem"))


def zones(spark):
    return R.grid_zones(spark, NX, NY, W, H)


def road_profile(spark, sf):
    return R.road_suitability(roads(spark, sf), zones(spark))


def demand(spark, sf):
    return demand_gap(cleaned(spark, sf), zone="PULocationID", min_trips=20)


def lookup_df(spark, sf):
    return R.zone_lookup_from_nations(load(spark, sf, "nation"), load(spark, sf, "region"))


@query("spatial_within", f"""
  SELECT w.LocationID, p.px, p.py, p.StreetWidth_Min FROM ({WITHIN_SQL}) w JOIN ({POINTS_SQL}) p ON w.pid = p.pid""")
def q_spatial_within(spark, sf):
    r = R.with_centroid(R.drivable(roads(spark, sf)).select("geometry", "StreetWidth_Min"), "geometry")
    pts = r.select("px", "py", "StreetWidth_Min")
    return within(pts, "px", "py", zones(spark), "ring").select("LocationID", "px", "py", "StreetWidth_Min")


@query("road_suitability", ROAD_SQL)
def q_road_suitability(spark, sf):
    return road_profile(spark, sf)


@query("priority_score", SCORE_SQL)
def q_priority_score(spark, sf):
    s = R.priority_score(demand(spark, sf), road_profile(spark, sf), lookup_df(spark, sf))
    return s.withColumns({c: F.round(c, 6) for c in ("final_priority_score", "demand_gap_z", "road_suitability_z")})


@query("score_held_back", f"""
  SELECT count(*) AS zones,
         count(*) FILTER (WHERE NOT (coalesce(has_enough_data, false) AND coalesce(has_enough_road_data, false))) AS held_back,
         count(*) FILTER (WHERE coalesce(has_enough_data, false) AND coalesce(has_enough_road_data, false)) AS ranked
  FROM ({demand_gap_sql('PULocationID', 20)}) d JOIN ({ROAD_SQL}) r ON d.LocationID = r.LocationID""")
def q_score_held_back(spark, sf):
    return R.held_back(demand(spark, sf), road_profile(spark, sf))


@query("zone_compare", f"""
  SELECT * FROM ({SCORE_SQL}) s WHERE LocationID IN (
    SELECT LocationID FROM ({LOOKUP_SQL}) l WHERE Zone IN ('NATION_3', 'NATION_8', 'NATION_20'))""")
def q_zone_compare(spark, sf):
    scores = q_priority_score(spark, sf)
    return R.zone_compare(scores, lookup_df(spark, sf), ["NATION_3", "NATION_8", "NATION_20"])


def score_files(spark, sf):
    """The part files of both jobs and the zone names, each with lines that do not
    fit: zones that are names, not numbers; a road line per region without a zone;
    region names in the place of a zone number."""
    at = f"{checkpoint_dir(spark)}/io/score-{uuid.uuid4().hex}"
    n, r = load(spark, sf, "nation"), load(spark, sf, "region")
    text = demand(spark, sf)
    write_csv(text, f"{at}/demand")
    write_csv(n.select(F.col("n_name").alias("LocationID"), F.col("n_nationkey").alias("day_trip_count"),
                       *[F.lit(None).cast("string").alias(c) for c in text.columns[2:]]), f"{at}/demand", mode="append")
    names = [f.name for f in T.StructType.fromDDL(R.ROAD_FILE).fields]
    write_csv(road_profile(spark, sf).select(*names), f"{at}/road")
    write_csv(r.select(F.lit(None).cast("string").alias("LocationID"), F.col("r_regionkey").alias("segment_count"),
                       *[F.lit(None).cast("string").alias(c) for c in names[2:]]), f"{at}/road", mode="append")
    zone_names = lookup_df(spark, sf)
    write_csv(zone_names, f"{at}/lookup")
    write_csv(r.select(F.col("r_name").alias("LocationID"), F.lit("x").alias("Borough"), F.lit("y, z").alias("Zone")),
              f"{at}/lookup", mode="append")
    return R.score_from_files(spark, f"{at}/demand", f"{at}/road", f"{at}/lookup")


@query("score_from_files", SCORE_SQL)
def q_score_from_files(spark, sf):
    s = score_files(spark, sf)[0]
    return s.withColumns({c: F.round(c, 6) for c in ("final_priority_score", "demand_gap_z", "road_suitability_z")})


@query("score_rejects", """
  SELECT 'demand' AS source, 'bad LocationID' AS reason, n_name || ',' || n_nationkey || ',,,,,' AS line FROM nation
  UNION ALL SELECT 'road', 'no LocationID', ',' || r_regionkey || ',,,,' FROM region
  UNION ALL SELECT 'lookup', 'bad LocationID', r_name || ',x,"y, z"' FROM region""")
def q_score_rejects(spark, sf):
    return score_files(spark, sf)[1]
