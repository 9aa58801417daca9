"""P6 road suitability by zone, P7 service priority score, P15 zone report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.geometry import polyline_centroid
from tessera.functions.scalars import safe_ratio
from tessera.operators.joins import dense, lookup
from tessera.operators.spatial import within
from tessera.operators.ranges import desc
from tessera.operators.windows import global_rank, zscore
from tessera.session import cut_lineage
from tessera.sources.files import read_lookup, read_parts

# fixed values of the jobs: smallest sample of a zone, weights of the score
MIN_ROAD_SEGMENTS = 15
WEIGHTS = {"demand_gap": 1.0, "width": 1.0, "lanes": 1.0, "one_way": 0.5}


def roads_from_lineitem(li: DataFrame) -> DataFrame:
    """Stand-in road centre lines from ``lineitem``: a 3-vertex polyline per row
    and the fixed-width attribute text of the road file."""
    x0, y0 = F.col("l_quantity"), F.col("l_extendedprice") / 1000
    pt = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    line = F.array(pt(x0, y0), pt(x0 + F.col("l_discount") * 10, y0 + F.col("l_tax") * 10), pt(x0 + 1, y0))
    return li.select(
        F.col("l_orderkey").alias("segment_id"), F.col("l_linenumber").alias("segment_part"),
        line.alias("geometry"),
        F.lpad(F.when(F.col("l_returnflag") == "R", "3").otherwise("1"), 2, " ").alias("RW_TYPE"),
        F.when(F.col("l_linenumber") == 7, " 9").otherwise(" 2").alias("Status"),
        F.rpad(F.when(F.col("l_linenumber") % 4 == 1, "T").when(F.col("l_linenumber") % 4 == 2, "W")
               .when(F.col("l_linenumber") % 4 == 3, "A").otherwise("P"), 2, " ").alias("TrafDir"),
        F.when(F.col("l_tax") == 0, F.lit("  "))
         .otherwise(F.lpad((F.col("l_tax") * 100).cast("int").cast("string"), 2, " ")).alias("Number_Travel_Lanes"),
        (F.col("l_discount") * 300 + 10).alias("StreetWidth_Min"))


def _centroid_batches(batches, geom, xname, yname):
    import numpy as np
    import pyarrow as pa

    from tessera.functions.geometry_arrow import polyline_centroid_np
    for b in batches:
        cx, cy = polyline_centroid_np(b.column(geom))
        yield (b.append_column(xname, pa.array(cx, mask=np.isnan(cx)))
                .append_column(yname, pa.array(cy, mask=np.isnan(cy))))


def with_centroid(df: DataFrame, geom: str, xname: str = "px", yname: str = "py",
                  vectorized: bool = True) -> DataFrame:
    """Add the polyline centroid (vectorised over Arrow batches by default)."""
    if not vectorized:
        c = polyline_centroid(F.col(geom))
        return df.withColumn(xname, c["x"]).withColumn(yname, c["y"])
    from pyspark.sql import types as T
    schema = T.StructType(df.schema.fields + [T.StructField(xname, T.DoubleType()),
                                              T.StructField(yname, T.DoubleType())])
    return df.mapInArrow(lambda it: _centroid_batches(it, geom, xname, yname), schema)


def grid_zones(spark: SparkSession, nx: int = 9, ny: int = 11, w: float = 6.0, h: float = 10.0) -> DataFrame:
    """Zone layer built by rule: an nx x ny grid of concave pentagons (each cell
    with a notch cut into its top edge), ids 0..nx*ny-1."""
    i = F.col("id") % nx
    j = F.floor(F.col("id") / nx)
    x0, y0 = i * w, j * h
    pt = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    ring = F.array(pt(x0, y0), pt(x0 + w, y0), pt(x0 + w, y0 + h), pt(x0 + w / 2, y0 + h * 2 / 3), pt(x0, y0 + h))
    return spark.range(nx * ny).select(F.col("id").cast("int").alias("LocationID"), ring.alias("ring"))


def drivable(roads: DataFrame) -> DataFrame:
    """C17 + B8 + J28: ordinary streets in service with a direction; lanes parsed
    tolerantly; one-way flag."""
    rw, st, td = F.trim("RW_TYPE"), F.trim("Status"), F.trim("TrafDir")
    return (roads.filter((rw == "1") & (st == "2") & td.isin("T", "W", "A"))
            .withColumn("travel_lanes", F.trim("Number_Travel_Lanes").try_cast("double"))
            .withColumn("is_one_way", td.isin("W", "A")))


def road_suitability(roads: DataFrame, zones: DataFrame, min_segments: int = MIN_ROAD_SEGMENTS,
                     cell: float | None = None) -> DataFrame:
    """Segment midpoints joined to zones, profiled per zone, every zone kept."""
    r = with_centroid(drivable(roads).select("geometry", "is_one_way", "StreetWidth_Min", "travel_lanes"),
                      "geometry", "px", "py").drop("geometry")
    pts = r.select("px", "py", "is_one_way", "StreetWidth_Min", "travel_lanes")
    joined = within(pts, "px", "py", zones.select("LocationID", "ring"), "ring", cell)
    prof = joined.groupBy("LocationID").agg(
        F.count(F.lit(1)).alias("segment_count"),
        F.count_if(F.col("is_one_way")).alias("one_way_segment_count"),
        F.avg("StreetWidth_Min").alias("avg_street_width_ft"),
        F.avg("travel_lanes").alias("avg_travel_lanes"))
    all_zones = zones.select("LocationID").distinct()
    out = dense(all_zones, prof, "LocationID", {"segment_count": 0, "one_way_segment_count": 0})
    return (out.withColumn("one_way_ratio", F.round(safe_ratio("one_way_segment_count", "segment_count"), 3))
            .withColumn("avg_street_width_ft", F.round("avg_street_width_ft", 1))
            .withColumn("avg_travel_lanes", F.round("avg_travel_lanes", 2))
            .withColumn("has_enough_road_data", F.col("segment_count") >= min_segments)
            .drop("one_way_segment_count"))


def zone_lookup_from_nations(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Stand-in zone names: LocationID = nation key, Zone = nation, Borough = region."""
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("LocationID"), F.col("r_name").alias("Borough"), F.col("n_name").alias("Zone"))


def priority_score(demand: DataFrame, road: DataFrame, lookup_df: DataFrame, weights: dict = WEIGHTS,
                   materialize: bool = True) -> DataFrame:
    """Zones with both layers, scorable when both have enough data; z-scores
    over the scorable zones, road score, re-standardised, final score and rank."""
    merged = demand.join(road, "LocationID")
    merged = lookup(merged, lookup_df, "LocationID")
    if materialize:
        # zone-level table: small, reused by several scalar subqueries and the
        # ranking; checkpointing it once avoids recomputing both layers each time
        merged = cut_lineage(merged)
    merged = merged.withColumn("has_enough_data", F.coalesce(F.col("has_enough_data"), F.lit(False))
                               & F.coalesce(F.col("has_enough_road_data"), F.lit(False)))
    s = merged.filter("has_enough_data")
    s = zscore(s, ["night_day_gap_ratio", "avg_street_width_ft", "avg_travel_lanes", "one_way_ratio"],
               names={"night_day_gap_ratio": "demand_gap_z", "avg_street_width_ft": "width_z",
                      "avg_travel_lanes": "lanes_z", "one_way_ratio": "one_way_z"})
    s = s.withColumn("road_suitability_score", weights["width"] * F.col("width_z")
                     + weights["lanes"] * F.col("lanes_z") - weights["one_way"] * F.col("one_way_z"))
    s = zscore(s, ["road_suitability_score"], names={"road_suitability_score": "road_suitability_z"})
    s = s.withColumn("final_priority_score", weights["demand_gap"] * F.col("demand_gap_z") + F.col("road_suitability_z"))
    ranked = global_rank(s, [desc("final_priority_score"), "LocationID"], "priority_rank")
    return ranked.select("priority_rank", "LocationID", "Zone", "Borough", "final_priority_score",
                         "night_day_gap_ratio", "day_trip_count", "night_trip_count", "avg_street_width_ft",
                         "avg_travel_lanes", "one_way_ratio", "demand_gap_z", "road_suitability_z")


#: What the score reads of the two jobs' part files and the zone names.
DEMAND_FILE = ("LocationID INT, day_trip_count LONG, day_gap_p90_minutes DOUBLE, night_trip_count LONG, "
               "night_gap_p90_minutes DOUBLE, has_enough_data BOOLEAN, night_day_gap_ratio DOUBLE")
ROAD_FILE = ("LocationID INT, segment_count LONG, avg_street_width_ft DOUBLE, avg_travel_lanes DOUBLE, "
             "one_way_ratio DOUBLE, has_enough_road_data BOOLEAN")
LOOKUP_FILE = "LocationID INT, Borough STRING, Zone STRING"


def score_from_files(spark: SparkSession, demand_dir: str, road_dir: str, lookup_path: str,
                     weights: dict = WEIGHTS) -> tuple[DataFrame, DataFrame]:
    """P7 as a job of its own: the CSV part files that the demand and road jobs left
    (A19) and the zone names (A9) are read under their declared schemas, good rows are
    scored, and the others are listed as ``source, reason, line`` (second frame)."""
    read = {"demand": read_parts(spark, demand_dir, DEMAND_FILE, "LocationID"),
            "road": read_parts(spark, road_dir, ROAD_FILE, "LocationID"),
            "lookup": read_lookup(spark, lookup_path, LOOKUP_FILE, "LocationID")}
    scores = priority_score(read["demand"].good, read["road"].good, read["lookup"].good, weights)
    rejected = [r.bad.select(F.lit(name).alias("source"), "reason", "line") for name, r in read.items()]
    return scores, rejected[0].unionAll(rejected[1]).unionAll(rejected[2])


def held_back(demand: DataFrame, road: DataFrame) -> DataFrame:
    """Zones with both layers, and how many are held back for too little data."""
    m = demand.join(road, "LocationID")
    ok = F.coalesce(F.col("has_enough_data"), F.lit(False)) & F.coalesce(F.col("has_enough_road_data"), F.lit(False))
    return m.agg(F.count(F.lit(1)).alias("zones"), F.count_if(~ok).alias("held_back"),
                 F.count_if(ok).alias("ranked"))


def zone_compare(scores: DataFrame, lookup_df: DataFrame, names) -> DataFrame:
    """The named zones' scores side by side (lookup join + name filter)."""
    named = lookup_df.filter(F.col("Zone").isin(*names)).select("LocationID")
    return scores.join(named, "LocationID", "left_semi")
