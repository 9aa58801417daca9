"""Hand-made rows for the semantics the reference pins down (FIXTURES.md §2)."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import scalars as S
from tessera.functions.tdist import t_two_sided_p
from tessera.functions.text import SENTIMENT_TOKEN, WORDCOUNT_TOKEN, tokens
from tessera.operators import joins as D
from tessera.operators import text as L
from tessera.operators import windows as W
from tessera.operators.ranges import asc, desc, with_range_id
from tessera.plans import trips as TR
from tessera.plans.demand_gap import demand_gap
from tessera.plans.weather import hourly_weather


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_trip_guard_edges(spark):
    base = ts("2024-01-01 10:00:00")
    rows = [  # (id, pickup, minutes, distance, passengers)
        (1, base, 0.0, 1.0, 1.0), (2, base, -5.0, 1.0, 1.0), (3, base, 24 * 60 + 1, 1.0, 1.0),
        (4, base, 24 * 60, 1.0, 1.0), (5, base, 10.0, 0.0, 1.0), (6, base, 10.0, 100.0, 1.0),
        (7, base, 10.0, 100.01, 1.0), (8, base, 10.0, 312722.0, 1.0), (9, base, 10.0, 2.0, None),
        (10, None, 10.0, 2.0, 1.0), (11, base, 10.0, None, 1.0)]
    df = spark.createDataFrame(
        [(i, p, (p + dt.timedelta(minutes=m)) if p else None, n, d) for i, p, m, d, n in rows],
        "trip_id int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
        "passenger_count double, trip_distance double")
    kept = {r.trip_id: r.passenger_count for r in TR.clean_trips(df).collect()}
    assert kept == {4: 1, 6: 1, 9: 1}     # exactly 24 h and exactly 100 mi are kept; null passengers -> 1


def test_peak_tie_earlier_hour_wins(spark):
    rows = [(ts("2024-01-01 07:10:00"),)] * 3 + [(ts("2024-01-01 09:10:00"),)] * 3 + [(ts("2024-01-01 08:00:00"),)]
    df = spark.createDataFrame(rows, "tpep_pickup_datetime timestamp_ntz")
    peaks = [r.pickup_hour for r in TR.peak_hours(df).filter("is_peak").collect()]
    assert peaks == [7]


def test_weather_markers(spark):
    raw = spark.createDataFrame([
        ("2024-01-01T10:05:00", "FM-15", "50", "0.05"), ("2024-01-01T10:40:00", "FM-15", "-3", "0.05s"),
        ("2024-01-01T11:00:00", "FM-15", "*", "T"), ("2024-01-01T12:00:00", "FM-15", None, None),
        ("2024-01-01T12:00:00", "FM-16", "99", "9.0"), ("2024-01-01T13:00:00", "SOD", "99", "9.0"),
        ("2024-01-01T14:00:00", "SOM", "99", "9.0")],
        "DATE string, REPORT_TYPE string, HourlyDryBulbTemperature string, HourlyPrecipitation string")
    got = {r.obs_hour.hour: (r.temperature_f, r.precipitation_in) for r in hourly_weather(raw).collect()}
    assert got[10] == (23.5, pytest.approx(0.1))
    assert got[11] == (None, 0.0)
    assert got[12] == (None, None)          # blank precipitation stays missing by default
    assert set(got) == {10, 11, 12}


def test_demand_gap_buckets_and_flags(spark):
    day = [ts(f"2024-01-01 {h}") for h in ("05:59:00", "06:00:00", "21:59:00", "22:00:00")]
    rows = [(1, t) for t in day] + [(2, ts("2024-01-01 10:00:00")), (2, ts("2024-01-01 10:00:00")),
                                    (3, ts("2024-01-01 23:00:00"))]
    df = spark.createDataFrame(rows, "PULocationID int, tpep_pickup_datetime timestamp_ntz")
    out = {r.LocationID: r for r in demand_gap(df, min_trips=2).collect()}
    assert (out[1].day_trip_count, out[1].night_trip_count) == (2, 2)
    assert out[1].day_gap_p90_minutes == pytest.approx(959.0)       # 06:00 -> 21:59
    assert out[1].night_gap_p90_minutes == pytest.approx(961.0)     # 05:59 -> 22:00 (same bucket)
    assert out[1].has_enough_data and out[1].night_day_gap_ratio == pytest.approx(round(961 / 959, 3))
    assert out[2].day_gap_p90_minutes == 0.0 and not out[2].has_enough_data   # equal pickup times, day only
    assert out[3].day_trip_count == 0 and out[3].night_day_gap_ratio is None   # night only


def test_lag_gap_across_slices_equals_plain_lag(spark):
    rows = [(k, ts("2024-01-01 00:00:00") + dt.timedelta(minutes=37 * i + 5 * k)) for k in (1, 2) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz")
    split = W.lag_gap_sliced(df, ["k"], "t", "hour").select("k", "t", "prev_ts")
    from pyspark.sql import Window
    plain = df.withColumn("prev_ts", F.lag("t").over(Window.partitionBy("k").orderBy("t")))
    assert sorted(split.collect()) == sorted(plain.collect())


def _plain_lag(df, keys, t):
    from pyspark.sql import Window
    return df.withColumn("prev_ts", F.lag(t).over(Window.partitionBy(*keys).orderBy(t)))


def _key(r):
    return tuple((x is None, x) for x in r)


@pytest.mark.parametrize("parts", [1, 3, 16, 64])
def test_lag_gap_range_equals_plain_lag(spark, parts):
    # one hot key (a third of the rows spread over many partitions), a null key,
    # repeated timestamps, null timestamps, keys with a single row
    base = ts("2024-01-01 00:00:00")
    rows = [(1, "a", base + dt.timedelta(seconds=7 * i)) for i in range(600)]
    rows += [(k, "b", base + dt.timedelta(minutes=(k * 13 + i * 29) % 500)) for k in range(2, 40) for i in range(30)]
    rows += [(None, "b", base + dt.timedelta(minutes=i)) for i in range(20)]
    rows += [(5, "b", base), (5, "b", base), (7, "c", None), (7, "c", None), (7, "c", base), (99, None, base)]
    df = spark.createDataFrame(rows, "k int, s string, t timestamp_ntz")
    got = W.lag_gap(df, ["k", "s"], "t", partitions=parts).select("k", "s", "t", "prev_ts", "gap_minutes")
    want = _plain_lag(df, ["k", "s"], "t").withColumn(
        "gap_minutes", (F.unix_timestamp("t") - F.unix_timestamp("prev_ts")) / 60.0)
    assert sorted(got.collect(), key=_key) == sorted(want.collect(), key=_key)


def test_lag_gap_range_across_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        base = ts("2024-03-01 00:00:00")
        rows = [(i % 3, base + dt.timedelta(minutes=i * 11 % 997)) for i in range(400)]
        df = spark.createDataFrame(rows, "k int, t timestamp")
        got = W.lag_gap(df, "k", "t", partitions=4).select("k", "t", "prev_ts")
        assert sorted(got.collect(), key=_key) == sorted(_plain_lag(df, ["k"], "t").collect(), key=_key)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_tokens_unicode_and_apostrophes(spark):
    df = spark.createDataFrame([("Don't don’t UPPER Émile 42 snake_case ½",)], "text string")
    wc = df.select(tokens("text", WORDCOUNT_TOKEN).alias("t")).first().t
    assert wc == ["don't", "don’t", "upper", "émile", "42", "snake_case", "½"]
    st = df.select(tokens("text", SENTIMENT_TOKEN).alias("t")).first().t
    assert st[:3] == ["don't", "don", "t"]


def test_sentiment_rules(spark):
    df = spark.createDataFrame([("good good bad",), ("bad sad good",), ("good bad",), ("",), ("nothing",)], "text string")
    got = [r.sentiment for r in L.sentiment(df, "text").collect()]
    assert got == ["positive", "negative", "neutral", "neutral", "neutral"]


def test_clean_text_keeps_order_and_duplicates(spark):
    df = spark.createDataFrame([("I &amp; you LOVE love the café!! 2 lol",)], "text string")
    out = L.clean_text(df, "text", ["the", "lol"]).first().text
    assert out == "i you love love caf"


def test_number_parse_rules(spark):
    vals = ["4.0", " 4.0 ", "4.0d", "1_0", "abc", "nan", "inf", "", "-2.5e1", ".5"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r.x for r in df.select(S.tolerant_number("v").alias("x")).collect()]
    assert got == [4.0, 4.0, None, None, None, None, None, None, -25.0, 0.5]


def test_kv_lines_skip_bad_lines(spark):
    from tessera.sources.files import kv_from_lines
    lines = spark.createDataFrame([("userId,movieId,rating,timestamp",), ("1,10,4.0,1",), ("1,10",), ("2,10,abc,1",),
                                   ("3,10,4.0d,1",), ("4,10,1_0,1",), ("5,11, 3.5 ,1",), ("6,11,2.5,1",)], "value string")
    kv = kv_from_lines(lines, 1, 2)
    got = {r.key: r.mean for r in kv.groupBy("key").agg(F.round(F.avg("value"), 1).alias("mean")).collect()}
    assert got == {"10": 4.0, "11": 3.0}


def test_round_half_up(spark):
    df = spark.createDataFrame([(0.25,), (0.35,), (2.5,)], "x double")
    assert [r.r for r in df.select(F.round("x", 1).alias("r")).collect()] == [0.3, 0.4, 2.5]


def test_safe_ratio_and_zscore_constant(spark):
    df = spark.createDataFrame([(1, 0.0, 5.0), (2, 2.0, 5.0)], "id int, a double, c double")
    assert [r.q for r in df.select(S.safe_ratio("c", "a").alias("q")).orderBy("id").collect()] == [None, 2.5]
    z = W.zscore(df, ["c"]).orderBy("id").collect()
    assert [r.c_z for r in z] == [None, None]


def test_not_in_with_null_and_all_on_empty(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    nulls = spark.createDataFrame([(1,), (None,)], "k2 int")
    empty = spark.createDataFrame([], "k2 int")
    assert D.not_in(left, "k", nulls, "k2").count() == 0
    assert D.not_in(left, "k", empty, "k2").count() == 3
    assert D.all_of(left, "k", "=", empty, "k2").count() == 3
    some = spark.createDataFrame([(1,), (1,)], "k2 int")
    assert [r.k for r in D.all_of(left, "k", "=", some, "k2").collect()] == [1]
    assert D.any_of(left, "k", ">", some, "k2").count() == 1


def test_topn_tie_rules(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 2, 9.0), ("a", 3, 9.0), ("a", 4, 1.0)], "g string, id int, v double")
    assert W.topn(df, "g", [F.col("v").desc()], 2, "rank").count() == 3
    assert W.topn(df, "g", [F.col("v").desc(), "id"], 2, "row").count() == 2


def test_global_rank_is_a_permutation(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("v"), "id")
    r = W.global_rank(df, [desc("v"), "id"], "rank", partitions=7)
    got = sorted((row.rank, row.v) for row in r.collect())
    assert [x for x, _ in got] == list(range(1, 5001))
    assert [v for _, v in got] == sorted((v for _, v in got), reverse=True)


def test_t_tail_against_jvm(spark):
    # independent implementation: the JVM's commons-math Student-t
    td = spark._jvm.org.apache.commons.math3.distribution.TDistribution
    for t, d in [(2.0, 10.0), (-2.5, 30.0), (0.5, 3.0), (10.0, 4366.0), (-0.143, 200.5), (3.3, 1.5)]:
        want = 2 * td(d).cumulativeProbability(-abs(t))
        assert t_two_sided_p(t, d) == pytest.approx(want, rel=1e-9, abs=1e-300)
    assert t_two_sided_p(0.0, 5.0) == pytest.approx(1.0)


def test_polygons(spark):
    from tessera.functions.geometry import strictly_within
    from tessera.operators.spatial import within
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    concave = [(10.0, 0.0), (16.0, 0.0), (16.0, 6.0), (13.0, 2.0), (10.0, 6.0)]   # notch from the top
    zones = spark.createDataFrame([(1, [Row(x=x, y=y) for x, y in square]),
                                   (2, [Row(x=x, y=y) for x, y in concave]),
                                   (3, [Row(x=x, y=y) for x, y in [(30.0, 30.0), (31.0, 30.0), (30.0, 31.0)]])],
                                  "zid int, ring array<struct<x:double,y:double>>")
    pts = spark.createDataFrame([(1, 2.0, 2.0), (2, 5.0, 2.0), (3, 4.0, 2.0), (4, 4.0, 4.0), (5, 13.0, 4.0),
                                 (6, 11.0, 1.0), (7, 15.5, 5.0), (8, 13.0, 2.0), (9, None, 1.0)],
                                "pid int, x double, y double")
    for cell in (None, 2.0, 0.7, 100.0):
        got = sorted((r.pid, r.zid) for r in within(pts, "x", "y", zones, "ring", cell).collect())
        # inside square; outside; on edge; on vertex; in the notch; inside concave arms; notch vertex; null point
        assert got == [(1, 1), (6, 2), (7, 2)]
    pairs = pts.crossJoin(zones).filter(strictly_within(F.col("x"), F.col("y"), F.col("ring")))
    assert sorted((r.pid, r.zid) for r in pairs.collect()) == got


def plainly_within(px, py, ring):
    inside = False
    for (ax, ay), (bx, by) in zip(ring, ring[-1:] + ring[:-1]):
        if ((bx - ax) * (py - ay) - (by - ay) * (px - ax) == 0 and min(ax, bx) <= px <= max(ax, bx)
                and min(ay, by) <= py <= max(ay, by)):
            return False
        if (ay > py) != (by > py) and px < (bx - ax) * (py - ay) / (by - ay) + ax:
            inside = not inside
    return inside


def test_within_equals_the_plain_rule(spark):
    """Random rings of many shapes (stars, self-crossing, closed, on the grid's own
    lines, far from the origin), points among them, on vertices and on edges."""
    import math
    import random

    from tessera.operators.spatial import within
    rng = random.Random(7)
    rings = []
    for z in range(40):
        cx, cy = rng.uniform(-40, 40), rng.uniform(-40, 40)
        n = rng.randint(3, 40)
        if z % 4 == 0:      # whole coordinates: vertices on cell borders, horizontal and vertical edges
            ring = [(float(round(cx) + rng.randint(-9, 9)), float(round(cy) + rng.randint(-9, 9))) for _ in range(n)]
        elif z % 4 == 1:    # a star
            ring = [(cx + r * math.cos(2 * math.pi * k / n), cy + r * math.sin(2 * math.pi * k / n))
                    for k in range(n) for r in [rng.uniform(1, 15)]]
        elif z % 4 == 2:    # crosses itself, closing vertex given
            ring = [(cx + rng.uniform(-20, 20), cy + rng.uniform(-20, 20)) for _ in range(n)]
            ring.append(ring[0])
        else:               # thin
            ring = [(cx - 30, cy), (cx + 30, cy + 1e-7), (cx + 30, cy + 0.5), (cx - 30, cy + rng.uniform(0.1, 1))]
        rings.append(ring)
    pts = [(rng.uniform(-60, 60), rng.uniform(-60, 60)) for _ in range(1500)]
    pts += [(float(rng.randint(-50, 50)), float(rng.randint(-50, 50))) for _ in range(500)]
    pts += [rng.choice(rng.choice(rings)) for _ in range(200)]
    for _ in range(200):
        ring = rng.choice(rings)
        k = rng.randrange(len(ring))
        pts.append(((ring[k][0] + ring[k - 1][0]) / 2, (ring[k][1] + ring[k - 1][1]) / 2))
    for far in (0.0, 1e6):
        shift = lambda p: (p[0] + far, p[1] - far)
        moved, at = [[shift(p) for p in r] for r in rings], [shift(p) for p in pts]
        zones = spark.createDataFrame([(k, [Row(x=x, y=y) for x, y in r]) for k, r in enumerate(moved)],
                                      "zid int, ring array<struct<x:double,y:double>>")
        points = spark.createDataFrame([(k, x, y) for k, (x, y) in enumerate(at)], "pid int, x double, y double")
        want = sorted((p, z) for z, r in enumerate(moved) for p, (x, y) in enumerate(at) if plainly_within(x, y, r))
        assert len(want) > 1000
        for cell in (None, 1.0):
            got = sorted((r.pid, r.zid) for r in within(points, "x", "y", zones, "ring", cell).collect())
            assert got == want


def test_within_odd_rings_and_points(spark):
    from tessera.operators.spatial import within, zone_cells
    nan, inf = float("nan"), float("inf")
    square = [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 9.0)]
    rows = [(1, square), (2, square), (3, []), (4, None), (5, [(0.0, 0.0), (nan, 9.0), (9.0, 0.0)]),
            (6, [(0.0, 0.0), (inf, 9.0), (9.0, 0.0)]), (7, [(1.0, 1.0)])]
    zones = spark.createDataFrame([(z, r if r is None else [Row(x=x, y=y) for x, y in r]) for z, r in rows]
                                  + [(8, [Row(x=0.0, y=0.0), None, Row(x=9.0, y=9.0)])],
                                  "zid int, ring array<struct<x:double,y:double>>")
    pts = spark.createDataFrame([(1, 4.0, 4.0), (1, 4.0, 4.0), (2, nan, 4.0), (3, 4.0, nan), (4, inf, 4.0), (5, -inf, -inf),
                                 (6, None, None), (7, 1e300, 1e300)], "pid int, x double, y double")
    for cell in (None, 1.0):
        got = sorted((r.pid, r.zid) for r in within(pts, "x", "y", zones, "ring", cell).collect())
        assert got == [(1, 1), (1, 1), (1, 2), (1, 2)]      # overlapping zones, repeated rows
    assert within(pts, "x", "y", zones.limit(0)).count() == 0
    assert within(pts.limit(0), "x", "y", zones).count() == 0
    # inner cells hold no edge, cells keep few edges, no ring travels with a point
    cells = zone_cells(zones.filter("zid = 1"), "ring", F.lit(1.0)).collect()
    inner = [c for c in cells if not c["_near"]]
    assert len(inner) >= 49 and all(c["_seed"] == 1 and not c["_steps"] for c in inner)
    assert max(len(c["_near"]) for c in cells) <= 4
    plan = within(pts, "x", "y", zones)._jdf.queryExecution().optimizedPlan().toString()
    joined = plan[:plan.index("Join ")]
    assert "ring#" not in joined and "_slice#" in plan


def test_headerless_csv_edges(spark, tmp_path):
    from tessera.sources.files import read_headerless_csv
    p = tmp_path / "t.csv"
    lines = ['0,"1","d","q","u","a, b ""quoted"""', '4,"2","d","q","u",""', '0,"3","d"', '4,"4","d","q","u","long","extra"',
             '', '0,"5","d","q","u","caf\xe9"']
    p.write_bytes("\n".join(lines).encode("latin-1"))
    schema = T.StructType([T.StructField(n, t) for n, t in [("polarity", T.IntegerType()), ("id", T.LongType()),
                           ("date", T.StringType()), ("query", T.StringType()), ("user", T.StringType()),
                           ("text", T.StringType())]])
    got = {r.id: r.text for r in read_headerless_csv(spark, str(p), schema).collect()}
    assert got == {1: 'a, b "quoted"', 2: "", 4: "long", 5: "café"}


def test_gdp_page_edges(spark):
    from tessera.plans.gdp import extract_gdp
    page = ('<table class="wikitable"><tr><th>Country</th><th>Year</th></tr><tr><td>1</td>'
            '<td><a href="#">Wrong</a></td><td>5</td></tr></table>'
            '<table class="wikitable"><tr><th>Country</th><th>IMF</th><th>x</th></tr>'
            '<tr><td>0</td><td><a href="#">World</a></td><td>100,000</td></tr>'
            '<tr><td>1</td><td><a href="#">Aland</a></td><td>1,234,567</td></tr>'
            '<tr><td>2</td><td><a href="#">Bland</a></td><td>—</td></tr>'
            '<tr><td>3</td><td>Nolink</td><td>77</td></tr>'
            '<tr><td>4</td><td><a href="#">Short</a></td></tr></table>')
    df = spark.createDataFrame([(1, page)], "page_id long, html string")
    got = [(r.Country, r.GDP_USD_millions) for r in extract_gdp(df).collect()]
    assert got == [("Aland", 1234567.0)]


def test_streaming_clean_matches_batch(spark, tmp_path, tiny):
    from tessera.streaming import incremental_clean, stream_files
    ev = spark.read.parquet(f"{tiny}/events.parquet")
    src = str(tmp_path / "src")
    ev.write.parquet(src)
    q = incremental_clean(stream_files(spark, src, ev.schema), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).count()
    assert got == TR.clean_trips(TR.trips_from_events(ev)).count()


def test_checkpoint_dir_respects_session(spark):
    from tessera.session import checkpoint_dir
    d = checkpoint_dir(spark)
    assert d and checkpoint_dir(spark) == d


def test_mixed_files_injection_adds_exactly_500(spark, tmp_path, tiny):
    from tessera.sources.files import read_mixed
    trips = TR.trips_from_events(spark.read.parquet(f"{tiny}/events.parquet"))
    base = str(tmp_path / "trips")
    trips.write.parquet(f"{base}/yellow_tripdata_2024-01.parquet")
    before = read_mixed(spark, base, "yellow_tripdata_*").count()
    extra = trips.limit(500)
    extra.select(*reversed(extra.columns)).write.option("header", True).option(
        "timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(f"{base}/yellow_tripdata_2024-02.csv")
    spark.range(3).write.option("header", True).csv(f"{base}/weather_2024_central_park.csv")
    after = read_mixed(spark, base, "yellow_tripdata_*")
    assert after.count() == before + 500
    assert dict(after.dtypes)["tpep_pickup_datetime"] == "timestamp_ntz"
    # the CSV rows come back with their values, typed by column name
    added = after.exceptAll(spark.read.parquet(f"{base}/yellow_tripdata_2024-01.parquet"))
    assert sorted(map(tuple, added.collect())) == sorted(map(tuple, extra.select(*after.columns).collect()))


def test_any_over_empty_set_is_false(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    empty = spark.createDataFrame([], "k2 int")
    assert D.any_of(left, "k", ">", empty, "k2").count() == 0
    assert D.any_of(left, "k", "=", empty, "k2").count() == 0


def test_gdp_unknown_country_kept(spark):
    from tessera.plans.gdp import transform_gdp
    raw = spark.createDataFrame([("Aland", 2500.0), ("Nowhere", 1234.0)], "Country string, GDP_USD_millions double")
    regions = spark.createDataFrame([("Aland", "Europe")], "Country string, Region string")
    got = {r.Country: (r.Region, r.GDP_USD_billion) for r in transform_gdp(raw, regions).collect()}
    assert got == {"Aland": ("Europe", 2.5), "Nowhere": ("not found", 1.23)}


def test_exact_quantiles_equal_sorted_positions(spark):
    import math

    from tessera.operators.aggregates import exact_quantiles
    rows = [(float(i % 7), float(i) * 0.5 if i % 5 else None, 3.0, None) for i in range(1, 203)]
    rows[0] = (1.0, -4.0, 3.0, None)
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    probs = [0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {(r.column, r.p): r.value for r in exact_quantiles(df, ["a", "b", "c", "d"], probs).collect()}
    for ci, c in enumerate("abcd"):
        vals = sorted(r[ci] for r in rows if r[ci] is not None)
        for p in probs:
            if not vals:
                assert (c, p) not in got
                continue
            k = max(1, math.ceil(p * len(vals)))
            assert got[(c, p)] == vals[k - 1], (c, p)
    one = spark.createDataFrame([(5.0,)], "x double")
    assert {r.p: r.value for r in exact_quantiles(one, ["x"], [0.25, 0.75]).collect()} == {0.25: 5.0, 0.75: 5.0}


def test_sample_n_takes_the_smallest_hashes(spark):
    import hashlib

    from tessera.operators.ordering import sample_n
    rows = [(i, "hot" if i % 3 else ("b" if i % 2 else "c")) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, cls string").repartition(5)
    got = sorted(tuple(r) for r in sample_n(df, "cls", "id", 400, seed=7).collect())
    want = []
    for c in ("hot", "b", "c"):
        want += sorted((r for r in rows if r[1] == c), key=lambda r: (hashlib.md5(f"{r[0]}|7".encode()).hexdigest(), r[0]))[:400]
    assert got == sorted(want)


def test_quantiles_by_group_interpolated_and_with_outliers(spark):
    import numpy as np

    from tessera.operators.aggregates import describe, exact_quantiles, percentile_by
    r = np.random.default_rng(3)
    rows = [(("hot", None, "c")[i % 3], float(x)) for i, x in enumerate(r.normal(size=900))] + [("c", 1e300), ("c", -1e300), ("d", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    got = {(x.g, x.p): x.value for x in exact_quantiles(df, ["v"], [0.1, 0.5, 0.9], keys=["g"], interpolate=True).collect()}
    for g in ("hot", None, "c"):
        for p in (0.1, 0.5, 0.9):
            assert got[(g, p)] == pytest.approx(np.quantile([v for k, v in rows if k == g and v is not None], p), rel=1e-12)
    assert ("d", 0.5) not in got and len(got) == 9
    assert {x.g: x.pct for x in percentile_by(df, "g", "v", 0.5).collect()}["d"] is None
    four = describe(spark.createDataFrame([(1,), (2,), (3,), (4,)], "x int"), ["x"]).first()
    assert (four.p25, four.p50, four.p75) == (1.75, 2.5, 3.25)


def test_lag_gap_range_spreads_one_timestamp_burst(spark):
    # a third of the rows share one (key, ts): they may span partitions and
    # still get the same gaps as a plain lag (0 after the first)
    base = ts("2024-05-01 08:00:00")
    rows = [(1, base, i) for i in range(300)] + [(1, base + dt.timedelta(minutes=i + 1), 1000 + i) for i in range(300)]
    rows += [(2, base + dt.timedelta(minutes=i), 2000 + i) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz, id int")
    got = W.lag_gap(df, "k", "t", partitions=12)
    assert got.columns == ["k", "t", "id", "prev_ts", "gap_minutes"]
    want = _plain_lag(df, ["k"], "t")
    strip = lambda d: sorted(((r.k, r.t, r.prev_ts) for r in d.collect()), key=_key)
    assert strip(got) == strip(want)
    laid = with_range_id(df.withColumn("_tb", F.xxhash64("k", "t", "id")), [asc("k"), asc("t"), asc("_tb")], 12, "r")
    assert laid.filter((F.col("k") == 1) & (F.col("t") == base)).select("r").distinct().count() > 1


@pytest.mark.parametrize("ties", ["rank", "row"])
def test_topn_large_n_equals_plain_window(spark, ties):
    from pyspark.sql import Window
    # one hot group, tied values, groups smaller than n
    rows = [("hot", i % 97, i) for i in range(1500)] + [(f"g{i % 5}", i % 13, 5000 + i) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, v int, id int")
    order = [F.col("v").desc(), F.col("id")] if ties == "row" else [F.col("v").desc()]
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "5")
    try:
        got = W.topn(df, "g", order, 300, ties, partitions=16)
        got_rows = sorted(tuple(r) for r in got.collect())
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    fn = F.rank() if ties == "rank" else F.row_number()
    want = (df.withColumn("rank_in_group", fn.over(Window.partitionBy("g").orderBy(*order)).cast("long"))
            .filter(F.col("rank_in_group") <= 300))
    assert got_rows == sorted(tuple(r) for r in want.collect())


def test_streaming_sentiment_totals_survive_restart(spark, tmp_path, tiny):
    # two file drops, two runs from one checkpoint: the running totals equal
    # the batch totals over everything (state is kept in the checkpoint folder)
    from tessera.operators.text import sentiment_counts
    from tessera.streaming.jobs import stream_files, streaming_sentiment_counts
    conv = spark.read.parquet(f"{tiny}/conversations.parquet").select("conv_id", "turn", "text")
    src, ck = str(tmp_path / "src"), str(tmp_path / "ck")
    conv.filter("turn % 2 = 0").write.parquet(src)

    def run(name):
        q = (streaming_sentiment_counts(stream_files(spark, src, conv.schema), "text")
             .writeStream.outputMode("complete").format("memory").queryName(name)
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination(120)
        return {r.sentiment: r.n for r in spark.table(name).collect()}

    first = run("sent_first")
    conv.filter("turn % 2 = 1").write.mode("append").parquet(src)
    second = run("sent_second")
    want = {r.sentiment: r.n for r in sentiment_counts(conv, "text").collect()}
    assert second == want
    assert sum(first.values()) == conv.filter("turn % 2 = 0").count()



@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(st.sampled_from([None, 1, 2, 3]), st.integers(0, 40)), min_size=1, max_size=120),
       parts=st.sampled_from([1, 3, 7]))
def test_property_lag_gap_range_equals_lag(spark, rows, parts):
    base = ts("2024-01-01 00:00:00")
    data = [(k, base + dt.timedelta(minutes=m), i) for i, (k, m) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, t timestamp_ntz, id int")
    got = W.lag_gap(df, "k", "t", partitions=parts)
    want = _plain_lag(df, ["k"], "t")
    strip = lambda d: sorted(((r.k, r.t, r.prev_ts) for r in d.collect()), key=_key)
    assert strip(got) == strip(want)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(vals=st.lists(st.one_of(st.none(), st.integers(-5, 5), st.floats(allow_nan=False)), min_size=1, max_size=150))
def test_property_exact_quantiles_equal_sorted_positions(spark, vals):
    import math

    from tessera.operators.aggregates import exact_quantiles
    df = spark.createDataFrame([(None if v is None else float(v),) for v in vals], "x double")
    probs = [0.01, 0.25, 0.5, 0.9, 1.0]
    got = {r.p: r.value for r in exact_quantiles(df, ["x"], probs).collect()}
    srt = sorted(v for v in vals if v is not None)
    want = {p: float(srt[max(1, math.ceil(p * len(srt))) - 1]) for p in probs} if srt else {}
    assert got == want


@pytest.mark.parametrize("desc", [True, False])
def test_topn_large_n_with_null_order_values(spark, desc):
    from pyspark.sql import Window
    rows = [("hot", None if i % 4 == 0 else i % 50, i) for i in range(900)] + [("cold", None, 5000 + i) for i in range(30)]
    df = spark.createDataFrame(rows, "g string, v int, id int")
    order = [F.col("v").desc() if desc else F.col("v").asc(), F.col("id")]
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "5")
    try:
        got = sorted((tuple(r) for r in W.topn(df, "g", order, 400, "row", partitions=8).collect()), key=_key)
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    want = (df.withColumn("rank_in_group", F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("long"))
            .filter(F.col("rank_in_group") <= 400))
    assert got == sorted((tuple(r) for r in want.collect()), key=_key)


def test_lag_gap_range_zone_aware_timestamps_other_session_zone(spark):
    # zone-aware timestamps cross the Arrow pass with a time zone attached
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        base = dt.datetime(2024, 3, 10, 1, 0, 0)          # the spring-forward night
        rows = [(i % 3, base + dt.timedelta(minutes=13 * i)) for i in range(120)]
        df = spark.createDataFrame(rows, "k int, t timestamp")
        got = W.lag_gap(df, "k", "t", partitions=5).select("k", "t", "prev_ts", "gap_minutes")
        want = _plain_lag(df, ["k"], "t").withColumn(
            "gap_minutes", (F.unix_timestamp("t") - F.unix_timestamp("prev_ts")) / 60.0)
        assert sorted(got.collect(), key=_key) == sorted(want.collect(), key=_key)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_global_rank_keeps_nested_and_timestamp_columns(spark):
    rows = [(i, float(i % 17), [i, i + 1], (str(i), i * 2), dt.datetime(2024, 1, 1) + dt.timedelta(hours=i))
            for i in range(300)]
    df = spark.createDataFrame(rows, "id long, v double, arr array<long>, s struct<a:string,b:long>, t timestamp")
    got = W.global_rank(df, [desc("v"), F.col("id")], "rank", partitions=7)
    out = sorted(got.collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in out] == list(range(1, 301))
    assert [(r.v, r.id) for r in out] == sorted(((r[1], r[0]) for r in rows), key=lambda x: (-x[0], x[1]))
    assert {(r.id, tuple(r.arr), r.s.a, r.s.b, r.t) for r in out} == {(a, tuple(b), c[0], c[1], d) for a, _, b, c, d in rows}
    # a caller keeping fewer columns gets the same ranks
    narrow = {r.id: r["rank"] for r in got.select("id", "rank").collect()}
    assert narrow == {r.id: r["rank"] for r in out}


def test_ranges_need_no_shared_exchange(spark):
    """Same result with exchange reuse off, and with one range as with many."""
    base = ts("2024-01-01 00:00:00")
    rows = [(i % 3 if i % 7 else None, base + dt.timedelta(seconds=i * 37 % 5000), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, t timestamp, id long").repartition(6)
    old = spark.conf.get("spark.sql.exchange.reuse", "true")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = W.lag_gap(df, "k", "t", partitions=9).select("k", "t", "prev_ts").collect()
        ranks = {r.id: r.rank for r in W.global_rank(df, [desc("t"), "id"], partitions=9).collect()}
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)
    assert sorted(got, key=_key) == sorted(_plain_lag(df, ["k"], "t").select("k", "t", "prev_ts").collect(), key=_key)
    want = sorted(rows, key=lambda r: (-(r[1] - base).total_seconds(), r[2]))
    assert ranks == {r[2]: n + 1 for n, r in enumerate(want)}


def test_range_ids_follow_the_order(spark):
    """Mixed directions, null places, NaN and strings: ranges ascend with the
    order and hold about as many rows each."""
    r = __import__("random").Random(4)
    rows = [(r.choice([None, "a", "b", "é", "zz"]), r.choice([None, float("nan"), r.random(), 0.0]), i) for i in range(6000)]
    df = spark.createDataFrame(rows, "s string, x double, id long").repartition(5)
    for order in ([desc("s"), asc("x"), "id"], [asc("s", nulls_first=False), desc("x", nulls_first=True), desc("id")]):
        by = [o if not isinstance(o, str) else asc(o) for o in order]
        laid = with_range_id(df, by, 12, "r").orderBy(*W._cols(order)).collect()
        ids = [x.r for x in laid]
        assert ids == sorted(ids) and set(ids) == set(range(12))
        assert max(ids.count(i) for i in range(12)) < 1500
    empty = W.global_rank(df.where("id < 0"), ["id"])
    assert empty.count() == 0 and W.global_rank(df.where("id = 5"), ["id"]).first()["rank"] == 1


def test_phrases_merge_from_left_to_right(spark):
    """Against a plain matcher: pending word and accepted pairs."""
    r = __import__("random").Random(8)
    pairs = {("a", "b"), ("b", "c"), ("c", "a"), ("a", "a"), ("d", "e")}
    rows = [(r.choice(["x", "y", None]), r.choices("abcdefg", k=r.randrange(0, 30))) for _ in range(400)] + [("x", None), ("y", []), ("x", list("aaaaa")), ("x", list("aaaaa"))]
    df = spark.createDataFrame(rows, "cls string, words array<string>").repartition(4)
    got = {(x.cls, x.word): x["count"] for x in L.merged_phrase_counts(df, "cls", "words", spark.createDataFrame(sorted(pairs), "w1 string, w2 string")).collect()}
    want = {}
    for cls, words in rows:
        out, pending = [], None
        for w in words or []:
            if pending is not None and (pending, w) in pairs:
                out.append(f"{pending}_{w}")
                pending = None
            else:
                out += [pending] if pending is not None else []
                pending = w
        for w in out + ([pending] if pending is not None else []):
            want[(cls, w)] = want.get((cls, w), 0) + 1
    assert got == want


def test_pages_with_null_and_large_ids(spark):
    from tessera.sources.html import extract_html_tables, extract_links
    html = "<table><tr><td>a</td></tr></table><a href='x'>y</a>"
    big = 2 ** 53 + 1
    df = spark.createDataFrame([(None, html), (big, html), (3, None)], "page_id long, html string").coalesce(1)
    assert sorted((r.page or 0, r.text) for r in extract_html_tables(df, "page_id", "html").collect()) == [(0, "a"), (big, "a")]
    assert sorted((r.page or 0, r.href) for r in extract_links(df, "page_id", "html").collect()) == [(0, "x"), (big, "x")]


@pytest.mark.parametrize("ties", ["rank", "row"])
@pytest.mark.parametrize("slices", [1, 16, 17, 300])
def test_topn_tournament_equals_plain_window(spark, ties, slices):
    import random
    r = random.Random(slices)
    rows = [(r.choice([None, "a", "a", "a", "b"]), r.choice([None, *range(12)]), i, "x") for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, id int, `dotted.name` string")
    order = [F.col("v").desc()] + (["id"] if ties == "row" else [])
    w = Window.partitionBy("g").orderBy(*order)
    fn = F.rank if ties == "rank" else F.row_number
    for n in (1, 5, 700, 5000):
        want = df.withColumn("rank_in_group", fn().over(w).cast("long")).filter(F.col("rank_in_group") <= n)
        got = W.topn(df, "g", order, n, ties, partitions=slices)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_topn_of_a_group_whose_rows_all_tie_runs_in_many_tasks(spark):
    df = spark.range(20_000).withColumn("g", F.lit("a")).withColumn("v", F.lit(1))
    top = W.topn(df, "g", [F.col("v").desc()], 3, "rank", partitions=64)
    parts = top.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    assert sum(r["count"] for r in parts) == 20_000
    # windows that are not within a slice see counted classes, not rows
    windows = [x for x in top._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in x]
    assert len(windows) > 3 and all("_slice" in x or "sum(_rows" in x for x in windows)


def test_topn_refuses_unknown_ties(spark):
    with pytest.raises(ValueError):
        W.topn(spark.range(3), "id", "id", 1, "dense")


def test_word_weight_of_a_whole_vocabulary(spark):
    counts = [(f"w{i:04d}", 1 if i % 2 else 1 + i % 7) for i in range(3000)] + [("top", 999)]
    df = spark.createDataFrame(counts, "word string, count long").repartition(3)
    weighed = L.word_weight(df, 0.25)
    want = {w: (k, 0.25 * c / 999 + 0.75 * (1 - (k - 1) / 3001)) for k, (w, c) in enumerate(sorted(counts, key=lambda x: (-x[1], x[0])), 1)}
    got = {r["word"]: (r["rank"], r["weight"]) for r in weighed.collect()}
    assert got.keys() == want.keys()
    assert all(got[w][0] == k and abs(got[w][1] - v) < 1e-12 for w, (k, v) in want.items())
    assert L.word_weight(df.limit(0)).count() == 0


def test_html_unescape_equals_the_rules_of_html(spark):
    import html
    import random
    from html.entities import html5

    from tessera.functions.text import html_unescape
    texts = [f"a &{n} b" for n in html5] + [f"&{n}x;y" for n in html5 if not n.endswith(";")]
    numbers = [*range(0, 0x2100), 0xd7ff, 0xd800, 0xdfff, 0xe000, 0xfdcf, *range(0xfdd0, 0xfdf2), *range(0xfffb, 0x10003), 0x1f600, 0x1fffe,
               0x1ffff, 0x10fffd, 0x10fffe, 0x10ffff, 0x110000, 10 ** 7, 10 ** 30]
    texts += [f"&#{n};" for n in numbers] + [f"&#x{n:x}z" for n in numbers] + [f"&#X000{n:X};" for n in numbers]
    texts += ["", "&", "&&", "a&", "&;", "&#;", "&#x;", "&#xg", "& amp;", "&amp;amp;", "&" + "a" * 40, "&notit;", "&notin;", "&ä;", "&\U0001f600;", "x", "&lt&gt",
              "a\n&amp\nb", "&#65", "&#0065;&#x41;B"]
    r = random.Random(1)
    texts += ["".join(r.choice(["&", "#", "x", "1", "9", "a", "m", "p", ";", "lt", "not", " ", "\U0001f600", "\n", "copy", "frac12", "\r"]) for _ in range(r.randrange(14)))
              for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").select("t", html_unescape("t").alias("u"))
    rows = df.collect()
    assert [(r["t"], r["u"]) for r in rows if r["u"] != (None if r["t"] is None else html.unescape(r["t"]))] == []
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_stop_words_of_any_kind(spark):
    df = spark.createDataFrame([("The cat's  THE other the-end, aéb then",), ("the",), ("",), (None,)], "t string")
    want = {(): ["the", "cats", "the", "other", "theend", "ab", "then"], ("the",): ["cats", "other", "theend", "ab", "then"],
            ("the", "th", "ab", "The", "(", "a|b", ""): ["cats", "other", "theend", "then"]}
    for words, left in want.items():
        for stop in (list(words), spark.createDataFrame([(w,) for w in words] + [(None,)], "word string")):
            got = [r["words"] for r in L.add_clean_words(df, "t", stop).collect()]
            assert got == [left, [] if "the" in words else ["the"], [], None]


def test_sample_n_moves_no_rows_to_one_task_of_a_class(spark):
    """Only the places of a class meet in one task; the sampled rows stay spread."""
    from tessera.operators.ordering import sample_n
    rows = [(i % 2, i, f"text {i}") for i in range(6000)]
    df = spark.createDataFrame(rows, "cls int, id long, text string").repartition(8)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = sample_n(df, "cls", "id", 2000).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert sum(r["count"] for r in got) == 4000 and max(r["count"] for r in got) < 1000


def test_sample_n_counts_repeated_and_null_rows(spark):
    from collections import Counter
    from tessera.operators.ordering import sample_n
    rows = [("a", 1, "x")] * 7 + [("a", None, "n")] * 5 + [("a", 1, "y")] * 2 + [(None, i % 3, "z") for i in range(9)] + [("b", 4, None)]
    df = spark.createDataFrame(rows, "cls string, id long, text string").repartition(3)
    for n in (1, 3, 6, 8, 100):
        got = [tuple(r) for r in sample_n(df, "cls", "id", n).collect()]
        assert Counter(r[0] for r in got) == {"a": min(n, 14), None: min(n, 9), "b": 1}
        assert not Counter(got) - Counter(rows)
        assert Counter(got)[("a", None, "n")] == min(n, 5)


def _initial_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_collocations_do_not_sort_their_pairs(spark):
    from tessera.operators import text as L
    words = spark.createDataFrame([(1, ["a", "b", "a", "b"]), (2, [])], "id long, words array<string>")
    plan = _initial_plan(L.collocations(words, "id", "words", 0.0))
    assert plan.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plan


def test_phrase_table_cleans_its_texts_once(spark):
    from tessera.plans import text_jobs as P
    docs = spark.createDataFrame([("x", 1, "Hot dog &amp; hot dog"), ("x", 2, " "), ("y", 3, None), ("y", 4, "hot dog")], "cls string, id long, text string")
    out = P.cloud_table(docs, "cls", "id", "text", ["the"], per_class=None, min_llr=1.0)
    assert "regexp_replace" not in _initial_plan(out)
    assert sorted((r["cls"], r["word"], r["count"]) for r in out.collect()) == [("x", "hot_dog", 2), ("y", "hot_dog", 1)]


def test_bridge_join_query_does_not_hash_its_result(spark, tmp_path):
    from tessera.catalog.quality import q_bridge_join
    spark.createDataFrame([(1,), (1,), (2,), (None,)], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(7, "p"), (7, "p"), (7, "q"), (8, None)], "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(1, 7), (1, 7), (2, 8), (None, 7), (3, 8)], "l_orderkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    out = q_bridge_join(spark, str(tmp_path))
    top = out._jdf.queryExecution().optimizedPlan().toString().splitlines()[0]
    assert not top.startswith(("Aggregate", "Deduplicate", "Distinct"))
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 7, "p"), (1, 7, "q"), (2, 8, None)]
