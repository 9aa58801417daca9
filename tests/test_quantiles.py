"""Radix selection: order-preserving keys and exact positions."""

import datetime as dt
import math
import random
import struct
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import quantiles as Q
from tessera.operators.aggregates import describe, exact_quantiles, percentile_by


def doubles():
    r = random.Random(1)
    out = [0.0, -0.0, 1.0, -1.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, math.inf, -math.inf, 1e300, 1e150, 0.1]
    out += [2.0 ** e for e in range(-1074, 1024, 7)] + [math.nextafter(2.0 ** e, s) for e in range(-1000, 1020, 11) for s in (0.0, math.inf)]
    return out + [struct.unpack("<d", struct.pack("<Q", r.getrandbits(64)))[0] for _ in range(3000)]


def test_keys_of_doubles_are_their_bits(spark):
    rows = [(x,) for x in doubles()] + [(None,)]
    t = T.DoubleType()
    keyed = Q.with_double_key(spark.createDataFrame(rows, "x double"), "x", "k")
    for r in keyed.select("x", "k", Q.from_sort_key(F.col("k"), t).alias("back")).collect():
        if r.x is None or math.isnan(r.x):
            assert r.k is None
            continue
        bits = struct.unpack("<q", struct.pack("<d", abs(r.x)))[0]
        assert r.k == (-bits if r.x < 0 else bits) and r.back == r.x


@pytest.mark.parametrize("dtype, values", [
    (T.LongType(), [2 ** 53, 2 ** 53 + 1, 2 ** 53 + 3, -2 ** 63, 2 ** 63 - 1, 0, -1, 1]),
    (T.IntegerType(), [5, -7, 0, 2 ** 31 - 1, -2 ** 31]),
    (T.DecimalType(18, 4), [Decimal("99999999999999.9999"), Decimal("-0.0001"), Decimal("0"), Decimal("12.5")]),
    (T.DateType(), [dt.date(1, 1, 1), dt.date(1970, 1, 1), dt.date(9999, 12, 31)]),
    (T.TimestampType(), [dt.datetime(1900, 1, 1, 0, 0, 0, 1), dt.datetime(2024, 5, 1, 8), dt.datetime(2024, 5, 1, 8, 0, 0, 1)]),
])
def test_exact_types_stay_exact(spark, dtype, values):
    schema = T.StructType([T.StructField("g", T.IntegerType()), T.StructField("x", dtype)])
    df = spark.createDataFrame([(1, v) for v in values] + [(1, None), (2, None)], schema)
    order = sorted(values)
    for p in (0.0, 0.3, 0.5, 0.8, 1.0):
        got = {r.g: r.pct for r in percentile_by(df, "g", "x", p).collect()}
        assert got == {1: order[max(1, math.ceil(p * len(order))) - 1], 2: None}


def test_whole_numbers_above_2_53(spark):
    df = spark.createDataFrame([(2 ** 53 + i,) for i in (0, 1, 3)], "x long")
    assert exact_quantiles(df, ["x"], [0.5]).first().value == 2 ** 53 + 1


def test_nested_outliers(spark):
    rows = [(1e300,), (1e150,), (-1e300,), (5e-324,)] + [(float(i),) for i in range(2000)]
    df = spark.createDataFrame(rows, "x double").repartition(4)
    values = sorted(r[0] for r in rows)
    probs = [0.0, 0.001, 0.25, 0.5, 0.9, 0.999, 1.0]
    assert {r.p: r.value for r in exact_quantiles(df, ["x"], probs).collect()} == {p: values[max(1, math.ceil(p * len(values))) - 1] for p in probs}


def test_mixed_types_and_groups(spark):
    r = random.Random(2)
    rows = [(r.choice(["hot", "hot", "b", None]), r.randrange(10 ** 15), r.random()) for _ in range(3000)]
    df = spark.createDataFrame(rows, "column2 string, a long, b double")
    got = {(x.column2, x.column, x.p): x.value for x in exact_quantiles(df, ["a", "b"], [0.1, 0.9], keys=["column2"]).collect()}
    for g in ("hot", "b", None):
        for i, c in ((1, "a"), (2, "b")):
            values = sorted(x[i] for x in rows if x[0] == g)
            for p in (0.1, 0.9):
                assert got[(g, c, p)] == float(values[math.ceil(p * len(values)) - 1])
    assert len(got) == 12


def test_windows_see_counted_bits_only(spark):
    """Each of the four windows stands on an aggregate by the next 16 bits."""
    df = spark.range(1000).withColumn("x", F.col("id") * 1.5)
    plan = exact_quantiles(df, ["x"], [0.5])._jdf.queryExecution().optimizedPlan().toString()
    above = plan.splitlines()
    windows = [i for i, line in enumerate(above) if "Window [" in line]
    assert len(windows) >= Q.LEVELS
    for i in windows:
        below = next(line for line in above[i + 1:] if "Window [" not in line and "Project" not in line)
        assert "Aggregate" in below
    levels = describe(df, ["x"])
    assert levels.first().p50 == 749.25
