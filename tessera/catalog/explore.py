"""Exploration tables (E20-E26) over ``lineitem`` as the numeric stand-in."""

from pyspark.sql import functions as F

from tessera.catalog import load, query
from tessera.operators import aggregates as E
from tessera.plans.explore import pair_points

NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def li(spark, sf):
    return load(spark, sf, "lineitem")


@query("size_by_pair", "SELECT l_returnflag, l_linestatus, count(*) AS size FROM lineitem GROUP BY 1, 2")
def q_size_by_pair(spark, sf):
    return E.size_by_pair(li(spark, sf), "l_returnflag", "l_linestatus")


@query("crosstab", """
  SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS F,
         count(*) FILTER (WHERE l_linestatus = 'O') AS O, count(*) FILTER (WHERE l_linestatus = 'X') AS X
  FROM lineitem GROUP BY 1""")
def q_crosstab(spark, sf):
    # 'X' never occurs: its column is all zeros
    return E.crosstab(li(spark, sf), "l_returnflag", "l_linestatus", ["F", "O", "X"])


@query("nonnull_by_key", """
  SELECT o_orderstatus, count(o_orderkey) AS o_orderkey, count(o_custkey) AS o_custkey,
         count(CASE WHEN o_totalprice > 100000 THEN o_totalprice END) AS o_totalprice
  FROM orders GROUP BY 1""")
def q_nonnull_by_key(spark, sf):
    o = load(spark, sf, "orders").select("o_orderstatus", "o_orderkey", "o_custkey",
                                         F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).alias("o_totalprice"))
    return E.nonnull_by_key(o, "o_orderstatus")


@query("describe", " UNION ALL ".join(f"""
  SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
         min({c}) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50,
         quantile_cont({c}, 0.75) AS p75, max({c}) AS max FROM lineitem""" for c in NUM))
def q_describe(spark, sf):
    d = E.describe(li(spark, sf), NUM)
    return d.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query("corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 9) AS r FROM lineitem" for a in NUM for b in NUM))
def q_corr_matrix(spark, sf):
    return E.corr_matrix(li(spark, sf), NUM).withColumn("r", F.round("r", 9))


def _hist_sql(c, bins=10):
    return f"""
  SELECT '{c}' AS "column", b.bin, s.lo + (b.bin - 1) * ((s.hi - s.lo) / {bins}) AS lower,
         s.lo + b.bin * ((s.hi - s.lo) / {bins}) AS upper, coalesce(h.count, 0) AS count
  FROM (SELECT CAST(range AS BIGINT) AS bin FROM range(1, {bins + 1})) b
  CROSS JOIN (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM lineitem) s
  LEFT JOIN (SELECT CAST(least(coalesce(floor(({c}::DOUBLE - s2.lo) * {bins} / nullif(s2.hi - s2.lo, 0)) + 1, 1),
                                {bins}) AS BIGINT) AS bin, count(*) AS count
             FROM lineitem, (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM lineitem) s2
             WHERE {c} IS NOT NULL GROUP BY 1) h ON b.bin = h.bin"""


@query("histogram", " UNION ALL ".join(_hist_sql(c) for c in NUM))
def q_histogram(spark, sf):
    return E.histogram(li(spark, sf), NUM, 10)


@query("pair_points", """
  SELECT l_quantity, l_extendedprice, round((SELECT corr(l_quantity, l_extendedprice) FROM lineitem), 9) AS r
  FROM lineitem""")
def q_pair_points(spark, sf):
    return pair_points(li(spark, sf), "l_quantity", "l_extendedprice").withColumn("r", F.round("r", 9))
