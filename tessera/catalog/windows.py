"""Window operators (survey section F)."""

from pyspark.sql import functions as F

from tessera.catalog import load, query
from tessera.operators import windows as W


def t(spark, sf, name):
    return load(spark, sf, name)


@query("topn_rank", """
  SELECT c_custkey, c_nationkey, bal_k, rank_in_group FROM (
    SELECT c_custkey, c_nationkey, CAST(floor(c_acctbal / 1000) AS BIGINT) AS bal_k,
           rank() OVER (PARTITION BY c_nationkey ORDER BY floor(c_acctbal / 1000) DESC) AS rank_in_group
    FROM customer) x WHERE rank_in_group <= 3""")
def q_topn_rank(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", "c_nationkey",
                                        F.floor(F.col("c_acctbal") / 1000).cast("long").alias("bal_k"))
    return W.topn(c, "c_nationkey", [F.col("bal_k").desc()], 3, "rank")


@query("topn_rownumber", """
  SELECT c_custkey, c_nationkey, c_acctbal, rank_in_group FROM (
    SELECT c_custkey, c_nationkey, c_acctbal,
           row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank_in_group
    FROM customer) x WHERE rank_in_group <= 3""")
def q_topn_rownumber(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return W.topn(c, "c_nationkey", [F.col("c_acctbal").desc(), F.col("c_custkey")], 3, "row")


@query("zscore", """
  SELECT p_partkey,
         round((p_retailprice - (SELECT avg(p_retailprice) FROM part))
               / nullif((SELECT stddev_pop(p_retailprice) FROM part), 0), 9) AS price_z,
         round((p_size - (SELECT avg(p_size) FROM part)) / nullif((SELECT stddev_pop(p_size) FROM part), 0), 9) AS size_z,
         (1 - (SELECT avg(1) FROM part)) / nullif((SELECT stddev_pop(1) FROM part), 0) AS const_z
  FROM part""")
def q_zscore(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", "p_retailprice", "p_size", F.lit(1).alias("const"))
    z = W.zscore(p, ["p_retailprice", "p_size", "const"],
                 names={"p_retailprice": "price_z", "p_size": "size_z", "const": "const_z"})
    return z.select("p_partkey", F.round("price_z", 9).alias("price_z"), F.round("size_z", 9).alias("size_z"),
                    F.col("const_z").cast("double").alias("const_z"))


@query("peak_flag", """
  WITH h AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)
  SELECT o_orderpriority, n,
         o_orderpriority = (SELECT o_orderpriority FROM h ORDER BY n DESC, o_orderpriority LIMIT 1) AS is_max
  FROM h""")
def q_peak_flag(spark, sf):
    h = t(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    # labels start with a distinct digit: tie-break on it, the smallest label wins
    h = h.withColumn("_t", F.ascii("o_orderpriority"))
    return W.flag_max(h, "n", "_t", "is_max").select("o_orderpriority", "n", "is_max")
