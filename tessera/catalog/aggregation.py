"""Aggregates (survey section E) over the TPC-H-like tables."""

from pyspark.sql import functions as F

from tessera.catalog import load, query
from tessera.operators import aggregates as E


def t(spark, sf, name):
    return load(spark, sf, name)


@query("agg_minmax", """
  SELECT min(o_totalprice) AS smallest, max(o_totalprice) AS largest,
         min(o_orderdate) AS first_order, max(o_orderdate) AS last_order FROM orders""")
def q_agg_minmax(spark, sf):
    return E.agg(t(spark, sf, "orders"), None, {
        "smallest": F.min("o_totalprice"), "largest": F.max("o_totalprice"),
        "first_order": F.min("o_orderdate"), "last_order": F.max("o_orderdate")})


@query("agg_minmax_by", """
  SELECT o_orderstatus, min(o_totalprice) AS smallest, max(o_orderdate) AS last_order
  FROM orders GROUP BY o_orderstatus""")
def q_agg_minmax_by(spark, sf):
    return E.agg(t(spark, sf, "orders"), "o_orderstatus",
                 {"smallest": F.min("o_totalprice"), "last_order": F.max("o_orderdate")})


@query("agg_count", """
  SELECT count(*) AS n_rows, count(seg) AS n_seg, count(*) FILTER (WHERE c_acctbal > 5000) AS n_rich
  FROM (SELECT *, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS seg FROM customer) c""")
def q_agg_count(spark, sf):
    c = t(spark, sf, "customer").withColumn("seg", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")))
    return E.agg(c, None, {"n_rows": F.count(F.lit(1)), "n_seg": F.count("seg"),
                           "n_rich": F.count_if(F.col("c_acctbal") > 5000)})


@query("agg_distinct", """
  SELECT count(DISTINCT o_custkey) AS customers,
         (SELECT count(*) FROM (SELECT DISTINCT o_orderpriority FROM orders) d) AS priorities
  FROM orders""")
def q_agg_distinct(spark, sf):
    o = t(spark, sf, "orders")
    prios = o.select("o_orderpriority").distinct()
    return o.agg(F.countDistinct("o_custkey").alias("customers")).withColumn(
        "priorities", prios.select(F.count(F.lit(1))).scalar())


@query("agg_sum", """
  SELECT l_returnflag, round(sum(l_quantity), 2) AS sum_qty,
         round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue,
         round(sum(l_quantity) FILTER (WHERE l_discount > 0.05), 2) AS sum_qty_disc
  FROM lineitem GROUP BY l_returnflag""")
def q_agg_sum(spark, sf):
    li = t(spark, sf, "lineitem")
    return E.agg(li, "l_returnflag", {
        "sum_qty": F.round(F.sum("l_quantity"), 2),
        "revenue": F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2),
        "sum_qty_disc": F.round(F.sum(F.when(F.col("l_discount") > 0.05, F.col("l_quantity"))), 2)})


@query("agg_avg", """
  SELECT round(avg(p_retailprice), 6) AS avg_price,
         round(avg(p_retailprice) FILTER (WHERE p_size > 25), 6) AS avg_price_big
  FROM part""")
def q_agg_avg(spark, sf):
    p = t(spark, sf, "part")
    return E.agg(p, None, {"avg_price": F.round(F.avg("p_retailprice"), 6),
                           "avg_price_big": F.round(F.avg(F.when(F.col("p_size") > 25, F.col("p_retailprice"))), 6)})


@query("group_order", """
  SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY c_nationkey ORDER BY customers DESC""")
def q_group_order(spark, sf):
    return E.agg(t(spark, sf, "customer"), "c_nationkey", {"customers": F.count(F.lit(1))},
                 order=[F.col("customers").desc()])


@query("group_join", """
  SELECT c.c_mktsegment, count(*) AS orders, round(sum(o.o_totalprice), 2) AS total
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_mktsegment""")
def q_group_join(spark, sf):
    o, c = t(spark, sf, "orders"), t(spark, sf, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return E.agg(j, "c_mktsegment", {"orders": F.count(F.lit(1)), "total": F.round(F.sum("o_totalprice"), 2)})


@query("having", """
  SELECT n.n_name, count(*) AS customers FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE c.c_acctbal > 0 GROUP BY n.n_name HAVING count(*) > 50 ORDER BY customers DESC""")
def q_having(spark, sf):
    c, n = t(spark, sf, "customer"), t(spark, sf, "nation")
    j = c.filter(F.col("c_acctbal") > 0).join(n, c.c_nationkey == n.n_nationkey)
    return E.agg(j, "n_name", {"customers": F.count(F.lit(1))}, having=F.col("customers") > 50,
                 order=[F.col("customers").desc()])


@query("distinct", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def q_distinct(spark, sf):
    return t(spark, sf, "customer").select("c_nationkey", "c_mktsegment").distinct()


@query("agg_multi", """
  SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty,
         round(sum(l_extendedprice), 2) AS sum_base_price,
         round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
         round(avg(l_quantity), 6) AS avg_qty, round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order
  FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def q_agg_multi(spark, sf):
    li = t(spark, sf, "lineitem").filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return E.agg(li, ["l_returnflag", "l_linestatus"], {
        "sum_qty": F.round(F.sum("l_quantity"), 2),
        "sum_base_price": F.round(F.sum("l_extendedprice"), 2),
        "sum_disc_price": F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2),
        "avg_qty": F.round(F.avg("l_quantity"), 6), "avg_disc": F.round(F.avg("l_discount"), 6),
        "count_order": F.count(F.lit(1))})


@query("percentile_by", """
  SELECT o_orderpriority, quantile_disc(o_totalprice, 0.9) AS p90 FROM orders GROUP BY 1""")
def q_percentile_by(spark, sf):
    return E.percentile_by(t(spark, sf, "orders"), "o_orderpriority", "o_totalprice", 0.9, "p90")


@query("mean_by_key", """
  SELECT CAST(l_partkey AS VARCHAR) AS key, round(avg(l_quantity), 1) AS mean FROM lineitem GROUP BY 1""")
def q_mean_by_key(spark, sf):
    # P11 shape: ratings are (movie, rating) lines; here part -> quantity
    from tessera.plans.ratings import ratings_from_table
    return E.mean_by_key(ratings_from_table(t(spark, sf, "lineitem")), "key", "value", 1, "mean")


@query("count_mean_by_key", """
  SELECT key, n, mean FROM (
    SELECT CAST(l_suppkey AS VARCHAR) AS key, count(*) AS n, round(avg(l_quantity), 1) AS mean
    FROM lineitem GROUP BY 1) x""")
def q_count_mean_by_key(spark, sf):
    from tessera.plans.ratings import ratings_from_table
    r = ratings_from_table(t(spark, sf, "lineitem"), key="l_suppkey")
    return E.count_mean_by_key(r, "key", "value", 1)


@query("top_reviewed", """
  SELECT CAST(l_partkey AS VARCHAR) AS key, count(*) AS n, round(avg(l_quantity), 1) AS mean
  FROM lineitem GROUP BY 1 ORDER BY n DESC, key LIMIT 10""")
def q_top_reviewed(spark, sf):
    from tessera.plans.ratings import top_products
    from tessera.plans.ratings import ratings_from_table
    return top_products(ratings_from_table(t(spark, sf, "lineitem")), 10)


@query("safe_ratio", """
  SELECT s_suppkey, s_acctbal / nullif(s_nationkey, 0) AS per_nation FROM supplier""")
def q_safe_ratio(spark, sf):
    from tessera.functions.scalars import safe_ratio
    return t(spark, sf, "supplier").select("s_suppkey", safe_ratio("s_acctbal", "s_nationkey").alias("per_nation"))


@query("min_sample", """
  SELECT o_custkey, count(*) AS orders, count(*) >= 15 AS has_enough_data FROM orders GROUP BY 1""")
def q_min_sample(spark, sf):
    per = E.agg(t(spark, sf, "orders"), "o_custkey", {"orders": F.count(F.lit(1))})
    return E.min_sample(per, ["orders"], 15)


@query("partition_profile", """
  SELECT count(*) AS rows, count(*) FILTER (WHERE l_quantity > 25) AS hits FROM lineitem""")
def q_partition_profile(spark, sf):
    # partition ids depend on the file layout, so the query returns the totals over them
    per = E.partition_profile(t(spark, sf, "lineitem"), F.col("l_quantity") > 25)
    return per.agg(F.sum("rows").alias("rows"), F.sum("hits").alias("hits"))


@query("topn_avg", """
  SELECT c_mktsegment, round(avg(c_acctbal), 6) AS avg_top FROM (
    SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS r
    FROM customer) x WHERE r <= 5 GROUP BY 1""")
def q_topn_avg(spark, sf):
    out = E.topn_avg(t(spark, sf, "customer"), "c_mktsegment", "c_acctbal", 5, "row", "c_custkey")
    return out.withColumn("avg_top", F.round("avg_top", 6))


@query("topn_avg_rank", """
  SELECT n_regionkey, round(avg(c_acctbal), 6) AS avg_top FROM (
    SELECT c.*, n.n_regionkey, rank() OVER (PARTITION BY n.n_regionkey ORDER BY floor(c.c_acctbal / 1000) DESC) AS r
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey) x WHERE r <= 5 GROUP BY 1""")
def q_topn_avg_rank(spark, sf):
    # RANK keeps ties at the cut (values rounded to thousands so ties exist)
    c, n = t(spark, sf, "customer"), t(spark, sf, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey).withColumn("bal_k", F.floor(F.col("c_acctbal") / 1000))
    from tessera.operators.windows import topn
    top = topn(j, "n_regionkey", [F.col("bal_k").desc()], 5, "rank")
    return top.groupBy("n_regionkey").agg(F.round(F.avg("c_acctbal"), 6).alias("avg_top"))


@query("value_profile", """
  SELECT o_orderpriority, count(*) AS n FROM orders
  WHERE NOT coalesce(regexp_matches(o_orderpriority, '^[1-3]-'), false) GROUP BY 1""")
def q_value_profile(spark, sf):
    return E.value_profile(t(spark, sf, "orders"), "o_orderpriority", "^[1-3]-")


@query("split_means", """
  SELECT round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 6) AS mean_true,
         count(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS n_true,
         round(avg(o_totalprice) FILTER (WHERE NOT o_orderstatus = 'F'), 6) AS mean_false,
         count(o_totalprice) FILTER (WHERE NOT o_orderstatus = 'F') AS n_false
  FROM orders""")
def q_split_means(spark, sf):
    out = E.split_means(t(spark, sf, "orders"), F.col("o_orderstatus") == "F", "o_totalprice")
    return out.withColumns({"mean_true": F.round("mean_true", 6), "mean_false": F.round("mean_false", 6)})


@query("daily_summary", """
  SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders, round(sum(o_totalprice), 2) AS revenue
  FROM orders GROUP BY 1""")
def q_daily_summary(spark, sf):
    from tessera.operators.quality import daily_summary
    return daily_summary(t(spark, sf, "orders"), "o_orderdate",
                         {"orders": F.count(F.lit(1)), "revenue": F.round(F.sum("o_totalprice"), 2)})


@query("first_per_key", """
  SELECT c_nationkey, c_custkey, c_name FROM (
    SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS r FROM customer) x
  WHERE r = 1""")
def q_first_per_key(spark, sf):
    # One row per key, chosen by an explicit order (dropDuplicates keeps an arbitrary row)
    from tessera.operators.windows import topn
    c = t(spark, sf, "customer")
    return topn(c, "c_nationkey", [F.col("c_acctbal").desc(), F.col("c_custkey")], 1, "row").select(
        "c_nationkey", "c_custkey", "c_name")
