"""Table changes as copy-on-write transforms."""

from pyspark.sql import functions as F

from tessera.catalog import load, query
from tessera.operators import changes as I


@query("insert_rows", """
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
  UNION ALL SELECT s_suppkey + 1000000, s_name, s_nationkey, NULL, NULL FROM supplier WHERE s_acctbal > 9000""")
def q_insert_rows(spark, sf):
    new = load(spark, sf, "supplier").filter(F.col("s_acctbal") > 9000).select(
        (F.col("s_suppkey") + 1000000).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"))
    return I.insert_rows(load(spark, sf, "customer"), new)


@query("update_where", """
  SELECT c_custkey, c_name, c_nationkey, c_acctbal + CASE WHEN c_nationkey = 4 THEN 100 ELSE 0 END AS c_acctbal,
         CASE WHEN c_acctbal > 9000 THEN 'VIP' ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def q_update_where(spark, sf):
    c = load(spark, sf, "customer")
    c = I.update_where(c, F.col("c_acctbal") > 9000, {"c_mktsegment": F.lit("VIP")})
    return I.update_where(c, F.col("c_nationkey") == 4, {"c_acctbal": F.col("c_acctbal") + 100})


@query("update_all", "SELECT n_nationkey, upper(n_name) || '!' AS n_name, n_regionkey FROM nation")
def q_update_all(spark, sf):
    return I.update_where(load(spark, sf, "nation"), None, {"n_name": F.concat(F.upper("n_name"), F.lit("!"))})


@query("delete_where", "SELECT * FROM orders WHERE NOT coalesce(o_orderstatus = 'P' OR o_totalprice < 5000, false)")
def q_delete_where(spark, sf):
    return I.delete_where(load(spark, sf, "orders"), (F.col("o_orderstatus") == "P") | (F.col("o_totalprice") < 5000))


@query("delete_all", "SELECT * FROM orders WHERE false")
def q_delete_all(spark, sf):
    return I.delete_where(load(spark, sf, "orders"))
