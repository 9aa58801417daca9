"""Data rules as table checks (survey section N)."""

from pyspark.sql import functions as F

from tessera.catalog import load, query
from tessera.operators import quality as N


def t(spark, sf, name):
    return load(spark, sf, name)


@query("check_pk", """
  SELECT l_orderkey, n, 'duplicate' AS problem FROM (
    SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1) x WHERE n > 1""")
def q_check_pk(spark, sf):
    # l_orderkey alone is not a key of lineitem: every multi-line order is reported
    return N.check_pk(t(spark, sf, "lineitem"), "l_orderkey")


@query("check_pk_ok", """
  SELECT l_orderkey, l_linenumber, n, 'duplicate' AS problem FROM (
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2) x WHERE n > 1""")
def q_check_pk_ok(spark, sf):
    return N.check_pk(t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("check_fk", """
  SELECT l.* FROM lineitem l WHERE l_partkey IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size > 5)""")
def q_check_fk(spark, sf):
    parent = t(spark, sf, "part").filter(F.col("p_size") > 5)
    return N.check_fk(t(spark, sf, "lineitem"), "l_partkey", parent, "p_partkey")


DOMAIN_SQL_RULES = {
    "discount_range": "l_discount BETWEEN 0 AND 0.1",
    "flag_code": "l_returnflag IN ('A', 'N')",
    "quantity_whole": "l_quantity = floor(l_quantity)",
    "price_positive": "l_extendedprice > 1000",
}


@query("check_domain", " UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, '{name}' AS rule FROM lineitem WHERE NOT coalesce({cond}, false)"
    for name, cond in DOMAIN_SQL_RULES.items()))
def q_check_domain(spark, sf):
    return N.check_domain(t(spark, sf, "lineitem"), {
        "discount_range": F.col("l_discount").between(0, 0.1),
        "flag_code": F.col("l_returnflag").isin("A", "N"),
        "quantity_whole": F.col("l_quantity") == F.floor("l_quantity"),
        "price_positive": F.col("l_extendedprice") > 1000}, ["l_orderkey", "l_linenumber"])


@query("fk_delete_cascade", """
  SELECT * FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3)""")
def q_fk_delete_cascade(spark, sf):
    gone = t(spark, sf, "customer").filter(F.col("c_nationkey") == 3)
    return N.fk_delete(gone, "c_custkey", t(spark, sf, "orders"), "o_custkey", "cascade")


@query("fk_delete_set_null", """
  SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3)
                          THEN NULL ELSE o_custkey END AS o_custkey,
         o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def q_fk_delete_set_null(spark, sf):
    gone = t(spark, sf, "customer").filter(F.col("c_nationkey") == 3)
    return N.fk_delete(gone, "c_custkey", t(spark, sf, "orders"), "o_custkey", "set_null")


@query("fk_delete_restrict", """
  SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3)""")
def q_fk_delete_restrict(spark, sf):
    gone = t(spark, sf, "customer").filter(F.col("c_nationkey") == 3)
    return N.fk_delete(gone, "c_custkey", t(spark, sf, "orders"), "o_custkey", "restrict")


@query("check_fd", """
  SELECT * FROM (
    SELECT l_orderkey, count(DISTINCT l_returnflag) + max(CASE WHEN l_returnflag IS NULL THEN 1 ELSE 0 END) AS n_values
    FROM lineitem GROUP BY 1) x WHERE n_values > 1""")
def q_check_fd(spark, sf):
    return N.check_fd(t(spark, sf, "lineitem"), "l_orderkey", "l_returnflag")


@query("explode_list", """
  SELECT o_orderkey, CAST(pos - 1 AS INT) AS pos, trim(parts[pos]) AS parts, trim(prio[pos]) AS prio FROM (
    SELECT o_orderkey, string_split(o_orderpriority, '-') AS parts,
           string_split(o_orderpriority || '-x', '-') AS prio,
           unnest(range(1, len(string_split(o_orderpriority || '-x', '-')) + 1)) AS pos
    FROM orders) x""")
def q_explode_list(spark, sf):
    # two parallel multi-valued cells of unequal length: the shorter gives nulls
    o = t(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("parts"),
                                      F.concat(F.col("o_orderpriority"), F.lit("-x")).alias("prio"))
    return N.explode_list(o, ["parts", "prio"], "-", keep=["o_orderkey"])


@query("decompose", """
  SELECT count(*) AS original_rows, count(*) AS rejoined_rows, true AS lossless FROM (
    SELECT DISTINCT o_orderkey, o_custkey, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey) x""")
def q_decompose(spark, sf):
    o, c = t(spark, sf, "orders"), t(spark, sf, "customer")
    wide = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_custkey", "c_nationkey")
    parts = N.decompose(wide, {"orders": ["o_orderkey", "o_custkey"], "cust": ["o_custkey", "c_nationkey"]})
    return N.lossless_check(wide, parts, [("cust", "o_custkey")])


@query("subtype_rollup", """
  SELECT c_custkey AS party_key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment,
         NULL::VARCHAR AS supplier_only, 'customer' AS subtype FROM customer
  UNION ALL
  SELECT s_suppkey, s_name, s_acctbal, NULL, 'S' || CAST(s_nationkey AS VARCHAR), 'supplier' FROM supplier""")
def q_subtype_rollup(spark, sf):
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"),
                                        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = t(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"),
        F.concat(F.lit("S"), F.col("s_nationkey").cast("string")).alias("supplier_only"))
    return N.subtype_rollup({"customer": c, "supplier": s})


def _parties(spark, sf):
    c = t(spark, sf, "customer").select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("party"), F.col("c_name").alias("name"),
                                        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = t(spark, sf, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("party"), F.col("s_name").alias("name"),
                                        F.col("s_acctbal").alias("balance"), F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("nation"))
    return N.subtype_rollup({"customer": c, "supplier": s})


@query("subtype_rolldown", """
  SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS party, s_name AS name, s_acctbal AS balance, 'N' || CAST(s_nationkey AS VARCHAR) AS nation FROM supplier""")
def q_subtype_rolldown(spark, sf):
    return N.subtype_rolldown(_parties(spark, sf), "subtype", "supplier", ["party", "name", "balance", "nation"])


@query("subtype_hacksaw", """
  SELECT 'C' || CAST(c_custkey AS VARCHAR) AS party, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment,
         NULL::VARCHAR AS nation, 'customer' AS subtype FROM customer
  UNION ALL
  SELECT 'S' || CAST(s_suppkey AS VARCHAR), s_name, s_acctbal, NULL, 'N' || CAST(s_nationkey AS VARCHAR), 'supplier' FROM supplier""")
def q_subtype_hacksaw(spark, sf):
    rolled = _parties(spark, sf)
    own = {"customer": N.subtype_rolldown(rolled, "subtype", "customer", ["party", "segment"]),
           "supplier": N.subtype_rolldown(rolled, "subtype", "supplier", ["party", "nation"])}
    return N.subtype_hacksaw(rolled.select("party", "name", "balance"), own, "party")


@query("denormalize", """
  SELECT c.c_custkey, c.c_nationkey, n.n_name, n.n_regionkey
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def q_denormalize(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", F.col("c_nationkey"))
    n = t(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return N.denormalize(c, n, "c_nationkey", ["n_name", "n_regionkey"]).withColumnRenamed(
        "c_nationkey", "c_nationkey")


@query("code_names", """
  SELECT o.o_orderkey, o.o_orderstatus, s.code_name FROM orders o LEFT JOIN
    (SELECT * FROM (VALUES ('STATUS', 'F', 'fulfilled'), ('STATUS', 'O', 'open'), ('STATUS', 'P', 'partial'),
                           ('FLAG', 'F', 'final')) v(code_group, code, code_name) WHERE code_group = 'STATUS') s
  ON o.o_orderstatus = s.code""")
def q_code_names(spark, sf):
    codes = spark.createDataFrame([("STATUS", "F", "fulfilled"), ("STATUS", "O", "open"),
                                   ("STATUS", "P", "partial"), ("FLAG", "F", "final")],
                                  "code_group string, code string, code_name string")
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return N.code_names(o, "o_orderstatus", codes, group="STATUS")


@query("standardize_terms", """
  SELECT p_partkey, coalesce(m.standard, p_type) AS p_type FROM part
  LEFT JOIN (VALUES ('ECONOMY', 'STANDARD'), ('SMALL', 'STANDARD'), ('PROMO', 'PROMOTION')) m(term, standard)
  ON p_type = m.term""")
def q_standardize_terms(spark, sf):
    m = spark.createDataFrame([("ECONOMY", "STANDARD"), ("SMALL", "STANDARD"), ("PROMO", "PROMOTION")],
                              "term string, standard string")
    return N.standardize_terms(t(spark, sf, "part").select("p_partkey", "p_type"), "p_type", m)


STD_DICT = {"customer": "cust", "number": "no", "name": "nm", "account": "acct", "balance": "bal"}


@query("standardize_columns", """
  SELECT c_custkey AS cust_no, c_name AS cust_nm, c_acctbal AS acct_bal FROM customer""")
def q_standardize_columns(spark, sf):
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("Customer Number"),
                                        F.col("c_name").alias("customer_name"),
                                        F.col("c_acctbal").alias("Account-Balance"))
    return N.standardize_columns(c, STD_DICT)


@query("bridge_join", """
  SELECT DISTINCT o.o_orderkey, p.p_partkey, p.p_name FROM orders o
  JOIN (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) b ON o.o_orderkey = b.l_orderkey
  JOIN part p ON b.l_partkey = p.p_partkey""")
def q_bridge_join(spark, sf):
    # both sides distinct, as the bridge's pairs are: so are the joined rows
    o = t(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey")).distinct()
    p = t(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name").distinct()
    out = N.bridge_join(o, t(spark, sf, "lineitem"), p, "l_orderkey", "l_partkey")
    return out.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"), "p_name")


@query("surrogate_key", """
  SELECT l_orderkey, l_linenumber, l_partkey, dense_rank() OVER (ORDER BY l_orderkey, l_linenumber) AS sk FROM lineitem""")
def q_surrogate_key(spark, sf):
    rows = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return N.surrogate_key(rows, ["l_orderkey", "l_linenumber"])


@query("audit_columns", """
  SELECT *, TIMESTAMP '2024-01-02 03:04:05' AS created_at, 'etl' AS created_by,
         TIMESTAMP '2024-01-02 03:04:05' AS updated_at, 'etl' AS updated_by FROM supplier""")
def q_audit_columns(spark, sf):
    return N.with_audit_columns(t(spark, sf, "supplier"), "etl", F.to_timestamp_ntz(F.lit("2024-01-02 03:04:05")))
