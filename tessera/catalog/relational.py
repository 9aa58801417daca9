"""Relational core over the TPC-H-like tables (survey sections B, C, D, G, H).

Stand-ins: Customers -> customer, Orders -> orders, OrderDetails -> lineitem,
Products -> part, Suppliers -> supplier, Categories/Shippers -> nation/region.
"""

from pyspark.sql import functions as F

from tessera.catalog import load, query
from tessera.operators import columns as B
from tessera.operators import filters as C
from tessera.operators import joins as D
from tessera.operators import ordering as G
from tessera.operators import sets as H


def t(spark, sf, name):
    return load(spark, sf, name)


# ---------------------------------------------------------------- B: columns
@query("project", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def q_project(spark, sf):
    return B.project(t(spark, sf, "customer"), ["c_custkey", "c_name", "c_nationkey"])


@query("alias", 'SELECT c_custkey AS "id", c_name AS "Customer Name", c_acctbal AS "[Balance]" FROM customer')
def q_alias(spark, sf):
    c = t(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("Customer Name"),
                    F.col("c_acctbal").alias("[Balance]"))


@query("rename", "SELECT n_nationkey AS nation_id, n_name AS nation_name, n_regionkey FROM nation")
def q_rename(spark, sf):
    return B.rename(t(spark, sf, "nation"), {"n_nationkey": "nation_id", "n_name": "nation_name"})


@query("reorder", "SELECT o_totalprice, o_orderkey, o_custkey FROM orders")
def q_reorder(spark, sf):
    o = t(spark, sf, "orders").drop("o_orderpriority", "o_orderstatus", "o_orderdate")
    return B.reorder(o, ["o_totalprice", "o_orderkey", "o_custkey"])


@query("computed", """
  SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net_price,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross_price, 'lineitem' AS src
  FROM lineitem""")
def q_computed(spark, sf):
    li = t(spark, sf, "lineitem")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return B.compute(li, {"net_price": net,
                          "gross_price": net * (1 + F.col("l_tax")),
                          "src": F.lit("lineitem")}).select(
        "l_orderkey", "l_linenumber", "net_price", "gross_price", "src")


@query("tolerant_cast", """
  SELECT c_custkey, TRY_CAST(c_mktsegment AS INT) AS seg_as_int,
         TRY_CAST(CAST(c_nationkey AS VARCHAR) AS INT) AS nation_as_int FROM customer""")
def q_tolerant_cast(spark, sf):
    c = t(spark, sf, "customer")
    return c.select("c_custkey", F.col("c_mktsegment").try_cast("int").alias("seg_as_int"),
                    F.col("c_nationkey").cast("string").try_cast("int").alias("nation_as_int"))


@query("case_bands", """
  SELECT p_partkey,
         CASE WHEN p_retailprice < 920 THEN 'cheap' WHEN p_retailprice < 960 THEN 'mid' ELSE 'dear' END AS band,
         CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 20 THEN 'medium' END AS size_band
  FROM part""")
def q_case_bands(spark, sf):
    from tessera.functions.scalars import bands
    p = t(spark, sf, "part")
    return p.select("p_partkey", bands("p_retailprice", [(920, "cheap"), (960, "mid")], "dear").alias("band"),
                    bands("p_size", [(10, "small"), (20, "medium")]).alias("size_band"))


@query("concat_cols", """
  SELECT c_custkey,
         concat_ws(', ', c_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END) AS skip_nulls,
         c_name || ' / ' || CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS keep_nulls,
         concat_ws(' ', c_name, CAST(c_nationkey AS VARCHAR)) AS spaced
  FROM customer""")
def q_concat_cols(spark, sf):
    c = t(spark, sf, "customer")
    seg = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    return c.select("c_custkey", F.concat_ws(", ", "c_name", seg).alias("skip_nulls"),
                    F.concat(F.col("c_name"), F.lit(" / "), seg).alias("keep_nulls"),
                    F.concat_ws(" ", "c_name", F.col("c_nationkey").cast("string")).alias("spaced"))


@query("shape", "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_cols FROM lineitem")
def q_shape(spark, sf):
    return B.shape(t(spark, sf, "lineitem"))


@query("schema_profile", """
  SELECT * FROM (VALUES
    (0, 'c_custkey', 'bigint', (SELECT count(c_custkey) FROM customer)),
    (1, 'c_name', 'string', (SELECT count(c_name) FROM customer)),
    (2, 'c_nationkey', 'int', (SELECT count(c_nationkey) FROM customer)),
    (3, 'c_acctbal', 'double', (SELECT count(c_acctbal) FROM customer)),
    (4, 'c_mktsegment', 'string', (SELECT count(c_mktsegment) FROM customer)))
  AS v(position, "column", data_type, non_null)""")
def q_schema_profile(spark, sf):
    return B.schema_profile(t(spark, sf, "customer"))


@query("head_tail", """
  (SELECT *, 'head' AS side FROM orders ORDER BY o_orderkey LIMIT 5)
  UNION ALL (SELECT *, 'tail' AS side FROM orders ORDER BY o_orderkey DESC LIMIT 5)""")
def q_head_tail(spark, sf):
    return B.head_tail(t(spark, sf, "orders"), "o_orderkey", 5)


# ---------------------------------------------------------------- C: filters
@query("filter_eq", "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 7")
def q_filter_eq(spark, sf):
    c = t(spark, sf, "customer")
    return C.where(c, (F.col("c_mktsegment") == "BUILDING") & (F.col("c_nationkey") == 7))


@query("filter_cmp", """
  SELECT p_partkey, p_size, p_retailprice FROM part
  WHERE p_size > 10 AND p_retailprice < 950 AND p_size >= 12 AND p_size <> 20
    AND NOT p_retailprice > 940 AND NOT p_size < 15""")
def q_filter_cmp(spark, sf):
    p = t(spark, sf, "part")
    s, r = F.col("p_size"), F.col("p_retailprice")
    return C.where(p, (s > 10) & (r < 950) & (s >= 12) & (s != 20) & ~(r > 940) & ~(s < 15)).select(
        "p_partkey", "p_size", "p_retailprice")


@query("filter_and", """
  SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND o_totalprice > 200000""")
def q_filter_and(spark, sf):
    o = t(spark, sf, "orders")
    return C.where(o, (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
                   & (F.col("o_totalprice") > 200000))


@query("filter_or_prec", """
  SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal,
         (c_nationkey = 1 OR c_nationkey = 2) AND c_mktsegment = 'BUILDING' AS with_parens,
         c_nationkey = 1 OR c_nationkey = 2 AND c_mktsegment = 'BUILDING' AS without_parens
  FROM customer
  WHERE (c_nationkey = 1 OR c_nationkey = 2) AND c_mktsegment = 'BUILDING'
     OR c_nationkey = 3 OR c_acctbal > 9900""")
def q_filter_or_prec(spark, sf):
    c = t(spark, sf, "customer")
    n, seg = F.col("c_nationkey"), F.col("c_mktsegment")
    with_p = ((n == 1) | (n == 2)) & (seg == "BUILDING")
    without_p = (n == 1) | ((n == 2) & (seg == "BUILDING"))   # AND binds tighter than OR
    return C.where(c, with_p | (n == 3) | (F.col("c_acctbal") > 9900)).select(
        "c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal",
        with_p.alias("with_parens"), without_p.alias("without_parens"))


@query("filter_not", """
  SELECT p_partkey FROM part
  WHERE NOT p_type = 'SMALL' AND p_name NOT ILIKE '%bolt%' AND p_size NOT BETWEEN 10 AND 40
    AND p_brand NOT IN ('Brand#1', 'Brand#2', 'Brand#3')""")
def q_filter_not(spark, sf):
    p = t(spark, sf, "part")
    cond = (~(F.col("p_type") == "SMALL") & ~C.like_ci("p_name", "%bolt%")
            & ~F.col("p_size").between(10, 40) & ~F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3"))
    return C.where(p, cond).select("p_partkey")


@query("filter_null", """
  SELECT c_custkey, seg, seg IS NULL AS is_missing FROM (
    SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS seg FROM customer) x
  WHERE seg IS NULL OR c_custkey < 50""")
def q_filter_null(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", F.when(F.col("c_acctbal") >= 0,
                                                             F.col("c_mktsegment")).alias("seg"))
    return C.where(c, F.col("seg").isNull() | (F.col("c_custkey") < 50)).withColumn(
        "is_missing", F.col("seg").isNull())


LIKE_PATTERNS = ["s%", "%t", "%ed%", "b%t", "_ed%", "r_%", "blue bolt", "%E_ G%"]


@query("filter_like", "SELECT p_partkey, pattern FROM part, (VALUES " +
       ", ".join(f"('{p}')" for p in LIKE_PATTERNS) + ") v(pattern) WHERE p_name ILIKE pattern")
def q_filter_like(spark, sf):
    p = t(spark, sf, "part")
    parts = [C.where(p, C.like_ci("p_name", pat)).select("p_partkey", F.lit(pat).alias("pattern"))
             for pat in LIKE_PATTERNS]
    return H.union_all(*parts)


@query("filter_charclass", """
  SELECT p_partkey, p_name, regexp_matches(p_name, '^[bsp]', 'i') AS bsp,
         regexp_matches(p_name, '^[a-f]', 'i') AS a_to_f
  FROM part WHERE regexp_matches(p_name, '^[bsp]', 'i') OR regexp_matches(p_name, '^[a-f]', 'i')""")
def q_filter_charclass(spark, sf):
    p = t(spark, sf, "part")
    bsp, af = C.char_class("p_name", "bsp"), C.char_class("p_name", "a-f")
    return C.where(p, bsp | af).select("p_partkey", "p_name", bsp.alias("bsp"), af.alias("a_to_f"))


@query("filter_in", """
  SELECT o_orderkey, o_orderpriority FROM orders
  WHERE o_orderpriority IN ('1-URGENT', '5-LOW') OR o_orderstatus = 'P' OR o_orderstatus = 'X'""")
def q_filter_in(spark, sf):
    o = t(spark, sf, "orders")
    return C.where(o, F.col("o_orderpriority").isin("1-URGENT", "5-LOW")
                   | (F.col("o_orderstatus") == "P") | (F.col("o_orderstatus") == "X")).select(
        "o_orderkey", "o_orderpriority")


@query("filter_between", """
  SELECT o_orderkey FROM orders
  WHERE o_totalprice BETWEEN 100000 AND 200000
    AND o_orderpriority IN ('1-URGENT', '2-HIGH')
    AND o_orderstatus BETWEEN 'F' AND 'O'
    AND o_orderdate BETWEEN TIMESTAMP '1996-07-01' AND TIMESTAMP '1997-07-31'
    AND o_orderpriority NOT BETWEEN '3' AND '4'""")
def q_filter_between(spark, sf):
    o = t(spark, sf, "orders")
    cond = (F.col("o_totalprice").between(100000, 200000)
            & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
            & F.col("o_orderstatus").between("F", "O")
            & F.col("o_orderdate").between(F.lit("1996-07-01").cast("timestamp_ntz"),
                                           F.lit("1997-07-31").cast("timestamp_ntz"))
            & ~F.col("o_orderpriority").between("3", "4"))
    return C.where(o, cond).select("o_orderkey")


@query("filter_regex", """
  SELECT p_partkey FROM part WHERE regexp_matches(p_brand, '^Brand#1[0-9]$') AND contains(p_name, 'ring')""")
def q_filter_regex(spark, sf):
    p = t(spark, sf, "part")
    return C.where(p, F.col("p_brand").rlike("^Brand#1[0-9]$") & F.col("p_name").contains("ring")).select(
        "p_partkey")


@query("range_guard", """
  SELECT l_orderkey, l_linenumber FROM lineitem
  WHERE l_quantity > 5 AND l_quantity <= 45 AND l_discount >= 0.02 AND l_discount <= 0.08
    AND l_shipdate IS NOT NULL""")
def q_range_guard(spark, sf):
    li = t(spark, sf, "lineitem")
    return C.range_guard(li, {"l_quantity": (5, True, 45), "l_discount": (0.02, False, 0.08)},
                         not_null=["l_shipdate"]).select("l_orderkey", "l_linenumber")


@query("threshold", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 9000 ORDER BY c_acctbal DESC")
def q_threshold(spark, sf):
    return C.threshold(t(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", 9000)


@query("label_split", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def q_label_split(spark, sf):
    return t(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("empty_like", "SELECT * FROM customer WHERE 1 = 0")
def q_empty_like(spark, sf):
    return C.empty_like(t(spark, sf, "customer"))


@query("param_query", "SELECT c_custkey, c_name FROM customer WHERE c_nationkey = 5 AND c_mktsegment = 'MACHINERY'")
def q_param_query(spark, sf):
    return C.param_query(spark, "SELECT c_custkey, c_name FROM {customer} WHERE c_nationkey = nation AND c_mktsegment = seg",
                         {"nation": "INT", "seg": "STRING"}, {"nation": 5, "seg": "MACHINERY"}, {"customer": t(spark, sf, "customer")})


@query("table_function_join", """
  SELECT seg, nation, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
  FROM (SELECT * FROM (VALUES ('BUILDING', 1), ('MACHINERY', 5), ('MACHINERY', 7)) v(seg, nation)) a
  JOIN customer ON c_mktsegment = seg AND c_nationkey = nation
  JOIN nation n ON n_nationkey = c_nationkey GROUP BY 1, 2""")
def q_table_function_join(spark, sf):
    """One stored query, called with three sets of arguments."""
    body = """SELECT c_mktsegment AS seg, c_nationkey AS nation, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
              FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey WHERE c_mktsegment = segment AND c_nationkey = nation_key
              GROUP BY c_mktsegment, c_nationkey"""
    tables = {"customer": t(spark, sf, "customer"), "nation": t(spark, sf, "nation")}
    with C.TableFunction(spark, body, {"segment": "STRING", "nation_key": "INT"}, tables) as call:
        parts = [call(segment=s, nation_key=n) for s, n in (("BUILDING", 1), ("MACHINERY", 5), ("MACHINERY", 7))]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("code_filter", """
  SELECT o_orderkey, trim(pri) AS priority FROM (
    SELECT o_orderkey, ' ' || o_orderpriority || '  ' AS pri FROM orders) x
  WHERE trim(pri) IN ('1-URGENT', '2-HIGH')""")
def q_code_filter(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", F.concat(F.lit(" "), "o_orderpriority", F.lit("  ")).alias("pri"))
    return C.code_filter(o, "pri", ["1-URGENT", "2-HIGH"]).select("o_orderkey", F.trim("pri").alias("priority"))


@query("drop_sentinel", "SELECT n_nationkey, n_name FROM nation WHERE n_name NOT IN ('NATION_0', 'NATION_24')")
def q_drop_sentinel(spark, sf):
    return C.drop_sentinel(t(spark, sf, "nation").select("n_nationkey", "n_name"), "n_name",
                           ["NATION_0", "NATION_24"])


# ---------------------------------------------------------------- D: joins
@query("join_inner", """
  SELECT o.o_orderkey, c.c_name, o.o_totalprice FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def q_join_inner(spark, sf):
    o, c = t(spark, sf, "orders").alias("o"), t(spark, sf, "customer").alias("c")
    return o.join(c, F.col("o.o_custkey") == F.col("c.c_custkey")).select("o.o_orderkey", "c.c_name", "o.o_totalprice")


@query("join_multi", """
  SELECT o.o_orderkey, c.c_name, n.n_name FROM orders o
  INNER JOIN customer c ON o.o_custkey = c.c_custkey INNER JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def q_join_multi(spark, sf):
    o, c, n = (t(spark, sf, x) for x in ("orders", "customer", "nation"))
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .select("o_orderkey", "c_name", "n_name"))


@query("join_left", """
  SELECT c.c_custkey, c.c_name, o.o_orderkey FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey""")
def q_join_left(spark, sf):
    c, o = t(spark, sf, "customer"), t(spark, sf, "orders")
    return c.join(o, c.c_custkey == o.o_custkey, "left").select("c_custkey", "c_name", "o_orderkey")


@query("join_anti", """
  SELECT c.c_custkey, c.c_name FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
  WHERE o.o_orderkey IS NULL""")
def q_join_anti(spark, sf):
    c, o = t(spark, sf, "customer"), t(spark, sf, "orders")
    return D.anti(c, o, c.c_custkey == o.o_custkey).select("c_custkey", "c_name")


@query("join_right", """
  SELECT o.o_orderkey, n.n_nationkey, n.n_name FROM
    orders o JOIN customer c ON o.o_custkey = c.c_custkey
    RIGHT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def q_join_right(spark, sf):
    o = t(spark, sf, "orders")
    c, n = t(spark, sf, "customer"), t(spark, sf, "nation")
    oc = o.join(c, o.o_custkey == c.c_custkey)
    return oc.join(n, oc.c_nationkey == n.n_nationkey, "right").select("o_orderkey", "n_nationkey", "n_name")


@query("join_full", """
  SELECT coalesce(c.nationkey, s.nationkey) AS nationkey,
         coalesce(c.customers, 0) AS customers, coalesce(s.suppliers, 0) AS suppliers
  FROM (SELECT c_nationkey AS nationkey, count(*) AS customers FROM customer WHERE c_nationkey < 15 GROUP BY 1) c
  FULL OUTER JOIN (SELECT s_nationkey AS nationkey, count(*) AS suppliers FROM supplier WHERE s_nationkey > 8 GROUP BY 1) s
  ON c.nationkey = s.nationkey""")
def q_join_full(spark, sf):
    c = (t(spark, sf, "customer").filter(F.col("c_nationkey") < 15)
         .groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("customers")))
    s = (t(spark, sf, "supplier").filter(F.col("s_nationkey") > 8)
         .groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("suppliers")))
    return D.join(c, s, ["nationkey"], "full").na.fill({"customers": 0, "suppliers": 0})


@query("join_self", """
  SELECT a.l_orderkey, a.l_linenumber, b.l_linenumber AS next_linenumber, b.l_quantity - a.l_quantity AS qty_change
  FROM lineitem a, lineitem b
  WHERE a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1 AND a.l_partkey <> b.l_partkey""")
def q_join_self(spark, sf):
    # self join with an equality plus extra predicates; each line meets only its successor
    li = t(spark, sf, "lineitem")
    a, b = li.alias("a"), li.alias("b")
    cond = ((F.col("a.l_orderkey") == F.col("b.l_orderkey"))
            & (F.col("b.l_linenumber") == F.col("a.l_linenumber") + 1)
            & (F.col("a.l_partkey") != F.col("b.l_partkey")))
    return a.join(b, cond).select(F.col("a.l_orderkey"), F.col("a.l_linenumber"),
                                  F.col("b.l_linenumber").alias("next_linenumber"),
                                  (F.col("b.l_quantity") - F.col("a.l_quantity")).alias("qty_change"))


@query("semi_in", """
  SELECT c_custkey, c_name FROM customer
  WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 300000)""")
def q_semi_in(spark, sf):
    c = t(spark, sf, "customer")
    o = t(spark, sf, "orders").filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 300000))
    return D.semi(c, o, c.c_custkey == o.o_custkey).select("c_custkey", "c_name")


@query("anti_not_in", """
  SELECT c_custkey FROM customer
  WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)""")
def q_anti_not_in(spark, sf):
    s = t(spark, sf, "supplier").filter(F.col("s_acctbal") > 5000)
    return D.not_in(t(spark, sf, "customer"), "c_nationkey", s, "s_nationkey").select("c_custkey")


@query("anti_not_in_null", """
  SELECT c_custkey FROM customer
  WHERE c_nationkey NOT IN (SELECT CASE WHEN s_acctbal > 9000 THEN NULL ELSE s_nationkey END FROM supplier)""")
def q_anti_not_in_null(spark, sf):
    # one null in the list: NOT IN is never true, the result is empty
    s = t(spark, sf, "supplier").select(
        F.when(F.col("s_acctbal") <= 9000, F.col("s_nationkey")).alias("k"))
    return D.not_in(t(spark, sf, "customer"), "c_nationkey", s, "k").select("c_custkey")


@query("semi_exists", """
  SELECT o_orderkey FROM orders o
  WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_quantity > 45)""")
def q_semi_exists(spark, sf):
    o = t(spark, sf, "orders")
    li = t(spark, sf, "lineitem")
    return D.semi(o, li, (o.o_orderkey == li.l_orderkey) & (li.l_quantity > 45)).select("o_orderkey")


@query("any_subquery", """
  SELECT p_partkey FROM part
  WHERE p_partkey = ANY (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)
     OR p_retailprice > ANY (SELECT p_retailprice FROM part WHERE p_size = 50 AND p_brand = 'Brand#9')""")
def q_any_subquery(spark, sf):
    p = t(spark, sf, "part")
    li = t(spark, sf, "lineitem").filter(F.col("l_quantity") == 50)
    ref = p.filter((F.col("p_size") == 50) & (F.col("p_brand") == "Brand#9"))
    a = D.any_of(p, "p_partkey", "=", li, "l_partkey").select("p_partkey")
    b = D.any_of(p, "p_retailprice", ">", ref, "p_retailprice").select("p_partkey")
    return H.union_distinct(a, b)


@query("all_subquery", """
  SELECT p_partkey, 'gt' AS test FROM part
  WHERE p_retailprice > ALL (SELECT p_retailprice FROM part WHERE p_size = 1)
  UNION ALL
  SELECT p_partkey, 'eq_empty' AS test FROM part
  WHERE p_size = ALL (SELECT p_size FROM part WHERE p_size > 1000)""")
def q_all_subquery(spark, sf):
    p = t(spark, sf, "part")
    gt = D.all_of(p, "p_retailprice", ">", p.filter(F.col("p_size") == 1), "p_retailprice")
    eq = D.all_of(p, "p_size", "=", p.filter(F.col("p_size") > 1000), "p_size")   # empty set: all rows
    return H.union_all(gt.select("p_partkey", F.lit("gt").alias("test")),
                       eq.select("p_partkey", F.lit("eq_empty").alias("test")))


@query("above_avg", """
  SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice > (SELECT avg(p_retailprice) FROM part)""")
def q_above_avg(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", "p_retailprice")
    return D.above_scalar(p, "p_retailprice", F.avg("p_retailprice"))


@query("lookup_enrich", """
  SELECT c.c_custkey, coalesce(n.n_name, 'not found') AS n_name
  FROM customer c LEFT JOIN (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey < 3) n
    ON c.c_nationkey = n.n_nationkey""")
def q_lookup_enrich(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    n = t(spark, sf, "nation").filter(F.col("n_regionkey") < 3).select("n_nationkey", "n_name")
    return D.lookup(c, n, "n_nationkey", {"n_name": "not found"}).select(
        "c_custkey", "n_name")


@query("dense_dimension", """
  SELECT n.n_nationkey, coalesce(s.suppliers, 0) AS suppliers
  FROM nation n LEFT JOIN (SELECT s_nationkey, count(*) AS suppliers FROM supplier
                           WHERE s_acctbal > 2000 GROUP BY 1) s ON n.n_nationkey = s.s_nationkey""")
def q_dense_dimension(spark, sf):
    s = (t(spark, sf, "supplier").filter(F.col("s_acctbal") > 2000)
         .groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("suppliers")))
    return D.dense(t(spark, sf, "nation").select("n_nationkey"), s, "n_nationkey", {"suppliers": 0})


@query("bucket_pivot", """
  SELECT l_returnflag,
         count(*) FILTER (WHERE l_linestatus = 'O') AS O_lines,
         round(sum(l_quantity) FILTER (WHERE l_linestatus = 'O'), 2) AS O_qty,
         count(*) FILTER (WHERE l_linestatus = 'F') AS F_lines,
         round(sum(l_quantity) FILTER (WHERE l_linestatus = 'F'), 2) AS F_qty
  FROM lineitem GROUP BY 1""")
def q_bucket_pivot(spark, sf):
    li = t(spark, sf, "lineitem")
    return D.bucket_pivot(li, "l_returnflag", "l_linestatus", ["O", "F"],
                          {"lines": lambda m: F.count_if(m),
                           "qty": lambda m: F.round(F.sum(F.when(m, F.col("l_quantity"))), 2)})


# ---------------------------------------------------------------- G: ordering
@query("sort_multi", """
  SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal FROM customer
  ORDER BY c_nationkey ASC, c_mktsegment DESC, c_acctbal DESC, c_custkey""")
def q_sort_multi(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    return G.sort(c, [F.col("c_nationkey").asc(), F.col("c_mktsegment").desc(),
                      F.col("c_acctbal").desc(), "c_custkey"])


@query("sort_nulls", """
  SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS bal FROM customer
  ORDER BY bal DESC NULLS LAST, c_custkey""")
def q_sort_nulls(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("bal"))
    return G.sort(c, [F.col("bal").desc_nulls_last(), "c_custkey"])


@query("limit_n", """
  SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderkey LIMIT 10""")
def q_limit_n(spark, sf):
    o = t(spark, sf, "orders").filter(F.col("o_orderstatus") == "O").select("o_orderkey", "o_totalprice")
    return G.topk(o, ["o_orderkey"], 10)


@query("topk", "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10")
def q_topk(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return G.topk(c, [F.col("c_acctbal").desc(), "c_custkey"], 10)


@query("top_percent", """
  SELECT p_partkey, p_retailprice, rank FROM (
    SELECT p_partkey, p_retailprice, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part) x
  WHERE rank <= ceil((SELECT count(*) FROM part) * 5 / 100.0)""")
def q_top_percent(spark, sf):
    from tessera.operators.ranges import desc
    p = t(spark, sf, "part").select("p_partkey", "p_retailprice")
    return G.top_percent(p, [desc("p_retailprice"), "p_partkey"], 5)


@query("global_rank", """
  SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders""")
def q_global_rank(spark, sf):
    from tessera.operators.ranges import desc
    from tessera.operators.windows import global_rank
    o = t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return global_rank(o, [desc("o_totalprice"), "o_orderkey"], "rank").select("o_orderkey", "rank")


@query("sample_n", """
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM (
    SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5(c_custkey || '|42'), c_custkey) AS r FROM customer) x
  WHERE r <= 5""")
def q_sample_n(spark, sf):
    # seeded hash sample: 5 customers per segment
    return G.sample_n(t(spark, sf, "customer"), "c_mktsegment", "c_custkey", 5, seed=42)


# ---------------------------------------------------------------- H: sets
@query("union_distinct", """
  SELECT c_nationkey AS nationkey FROM customer WHERE c_acctbal > 9000
  UNION SELECT s_nationkey FROM supplier""")
def q_union_distinct(spark, sf):
    c = t(spark, sf, "customer").filter(F.col("c_acctbal") > 9000).select(F.col("c_nationkey").alias("nationkey"))
    return H.union_distinct(c, t(spark, sf, "supplier").select("s_nationkey"))


@query("union_all", """
  SELECT c_nationkey AS nationkey FROM customer WHERE c_acctbal > 9000
  UNION ALL SELECT s_nationkey FROM supplier WHERE s_acctbal > 0""")
def q_union_all(spark, sf):
    c = t(spark, sf, "customer").filter(F.col("c_acctbal") > 9000).select(F.col("c_nationkey").alias("nationkey"))
    s = t(spark, sf, "supplier").filter(F.col("s_acctbal") > 0).select("s_nationkey")
    return H.union_all(c, s)


@query("union_tagged", """
  SELECT 'Customer' AS source, c_name AS name, c_nationkey AS nationkey FROM customer
  UNION ALL SELECT 'Supplier', s_name, s_nationkey FROM supplier""")
def q_union_tagged(spark, sf):
    c = t(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"))
    s = t(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"))
    return H.union_tagged({"Customer": c, "Supplier": s})
