"""Source and sink round trips (A1-A19): data is written from the test tables
into a fresh folder under the shared checkpoint folder and read back through
the library's readers; the oracle is the original table."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.catalog import load, query
from tessera.catalog.html import GDP_SQL, gdp
from tessera.catalog.trips import CLEAN_SQL, PEAK_SQL, TRIPS_SQL, q_peak_hours
from tessera.catalog.text import TOK
from tessera.plans import ratings as P11
from tessera.plans import trips as TR
from tessera.session import checkpoint_dir
from tessera.sources import files as S
from tessera.sources import sinks as K


def scratch(spark, name):
    return f"{checkpoint_dir(spark)}/io/{name}-{uuid.uuid4().hex}"


@query("csv_roundtrip", "SELECT * FROM customer")
def q_csv_roundtrip(spark, sf):
    c = load(spark, sf, "customer")
    path = scratch(spark, "customer_csv")
    K.write_csv(c, path, single=False)
    return S.read_csv(spark, path, c.schema)


@query("csv_raw", """
  SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment
  FROM customer""")
def q_csv_raw(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    path = scratch(spark, "customer_raw")
    # a whole table grows with the data: part files, written in parallel
    K.write_csv(c, path, single=False)
    return S.read_csv_raw(spark, path)


@query("csv_single", f"SELECT * FROM ({PEAK_SQL}) p")
def q_csv_single(spark, sf):
    # A result bounded by construction (one row per hour of the day)
    # written as one CSV file, then read back with its schema
    peak = q_peak_hours(spark, sf)
    path = scratch(spark, "peak_csv")
    K.write_csv(peak, path, single=True)
    return S.read_csv(spark, path, peak.schema)


@query("headerless_latin1", """
  SELECT conv_id, turn, role, replace(text, chr(10), ' ') AS text FROM conversations""")
def q_headerless_latin1(spark, sf):
    c = load(spark, sf, "conversations").withColumn("text", F.regexp_replace("text", "\n", " "))
    path = scratch(spark, "conv_latin1")
    c.write.option("encoding", "ISO-8859-1").option("header", False).option("quoteAll", True).csv(path)
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                           T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    return S.read_headerless_csv(spark, path, schema, "ISO-8859-1")


@query("kv_lines", """
  SELECT CAST(l_partkey AS VARCHAR) AS key, round(avg(l_quantity), 1) AS mean FROM lineitem GROUP BY 1""")
def q_kv_lines(spark, sf):
    # P11 end to end: CSV lines with a header, key = field 1, value = field 2
    li = load(spark, sf, "lineitem")
    lines = li.select(F.concat_ws(",", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"),
                                  F.col("l_quantity").cast("string")).alias("value"))
    header = spark.createDataFrame([("orderId,partId,quantity",)], "value string")
    path = scratch(spark, "kv_lines")
    header.union(lines).write.text(path)
    return P11.movie_means(S.read_kv_lines(spark, path, 1, 2))


@query("text_lines", f"""
  SELECT word, count(*) AS count FROM (SELECT unnest(regexp_extract_all(lower(text), {TOK})) AS word
                                       FROM documents) w GROUP BY word""")
def q_text_lines(spark, sf):
    # P9 end to end: documents written as plain text lines, read back, counted
    from tessera.plans.text_jobs import word_count_job
    path = scratch(spark, "doc_lines")
    load(spark, sf, "documents").select(F.col("text").alias("value")).write.text(path)
    return word_count_job(S.read_lines(spark, path), "value")


@query("mixed_sources", f"""
  SELECT count(*) AS trips, count(*) FILTER (WHERE trip_id < 5000) AS from_parquet,
         count(*) FILTER (WHERE trip_id >= 5000) AS from_csv
  FROM ({TRIPS_SQL}) t""")
def q_mixed_sources(spark, sf):
    # two formats, different column order, a decoy file with another name pattern
    trips = TR.trips_from_events(load(spark, sf, "events"))
    base = scratch(spark, "mixed")
    trips.filter(F.col("trip_id") < 5000).write.parquet(f"{base}/yellow_tripdata_2024-01.parquet")
    csv_part = trips.filter(F.col("trip_id") >= 5000)
    csv_part.select(*reversed(csv_part.columns)).write.option("header", True).csv(
        f"{base}/yellow_tripdata_2024-02.csv")
    load(spark, sf, "nation").write.option("header", True).csv(f"{base}/weather_2024_central_park.csv")
    mixed = S.read_mixed(spark, base, "yellow_tripdata_*")
    return mixed.agg(F.count(F.lit(1)).alias("trips"), F.count_if(F.col("trip_id") < 5000).alias("from_parquet"),
                     F.count_if(F.col("trip_id") >= 5000).alias("from_csv"))


@query("parquet_partitioned", f"""
  SELECT CAST(tpep_pickup_datetime AS DATE) AS pickup_date, count(*) AS trips FROM ({CLEAN_SQL}) c GROUP BY 1""")
def q_parquet_partitioned(spark, sf):
    # P1 as a job: cleaned trips written partitioned by pickup date, read back with pruning
    src = scratch(spark, "raw_trips")
    TR.trips_from_events(load(spark, sf, "events")).write.parquet(f"{src}/yellow_tripdata_2024.parquet")
    out = TR.run_clean(spark, src, scratch(spark, "clean_trips"))
    return out.groupBy("pickup_date").agg(F.count(F.lit(1)).alias("trips"))


@query("json_roundtrip", GDP_SQL)
def q_json_roundtrip(spark, sf):
    g = gdp(spark, sf)
    path = scratch(spark, "gdp_json")
    K.write_json(g, path)
    return spark.read.schema(g.schema).json(path)


@query("tsv_parts", f"""
  SELECT word, count(*) AS count FROM (SELECT unnest(regexp_extract_all(lower(text), {TOK})) AS word
                                       FROM documents) w GROUP BY word""")
def q_tsv_parts(spark, sf):
    from tessera.operators.text import word_count
    path = scratch(spark, "wc_tsv")
    K.write_tsv(word_count(load(spark, sf, "documents"), "text"), path, 4, "word")
    return spark.read.schema("word string, count long").option("sep", "\t").csv(path)


@query("saved_table", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def q_saved_table(spark, sf):
    # saved twice: the second replaces the whole table
    o, name = load(spark, sf, "orders"), f"orders_{uuid.uuid4().hex}"
    path = scratch(spark, name)
    K.save_table(o.select("o_orderkey"), name, path=path)
    K.save_table(o.select("o_orderkey", "o_orderpriority"), name, path=path)
    return spark.table(name).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("literal_rows", """
  SELECT label, count(*) AS customers FROM customer
  JOIN (VALUES ('BUILDING', 'construction'), ('MACHINERY', 'industry'), ('AUTOMOBILE', 'industry')) v(segment, label)
    ON segment = c_mktsegment GROUP BY 1""")
def q_literal_rows(spark, sf):
    rows = [("BUILDING", "construction"), ("MACHINERY", "industry"), ("AUTOMOBILE", "industry")]
    labels = S.table_of(spark, rows, "c_mktsegment string, label string")
    return load(spark, sf, "customer").join(labels, "c_mktsegment").groupBy("label").agg(F.count(F.lit(1)).alias("customers"))
