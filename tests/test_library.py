import pytest
"""Library functions not exercised by the registered queries."""

import uuid

from pyspark.sql import functions as F

from tessera.operators import changes as I
from tessera.operators import joins as D
from tessera.operators import quality as N
from tessera.session import checkpoint_dir


def test_create_and_drop_table(spark, tiny):
    name = f"t_{uuid.uuid4().hex[:10]}"
    nation = spark.read.parquet(f"{tiny}/nation.parquet")
    t = I.create_as(nation, name, path=f"{checkpoint_dir(spark)}/tables/{name}")
    assert t.count() == 25
    I.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_subtype_hacksaw(spark):
    top = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id int, name string")
    a, b = spark.createDataFrame([(1, 7)], "id int, a int"), spark.createDataFrame([(2, 0.5)], "id int, b double")
    rows = {tuple(r) for r in N.subtype_hacksaw(top, {"A": a, "B": b}, "id").select("id", "name", "a", "b", "subtype").collect()}
    assert rows == {(1, "x", 7, None, "A"), (2, "y", None, 0.5, "B"), (3, "z", None, None, None)}


def test_subtype_rolldown_and_banned_words(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, 3.5)], "id int, b double")
    rolled = N.subtype_rollup({"A": a, "B": b})
    assert rolled.count() == 2 and set(rolled.columns) == {"id", "a", "b", "subtype"}
    assert N.subtype_rolldown(rolled, "subtype", "B", ["id", "b"]).collect()[0].b == 3.5
    assert N.banned_words(["cust_tmp_no", "cust_nm"], ["tmp"]) == ["cust_tmp_no"]
    assert N.standard_name("Customer Number", {"customer": "cust", "number": "no"}) == "cust_no"


def test_fk_delete_modes(spark):
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    child = spark.createDataFrame([(10, 1), (11, 2), (12, 3), (13, None)], "id int, fk int")
    gone = parent.filter("pk = 1")
    assert sorted(r.id for r in N.fk_delete(gone, "pk", child, "fk", "cascade").collect()) == [11, 12, 13]
    assert [r.id for r in N.fk_delete(gone, "pk", child, "fk", "restrict").collect()] == [10]
    nulled = {r.id: r.fk for r in N.fk_delete(gone, "pk", child, "fk", "set_null").collect()}
    assert nulled == {10: None, 11: 2, 12: 3, 13: None}


def test_update_null_condition_keeps_value(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id int, v int")
    out = I.update_where(df, F.col("v") > 3, {"v": F.lit(0)})
    assert {r.id: r.v for r in out.collect()} == {1: None, 2: 0}
    assert I.delete_where(df, F.col("v") > 3).count() == 1       # null condition keeps the row


def test_single_csv_and_part_files(spark):
    import glob

    from tessera.sources import sinks as K
    df = spark.range(0, 500, 1, 6).withColumn("v", F.col("id") * 2)
    small = f"{checkpoint_dir(spark)}/t-single-{uuid.uuid4().hex}"
    K.write_csv(df, small, single=True)
    def files(p):
        return glob.glob(f"{p.removeprefix('file:')}/part-*.csv")
    assert len(files(small)) == 1
    big = f"{checkpoint_dir(spark)}/t-parts-{uuid.uuid4().hex}"
    K.write_csv(df, big)
    assert len(files(big)) > 1
    for path in (small, big):
        back = spark.read.option("header", True).schema("id long, v long").csv(path)
        assert back.count() == 500 and back.agg(F.sum("v")).first()[0] == 2 * sum(range(500))


def test_any_all_match_exists_rewrites(spark):
    # x op ANY (S) == EXISTS (s in S where x op s); x op ALL (S) == NOT EXISTS (s where NOT (x op s) or unknown)
    left = spark.createDataFrame([(1,), (2,), (3,), (None,)], "x int")
    sets = {"two": [(1,), (3,)], "one": [(2,)], "nulls": [(2,), (None,)], "empty": []}
    left.createOrReplaceTempView("l")
    for name, rows in sets.items():
        right = spark.createDataFrame(rows, "s int")
        right.createOrReplaceTempView("r")
        for op in ("=", "<>", ">", ">=", "<", "<="):
            got_any = sorted(r.x for r in D.any_of(left, "x", op, right, "s").collect())
            want_any = sorted(r.x for r in spark.sql(
                f"SELECT x FROM l WHERE EXISTS (SELECT 1 FROM r WHERE l.x {op} r.s)").collect())
            assert got_any == want_any, (name, op, "any")
            got_all = sorted((r.x for r in D.all_of(left, "x", op, right, "s").collect()), key=lambda v: (v is None, v))
            want_all = sorted((r.x for r in spark.sql(
                f"SELECT x FROM l WHERE NOT EXISTS (SELECT 1 FROM r WHERE NOT coalesce(l.x {op} r.s, false))"
                f" AND (NOT EXISTS (SELECT 1 FROM r WHERE (l.x {op} r.s) IS NULL) OR NOT EXISTS (SELECT 1 FROM r))").collect()),
                key=lambda v: (v is None, v))
            assert got_all == want_all, (name, op, "all")


def test_update_where_literals_of_every_kind(spark):
    df = spark.createDataFrame([(1, "a", 1.0, False), (2, "b", 2.0, False)], "k int, s string, x double, f boolean")
    out = I.update_where(df, F.col("k") == 2, {"s": "z", "x": 5, "f": True, "k": F.col("k") * 10})
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", 1.0, False), (20, "z", 5.0, True)]
    assert out.schema == df.schema


def test_write_parquet_partitioned_round_trip(spark):
    from tessera.sources import sinks as K
    df = spark.range(0, 300, 1, 5).select((F.col("id") % 4).alias("part"), F.col("id"))
    path = f"{checkpoint_dir(spark)}/t-pq-{uuid.uuid4().hex}"
    K.write_parquet(df, path, partition_by="part")
    back = spark.read.parquet(path)
    assert back.filter(F.col("part") == 2).count() == 75
    assert sorted(r.id for r in back.select("id").collect()) == list(range(300))


def test_check_fd_counts_a_missing_value(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (2, "b"), (3, None)], "x int, y string")
    assert [(r.x, r.n_values) for r in N.check_fd(df, "x", "y").collect()] == [(1, 2)]


def test_surrogate_keys_are_unique(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), (None, None), ("a", "a"), (None, "a")], "x string, y string").repartition(3)
    rows = [tuple(r) for r in N.surrogate_key(df, ["x", "y"]).collect()]
    keys = {(x, y): sk for x, y, sk in rows}
    assert len(rows) == 5 and sorted(keys.values()) == [1, 2, 3, 4] and all(keys[(x, y)] == sk for x, y, sk in rows)


def test_bad_times_are_dropped(spark):
    from tessera.plans.trips import clean_audit, clean_trips
    rows = [("2024-01-01 10:00:00", "2024-01-01 10:20:00", 2.0, 1.0), ("oops", "2024-01-01 10:20:00", 2.0, 1.0), ("2024-01-01 10:00:00", None, 2.0, 1.0)]
    raw = spark.createDataFrame(rows, "tpep_pickup_datetime string, tpep_dropoff_datetime string, trip_distance double, passenger_count double")
    assert clean_trips(raw).count() == 1
    assert tuple(clean_audit(raw).first())[:2] == (3, 1)


def test_cluster_needs_a_shared_folder(spark):
    from tessera import session

    class Unset:
        def isDefined(self):
            return False

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"
        _jsc = type("J", (), {"sc": staticmethod(lambda: type("S", (), {"getCheckpointDir": staticmethod(Unset)}))})
        getConf = staticmethod(Conf)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(type("Spark", (), {"sparkContext": Context})())


def test_table_function(spark):
    from pyspark.errors import PySparkException

    from tessera.operators.filters import TableFunction, param_query
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, v string")
    b = spark.createDataFrame([(7, "x")], "id int, v string")
    views, functions = len(spark.catalog.listTables()), len(spark.catalog.listFunctions())
    body = "SELECT id, v FROM {t} WHERE v = word OR id >= least_id"
    params = {"word": "STRING", "least_id": "INT"}
    # two of one body at a time, over different tables
    with TableFunction(spark, body, params, {"t": a}) as f, TableFunction(spark, body, params, {"t": b}) as g:
        both = f(word="x", least_id=3), g(word="x", least_id=9)
        assert f(word=None, least_id=None).count() == 0
        assert [tuple(r) for r in f(least_id="2", word="' OR true --").orderBy("id").collect()] == [(2, "y"), (3, None)]
        with pytest.raises(PySparkException):
            f(word="x", least_id="many").collect()
        with pytest.raises(TypeError):
            f(word="x")
        with pytest.raises(TypeError):
            f(word="x", least_id=1, more=2)
    # calls outlive the function, and nothing is left in the session
    assert sorted(tuple(r) for r in both[0].collect()) == [(1, "x"), (3, None)]
    assert [tuple(r) for r in both[1].collect()] == [(7, "x")]
    with pytest.raises(PySparkException):
        TableFunction(spark, "SELECT nothing FROM {t}", {}, {"t": a})
    assert param_query(spark, "SELECT count(*) AS n FROM {t}", {}, {}, {"t": a}).first()["n"] == 3
    assert (len(spark.catalog.listTables()), len(spark.catalog.listFunctions())) == (views, functions)


def test_declared_reader_puts_every_line_somewhere(spark, tmp_path):
    from tessera.sources.files import read_declared, read_lookup, read_parts
    (tmp_path / "parts").mkdir()
    (tmp_path / "parts" / "a.csv").write_text('id,name,when\n1,"x, y",2024-01-02\n2,z,not a day\n,nobody,2024-01-03\n3,"",\n')
    (tmp_path / "parts" / "b.csv").write_text("id,name,when\n4,w,2024-02-30,extra\n5\n99999999999,big,2024-01-01\n6,ok,2024-01-01\n")
    (tmp_path / "parts" / "empty.csv").write_text("id,name,when\n")
    schema = "id INT, name STRING, when DATE"
    read = read_parts(spark, str(tmp_path / "parts"), schema, "id")
    assert read.good.schema.simpleString() == "struct<id:int,name:string,when:date>"
    assert sorted((r["id"], r["name"], str(r["when"])) for r in read.good.collect()) == [
        (1, "x, y", "2024-01-02"), (3, None, "None"), (6, "ok", "2024-01-01")]
    assert sorted((r["file"][-5:], r["reason"], r["line"]) for r in read.bad.collect()) == [
        ("a.csv", "bad when", "2,z,not a day"), ("a.csv", "no id", ",nobody,2024-01-03"),
        ("b.csv", "bad id", "99999999999,big,2024-01-01"), ("b.csv", "malformed", "4,w,2024-02-30,extra"), ("b.csv", "malformed", "5")]
    # whatever columns are read, the same lines are good
    assert read.good.count() == read.good.select("name").count() == 3 and read.bad.count() == 5
    assert {r["name"] for r in read.good.select("name").collect()} == {"x, y", None, "ok"}
    with pytest.raises(Exception, match="(?i)header"):
        read_lookup(spark, str(tmp_path / "parts" / "b.csv"), "name STRING, id INT").good.collect()
    nothing = read_declared(spark, str(tmp_path / "parts" / "empty.csv"), schema)
    assert nothing.good.count() == nothing.bad.count() == 0


def test_saved_table_is_replaced_whole(spark, tmp_path):
    from tessera.sources.sinks import save_table
    name = f"t_{tmp_path.name.replace('-', '_')}"
    save_table(spark.range(5), name, path=str(tmp_path / "t"))
    save_table(spark.range(2).withColumnRenamed("id", "k"), name, path=str(tmp_path / "t"))
    assert spark.table(name).columns == ["k"] and spark.table(name).count() == 2
    spark.sql(f"DROP TABLE {name}")
