"""Physical plan shape: pushdown, pruning, group limits, no pairwise joins."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from tessera.catalog import all_queries


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filter_and_columns_reach_the_scan(spark, tiny):
    p = plan(E.queries()["filter_eq"](spark, tiny))
    assert "PushedFilters: [IsNotNull(c_mktsegment), IsNotNull(c_nationkey), EqualTo(c_mktsegment,BUILDING)" in p
    p = plan(E.queries()["project"](spark, tiny))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_nationkey:int>" in p


def test_topn_uses_group_limit(spark, tiny):
    assert "WindowGroupLimit" in plan(E.queries()["topn_rownumber"](spark, tiny))


def test_topk_is_take_ordered(spark, tiny):
    assert "TakeOrderedAndProject" in plan(E.queries()["topk"](spark, tiny))


def test_scalar_subqueries_not_cross_joins(spark, tiny):
    p = plan(E.queries()["zscore"](spark, tiny))
    assert "Subquery" in p and "CartesianProduct" not in p and "NestedLoopJoin" not in p


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_pairwise_join(spark, tiny, name):
    p = plan(E.queries()[name](spark, tiny))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", ["html_tables", "gdp_topn"])
def test_pages_are_parsed_once(spark, tiny, name):
    tree = plan(E.queries()[name](spark, tiny)).split("\n\n")[0]
    assert tree.count("MapInPandas") == 1


def test_aggregates_are_partial(spark, tiny):
    p = plan(E.queries()["word_count"](spark, tiny))
    assert "partial_count" in p


@pytest.mark.parametrize("name", ["gap_minutes", "global_rank", "top_percent"])
def test_rows_are_dealt_by_range_number(spark, tiny, name):
    p = plan(E.queries()[name](spark, tiny)).lower()
    assert "shufflepartitionidpassthrough" in p and "rangepartitioning" not in p
    # no Python pass, and the window never stands on the (hot) key alone
    assert "mapinarrow" not in p and "hashpartitioning(service" not in p
    assert "broadcasthashjoin" in p


def test_partitioned_write_one_file_per_small_day(spark, tiny):
    import glob
    import uuid

    from tessera.plans import trips as TR
    from tessera.session import checkpoint_dir
    root = f"{checkpoint_dir(spark)}/t-clean-{uuid.uuid4().hex}"
    src, out = f"{root}/raw", f"{root}/out"
    TR.trips_from_events(spark.read.parquet(f"{tiny}/events.parquet")).write.parquet(f"{src}/yellow_tripdata_x.parquet")
    back = TR.run_clean(spark, src, out)
    days = glob.glob(f"{out.removeprefix('file:')}/pickup_date=*")
    files = glob.glob(f"{out.removeprefix('file:')}/pickup_date=*/*.parquet")
    assert back.count() > 0 and len(days) > 1
    assert len(files) == len(days)          # small days: one file each, not one per scan task
