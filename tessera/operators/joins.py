"""Joins (D1-D18).

Small sides are never broadcast blindly: dimension/lookup joins are planned
as ordinary joins and AQE switches them to broadcast when the runtime size of
the small side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
Subquery operators use scalar subqueries (one-row aggregates inlined as
values), never cross joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalars import hour_start


def join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Equi joins. With ``on`` as a list of names, full joins coalesce the key."""
    return left.join(right, on, how)


def semi(left: DataFrame, right: DataFrame, on, extra: Column | None = None) -> DataFrame:
    """D8/D10/D11(=ANY): rows of ``left`` with a match (IN / EXISTS)."""
    if extra is None:
        return left.join(right, on, "left_semi")
    if isinstance(on, str):
        on = [on]
    if isinstance(on, (list, tuple)):
        l, r = left.alias("l"), right.alias("r")
        cond = None
        for k in on:
            c = F.col(f"l.{k}") == F.col(f"r.{k}")
            cond = c if cond is None else cond & c
        return l.join(r, cond & extra, "left_semi")
    return left.join(right, on & extra, "left_semi")


def anti(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` without a match (LEFT JOIN ... IS NULL)."""
    return left.join(right, on, "left_anti")


def not_in(left: DataFrame, col: str, right: DataFrame, col2: str) -> DataFrame:
    """SQL ``NOT IN (subquery)`` with its null rules: one null in the list
    empties the result; a null probe value passes only when the list is empty.

    Built from an ordinary anti join (hash or sort-merge, chosen by size at
    runtime) plus two scalar counts, instead of the null-aware anti join that
    Spark can only plan when the list side is broadcastable (otherwise it
    falls back to a nested-loop join)."""
    keys = right.select(F.col(col2).alias("_k"))
    n_list = keys.select(F.count(F.lit(1))).scalar()
    n_null = keys.select(F.count_if(F.col("_k").isNull())).scalar()
    unmatched = left.join(keys.filter(F.col("_k").isNotNull()).distinct(), F.col(col) == F.col("_k"), "left_anti")
    return unmatched.filter((n_null == 0) & (F.col(col).isNotNull() | (n_list == 0)))


_OPS = {"=": lambda a, b: a == b, "<>": lambda a, b: a != b, ">": lambda a, b: a > b,
        ">=": lambda a, b: a >= b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b}


def _set_stats(right: DataFrame, col2: str):
    s = right.select(F.count(F.lit(1)).alias("n"), F.count_if(F.col(col2).isNull()).alias("n_null"),
                     F.min(col2).alias("lo"), F.max(col2).alias("hi"))
    return (s.select("n").scalar(), s.select("n_null").scalar(),
            s.select("lo").scalar(), s.select("hi").scalar())


def any_of(left: DataFrame, col: str, op: str, right: DataFrame, col2: str) -> DataFrame:
    """``col op ANY (subquery)`` (keeps rows where the predicate is true)."""
    if op == "=":
        return left.filter(F.col(col).isin(right.select(col2)))
    n, n_null, lo, hi = _set_stats(right, col2)
    x = F.col(col)
    if op in (">", ">="):
        return left.filter(_OPS[op](x, lo))
    if op in ("<", "<="):
        return left.filter(_OPS[op](x, hi))
    if op == "<>":
        # a null probe compares as unknown with every member: never true
        return left.filter(x.isNotNull() & ((lo != hi) | (x != lo)))
    raise ValueError(op)


def all_of(left: DataFrame, col: str, op: str, right: DataFrame, col2: str) -> DataFrame:
    """``col op ALL (subquery)``: true on an empty set; a null in the set
    makes the predicate unknown (row dropped) unless a counter-example exists."""
    if op == "<>":
        # differs from every member: exactly NOT IN, with its null rules
        return not_in(left, col, right, col2)
    n, n_null, lo, hi = _set_stats(right, col2)
    x = F.col(col)
    if op == "=":
        holds = (lo == hi) & (x == lo)
    elif op in (">", ">="):
        holds = _OPS[op](x, hi)
    elif op in ("<", "<="):
        holds = _OPS[op](x, lo)
    else:
        raise ValueError(op)
    return left.filter((n == 0) | ((n_null == 0) & F.coalesce(holds, F.lit(False))))


def above_scalar(df: DataFrame, col: str, agg: Column, source: DataFrame | None = None) -> DataFrame:
    """Compare with a scalar subquery, e.g. price > (SELECT avg(price) ...)."""
    src = df if source is None else source
    return df.filter(F.col(col) > src.select(agg).scalar())


def join_on_hour(left: DataFrame, ts: str, right: DataFrame, ts2: str, how: str = "inner",
                 name: str = "obs_hour") -> DataFrame:
    """Equi join on both timestamps truncated to the hour."""
    l = left.withColumn(name, hour_start(ts))
    r = right.withColumn(name, hour_start(ts2))
    return l.join(r, name, how)


def lookup(df: DataFrame, dim: DataFrame, on, default: dict | None = None) -> DataFrame:
    """Enrich from a lookup table, keeping unmatched rows; missing
    attributes get ``default`` values (e.g. 'not found')."""
    out = df.join(dim, on, "left")
    return out.na.fill(default) if default else out


def dense(dim: DataFrame, facts: DataFrame, on, fills: dict) -> DataFrame:
    """Every dimension member kept, missing counts filled (e.g. 0)."""
    return dim.join(facts, on, "left").na.fill(fills)


def bucket_pivot(df: DataFrame, key, bucket: str, buckets, aggs: dict) -> DataFrame:
    """One conditional aggregate per (bucket, measure) instead of joining
    per-bucket aggregates of the same table: one scan, one shuffle.

    ``aggs`` maps an output suffix to a function ``(Column mask) -> Column``
    building the aggregate over rows of one bucket, e.g.
    ``{"trip_count": lambda m: F.count_if(m)}``.
    """
    exprs = []
    for b in buckets:
        m = F.col(bucket) == F.lit(b)
        for name, fn in aggs.items():
            exprs.append(fn(m).alias(f"{b}_{name}"))
    keys = [key] if isinstance(key, (str, Column)) else list(key)
    return df.groupBy(*keys).agg(*exprs)
