"""Aggregates (E1-E34). Every aggregate here is algebraic or a bounded sketch,
so Spark runs a partial (map-side) aggregate before the shuffle and a hot key
costs one row per task, not its whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalars import hour_start, safe_ratio  # noqa: F401  (safe_ratio re-exported, E28)
from tessera.operators.quantiles import exact_quantiles


def agg(df: DataFrame, keys, exprs: dict, having: Column | None = None, order=None) -> DataFrame:
    """GROUP BY keys with named aggregates, optional HAVING and ORDER BY."""
    keys = [keys] if isinstance(keys, str) else list(keys or [])
    named = [e.alias(n) for n, e in exprs.items()]
    out = df.groupBy(*keys).agg(*named) if keys else df.agg(*named)
    if having is not None:
        out = out.filter(having)
    if order is not None:
        out = out.orderBy(*order)
    return out


def count_distinct(df: DataFrame, col: str, name: str = "n_distinct") -> DataFrame:
    """E4."""
    return df.agg(F.countDistinct(col).alias(name))


def hourly_profile(df: DataFrame, ts: str, name: str = "pickup_hour", count: str = "trip_count") -> DataFrame:
    """Rows per hour of day (0-23), any date."""
    return df.groupBy(F.hour(ts).alias(name)).agg(F.count(F.lit(1)).alias(count))


def hourly_counts(df: DataFrame, ts: str, name: str = "obs_hour", count: str = "trip_count") -> DataFrame:
    """Rows per calendar hour."""
    return df.groupBy(hour_start(ts).alias(name)).agg(F.count(F.lit(1)).alias(count))


def percentile_by(df: DataFrame, keys, col: str, p: float, name: str = "pct", exact: bool = True,
                  accuracy: int = 10000, once: bool = False) -> DataFrame:
    """Percentile per group: the value at position ``max(1, ceil(p * n))``
    of the group's sorted non-null values (``exact_quantiles``: no group is held
    whole). ``exact=False`` uses the mergeable sketch at ``accuracy`` instead.
    Groups without a value get null. ``once``: see ``exact_quantiles``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not exact:
        return df.groupBy(*keys).agg(F.percentile_approx(col, p, accuracy).alias(name))
    found = exact_quantiles(df, [col], [p], keys=keys, once=once).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                                                              F.col("value").cast(df.schema[col].dataType).alias(name))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return df.select(*keys).distinct().join(found, same, "left").select(*keys, name)


def mean_by_key(df: DataFrame, key: str, value: str, digits: int = 1, name: str = "mean") -> DataFrame:
    """Mean per key rounded half-up to ``digits``."""
    return df.groupBy(key).agg(F.round(F.avg(value), digits).alias(name))


def count_mean_by_key(df: DataFrame, key: str, value: str, digits: int = 1) -> DataFrame:
    """Count and rounded mean per key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(value), digits).alias("mean"))


def size_by_pair(df: DataFrame, a: str, b: str) -> DataFrame:
    """E20."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("size"))


def crosstab(df: DataFrame, a: str, b: str, values=None) -> DataFrame:
    """Counts of ``a`` x ``b`` as columns, zeros filled. Pass ``values`` (the
    column labels) to avoid a distinct pass over ``b``."""
    return df.groupBy(a).pivot(b, values).count().na.fill(0)


def nonnull_by_key(df: DataFrame, key: str, cols=None) -> DataFrame:
    """Non-null count of every column per key."""
    cols = [c for c in (cols or df.columns) if c != key]
    return df.groupBy(key).agg(*[F.count(c).alias(c) for c in cols])


def describe(df: DataFrame, cols, exact: bool = True, accuracy: int = 10_000) -> DataFrame:
    """Per column count, mean, std (n-1), min, 25/50/75 %, max, long format.

    Quartiles are exact and interpolated by default (``exact_quantiles``: no
    group held whole). ``exact=False`` uses the mergeable ``percentile_approx``
    sketch at ``accuracy`` instead (one pass)."""
    moments = []
    for c in cols:
        x = F.col(c).cast("double")
        fields = [F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"),
                  F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")]
        if not exact:
            q = F.percentile_approx(x, [0.25, 0.5, 0.75], accuracy)
            fields += [q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75")]
        moments.append(F.struct(*fields))
    out = df.agg(F.array(*moments).alias("r")).select(F.inline("r"))
    if exact:
        q = exact_quantiles(df, cols, [0.25, 0.5, 0.75], interpolate=True)
        wide = q.groupBy("column").agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(name)
                                         for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
        out = out.join(wide, "column", "left")
    return out.select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def corr_matrix(df: DataFrame, cols) -> DataFrame:
    """Pearson r of every column pair (both orders, diagonal 1), one pass."""
    pairs = [(a, b) for a in cols for b in cols]
    rows = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                              F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("r"))
                     for a, b in pairs])
    return df.agg(rows.alias("r")).select(F.inline("r"))


def histogram(df: DataFrame, cols, bins: int = 10) -> DataFrame:
    """Equal-width bins per column between its min and max; the max value
    falls in the last bin; empty bins are listed with count 0.

    One scan: min/max of every column come from one merged scalar-subquery
    aggregate; each row emits one (column, bin) pair per column and a single
    grouped count follows."""
    lo = {c: df.select(F.min(F.col(c).cast("double"))).scalar() for c in cols}
    hi = {c: df.select(F.max(F.col(c).cast("double"))).scalar() for c in cols}

    def bin_of(c):
        x = F.col(c).cast("double")
        b = F.floor((x - lo[c]) * bins / F.nullif(hi[c] - lo[c], F.lit(0.0))) + 1
        return F.when(x.isNotNull(), F.least(F.coalesce(b, F.lit(1)), F.lit(bins)).cast("long"))

    pairs = F.array(*[F.struct(F.lit(c).alias("column"), bin_of(c).alias("bin")) for c in cols])
    counted = (df.select(F.inline(pairs)).filter(F.col("bin").isNotNull())
               .groupBy("column", "bin").agg(F.count(F.lit(1)).alias("count")))
    spark = df.sparkSession
    grid = spark.createDataFrame([(c, b) for c in cols for b in range(1, bins + 1)], "column string, bin long")
    lo_col = F.coalesce(*[F.when(F.col("column") == c, lo[c]) for c in cols])
    hi_col = F.coalesce(*[F.when(F.col("column") == c, hi[c]) for c in cols])
    width = (hi_col - lo_col) / F.lit(bins)
    return grid.join(counted, ["column", "bin"], "left").select(
        "column", "bin", (lo_col + (F.col("bin") - 1) * width).alias("lower"),
        (lo_col + F.col("bin") * width).alias("upper"), F.coalesce("count", F.lit(0)).alias("count"))


def min_sample(df: DataFrame, count_cols, n: int, name: str = "has_enough_data") -> DataFrame:
    """Flag rows whose every count column reaches ``n``."""
    cond = F.lit(True)
    for c in count_cols:
        cond = cond & (F.col(c) >= n)
    return df.withColumn(name, cond)


def retention_audit(df: DataFrame, cond: Column) -> DataFrame:
    """Rows before and after a filter, in one pass."""
    return (df.agg(F.count(F.lit(1)).alias("raw_count"), F.count_if(cond).alias("kept_count"))
            .withColumn("kept_ratio", F.try_divide(F.col("kept_count"), F.col("raw_count"))))


def partition_profile(df: DataFrame, cond: Column | None = None) -> DataFrame:
    """Rows (and rows meeting ``cond``) per input partition."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    if cond is not None:
        aggs.append(F.count_if(cond).alias("hits"))
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(*aggs)


def topn_avg(df: DataFrame, key: str, value: str, n: int, ties: str = "row", tie_break: str | None = None,
             name: str = "avg_top") -> DataFrame:
    """Mean of the top n values per group (``ties`` as in ``topn``)."""
    from tessera.operators.windows import topn
    order = [F.col(value).desc()] + ([F.col(tie_break).asc()] if tie_break else [])
    return topn(df, key, order, n, ties).groupBy(key).agg(F.avg(value).alias(name))


def value_profile(df: DataFrame, col: str, regex: str | None = None) -> DataFrame:
    """Distinct values with counts; with ``regex`` only values not matching it."""
    src = df if regex is None else df.filter(~F.coalesce(F.col(col).rlike(regex), F.lit(False)))
    return src.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def split_means(df: DataFrame, cond: Column, value: str) -> DataFrame:
    """Mean and size of ``value`` where ``cond`` is true / false."""
    v = F.col(value)
    return df.agg(F.avg(F.when(cond, v)).alias("mean_true"), F.count_if(cond & v.isNotNull()).alias("n_true"),
                  F.avg(F.when(~cond, v)).alias("mean_false"), F.count_if(~cond & v.isNotNull()).alias("n_false"))
