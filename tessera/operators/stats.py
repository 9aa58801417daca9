"""Statistics (M1-M4). Each test is one distributed aggregate down to a few
numbers (per group when ``keys`` are given); only the t-distribution tail is
evaluated in Python, on those few rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.stats import t_pvalue


def pearson(df: DataFrame, x: str, y: str, keys=None, with_p: bool = True) -> DataFrame:
    """M1/M2: n, r and (optionally) the two-sided p-value of r (t = r sqrt((n-2)/(1-r^2)))."""
    keys = [keys] if isinstance(keys, str) else list(keys or [])
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    aggs = [F.count(F.lit(1)).alias("n"), F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias("r")]
    out = both.groupBy(*keys).agg(*aggs) if keys else both.agg(*aggs)
    out = out.withColumn("t", F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2, 1 - F.col("r") * F.col("r"))))
    if with_p:
        out = out.withColumn("p", t_pvalue(F.col("t"), (F.col("n") - 2).cast("double")))
    return out


def welch(df: DataFrame, cond: Column, value: str, keys=None, with_p: bool = True) -> DataFrame:
    """M3/M4: Welch's unequal-variance t-test of ``value`` where ``cond`` is true
    vs false: sizes, means, t, Welch-Satterthwaite degrees of freedom, p."""
    keys = [keys] if isinstance(keys, str) else list(keys or [])
    v = F.col(value).cast("double")
    a, b = F.when(cond, v), F.when(~cond, v)
    aggs = [F.count(a).alias("n_true"), F.avg(a).alias("mean_true"), F.var_samp(a).alias("var_true"),
            F.count(b).alias("n_false"), F.avg(b).alias("mean_false"), F.var_samp(b).alias("var_false")]
    out = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    s1 = F.col("var_true") / F.col("n_true")
    s2 = F.col("var_false") / F.col("n_false")
    se2 = s1 + s2
    out = (out.withColumn("t", F.try_divide(F.col("mean_true") - F.col("mean_false"), F.sqrt(se2)))
              .withColumn("dof", F.try_divide(se2 * se2, s1 * s1 / (F.col("n_true") - 1)
                                              + s2 * s2 / (F.col("n_false") - 1))))
    if with_p:
        out = out.withColumn("p", t_pvalue(F.col("t"), F.col("dof")))
    return out
