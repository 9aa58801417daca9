"""Sort, limit, top-k and sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ranges import row_hash
from tessera.operators.windows import _cols, global_rank, topn

#: Rows a group from which a table of one row per group is broadcast.
GROUP_LIMIT = 1000


def sort(df: DataFrame, order) -> DataFrame:
    """Order by several keys, mixed directions, explicit null placement."""
    return df.orderBy(*_cols(order))


def topk(df: DataFrame, order, k: int) -> DataFrame:
    """ORDER BY ... LIMIT k, planned as TakeOrderedAndProject (each task
    keeps its k best; only k rows per task reach the final merge)."""
    return df.orderBy(*_cols(order)).limit(k)


def top_percent(df: DataFrame, order, pct: float, name: str = "rank") -> DataFrame:
    """TOP pct PERCENT = first ceil(n * pct / 100) rows of the order."""
    n = df.select(F.count(F.lit(1))).scalar()
    ranked = global_rank(df, order, name)
    return ranked.filter(F.col(name) <= F.ceil(n * F.lit(pct) / F.lit(100.0)))


def sample_n(df: DataFrame, key: str, id_col: str, n: int, seed: int = 42, name: str = "_pick") -> DataFrame:
    """N rows per class, repeatable under any partitioning and in any
    engine: the n smallest ``(md5('id|seed'), id)`` per class; rows alike in
    both are taken by row hash.

    Only those values go through ``topn`` (so a class holding half the rows is cut
    down in many tasks); its last one is the class's cut, and the rows up to the
    cut are taken where they are. Rows that stand at the cut are counted off,
    dealt by class and place, which no other rows share."""
    names = df.columns
    h = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"|{seed}")).cast("binary"))
    place = F.struct(h.alias("h"), F.col(id_col).alias("i"), row_hash(df).alias("r"))
    first = topn(df.select(F.col(key).alias("_cls"), place.alias("_place")), "_cls", "_place", n, "row", name)
    # per class of n rows or more: its last place, and how many of the n stand there
    cuts = (first.groupBy("_cls", "_place").agg(F.count(F.lit(1)).alias("_m"))
            .groupBy("_cls").agg(F.max(F.struct("_place", "_m")).alias("_cut"), F.sum("_m").alias("_of")).filter(F.col("_of") == n))
    if n >= GROUP_LIMIT:  # one row for n rows of the input at most
        cuts = F.broadcast(cuts)
    rows = df.withColumn("_place", place).join(cuts, F.col(key).eqNullSafe(F.col("_cls")), "left")
    rows = rows.filter(F.col("_cut").isNull() | (F.col("_place") <= F.col("_cut")["_place"]))
    nth = F.row_number().over(Window.partitionBy(key, "_place").orderBy("_place"))
    rows = rows.withColumn(name, nth).filter(F.col("_cut").isNull() | (F.col("_place") < F.col("_cut")["_place"]) | (F.col(name) <= F.col("_cut")["_m"]))
    return rows.select(*[F.col(f"`{c}`") for c in names])
