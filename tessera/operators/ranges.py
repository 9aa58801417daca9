"""A range layout of rows that every branch of a plan computes alike.

``with_range_id`` numbers each row's range of a sort order. The split points are
one value of the plan (a scalar subquery over a small sample drawn by row hash,
so computing it twice gives the same points), found per row by binary search.
Rows are dealt by ``repartitionById`` and ordered within their range by plain
windows; what a branch needs of all ranges (counts, last rows) it aggregates from
the same numbers, before any exchange. Nothing depends on a shared exchange.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

#: Sampled rows per range, about.
SAMPLE = 64


@dataclass(frozen=True)
class By:
    """One key of a sort order; nulls come first when ascending, last when
    descending, unless ``nulls_first`` says otherwise."""
    value: Column
    descending: bool = False
    nulls_first: bool | None = None

    @property
    def empty_first(self) -> bool:
        return not self.descending if self.nulls_first is None else self.nulls_first

    def column(self, value: Column | None = None) -> Column:
        c = self.value if value is None else value
        if self.descending:
            return c.desc_nulls_first() if self.empty_first else c.desc_nulls_last()
        return c.asc_nulls_first() if self.empty_first else c.asc_nulls_last()

    def less(self, a: Column, b: Column) -> Column:
        """``a`` stands before ``b``."""
        first, second = (a, b) if self.empty_first else (b, a)
        return (first.isNull() & second.isNotNull()) | F.coalesce(a > b if self.descending else a < b, F.lit(False))


def asc(x, nulls_first: bool | None = None) -> By:
    return By(F.col(x) if isinstance(x, str) else x, False, nulls_first)


def desc(x, nulls_first: bool | None = None) -> By:
    return By(F.col(x) if isinstance(x, str) else x, True, nulls_first)


def ordering(order) -> list[By]:
    """Names, columns (ascending) and ``By`` as a list of ``By``."""
    order = [order] if isinstance(order, (str, Column, By)) else order
    return [o if isinstance(o, By) else asc(o) for o in order]


def row_hash(df: DataFrame) -> Column:
    """Hash of a row's columns (maps cannot be hashed)."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, MapType)])


def ranges_of(df: DataFrame, partitions: int | None = None) -> int:
    return partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_range_id(df: DataFrame, order: list[By], n: int, name: str) -> DataFrame:
    """``df`` with the range (0 to n - 1) of each row under ``order``. End the
    order with a hash of the row, so that many rows with one key are spread too
    (rows alike in every column stay together)."""
    fields = [f"o{i}" for i in range(len(order))]
    keys = df.select(*[o.value.alias(f) for o, f in zip(order, fields)])
    every = F.greatest(F.lit(1), F.floor(keys.select(F.count(F.lit(1))).scalar() / (n * SAMPLE)))
    sample = keys.where(F.pmod(F.xxhash64(F.lit(n), *fields), every) == 0).distinct()
    at = Window.orderBy(*[o.column(F.col(f)) for o, f in zip(order, fields)])  # the sample only
    tiles = sample.select(F.ntile(n).over(at).alias("tile"), F.row_number().over(at).alias("place"), F.struct(*fields).alias("key"))
    heads = tiles.withColumn("before", F.lag("tile").over(Window.orderBy("place"))).where("before <> tile")
    splits = heads.agg(F.sort_array(F.collect_list(F.struct("place", "key")))["key"].alias("s")).select("s").scalar()

    def stands_before(split: Column) -> Column:
        """The row comes before this split point."""
        out = F.lit(False)
        for o, f in reversed(list(zip(order, fields))):
            out = o.less(o.value, split[f]) | (o.value.eqNullSafe(split[f]) & out)
        return out
    steps = [1 << b for b in reversed(range(max(1, (n - 1).bit_length())))]
    held, size = F.col("_splits"), F.size("_splits")

    def step(low, jump):
        to = low + jump
        return F.when((to <= size) & ~F.coalesce(stands_before(F.get(held, to - 1)), F.lit(True)), to).otherwise(low)
    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)
    return df.withColumn("_splits", F.coalesce(splits, F.array())).withColumn(name, found).drop("_splits")
