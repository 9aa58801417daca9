"""Set operations (H1-H3)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*dfs: DataFrame) -> DataFrame:
    """H2: UNION ALL by position."""
    return reduce(lambda a, b: a.union(b), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """H1: UNION (duplicates removed)."""
    return union_all(*dfs).distinct()


def union_tagged(tagged: dict, name: str = "source") -> DataFrame:
    """H3: union with a constant source column."""
    return reduce(lambda a, b: a.unionByName(b),
                  [df.withColumn(name, F.lit(tag)) for tag, df in tagged.items()])
