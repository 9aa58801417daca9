"""Key/value rating jobs: mean per movie (P11), count and mean per product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.aggregates import count_mean_by_key, mean_by_key
from tessera.sources.files import kv_from_lines


def ratings_from_lines(lines: DataFrame, key_idx: int = 1, value_idx: int = 2) -> DataFrame:
    """(key, value) from CSV text lines: field ``key_idx`` as text key, field
    ``value_idx`` parsed as a number; header, short and bad lines dropped."""
    return kv_from_lines(lines, key_idx, value_idx)


def ratings_from_table(df: DataFrame, key: str = "l_partkey", value: str = "l_quantity") -> DataFrame:
    """Stand-in: the key rendered as text (the jobs treat ids as text) and a numeric value."""
    return df.select(F.col(key).cast("string").alias("key"), F.col(value).cast("double").alias("value"))


def movie_means(ratings: DataFrame, digits: int = 1) -> DataFrame:
    return mean_by_key(ratings, "key", "value", digits, "mean")


def product_counts(ratings: DataFrame, digits: int = 1) -> DataFrame:
    return count_mean_by_key(ratings, "key", "value", digits)


def top_products(ratings: DataFrame, k: int = 10) -> DataFrame:
    """Most reviewed products (ties by key), TakeOrdered after a partial aggregate."""
    return product_counts(ratings).orderBy(F.col("n").desc(), F.col("key")).limit(k)
