"""Projection and schema operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalars import bands as _bands


def project(df: DataFrame, cols) -> DataFrame:
    """B1: all or some columns (pruned down to the scan by Catalyst)."""
    return df.select(*cols)


def rename(df: DataFrame, mapping: dict) -> DataFrame:
    """Rename columns (names with spaces or brackets are fine)."""
    return df.withColumnsRenamed(mapping)


def reorder(df: DataFrame, cols) -> DataFrame:
    """Keep and order the listed columns."""
    return df.select(*cols)


def compute(df: DataFrame, exprs: dict) -> DataFrame:
    """Add computed or constant columns in one projection."""
    return df.withColumns(exprs)


def tolerant_cast(df: DataFrame, col: str, to: str) -> DataFrame:
    """Cast that yields null instead of raising under ANSI mode."""
    return df.withColumn(col, F.col(col).try_cast(to))


def bands(df: DataFrame, col: str, bounds, default=None, name: str = "band") -> DataFrame:
    """CASE with ascending upper bounds; ``default=None`` means no ELSE."""
    return df.withColumn(name, _bands(col, bounds, default))


def shape(df: DataFrame) -> DataFrame:
    """One row (n_rows, n_cols)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("long"))


def schema_profile(df: DataFrame) -> DataFrame:
    """(column, data_type, non_null) per column, from one aggregate pass."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                              F.lit(f.dataType.simpleString()).alias("data_type"),
                              F.col(f"c{i}").alias("non_null"))
                     for i, f in enumerate(df.schema.fields)])
    return counts.select(F.inline(rows))


def head_tail(df: DataFrame, key, n: int) -> DataFrame:
    """First and last n rows by a key (frames have no order of their own)."""
    keys = [key] if isinstance(key, str) else list(key)
    head = df.orderBy(*[F.col(k).asc() for k in keys]).limit(n).withColumn("side", F.lit("head"))
    tail = df.orderBy(*[F.col(k).desc() for k in keys]).limit(n).withColumn("side", F.lit("tail"))
    return head.unionByName(tail)
