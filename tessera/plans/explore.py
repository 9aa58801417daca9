"""Table exploration - shape, schema, head/tail, sizes, crosstab, describe,
correlations, histograms, pair data (all as DataFrames, no plotting)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.aggregates import corr_matrix, crosstab, describe, histogram, size_by_pair
from tessera.operators.columns import head_tail, schema_profile, shape


def numeric_columns(df: DataFrame) -> list:
    return [f.name for f in df.schema.fields
            if f.dataType.typeName() in ("integer", "long", "double", "float", "short", "decimal")]


def pair_points(df: DataFrame, x: str, y: str) -> DataFrame:
    """The two columns for a scatter plot plus their correlation."""
    r = df.select(F.corr(F.col(x).cast("double"), F.col(y).cast("double"))).scalar()
    return df.select(x, y).withColumn("r", r)


def explore(df: DataFrame, key: str, a: str, b: str) -> dict:
    """Every exploration table of one frame, lazily."""
    nums = numeric_columns(df)
    return {"shape": shape(df), "schema": schema_profile(df), "head_tail": head_tail(df, key, 5),
            "sizes": size_by_pair(df, a, b), "crosstab": crosstab(df, a, b), "describe": describe(df, nums),
            "corr": corr_matrix(df, nums), "histogram": histogram(df, nums)}
