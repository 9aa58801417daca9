"""Table changes as copy-on-write transforms.

Parquet tables reject UPDATE/DELETE, so each change returns the new table
state as a DataFrame; persist it with ``create_as`` (or a table format with
MERGE support where available).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def insert_rows(df: DataFrame, new: DataFrame) -> DataFrame:
    """Append rows; columns the new rows lack are null."""
    typed = new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in new.columns
                         else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    return df.unionByName(typed)


def update_where(df: DataFrame, cond, changes: dict) -> DataFrame:
    """Set columns where ``cond`` holds (null condition keeps the old value);
    ``cond=None`` updates every row."""
    out = {}
    for c, expr in changes.items():
        new = expr if isinstance(expr, Column) else F.lit(expr)
        new = new.cast(df.schema[c].dataType)
        out[c] = new if cond is None else F.when(F.coalesce(cond, F.lit(False)), new).otherwise(F.col(c))
    return df.withColumns(out)


def delete_where(df: DataFrame, cond=None) -> DataFrame:
    """I4: drop rows where ``cond`` is true; ``cond=None`` deletes all rows."""
    if cond is None:
        return df.limit(0)
    return df.filter(~F.coalesce(cond, F.lit(False)))


def create_as(df: DataFrame, name: str, mode: str = "overwrite", path: str | None = None) -> DataFrame:
    """Save a query result as a table and return the table. With ``path``
    the table's files live there (e.g. the shared checkpoint folder)."""
    w = df.write.mode(mode)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """I5."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
