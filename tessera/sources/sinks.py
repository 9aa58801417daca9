"""Sinks (A13-A18). Writers never collect to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, UTF-8."""
    df.write.mode(mode).option("encoding", "UTF-8").json(path)


def save_table(df: DataFrame, name: str, mode: str = "overwrite", path: str | None = None) -> None:
    """Table of the catalog, whole table replaced: managed (in the
    warehouse), or with its files under ``path``."""
    writer = df.write.mode(mode)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_parquet(df: DataFrame, path: str, partition_by=None, mode: str = "overwrite") -> None:
    """Parquet, many files, optionally partitioned for pruning. With
    partition columns the rows are rebalanced on them first, so each folder
    gets a few large files (AQE splits a heavy value over several tasks)."""
    if not partition_by:
        df.write.mode(mode).parquet(path)
        return
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    df.hint("rebalance", *cols).write.mode(mode).partitionBy(*cols).parquet(path)


def write_csv(df: DataFrame, path: str, single: bool = False, mode: str = "overwrite") -> None:
    """CSV with header. ``single=True`` writes one file: the caller
    declares a result of bounded size (a zone table, a one-row summary).
    ``repartition(1)`` (not ``coalesce(1)``) leaves only the write in one task."""
    (df.repartition(1) if single else df).write.mode(mode).option("header", True).csv(path)


def write_tsv(df: DataFrame, path: str, n_files: int, key: str, mode: str = "overwrite") -> None:
    """Tab-separated key/value files, hash-partitioned by key into n files."""
    df.repartition(n_files, key).write.mode(mode).option("sep", "\t").csv(path)
