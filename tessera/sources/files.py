"""File and table sources.

All readers use explicit schemas where the format has none; parsing of raw
text is tolerant (``try_cast``) so one bad record never fails a job.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Decimal syntax accepted by the number parse: optional sign, digits with an
# optional fraction, optional exponent. Rejects "4.0d", "1_0", "nan", "inf".
DECIMAL_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One parquet table ``{base}/{name}.parquet``."""
    return spark.read.parquet(f"{base}/{name}.parquet")


def read_csv(spark: SparkSession, path, schema: T.StructType | str, header: bool = True,
             **options) -> DataFrame:
    """A1: CSV with header and a declared schema (no inference pass over the data)."""
    reader = spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def read_csv_raw(spark: SparkSession, path, **options) -> DataFrame:
    """A2: CSV with header, every column a string."""
    reader = spark.read.option("header", True)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def read_headerless_csv(spark: SparkSession, path, schema: T.StructType, encoding: str = "ISO-8859-1",
                        text_col: str | None = None) -> DataFrame:
    """A3: headerless, quoted CSV, one record per line, latin-1 by default.

    Short rows (fewer fields than the schema) are dropped, long rows are kept,
    an empty text field stays ``''``. ``nullValue`` is set to a character that
    never occurs so a quoted empty field is not turned into null.
    """
    text_col = text_col or schema.fieldNames()[-1]
    full = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
    df = (spark.read.schema(full)
          .option("header", False).option("encoding", encoding)
          .option("quote", '"').option("escape", '"')
          .option("multiLine", False).option("nullValue", "\u0001")
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
          .csv(path))
    keep = F.col(text_col).isNotNull() | F.col("_corrupt_record").isNull()
    return (df.filter(keep)
              .withColumn(text_col, F.coalesce(F.col(text_col), F.lit("")))
              .drop("_corrupt_record"))


def parse_number(col: Column) -> Column:
    """Tolerant decimal parse: null unless the text is plain decimal syntax."""
    c = F.trim(col)
    return F.when(c.rlike(DECIMAL_RE), c.try_cast("double"))


def kv_from_lines(lines: DataFrame, key_idx: int, value_idx: int, sep: str = ",",
                  line_col: str = "value", key_name: str = "key",
                  value_name: str = "value") -> DataFrame:
    """A4 core: split lines, take two fields, drop lines whose value is not a number
    (this also drops a header line and short lines)."""
    parts = F.split(F.trim(F.col(line_col)), sep)
    out = lines.select(F.get(parts, key_idx).alias(key_name),
                       parse_number(F.get(parts, value_idx)).alias(value_name))
    return out.filter(F.col(key_name).isNotNull() & F.col(value_name).isNotNull()
                      & ~F.isnan(value_name))


def read_kv_lines(spark: SparkSession, path, key_idx: int, value_idx: int, sep: str = ",") -> DataFrame:
    """A4: delimited text lines -> (key, value) with bad lines skipped."""
    return kv_from_lines(read_lines(spark, path), key_idx, value_idx, sep)


def read_lines(spark: SparkSession, path) -> DataFrame:
    """A5: plain text lines, column ``value``."""
    return spark.read.text(path)


def read_parquet(spark: SparkSession, *paths) -> DataFrame:
    """Parquet, one directory or many files."""
    return spark.read.parquet(*paths)


def union_by_name(dfs) -> DataFrame:
    """Merge frames by column name; missing columns become null."""
    dfs = list(dfs)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def _exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a Hadoop path glob matches anything (works on any file system)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(path)
    return found is not None and len(found) > 0


def read_mixed(spark: SparkSession, directory: str, pattern: str,
               csv_schema: T.StructType | None = None) -> DataFrame:
    """Every ``{pattern}.parquet`` and ``{pattern}.csv`` (files or written
    directories) in a folder, merged by column name (A8).

    Discovery is a Hadoop path glob, so it works on any file system (not a
    driver-local ``glob``). The CSV side is typed to the parquet side's schema.
    Raises ``FileNotFoundError`` when neither format matches.
    """
    pq_glob, csv_glob = f"{directory}/{pattern}.parquet", f"{directory}/{pattern}.csv"
    pq = spark.read.parquet(pq_glob) if _exists(spark, pq_glob) else None
    csv = None
    if _exists(spark, csv_glob):
        reader = spark.read.option("header", True)
        if csv_schema is not None:
            reader = reader.schema(csv_schema)
        elif pq is None:
            raise ValueError("CSV files alone need csv_schema (types are declared, never inferred)")
        # with a parquet side and no schema the CSV stays text and is typed by
        # column name below: no inference pass over the CSV files
        csv = reader.csv(csv_glob)
    if pq is None and csv is None:
        raise FileNotFoundError(f"no {pattern}.parquet / {pattern}.csv under {directory}")
    if pq is None or csv is None:
        return pq if csv is None else csv
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in csv.columns else
             F.lit(None).cast(f.dataType).alias(f.name) for f in pq.schema.fields]
    extra = [c for c in csv.columns if c not in pq.columns]
    return union_by_name([pq, csv.select(*typed, *extra)])


class Declared(NamedTuple):
    """Rows that fit their declared schema, and the others."""
    good: DataFrame
    bad: DataFrame


def read_declared(spark: SparkSession, path, schema: T.StructType | str, required=(), **options) -> Declared:
    """CSV with header under a declared schema, with a quarantine: ``good`` has the
    schema's columns; ``bad`` lists each other line as ``file, reason, line``. The reason is
    ``malformed`` (wrong number of fields; ``line`` as it stands in the file), ``bad
    <column>`` (a text that is no value of its type) or ``no <column>`` (a ``required``
    one is empty), the first in column order; ``line`` is rendered from the columns then.
    A file whose header names other columns, or in another order, fails the read when it
    runs.

    Fields are read as text and cast here, with the parser's column pruning off: every
    line is good or bad whatever columns a query reads, where the parser itself checks
    only the fields it is asked for. Both frames read the files; nothing is cached."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    mark = "_malformed"
    texts = [T.StructField(f.name, T.StringType()) for f in schema.fields]
    reader = (spark.read.schema(T.StructType([*texts, T.StructField(mark, T.StringType())]))
              .option("header", True).option("enforceSchema", False).option("columnPruning", False)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", mark).options(**options))
    required = [required] if isinstance(required, str) else list(required)
    reason = F.when(F.col(mark).isNotNull(), F.lit("malformed"))
    typed = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in schema.fields}
    for c, value in typed.items():
        reason = reason.when(F.col(f"`{c}`").isNotNull() & value.isNull(), F.lit(f"bad {c}"))
    for c in required:
        reason = reason.when(F.col(f"`{c}`").isNull(), F.lit(f"no {c}"))
    rows = reader.csv(path).withColumn("_reason", reason)
    bad = rows.filter(F.col("_reason").isNotNull()).select(
        F.col("_metadata.file_path").alias("file"), F.col("_reason").alias("reason"),
        F.coalesce(F.col(mark), F.to_csv(F.struct(*[F.col(f"`{c}`") for c in typed]))).alias("line"))
    return Declared(rows.filter(F.col("_reason").isNull()).select(*[v.alias(c) for c, v in typed.items()]), bad)


def read_lookup(spark: SparkSession, path, schema: T.StructType | str, key=()) -> Declared:
    """Lookup CSV with its declared schema; rows without a ``key`` go to ``bad``."""
    return read_declared(spark, path, schema, key)


def table_of(spark: SparkSession, rows, schema) -> DataFrame:
    """A10: literal rows to a table."""
    return spark.createDataFrame(rows, schema)


def read_parts(spark: SparkSession, directory: str, schema: T.StructType | str, required=()) -> Declared:
    """Read back a directory of CSV part files as one table."""
    return read_declared(spark, directory, schema, required)
