"""Filters and predicates (C1-C18). Plain predicates so Catalyst can push them
into the parquet scan (``PushedFilters``)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def where(df: DataFrame, cond) -> DataFrame:
    """Any predicate (Column or SQL text)."""
    return df.filter(cond)


def like_ci(col, pattern: str) -> Column:
    """LIKE that ignores ASCII case (the tutorial's database does)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.ilike(pattern)


def char_class(col, chars: str, negate: bool = False) -> Column:
    """First character in a set or range, e.g. 'bsp' or 'a-f', case-insensitive."""
    c = F.col(col) if isinstance(col, str) else col
    cls = ("[^" if negate else "[") + chars + "]"
    return c.rlike("(?i)^" + cls)


def range_guard(df: DataFrame, bounds: dict, not_null=()) -> DataFrame:
    """For each column ``(low, low_open, high)``: low < x (or <=) and x <= high,
    plus not-null checks, as one filter."""
    return df.filter(guard_condition(bounds, not_null))


def guard_condition(bounds: dict, not_null=()) -> Column:
    cond = F.lit(True)
    for c, (low, low_open, high) in bounds.items():
        col = F.col(c)
        if low is not None:
            cond = cond & ((col > low) if low_open else (col >= low))
        if high is not None:
            cond = cond & (col <= high)
    for c in not_null:
        cond = cond & F.col(c).isNotNull()
    return cond


def threshold(df: DataFrame, col: str, value, descending: bool = True) -> DataFrame:
    """Rows with col >= value, sorted by it."""
    out = df.filter(F.col(col) >= value)
    return out.orderBy(F.col(col).desc() if descending else F.col(col).asc())


def drop_sentinel(df: DataFrame, col: str, values) -> DataFrame:
    """Drop rows whose value is a sentinel (e.g. a 'World' total row)."""
    return df.filter(~F.col(col).isin(*values) | F.col(col).isNull())


def code_filter(df: DataFrame, col: str, codes) -> DataFrame:
    """C17: allowed codes after trimming fixed-width text."""
    return df.filter(F.trim(F.col(col)).isin(*codes))


def empty_like(df: DataFrame) -> DataFrame:
    """Same schema, no rows."""
    return df.limit(0)


class TableFunction:
    """A stored query with typed arguments, the procedure analogue: a temporary
    SQL function of the session that returns a table.

    ``body`` is a query that names its tables as ``{table}`` and its arguments as
    plain names (an argument hides no column: columns win, so qualify or choose
    other names); ``params`` gives the arguments' SQL types, in order. Arguments are
    cast to these types (a value that does not fit raises) and may be null; in
    grouped queries Spark takes them in WHERE and HAVING only. Function
    and table names are the object's own, so functions made at the same time do not
    collide and no view of the session is replaced. A call is planned at once: its
    DataFrame stays good after ``drop`` (or the end of a ``with`` block).
    """

    def __init__(self, spark: SparkSession, body: str, params: dict[str, str], tables: dict[str, DataFrame]):
        mark = uuid.uuid4().hex
        self._spark, self._params, self._name = spark, params, f"fn_{mark}"
        self._views = {name: f"t{i}_{mark}" for i, name in enumerate(tables)}
        for name, df in tables.items():
            df.createOrReplaceTempView(self._views[name])
        query = body.format(**self._views)
        arguments = ", ".join(f"{p} {t}" for p, t in params.items())
        try:
            spark.sql(f"CREATE TEMPORARY FUNCTION {self._name}({arguments}) RETURNS TABLE RETURN {query}")
        except Exception:
            self.drop()
            raise

    def __call__(self, **args) -> DataFrame:
        if args.keys() != self._params.keys():
            raise TypeError(f"arguments must be {list(self._params)}: {list(args)}")
        marks = ", ".join(f"CAST(:{p} AS {t})" for p, t in self._params.items())
        return self._spark.sql(f"SELECT * FROM {self._name}({marks})", args=args)

    def drop(self) -> None:
        self._spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {self._name}")
        for view in self._views.values():
            self._spark.catalog.dropTempView(view)

    def __enter__(self) -> TableFunction:
        return self

    def __exit__(self, *_) -> None:
        self.drop()


def param_query(spark: SparkSession, sql: str, params: dict[str, str], args: dict, tables: dict[str, DataFrame]) -> DataFrame:
    """C16, one call: a ``TableFunction`` made, called and dropped."""
    with TableFunction(spark, sql, params, tables) as call:
        return call(**args)
