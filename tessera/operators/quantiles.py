"""Exact quantiles by radix selection on order-preserving keys.

Every value (whole number, decimal of up to 18 digits, double, date, timestamp)
becomes a 64-bit whole number with the same order, and back: ``sort_key``,
``with_double_key``, ``from_sort_key``. The number is narrowed 16 bits at a
time: four levels, always, whatever the values. A level counts the wanted
ranges' values by the next 16 bits and keeps, per wanted position, the one range
that holds it, with the position inside it. After four levels a range is one
value.

Rows are first counted per distinct value (a partial aggregate), so a hot value
is one row per task. A window holds at most 2**16 rows (the next 16 bits of one
range). Ranges are few (two per group and probability) and are joined to the
counts: by broadcast where there are no groups (two per column and probability,
then), else as Spark decides by their size at run time, which also splits a hot
range's side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import cut_lineage

BITS = 16
LEVELS = 64 // BITS
_UNIT = float(1 << 52)
_FINITE = 2047 << 52


def _exact(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.TimestampType)) or (
        isinstance(dtype, T.DecimalType) and dtype.precision <= 18)


def sort_key(value: Column, dtype: T.DataType) -> Column:
    """A long whose order is that of ``value``, for the types with an exact one."""
    if isinstance(dtype, T.DecimalType) and dtype.scale:
        return (value * F.lit(10 ** dtype.scale).cast(T.DecimalType(19, 0))).cast("long")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(dtype, T.DateType):
        return F.unix_date(value).cast("long")
    return value.cast("long")


def with_double_key(df: DataFrame, col: str, name: str) -> DataFrame:
    """``df`` with the sort key of a double: its bits (null for null and NaN),
    from exponent and fraction. Several steps, so that each is computed once."""
    x = F.col(col)
    size = F.abs(x)
    df = df.withColumn("_size", F.when((size > 0) & (size < float("inf")), size).otherwise(F.lit(1.0)))
    df = df.withColumn("_near", F.floor(F.log2("_size")).cast("int"))
    df = df.withColumn("_power", F.pow(F.lit(2.0), F.col("_near").cast("double")))
    above, below = F.col("_power") > F.col("_size"), F.col("_power") * 2 <= F.col("_size")
    df = df.withColumn("_exponent", F.greatest(F.col("_near") - F.when(above, 1).when(below, -1).otherwise(0), F.lit(-1022)))
    scaled = F.col("_size") / F.pow(F.lit(2.0), F.col("_exponent").cast("double"))
    df = df.withColumn("_bits", (F.col("_exponent") + 1022).cast("long") * F.lit(1 << 52) + (scaled * F.lit(_UNIT)).cast("long"))
    bits = F.when(size == 0, F.lit(0).cast("long")).when(size == float("inf"), F.lit(_FINITE).cast("long")).otherwise(F.col("_bits"))
    df = df.withColumn("_bits", bits)
    key = F.when(F.isnan(x) | x.isNull(), F.lit(None).cast("long")).when(x < 0, -F.col("_bits")).otherwise(F.col("_bits"))
    return df.withColumn(name, key).drop("_size", "_near", "_power", "_exponent", "_bits")


def from_sort_key(key: Column, dtype: T.DataType) -> Column:
    """The value of a key; the double for types that are ordered as doubles."""
    if isinstance(dtype, T.DecimalType) and _exact(dtype):
        return (key.cast(T.DecimalType(19, 0)) / F.lit(10 ** dtype.scale).cast(T.DecimalType(19, 0))).cast(dtype)
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(key)
    if isinstance(dtype, T.DateType):
        return F.date_from_unix_date(key.cast("int"))
    if _exact(dtype):
        return key.cast(dtype)
    bits = F.abs(key)
    exponent = F.shiftright(bits, 52)
    fraction = bits.bitwiseAND(F.lit((1 << 52) - 1)).cast("double")
    size = (F.when(bits >= _FINITE, F.lit(float("inf")))
            .when(exponent == 0, fraction * F.lit(2.0 ** -1074))
            .otherwise((fraction + _UNIT) * F.pow(F.lit(2.0), (exponent - 1075).cast("double"))))
    return F.when(key < 0, -size).otherwise(size)


def _places(n: Column, probs, interpolate: bool) -> Column:
    """Array of (p, share, pos): the 1-based positions wanted among ``n`` values.
    With ``interpolate`` two neighbours, the upper one with its share of the way."""
    out = []
    for p in probs:
        p = F.lit(float(p))
        if not interpolate:
            out.append(F.struct(p.alias("p"), F.lit(0.0).alias("share"), F.greatest(F.ceil(p * n), F.lit(1)).cast("long").alias("pos")))
            continue
        at = 1 + p * (n - 1)
        low = F.floor(at).cast("long")
        out += [F.struct(p.alias("p"), F.lit(0.0).alias("share"), low.alias("pos")),
                F.struct(p.alias("p"), (at - F.floor(at)).cast("double").alias("share"), F.least(low + 1, n).alias("pos"))]
    return F.array(*out)


def radix_select(counts: DataFrame, group: list[str], probs, interpolate: bool = False, bounded: bool = False) -> DataFrame:
    """(group..., p, share, key) of the wanted positions in ``counts(group...,
    key, w)``: one row per distinct key with its number of rows. ``bounded``: the
    groups are a fixed few, whatever the data."""
    ranges = None  # group..., range (the leading bits), places (positions inside it)
    for level in range(LEVELS):
        shift = 64 - BITS * (level + 1)
        rows = counts.withColumn("_next", F.shiftright("key", shift) if shift else F.col("key"))
        if ranges is None:
            cells = rows.groupBy(*group, "_next").agg(F.sum("w").alias("w"))
            cells = cells.withColumn("_range", F.lit(0).cast("long"))
        else:
            wanted = ranges.withColumnsRenamed({c: f"_r_{c}" for c in group})
            same = F.shiftright("key", shift + BITS) == F.col("_range")
            for c in group:
                same = same & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
            wanted = F.broadcast(wanted) if bounded else wanted
            cells = rows.join(wanted, same).groupBy(*group, "_range", "_next").agg(F.sum("w").alias("w"), F.first("places").alias("places"))
        whole = Window.partitionBy(*group, "_range")
        before = F.sum("w").over(whole.orderBy("_next").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("w")
        if ranges is None:
            cells = cells.withColumn("places", _places(F.sum("w").over(whole), probs, interpolate))
        cells = cells.withColumn("before", before)
        mine = F.filter("places", lambda x: (x["pos"] > F.col("before")) & (x["pos"] <= F.col("before") + F.col("w")))
        inner = F.transform(mine, lambda x: F.struct(x["p"].alias("p"), x["share"].alias("share"), (x["pos"] - F.col("before")).alias("pos")))
        ranges = cells.select(*group, F.col("_next").alias("_range"), inner.alias("places")).where(F.size("places") > 0)
    return ranges.select(*group, F.col("_range").alias("key"), F.inline("places")).drop("pos")


def exact_quantiles(df: DataFrame, cols, probs, keys=(), interpolate: bool = False, once: bool = False) -> DataFrame:
    """Exact quantiles of several columns, per group of ``keys``:
    (keys..., column, p, value). ``value`` is the one at 1-based position
    ``max(1, ceil(p * n))`` of the sorted non-null values (SQL
    ``quantile_disc``) in the column's type if all ``cols`` have one type (else a
    double), or with ``interpolate`` the straight line between the two values
    around position ``1 + p * (n - 1)`` (``quantile_cont``, a double). NaN is
    not a value here; a decimal of over 18 digits is taken as a double. ``once``
    writes the counts to the shared checkpoint folder first: for a ``df`` that is
    costly to compute and that Spark would compute again for each level."""
    keys = list(keys)
    types = {c: df.schema[c].dataType for c in cols}
    group = [*keys, "column"]

    def pair(c):
        exact = _exact(types[c])
        return F.struct(F.lit(c).alias("column"), (sort_key(F.col(c), types[c]) if exact else F.lit(None).cast("long")).alias("whole"),
                        (F.lit(None).cast("double") if exact else F.col(c).cast("double")).alias("rough"))
    rows = df.select(*keys, F.inline(F.array(*[pair(c) for c in cols])))
    rows = rows.where(F.col("whole").isNotNull() | F.col("rough").isNotNull() & ~F.isnan("rough"))
    if not all(map(_exact, types.values())):
        rows = with_double_key(rows, "rough", "_key").withColumn("whole", F.coalesce("whole", "_key"))
    # never null from here on: a filter on the key would be moved down and compute it again
    counts = rows.groupBy(*group, F.coalesce("whole", F.lit(0)).alias("key")).agg(F.count(F.lit(1)).alias("w"))
    counts = cut_lineage(counts) if once else counts
    found = radix_select(counts, group, probs, interpolate, bounded=not keys)
    one = len(set(map(str, types.values()))) == 1 and not interpolate
    values = {c: from_sort_key(F.col("key"), t) for c, t in types.items()}
    value = values[cols[0]] if one else F.coalesce(*[F.when(F.col("column") == c, v.cast("double")) for c, v in values.items()])
    if not interpolate:
        return found.select(*group, "p", value.alias("value"))
    # equal neighbours share a range: the upper one then has the lower one's value
    ends = found.withColumn("value", value).groupBy(*group, "p").agg(F.min("value").alias("a"), F.max("value").alias("b"), F.max("share").alias("way"))
    return ends.select(*group, "p", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.col("a") + (F.col("b") - F.col("a")) * F.col("way")).alias("value"))
