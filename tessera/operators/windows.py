"""Window operators (F1-F6), written so no window runs over one unbounded partition.

* ``topn`` cuts each group down in a tournament of hash slices; tied rows are
  counted, not moved; the filters on ``rank``/``row_number`` let Spark insert a
  partial ``WindowGroupLimit`` before the shuffles.
* ``lag_gap`` and ``global_rank`` deal rows into ranges of their order
  (``ranges``), so a key holding a third of all rows is spread over many tasks;
  what a range needs of the earlier ones comes from a table of one row per range.
* ``zscore`` and ``flag_max`` use scalar subqueries (a one-row aggregate
  inlined as a value), not a global window or a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ranges import By, asc, ordering, ranges_of, row_hash, with_range_id


#: Windows of a group that meet in one at each level of ``topn``.
FAN = 16


def _quoted(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def _cols(xs):
    if isinstance(xs, (str, Column, By)):
        xs = [xs]
    return [F.col(x) if isinstance(x, str) else x.column() if isinstance(x, By) else x for x in xs]


def _groups_of_slices(slices: int) -> list[int]:
    """How many slices meet in one window, level by level, until ``FAN`` windows
    of a group or fewer are left."""
    widths, width = [], 1
    while -(-slices // width) > FAN:
        width *= FAN
        widths.append(width)
    return widths


def topn(df: DataFrame, keys, order, n: int, ties: str = "rank", name: str = "rank_in_group",
         partitions: int | None = None) -> DataFrame:
    """top n rows per group. ``ties='rank'`` keeps all rows tied at the cut
    (may return more than n); ``ties='row'`` returns exactly n (``order`` must
    then end with a unique tie-break column).

    One plan for every n, a tournament: each group is first cut down within
    ``partitions`` hash slices of its rows (a row of the group's first n is among
    the first n of its slice; for n up to Spark's group-limit threshold a partial
    limit comes before that shuffle), then ``FAN`` slices meet at a time and are cut
    again, until one window of at most n rows from each of ``FAN`` is left.

    Tied rows do not travel: under ``ties='rank'`` the first row of each class of
    equal order within a slice stands for its class, with the class's row count,
    and a rank is 1 plus the rows counted before. The rows take their rank by
    (group, slice, class), so a group whose rows all tie stays in many tasks. Rows
    alike in every column share a slice."""
    if ties not in ("rank", "row"):
        raise ValueError(f"ties must be 'rank' or 'row': {ties!r}")
    slices = ranges_of(df, partitions)
    group = [f"_k{i}" for i in range(len(_cols(keys)))]
    order = _cols(order)
    held = df.withColumn("_slice", F.pmod(row_hash(df), F.lit(slices))).withColumns(dict(zip(group, _cols(keys))))
    within = Window.partitionBy(*group, "_slice").orderBy(*order)
    held = held.withColumn("_local", (F.rank if ties == "rank" else F.row_number)().over(within)).filter(F.col("_local") <= n)
    meets = [[*group, F.floor(F.col("_slice") / width)] for width in _groups_of_slices(slices)] + [group]
    if ties == "row":
        for meet in meets:
            held = held.withColumn("_local", F.row_number().over(Window.partitionBy(*meet).orderBy(*order))).filter(F.col("_local") <= n)
        return held.select(*_quoted(df), F.col("_local").cast("long").alias(name))
    peers = within.rangeBetween(Window.currentRow, Window.currentRow)
    first = (held.withColumn("_nth", F.row_number().over(within)).withColumn("_rows", F.count(F.lit(1)).over(peers))
             .filter(F.col("_nth") == F.col("_local")))
    for meet in meets:
        w = Window.partitionBy(*meet).orderBy(*order)
        upto = F.sum("_rows").over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow))
        here = F.sum("_rows").over(w.rangeBetween(Window.currentRow, Window.currentRow))
        first = first.withColumn("_before", upto - here).filter(F.col("_before") < n)
    ranks = first.select(*[F.col(k).alias(f"{k}r") for k in group], F.col("_slice").alias("_slicer"), F.col("_local").alias("_localr"),
                         (F.col("_before") + 1).cast("long").alias("_rank"))
    on = (F.col("_slice") == F.col("_slicer")) & (F.col("_local") == F.col("_localr"))
    for k in group:
        on = on & F.col(k).eqNullSafe(F.col(f"{k}r"))
    return held.join(ranks, on).select(*_quoted(df), F.col("_rank").alias(name))


def lag_gap(df: DataFrame, keys, ts: str, out: str = "gap_minutes", prev: str = "prev_ts",
            partitions: int | None = None) -> DataFrame:
    """previous row's timestamp per key (ordered by ``ts``) and the gap in
    whole-second minutes. Equal to ``lag(ts) over (partition by keys order by ts)``,
    with no key, and no busy hour of a key, ever held by one task:

    1. rows are dealt into ranges of (keys, ts, row hash); a key holding a third
       of all rows spans many of them, and so does one burst with one timestamp;
    2. within a range ``lag`` gives each row the row before it;
    3. a range's first row takes the last row of the nearest earlier range with
       rows, from a table of the ranges' last rows: one row per range - a proven
       bound - and broadcast. It is aggregated from the source rows by the same
       range numbers, so it needs no exchange of the rows.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    n = ranges_of(df, partitions)
    names = df.columns
    order = [asc(k) for k in keys] + [asc(ts), asc("_tb")]
    laid = with_range_id(df.withColumn("_tb", row_hash(df)), order, n, "_range")
    here = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(ts).alias("t"), F.col("_tb").alias("h"))
    ends = laid.groupBy("_range").agg(F.max(here).alias("_end"))
    ends = ends.select("_range", F.lag("_end").over(Window.orderBy("_range")).alias("_carry"))
    within = Window.partitionBy("_range").orderBy(*[o.column() for o in order])
    rows = laid.repartitionById(n, F.col("_range")).withColumn("_before", F.lag(here).over(within))
    rows = rows.join(F.broadcast(ends), "_range", "left").withColumn("_before", F.coalesce("_before", "_carry"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col("_before")[f"k{i}"].eqNullSafe(F.col(k))
    rows = rows.withColumn(prev, F.when(F.col("_before").isNotNull() & same, F.col("_before")["t"]))
    gap = (F.unix_timestamp(F.col(ts)) - F.unix_timestamp(F.col(prev))) / 60.0
    return rows.select(*names, prev, gap.alias(out))


def lag_gap_sliced(df: DataFrame, keys, ts: str, slice_unit: str = "day", out: str = "gap_minutes",
                   prev: str = "prev_ts") -> DataFrame:
    """F3 without the range exchange's sampling pass, for data whose volume per
    (key, time slice) is known to be bounded: the window runs per (key, slice)
    and each slice's first row takes the previous non-empty slice's last
    timestamp from a small per-(key, slice) table. Same result as ``lag_gap``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    sl = "_slice"
    base = df.withColumn(sl, F.date_trunc(slice_unit, F.col(ts)))
    local_prev = F.lag(ts).over(Window.partitionBy(*keys, sl).orderBy(ts))
    carry = (base.groupBy(*keys, sl).agg(F.max(ts).alias("_slice_last"))
             .withColumn("_carry", F.lag("_slice_last").over(Window.partitionBy(*keys).orderBy(sl)))
             .drop("_slice_last"))
    out_df = (base.withColumn("_local_prev", local_prev)
              .join(carry, keys + [sl], "left")
              .withColumn(prev, F.coalesce(F.col("_local_prev"), F.col("_carry")))
              .drop("_local_prev", "_carry", sl))
    return out_df.withColumn(out, (F.unix_timestamp(F.col(ts)) - F.unix_timestamp(F.col(prev))) / 60.0)


def zscore(df: DataFrame, cols, suffix: str = "_z", names: dict | None = None) -> DataFrame:
    """(x - mean) / population std over the whole frame; a constant column
    gives null. The mean/std are scalar subqueries merged into one aggregate job."""
    names = names or {}
    exprs = {}
    for c in cols:
        mu = df.select(F.avg(c)).scalar()
        sd = df.select(F.stddev_pop(c)).scalar()
        exprs[names.get(c, c + suffix)] = F.try_divide(F.col(c) - mu, F.nullif(sd, F.lit(0.0)))
    return df.withColumns(exprs)


def global_rank(df: DataFrame, order, name: str = "rank", partitions: int | None = None) -> DataFrame:
    """1-based position in a global order (``order``: names, ``asc(...)``,
    ``desc(...)``; add a tie-break, else ties are numbered by a hash of the row).
    Rows are dealt into ranges of the order and numbered within them; the rows of
    the earlier ranges (one count per range, a proven bound for a broadcast) are
    added. Rows alike in every column stay in one range."""
    n = ranges_of(df, partitions)
    order = ordering(order) + [asc("_tb")]
    laid = with_range_id(df.withColumn("_tb", row_hash(df)), order, n, "_range")
    before = F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")
    offsets = laid.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select("_range", before.alias("_off"))
    within = Window.partitionBy("_range").orderBy(*[o.column() for o in order])
    rows = laid.repartitionById(n, F.col("_range")).withColumn("_local", F.row_number().over(within))
    return (rows.join(F.broadcast(offsets), "_range")
            .select(*df.columns, (F.col("_local") + F.col("_off")).cast("long").alias(name)))


def flag_max(df: DataFrame, value: str, tie_break: str, name: str = "is_max") -> DataFrame:
    """flag the row with the largest ``value``; on ties the smallest
    ``tie_break`` wins. The arg-max is a scalar subquery."""
    best = df.select(F.max(F.struct(F.col(value), (-F.col(tie_break)).alias("neg"))).alias("b"))
    b = best.select("b").scalar()
    return df.withColumn(name, (F.col(value) == b[value]) & (-F.col(tie_break) == b["neg"]))
