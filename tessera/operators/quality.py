"""Data rules from the course notes as table checks and reshapes.

Every check returns the violating rows (empty frame = rule holds), so the
result of a check scales with the violations, not the table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_pk(df: DataFrame, key) -> DataFrame:
    """Key values that are null or not unique: (key..., n, problem), from
    one grouped count."""
    keys = [key] if isinstance(key, str) else list(key)
    null_any = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return (per_key.filter(null_any | (F.col("n") > 1))
            .withColumn("problem", F.when(null_any, F.lit("null key")).otherwise(F.lit("duplicate"))))


def check_fk(child: DataFrame, col: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-null reference has no parent (orphans)."""
    return child.filter(F.col(col).isNotNull()).join(
        parent.select(F.col(key).alias("_pk")), F.col(col) == F.col("_pk"), "left_anti")


def check_domain(df: DataFrame, rules: dict, id_cols) -> DataFrame:
    """One row per (record, broken rule). ``rules`` maps a rule name to a
    Column that must be true; a null result counts as broken."""
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    broken = F.filter(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(name))
                                for name, c in rules.items()]), lambda x: x.isNotNull())
    return df.select(*ids, F.explode(broken).alias("rule"))


def fk_delete(parent_deleted: DataFrame, key: str, child: DataFrame, col: str, mode: str = "restrict"):
    """Effect on the child table of deleting parent keys.

    ``cascade``: child rows that survive; ``set_null``: child with the reference
    cleared; ``restrict``: the child rows that block the delete (empty = allowed).
    """
    gone = parent_deleted.select(F.col(key).alias("_dk")).distinct()
    hit = F.col(col) == F.col("_dk")
    if mode == "cascade":
        return child.join(gone, hit, "left_anti")
    if mode == "restrict":
        return child.join(gone, hit, "left_semi")
    if mode == "set_null":
        flagged = child.join(gone.withColumn("_hit", F.lit(True)), hit, "left")
        return flagged.withColumn(col, F.when(F.col("_hit").isNull(), F.col(col))).drop("_dk", "_hit")
    raise ValueError(mode)


def check_fd(df: DataFrame, x, y: str) -> DataFrame:
    """Determinant values mapping to more than one ``y`` (X -> Y violated);
    a missing ``y`` counts as a value."""
    xs = [x] if isinstance(x, str) else list(x)
    missing = F.max(F.when(F.col(y).isNull(), 1).otherwise(0))
    return (df.groupBy(*xs).agg((F.countDistinct(y) + missing).alias("n_values"))
            .filter(F.col("n_values") > 1))


def explode_list(df: DataFrame, cols, sep: str = ",", keep=()) -> DataFrame:
    """N6 (1NF): parallel multi-valued text cells split into one row per position."""
    arrays = [F.split(F.col(c), sep).alias(c) for c in cols]
    z = F.arrays_zip(*arrays)
    return (df.select(*keep, F.posexplode(z).alias("pos", "_z"))
            .select(*keep, "pos", *[F.trim(F.col("_z")[c]).alias(c) for c in cols]))


def decompose(df: DataFrame, tables: dict) -> dict:
    """Split into entity tables (distinct projections)."""
    return {name: df.select(*cols).distinct() for name, cols in tables.items()}


def lossless_check(original: DataFrame, parts: dict, joins) -> DataFrame:
    """Rejoin the parts on ``joins`` (list of (table, key)) and compare
    distinct row counts: (original_rows, rejoined_rows, lossless)."""
    names = list(parts)
    out = parts[names[0]]
    for name, key in joins:
        out = out.join(parts[name], key)
    cols = original.columns
    orig_n = original.select(*cols).distinct().select(F.count(F.lit(1))).scalar()
    back = out.select(*cols).distinct()
    return back.agg(F.count(F.lit(1)).alias("rejoined_rows")).select(
        orig_n.alias("original_rows"), "rejoined_rows",
        (F.col("rejoined_rows") == orig_n).alias("lossless"))


def subtype_rollup(typed: dict, type_col: str = "subtype") -> DataFrame:
    """N8 roll-up: subtypes in one table with a type column (missing columns null)."""
    frames = [df.withColumn(type_col, F.lit(tag)) for tag, df in typed.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def subtype_rolldown(rolled: DataFrame, type_col: str, tag: str, cols) -> DataFrame:
    """N8 roll-down: one subtype's own table."""
    return rolled.filter(F.col(type_col) == tag).select(*cols)


def subtype_hacksaw(supertype: DataFrame, subtypes: dict, key: str, type_col: str = "subtype") -> DataFrame:
    """N8 hacksaw: the supertype's columns joined by ``key`` to each subtype's own
    table; a row without a subtype keeps nulls, one in several gives a row each."""
    typed = subtype_rollup(subtypes, type_col)
    return supertype.join(typed, key, "left")


def daily_summary(df: DataFrame, ts: str, aggs: dict, name: str = "day") -> DataFrame:
    """Summary table by calendar day."""
    return df.groupBy(F.to_date(F.col(ts)).alias(name)).agg(*[e.alias(n) for n, e in aggs.items()])


def denormalize(child: DataFrame, parent: DataFrame, on, cols) -> DataFrame:
    """Copy parent columns into the child (dimension-side join)."""
    keys = [on] if isinstance(on, str) else list(on)
    return child.join(parent.select(*keys, *cols), keys, "left")


def code_names(df: DataFrame, col: str, codes: DataFrame, code_col: str = "code",
               name_col: str = "code_name", group: str | None = None, group_col: str = "code_group") -> DataFrame:
    """Code -> code name from a code table (optionally one code group)."""
    c = codes if group is None else codes.filter(F.col(group_col) == group)
    return df.join(c.select(F.col(code_col).alias(col), name_col), col, "left")


def standardize_terms(df: DataFrame, col: str, mapping: DataFrame, term: str = "term",
                      standard: str = "standard") -> DataFrame:
    """Synonyms replaced by their standard term; unknown terms kept."""
    m = mapping.select(F.col(term).alias("_term"), F.col(standard).alias("_std"))
    return (df.join(m, F.col(col) == F.col("_term"), "left")
            .withColumn(col, F.coalesce(F.col("_std"), F.col(col))).drop("_term", "_std"))


def standard_name(name: str, dictionary: dict, sep: str = "_") -> str:
    """N13 helper: replace each word of a column name by its dictionary abbreviation."""
    return sep.join(dictionary.get(w.lower(), w.lower()) for w in name.replace("-", " ").replace("_", " ").split())


def standardize_columns(df: DataFrame, dictionary: dict, sep: str = "_") -> DataFrame:
    """Rename every column to its standard form built from a word dictionary."""
    return df.withColumnsRenamed({c: standard_name(c, dictionary, sep) for c in df.columns})


def banned_words(columns, banned) -> list:
    """N13 report: column names containing a banned word."""
    bad = {b.lower() for b in banned}
    return [c for c in columns if any(w in bad for w in c.lower().replace("-", "_").split("_"))]


def with_audit_columns(df: DataFrame, user: str, at=None) -> DataFrame:
    """created/updated timestamp and user columns; ``at``: the load time
    (a timestamp column), else the query's own."""
    at = F.current_timestamp() if at is None else at
    return df.withColumns({"created_at": at, "created_by": F.lit(user), "updated_at": at, "updated_by": F.lit(user)})


def bridge_join(left: DataFrame, bridge: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """M:N through a bridge of distinct key pairs."""
    pairs = bridge.select(left_key, right_key).distinct()
    return left.join(pairs, left_key).join(right, right_key)


def surrogate_key(df: DataFrame, natural, name: str = "sk") -> DataFrame:
    """Surrogate key 1..n, one per distinct natural key (missing parts are
    values too), numbered in natural order over a range exchange - no global
    window - and joined back to the rows."""
    from tessera.operators.windows import global_rank
    keys = [natural] if isinstance(natural, str) else list(natural)
    numbered = global_rank(df.select(*keys).distinct(), keys, name)
    n = numbered.select(*[F.col(k).alias(f"_n{i}") for i, k in enumerate(keys)], name)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_n{i}"))
    return df.join(n, same).select(*df.columns, name)
