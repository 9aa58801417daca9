"""Sharding by vector bin packing (operator 1).

``pack(df, shards)`` deals documents into shards whose bytes, words and rows
are balanced together. Rows with equal texts are one group and stay together
unless the group alone would overfill a shard. Groups are placed from the
largest down, each where the dot product of its (bytes, words, rows) with the
shard's residual capacity is highest.

Scale. Groups are pre-aggregated (a hot text is one partial row per task). A
group larger than a shard's share in any dimension is split by document hash
into units of at most a quarter share; fewer than 3 * shards groups can be that
large. Rows alike in id and text that crowd (over a quarter share, or ``SLOT_CELL``
rows: at most 12 * shards + rows / SLOT_CELL such pairs) are spread by a row number
written once, in units and in slots, so null or repeated ids are no hot group either;
they are the same row many times, so only their counts per shard depend on that
number. Units above 1 / ``FINE`` of a share - at most 3 * FINE * shards of them -
are packed first, in one task of bounded size. All others go by key hash into
cells of about ``CELL`` units, each packed by its own task against its part of
the residual capacities, so cells need no order among them and their small
errors average out. Slots are numbered per (cell of documents, shard) and
offset by the counts of earlier cells: no shard is gathered in one task.

Result: ``doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard
(null), words``. Size: UTF-8 bytes plus 16.

Defined results: null text: size 16, crc 0, grouped with other nulls (not with
empty texts); null and repeated ids: every row gets its own slot; ties: by key;
fewer rows than shards: some shards stay empty; no rows: no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import WORDS, written

OVERHEAD = 16
FINE = 50
CELL = 20_000
SLOT_CELL = 200_000
DIMENSIONS = ("size", "words", "rows")
#: Part of each dimension in the dot product: bytes first (the law that holds), then words, then rows.
PARTS = np.array([1.0, 0.5, 0.005])


def place(items: np.ndarray, capacity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shard of each item (rows of positive vectors, largest first) and the
    residual capacities. Both are scaled so that a shard's share is 1; the dot
    product weighs the dimensions by ``PARTS``."""
    items, left = items * np.sqrt(PARTS), capacity * np.sqrt(PARTS)
    out = np.empty(len(items), np.int32)
    for i, item in enumerate(items):
        best = int((left @ item).argmax())
        out[i] = best
        left[best] -= item
    return out, left / np.sqrt(PARTS)


def _ordered(units: pd.DataFrame) -> pd.DataFrame:
    return units.sort_values(["weight", "key", "salt"], ascending=[False, True, True], kind="stable")


def pack(df: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """See the module text."""
    text = F.col(text_col).cast("string")
    docs = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.coalesce(F.crc32(F.encode(text, "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long").alias("words"),
        F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b"null")).alias("key"),
        F.monotonically_increasing_id().alias("row"))
    docs = written(docs, "shard-sizes")
    groups = written(docs.groupBy("key").agg(F.sum("size").alias("size"), F.sum("words").alias("words"), F.count("*").alias("rows")), "shard-groups")
    total = groups.agg(*(F.sum(c).alias(c) for c in DIMENSIONS), F.count("*").alias("n")).first()
    share = {c: max(total[c] or 0, 1) / shards for c in DIMENSIONS}
    load = F.greatest(*(F.col(c) / share[c] for c in DIMENSIONS))

    # hot groups: each holds over 1/shards of a dimension, so fewer than 3 * shards rows
    hot = groups.where(load > 1).select("key", F.ceil(load * 4).cast("int").alias("pieces"))
    # pairs of id and text that crowd: counted in large groups only (as few as the pairs at most)
    many = groups.where((load > 1 / 4) | (F.col("rows") > SLOT_CELL)).select("key")
    crowds = (docs.join(F.broadcast(many), "key", "left_semi").groupBy("key", "doc_id")
              .agg(F.sum("size").alias("size"), F.sum("words").alias("words"), F.count("*").alias("rows"))
              .where((load > 1 / 4) | (F.col("rows") > SLOT_CELL)))
    crowds = crowds.select(F.col("key").alias("crowd_key"), F.col("doc_id").alias("crowd_id"), F.lit(True).alias("crowd"))
    docs = docs.join(F.broadcast(crowds), (F.col("key") == F.col("crowd_key")) & F.col("doc_id").eqNullSafe(F.col("crowd_id")), "left")
    # the row number of a crowd's rows, else null, which the hash passes over
    docs = docs.withColumn("spread", F.when(F.col("crowd"), F.col("row"))).drop("row", "crowd", "crowd_key", "crowd_id")
    salted = (docs.join(F.broadcast(hot), "key", "left")
              .withColumn("salt", F.coalesce(F.pmod(F.xxhash64("doc_id", "spread"), F.col("pieces")), F.lit(0)).cast("int")).drop("pieces"))
    cut = (salted.join(F.broadcast(hot.select("key")), "key", "left_semi").groupBy("key", "salt")
           .agg(F.sum("size").alias("size"), F.sum("words").alias("words"), F.count("*").alias("rows")))
    units = groups.where(load <= 1).withColumn("salt", F.lit(0)).select("key", "salt", *DIMENSIONS).unionByName(cut)
    weight = sum((F.col(c) * (float(p) / share[c]) for c, p in zip(DIMENSIONS, PARTS)), F.lit(0.0))
    units = written(units.select("key", "salt", *DIMENSIONS, weight.alias("weight"), load.alias("load")), "shard-units")
    shares = np.array([share[c] for c in DIMENSIONS])

    # the large units: at most 3 * FINE * shards, one bounded task
    large = units.where(F.col("load") > 1 / FINE)

    def pack_large(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = _ordered(pdf)
        items = pdf[list(DIMENSIONS)].to_numpy(float) / shares
        return pdf.assign(shard=place(items, np.ones((shards, len(DIMENSIONS))))[0])[["key", "salt", "shard"]]
    head = written(large.withColumn("cell", F.lit(0)).groupBy("cell").applyInPandas(pack_large, "key binary, salt int, shard int"), "shard-large")
    used = large.join(F.broadcast(head), ["key", "salt"]).groupBy("shard").agg(
        *(F.sum(c).alias(c) for c in DIMENSIONS)).collect()  # a row per shard at most
    left = np.ones((shards, len(DIMENSIONS)))
    for r in used:
        left[r["shard"]] -= np.array([r[c] for c in DIMENSIONS]) / shares

    # each cell fills its part of what is left; shards that the large units overfilled get less or none
    cells = max(1, -(-int(total["n"]) // CELL))

    def pack_cell(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = _ordered(pdf)
        items = pdf[list(DIMENSIONS)].to_numpy(float) / shares
        part = items.sum(axis=0) / np.maximum(left.sum(axis=0), 1e-12)
        return pdf.assign(shard=place(items, left * part)[0])[["key", "salt", "shard"]]
    tail = (units.where(F.col("load") <= 1 / FINE)
            .withColumn("cell", F.pmod(F.xxhash64("key", "salt"), F.lit(cells)))
            .groupBy("cell").applyInPandas(pack_cell, "key binary, salt int, shard int"))
    tail = written(tail, "shard-tail")
    # a large unit's documents meet it by broadcast (bounded), the others by key
    placed = (salted.join(F.broadcast(head.withColumnRenamed("shard", "large")), ["key", "salt"], "left")
              .join(tail, ["key", "salt"], "left").withColumn("shard", F.coalesce("large", "shard")))
    slot_cells = max(1, -(-int(total["rows"] or 0) // SLOT_CELL))
    placed = written(placed.select("doc_id", "size", "text_crc32", "words", "shard", "key",
                                   F.pmod(F.xxhash64("doc_id", "key", "spread"), F.lit(slot_cells)).alias("part")), "shard-placed")
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("shard", "part", before.alias("start"))
    number = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "key"))
    return (placed.withColumn("number", number).join(starts, ["shard", "part"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("start") + F.col("number") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "words"))
