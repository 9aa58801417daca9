"""Lempel-Ziv phrase fingerprints (operator 5).

A text is parsed into LZ78 phrases: the longest phrase seen before plus one
code point is a new phrase. The set of its phrases, each hashed by its code
points, is what the text's own compressor would store; the ``SIZE`` smallest
hashes of the set are its signature (bottom-k minimum hashing), and two
signatures estimate the share of common phrases of two texts - texts that would
compress each other well score high.

``compare_next(df)`` also fingerprints each text after an edit and compares it
with the next row's, in descending id order (after the last: the first).

A phrase is found by moving from the last phrase's length (the dictionary is
prefix-closed); the dictionary holds as many code points as the text, and an
edited text goes on from the dictionary at the edit.

Rows meet their successors in
range slices: split ids are taken once from the id column, each row goes to the
slice of its id, and a slice's last row gets its successor as a halo row, so
each text is shuffled once and no slice needs another.

Defined results: null text is empty; texts without phrases have the empty
fingerprint, likeness 1 to each other and 0 to others; equal texts have equal
fingerprints; rows with equal ids follow by text; null ids come after all ids;
a single row is its own next; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import mix, span_hashes

SIZE = 128


def parse(text: str, seen: set[str], cuts: list[int], stop: int) -> None:
    """Go on parsing ``text`` at ``cuts[-1]``; phrases that end by ``stop``."""
    i, size, add, put = cuts[-1], 1, seen.add, cuts.append
    while i < stop:
        # the shortest piece from i that is not in the dictionary
        if text[i:i + size] in seen:
            size += 1
            while i + size <= stop and text[i:i + size] in seen:
                size += 1
        else:
            while size > 1 and text[i:i + size - 1] not in seen:
                size -= 1
        if i + size > stop:
            return
        add(text[i:i + size])
        i += size
        put(i)


def signature(text: str, cuts: list[int]) -> np.ndarray:
    """The SIZE smallest 32-bit hashes of the phrases between ``cuts``."""
    if len(cuts) < 2:
        return np.zeros(0, np.uint32)
    at = np.array(cuts)
    h = mix(span_hashes(np.frombuffer(text.encode("utf-32-le"), "<u4"), at[:-1], at[1:], fold=False))
    return np.unique((h >> np.uint64(32)).astype(np.uint32))[:SIZE]


def fingerprint(text: str) -> np.ndarray:
    seen, cuts = set(), [0]
    parse(text, seen, cuts, len(text))
    return signature(text, cuts)


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by as many of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common phrases: of the SIZE smallest hashes of both
    together, those that both have."""
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    _, times = np.unique(np.concatenate([a, b]), return_counts=True)
    return float((times[:SIZE] == 2).mean())


def as_text(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


class _Row:
    """A text parsed up to its edit and, from there, as it is."""

    def __init__(self, doc_id, text: str):
        self.doc_id, self.text = doc_id, text
        self.seen, self.cuts = set(), [0]
        parse(text, self.seen, self.cuts, len(text) - len(text) // 2)
        seen, cuts = set(self.seen), list(self.cuts)
        parse(text, seen, cuts, len(text))
        self.sig = signature(text, cuts)

    def against(self, following: "_Row") -> tuple:
        new = edited(self.text, following.text)
        parse(new, self.seen, self.cuts, len(new))
        sig = signature(new, self.cuts)
        return (self.doc_id, len(self.text), hashlib.sha256(new.encode()).hexdigest(), as_text(self.sig), as_text(sig),
                likeness(self.sig, sig), likeness(self.sig, following.sig))


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _meet(batches):
    """Rows in (slice, halo, order) sequence; each meets its successor."""
    before, part = None, None
    for batch in batches:
        out = []
        for now, halo, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if now != part:
                before, part = None, now
            elif before is None and halo:
                continue  # the halo's first row was met
            row = _Row(doc_id, text)
            if before is not None:
                out.append(before.against(row))
            before = None if halo else row
        rows = list(zip(*out)) or [()] * len(NAMES)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, TYPES)], names=NAMES)


def compare_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", slices: int | None = None) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next`` (see the module text)."""
    slices = slices or 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # split ids, one per slice: slice 0 has the null ids, higher slices larger ids
    quantiles = rows.select("doc_id").approxQuantile("doc_id", [i / slices for i in range(1, slices)], 1 / (8 * slices)) if slices > 1 else []
    cuts = np.unique(np.array(quantiles, dtype=np.float64))

    @F.pandas_udf("int")
    def slice_of(ids: pd.Series) -> pd.Series:
        part = np.searchsorted(cuts, ids.to_numpy(dtype=np.float64, na_value=np.nan), side="right") + 1
        return pd.Series(np.where(ids.isna(), 0, part))
    rows = rows.withColumn("part", slice_of("doc_id"))
    # the largest id of each slice, and whose successor it is: a row per slice
    tops = rows.groupBy("part").agg(F.max("doc_id").alias("top"))
    order, everything = Window.orderBy(F.desc("part")), Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tops = tops.select("top", F.coalesce(F.lag("part").over(order), F.last("part").over(everything)).alias("halo_of"))
    marked = rows.alias("r").join(F.broadcast(tops), F.col("r.doc_id").eqNullSafe(F.col("top")), "left")
    places = F.array(F.struct(F.col("part"), F.lit(0).alias("halo")), F.struct(F.col("halo_of").alias("part"), F.lit(1).alias("halo")))
    dealt = (marked.select(F.explode(places).alias("p"), "doc_id", "text").where("p.part is not null")
             .select("p.part", "p.halo", "doc_id", "text"))
    dealt = dealt.repartitionById(len(cuts) + 2, F.col("part"))
    return (dealt.sortWithinPartitions("part", "halo", F.desc_nulls_last("doc_id"), "text")
            .mapInArrow(_meet, ", ".join(f"{n} {t}" for n, t in zip(NAMES, ["long", "long", "string", "string", "string", "double", "double"]))))
