"""Helpers of the training-data operators: scratch tables, word hashes over
Arrow buffers, seeded mixing, connected components.

Nothing here triggers work on the driver beyond scalar counts; every
intermediate table is Parquet below the folder named by
``spark.checkpoint.dir``, so a lost executor never loses the only copy.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir

WORDS = r"[^\x20\x09-\x0D]+"

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3 * 2 + 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/tessera-llm/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder (cuts the lineage)."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lean(run):
    """``run`` (batches to batches) that gives freed Arrow memory back to the
    system after each batch: Python workers live on through later stages, and
    what they keep counts against their executor."""
    def released(batches):
        for out in run(batches):
            yield out
            del out
            pa.default_memory_pool().release_unused()
        pa.default_memory_pool().release_unused()
    return released


def free_name(df: DataFrame, want: str) -> str:
    """``want``, or with underscores added until no column of ``df`` has it."""
    have = {c.lower() for c in df.columns}
    while want.lower() in have:
        want += "_"
    return want


def without(df: DataFrame, names: list[str], needed: str) -> DataFrame:
    """``df`` less the columns that new columns of these names replace."""
    gone = [c for c in df.columns if c.lower() in names and c != needed]
    return df.drop(*gone) if gone else df


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser over uint64 (wraps silently)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _powers or len(_powers["p"]) < n:
        size = max(n, 1 << 20)
        for key, base in (("p", _BASE), ("i", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
            steps[0] = 1
            _powers[key] = np.multiply.accumulate(steps)
    return _powers["p"], _powers["i"]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if pa.types.is_null(column.type):
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    wide = pa.types.is_large_string(column.type)
    buffers = column.buffers()
    offs = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)[column.offset:column.offset + n + 1]
    offs = offs.astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def row_runs(column: pa.Array, size: int = 1 << 21):
    """(first row, rows) of slices of a string column of about ``size`` bytes
    (one text at least), so that what is made from them stays small whatever a
    batch holds."""
    _, offs = text_bytes(column)
    at, rows = 0, len(offs) - 1
    while at < rows:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + size, "right")) - 1)
        yield at, to - at
        at = to


def runs(column: pa.Array):
    """The slices of ``row_runs``."""
    for at, n in row_runs(column):
        yield column.slice(at, n)


def word_spans(data: np.ndarray, offs: np.ndarray, letters: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of each word (runs without 0x20, 0x09-0x0D; with
    ``letters`` runs of ASCII letters, digits and bytes from 0x80) and the
    word count before each text (n + 1 numbers)."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    if letters:
        low = data | 32
        solid = (data >= 128) | ((low >= 97) & (low <= 122)) | ((data >= 48) & (data <= 57))
    else:
        solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = np.zeros(len(data) + 1, bool)
    first[offs] = True
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | first[1:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | first[1:-1]
    s = np.flatnonzero(starts)
    return s, np.flatnonzero(ends) + 1, np.searchsorted(s, offs)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int = 1 << 20, fold: bool = True) -> np.ndarray:
    """64-bit hash of each span of ``data`` (bytes, or code points), with A-Z
    lower-cased if ``fold``. Spans ascend and do not overlap; the prefix sums
    cover about ``window`` places at a time."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + window, "right")))
        lo, hi = int(starts[at]), int(ends[to - 1])
        part = data[lo:hi].astype(np.uint64)
        if fold:
            part += np.uint64(32) * ((part >= 65) & (part <= 90))
        p, inv = _power(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((part + np.uint64(1)) * p[:hi - lo], out=sums[1:])
        s, e = starts[at:to] - lo, ends[at:to] - lo
        out[at:to] = mix((sums[e] - sums[s]) * inv[s] + (e - s).astype(np.uint64) * _GOLD)
        at = to
    return out


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its k-word shingles (A-Z lower-
    cased); 1..k-1 words: the whole sequence as one; no words: empty."""
    out = []
    for part in runs(column):
        data, offs = text_bytes(part)
        starts, ends, count = word_spans(data, offs)
        words = span_hashes(data, starts, ends)
        for lo, hi in zip(count[:-1].tolist(), count[1:].tolist()):
            n = hi - lo
            if n == 0:
                out.append(np.zeros(0, np.uint64))
                continue
            width = min(n, k)
            h = words[lo:hi - width + 1] + np.uint64(width)
            for j in range(1, width):
                h = mix(h * _M2 + words[lo + j:hi - width + 1 + j])
            out.append(np.unique(mix(h)))
    return out


def connected(edges: DataFrame, label: str = "components", rounds: int = 60) -> DataFrame:
    """``(id, component)`` of every id in ``edges(a, b)``: the smallest id
    reachable. Alternating large and small stars; each round is written to
    the shared folder, and a node's neighbours are only min-aggregated and
    joined back (a hot node's join can be split), never gathered in a list."""
    spark = edges.sparkSession
    e = written(edges.where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(),
                label)
    seen = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        e = written(large, label)
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        small = (e.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))).alias("x"))
            .select("x.*").where("u <> v").distinct())
        e = written(small, label)
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
