"""Near-duplicate groups by SuperMinHash signatures (operator 2).

``near_duplicates(df, id_col, text_col, k, percent)`` returns one row per
input row: ``doc_id, n_shingles, component_id, kept`` (and ``shingle_key``,
the digest of its shingle set).

Method. Each text becomes its set of distinct k-word shingles. Rows with the
same set are one class. A class gets a SuperMinHash signature: element e takes
rank j + r_j at slot p_j of its own permutation, so the ranks of an element are
correlated over the slots, and no step j past the largest slot value is run
(early stop). Signature bands are bucket keys.

Links are found without pairing a whole bucket: first every class is compared
with its bucket's smallest class on full sets. Classes of one bucket that are
still in different components then meet in blocks of bounded size, which carry
the full sets: a task counts the common shingles of a class with its whole block
at once, joins what links, skips what is joined already and returns only the
links that joined two components (fewer than the classes of the block). So no
link between different texts is lost to a leader, no bucket is gathered into one
task, and no stage returns the pairs of a group. A link at the threshold is
missed only if no band has it: a chance below ``MISS``.

Defined results: null or wordless text: ``n_shingles`` 0, a component of its
own. A null id: ``component_id`` null, ``kept`` true, links with nothing.
Repeated rows and ties: same class; rows that share an id count as one
document. Very long texts are read whole (a block holds fewer of them). Empty
table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import connected, lean, mix, shingle_sets, written

SLOTS = 256
MISS = 1e-6
BLOCK = 1024  # classes of a block
BLOCK_SHINGLES = 1 << 20  # shingles of a block, about
_STEP = np.uint64(0x9E3779B97F4A7C15)


def layout(percent: int, most: int = SLOTS // 2, miss: float = MISS) -> tuple[int, int]:
    """(bands, rows): the longest bands whose chance to miss a link at the
    threshold stays below ``miss`` with at most ``most`` slots."""
    s = percent / 100
    for rows in range(16, 0, -1):
        bands = most // rows
        if (1 - s ** rows) ** bands <= miss:
            return bands, rows
    return most, 1


def super_min_hash(sets: list[np.ndarray], m: int, slice_size: int = 1 << 15) -> np.ndarray:
    """Signature matrix (len(sets), m) of float64 ranks; no element: infinity."""
    sig = np.full((len(sets), m), np.inf)
    at = 0
    while at < len(sets):  # about slice_size elements at once; a larger set in slices of itself
        to, total = at, 0
        while to < len(sets) and (to == at or total + len(sets[to]) <= slice_size):
            total += len(sets[to])
            to += 1
        if to == at + 1:
            for lo in range(0, len(sets[at]), slice_size):
                _update(sig[at:to], sets[at][lo:lo + slice_size], np.zeros(min(slice_size, len(sets[at]) - lo), np.int64))
        elif total:
            owner = np.repeat(np.arange(to - at), [len(s) for s in sets[at:to]])
            _update(sig[at:to], np.concatenate(sets[at:to]), owner)
        at = to
    return sig


def _update(sig: np.ndarray, elements: np.ndarray, owner: np.ndarray) -> None:
    m = sig.shape[1]
    flat = sig.reshape(-1)
    perm = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.int32), (len(elements), 1))
    for j in range(m):
        if len(elements) == 0:
            return
        word = mix(elements + np.uint64((2 * j + 1) * int(_STEP) & 0xFFFFFFFFFFFFFFFF))
        r = (word >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
        k = j + (mix(word + _STEP) % np.uint64(m - j)).astype(np.int64)
        rows = np.arange(len(elements))
        slot = perm[rows, k]
        perm[rows, k] = perm[:, j]
        perm[:, j] = slot
        np.minimum.at(flat, owner * m + slot, j + r)
        still = (sig.max(axis=1) > j + 1)[owner]  # later ranks are j + 1 or more
        if not still.all():
            elements, owner, perm = elements[still], owner[still], perm[still]


def _codes(sig: np.ndarray) -> np.ndarray:
    """16-bit code of each slot value."""
    return (mix(sig.view(np.uint64)) >> np.uint64(48)).astype(np.uint16)


def _band_keys(codes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.empty((len(codes), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(codes), b + 1, np.uint64)
        for c in range(b * rows, (b + 1) * rows):
            h = mix(h * _STEP + codes[:, c].astype(np.uint64))
        out[:, b] = h
    return out


def _digest(hashes: bytes) -> bytes | None:
    return hashlib.blake2b(hashes, digest_size=16).digest() if hashes else None


def _signer(k: int, bands: int, rows: int):
    def run(batches):
        for batch in batches:
            sets = shingle_sets(batch.column(1), k)
            n = np.array([len(s) for s in sets], np.int64)
            codes = _codes(super_min_hash(sets, SLOTS)) if len(sets) else np.zeros((0, SLOTS), np.uint16)
            keys = _band_keys(codes, bands, rows).astype(np.int64) if len(sets) else np.zeros((0, bands), np.int64)
            digest = [_digest(s.tobytes()) for s in sets]
            offsets = np.arange(0, (len(sets) + 1) * bands, bands, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n), pa.array(digest, pa.binary()),
                pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1))),
            ], names=["doc_id", "n_shingles", "shingle_key", "bands"])
    return run


def _setter(k: int):
    def run(batches):
        for batch in batches:
            sets = [s.tobytes() for s in shingle_sets(batch.column(1), k)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([_digest(s) for s in sets], pa.binary()), pa.array(sets, pa.large_binary()).cast(pa.binary())],
                names=["id", "shingle_key", "hashes"])
    return run


def _verifier(percent: int):
    def run(batches):
        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            keep = []
            for x, y in zip(a, b):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])
    return run


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full shingle sets meet the threshold."""
    x = sets.select(F.col("id").alias("a"), F.col("hashes").alias("x"))
    y = sets.select(F.col("id").alias("b"), F.col("hashes").alias("y"))
    joined = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
    return joined.mapInArrow(lean(_verifier(percent)), "a long, b long")


def _spanning(side: np.ndarray, ids: np.ndarray, comp: np.ndarray, sets: list[np.ndarray], percent: int):
    """Links of a block's classes that join two components. Side 0: one block,
    all meet; side 1 meets side 2 (two blocks of a bucket)."""
    local = np.unique(np.concatenate(sets), return_inverse=True)[1]
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    mark = np.zeros(int(local.max()) + 1, np.int32)
    root = np.unique(comp, return_inverse=True)[1]
    # links inside the largest component add nothing; the others meet it in their own turns
    for i in np.flatnonzero(root != np.bincount(root).argmax()):
        open_ = root != root[i]
        if side[i]:
            open_ &= side != side[i]
        if not open_.any():
            continue
        own = local[starts[i]:ends[i]]
        mark[own] = 1
        both = np.add.reduceat(mark[local], starts)
        mark[own] = 0
        hit = open_ & (100 * both >= percent * (sizes + sizes[i] - both))
        for j in np.flatnonzero(hit):
            if root[j] != root[i]:
                yield int(min(ids[i], ids[j])), int(max(ids[i], ids[j]))
                root[root == root[j]] = root[i]


def _block_links(percent: int):
    """Spanning links of the blocks of a bucket. Input is sorted by (bucket, cell)."""
    def links(group):
        if len(group) < 2:
            return []
        side, ids, comp = (np.array(x) for x in zip(*(g[:3] for g in group)))
        return list(_spanning(side, ids, comp, [np.frombuffer(g[3], np.uint64) for g in group], percent))

    def run(batches):
        group, key = [], None
        for batch in batches:
            out = []
            for bucket, cell, *row in zip(*(batch.column(n).to_pylist() for n in range(6))):
                if (bucket, cell) != key:
                    out += links(group)
                    group, key = [], (bucket, cell)
                group.append(row)
            yield _pair_batch(out)
        yield _pair_batch(links(group))
    return run


def _pair_batch(out) -> pa.RecordBatch:
    out = sorted(set(out))
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["a", "b"])


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """See the module text. Links: 100 * intersection >= percent * union."""
    bands, rows = layout(percent)
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = written(texts.mapInArrow(lean(_signer(k, bands, rows)),
                                      "doc_id long, n_shingles long, shingle_key binary, bands array<long>"), "near-sig")
    live = signed.where("shingle_key is not null and doc_id is not null")
    classes = live.groupBy("shingle_key").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    classes = written(classes, "near-classes")

    members = classes.select("id", "n", F.explode("bands").alias("bucket"))
    leaders = members.groupBy("bucket").agg(F.min("id").alias("leader"), F.max("id").alias("top")).where("leader < top")
    shared = written(members.join(leaders, "bucket").select("bucket", "id", "n", "leader"), "near-buckets")
    met = classes.join(shared.select("id").distinct(), "id", "left_semi").select("id", "shingle_key")
    sets = texts.join(met.select("id").distinct(), "id", "left_semi").mapInArrow(lean(_setter(k)), "id long, shingle_key binary, hashes binary")
    # an id may repeat, with this text or others: one set for each class
    sets = written(sets.join(met, ["id", "shingle_key"], "left_semi").dropDuplicates(["id", "shingle_key"]).drop("shingle_key"), "near-sets")
    first = _confirm(shared.where("id > leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct(), sets, percent)
    first = written(first, "near-links")
    comps = written(connected(first), "near-comps")

    rest = shared.join(comps, "id", "left").select("bucket", "id", "n", F.coalesce("component", "id").alias("comp"))
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    mixed = (rest.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), blocks.alias("blocks"))
             .where("lo < hi").select("bucket", "blocks"))
    rest = rest.join(mixed, "bucket").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    meet = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        (F.least(F.col("block"), o).cast("long") * F.col("blocks") + F.greatest(F.col("block"), o)).alias("cell"),
        F.when(o == F.col("block"), 0).when(F.col("block") < o, 1).otherwise(2).alias("side")))
    cells = (rest.select("bucket", "id", "comp", F.explode(meet).alias("c")).select("bucket", "c.cell", "c.side", "id", "comp")
             .join(sets, "id"))
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = cells.repartition(width, "bucket", "cell").sortWithinPartitions("bucket", "cell")
    more = cells.select("bucket", "cell", "side", "id", "comp", "hashes").mapInArrow(lean(_block_links(percent)), "a long, b long").distinct()
    links = written(first.unionByName(more), "near-links")

    final = connected(links)
    named = classes.select("shingle_key", "id").join(final, "id").select("shingle_key", "component")
    alone = classes.select("shingle_key", "id").join(final.select("id"), "id", "left_anti").select("shingle_key", F.col("id").alias("component"))
    found = signed.select("doc_id", "n_shingles", "shingle_key")
    # texts without words share no key; kept out of the join, they are no hot key
    keyed = found.where("shingle_key is not null").join(named.unionByName(alone), "shingle_key", "left").select(*found.columns, "component")
    every = keyed.unionByName(found.where("shingle_key is null").withColumn("component", F.lit(None).cast("long")))
    comp = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return every.select("doc_id", "n_shingles", comp.alias("component_id"),
                        F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept"), "shingle_key")
