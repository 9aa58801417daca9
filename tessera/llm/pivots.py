"""Near-duplicate vectors by a pivot-permutation index (operator 10).

``links(df)`` finds, within each label, all pairs of vectors of cosine at least
``threshold`` and returns per row ``vec_id, n_links, component_id, kept``.

Method. ``PIVOTS`` reference points are drawn from a bounded sample of the
vectors themselves (smallest id hash), no two of them nearer than cosine
``APART``: points within one group of near copies would order its members by
chance. Every vector is described by its
``NEAREST`` nearest points in order; two vectors are candidates when they share
at least ``SHARED`` of them. The shared-pivot count is read from inverted lists
keyed by the ``SHARED``-subsets of a description: vectors of one list share
that many pivots by construction, and lists are far shorter than those of
single pivots. Candidates are verified by their cosine in double precision, so
no link below the threshold is ever made; recall depends on ``SHARED`` only
(measured in the tests against brute force; at cosine 0.98 it is over 0.999).

Hot lists. Equal vectors of a label are one class with a row count, so copies
never meet in pairs. A list is cut into blocks of ``BLOCK`` classes by hash, and
pairs of blocks are compared in tasks of their own as matrix products; a pair
counts in one list only, that of the smallest pivots that both share. What
leaves a task is, per class and block, its number of links and an edge to the
smallest class of its group in the block - not the pairs.

Defined results: a null label, a null, empty or zero vector, or one with null or
non-finite parts links with nothing, not even its copies (``n_links`` 0, own
component, kept); vectors of different lengths never link; equal rows link with
each other; null ids: ``component_id`` null, kept, and counted by nobody; rows
that repeat an id count as that many vectors; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import connected, mix, written

PIVOTS = 256
NEAREST = 8
SHARED = 3
BLOCK = 512
THRESHOLD = 0.98
APART = 0.8
SAMPLE = 8 * PIVOTS


def _unit(rows: list, dim: int | None = None) -> np.ndarray:
    m = np.array(rows, np.float64)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def choose(sample: np.ndarray, most: int = PIVOTS, apart: float = APART) -> np.ndarray:
    """The first ``most`` unit vectors that are not near an earlier one."""
    out: list[int] = []
    for i in range(len(sample)):
        if len(out) < most and (not out or (sample[out] @ sample[i]).max() < apart):
            out.append(i)
    return sample[out]


def describe(vectors: np.ndarray, pivots: np.ndarray, nearest: int = NEAREST) -> np.ndarray:
    """Indices of the nearest pivots of unit vectors, nearest first."""
    sim = vectors @ pivots.T
    k = min(nearest, sim.shape[1])
    top = np.argpartition(-sim, k - 1, axis=1)[:, :k]
    order = np.argsort(-np.take_along_axis(sim, top, axis=1), axis=1, kind="stable")
    return np.take_along_axis(top, order, axis=1)


def subset_keys(order: np.ndarray, shared: int = SHARED) -> tuple[np.ndarray, np.ndarray]:
    """Key and largest pivot of every ``shared``-subset of each description
    (rows ascending)."""
    keys, tops = [], []
    for c in combinations(range(order.shape[1]), min(shared, order.shape[1])):
        h = np.zeros(len(order), np.uint64)
        for i in c:
            h = mix(h * np.uint64(0x100000001B3) + order[:, i].astype(np.uint64) + np.uint64(1))
        keys.append(h)
        tops.append(order[:, c[-1]])
    return np.stack(keys, axis=1), np.stack(tops, axis=1)


def _indexer(pivots: dict[int, np.ndarray]):
    def run(batches):
        for batch in batches:
            label, ids, vectors = batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()
            out: list = [None] * len(ids)
            for dim in {len(v) for v in vectors}:
                rows = [i for i, v in enumerate(vectors) if len(v) == dim]
                unit = _unit([vectors[i] for i in rows])
                if dim in pivots:
                    order = np.sort(describe(unit, pivots[dim]), axis=1).astype(np.uint16)
                    keys, tops = subset_keys(order)
                else:  # a length that the sample lacks: one list per label and length
                    order = np.zeros((len(rows), 0), np.uint16)
                    keys, tops = np.zeros((len(rows), 1), np.uint64), np.full((len(rows), 1), -1)
                tag = mix(np.array([label[i] for i in rows], np.int64).astype(np.uint64) * np.uint64(1_000_003) + np.uint64(dim))
                keys = mix(keys + tag[:, None]).astype(np.int64)
                for at, i in enumerate(rows):
                    out[i] = ([{"key": k, "top": t} for k, t in zip(keys[at].tolist(), tops[at].tolist())], order[at].tobytes(), unit[at].tobytes())
            lists, orders, units = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [ids, batch.column(3), pa.array(lists, pa.list_(pa.struct([("key", pa.int64()), ("top", pa.int32())]))),
                 pa.array(orders, pa.binary()), pa.array(units, pa.binary())], names=["id", "n", "lists", "pivots", "unit"])
    return run


def _comparer(threshold: float):
    """Links within blocks. Input is sorted by (key, cell): ``key, cell, side,
    id, n, top, pivots, unit``."""
    def compare(group, out):
        side, ids, count = (np.array([g[c] for g in group]) for c in (0, 1, 2))
        top, size = group[0][3], len(group[0][4]) // 2
        x = np.frombuffer(b"".join(g[5] for g in group), np.float64).reshape(len(group), -1)
        inner = bool((side == 0).all())
        a = np.arange(len(ids)) if inner else np.flatnonzero(side == 1)
        b = a if inner else np.flatnonzero(side == 2)
        if len(a) == 0 or len(b) == 0:
            return
        hit = x[a] @ x[b].T >= threshold - 1e-9
        if inner:
            hit &= ids[a][:, None] < ids[b][None, :]
        if top >= 0:  # the pair counts in the list of the smallest pivots that both share
            near = np.zeros((len(ids), top + 1), np.float32)
            order = np.frombuffer(b"".join(g[4] for g in group), np.uint16).reshape(len(group), size)
            rows = np.repeat(np.arange(len(ids)), size).reshape(order.shape)
            near[rows[order <= top], order[order <= top]] = 1
            hit &= near[a, :top] @ near[b, :top].T == min(SHARED, size) - 1
        i, j = np.nonzero(hit)
        p, q = a[i], b[j]
        # products in id order decide at the threshold, whatever block a pair meets in
        first, second = np.where(ids[p] < ids[q], p, q), np.where(ids[p] < ids[q], q, p)
        real = np.ones(len(p), bool)
        for lo in range(0, len(p), 1 << 14):
            s = slice(lo, lo + (1 << 14))
            real[s] = (x[first[s]] * x[second[s]]).sum(axis=1) >= threshold
        p, q = p[real], q[real]
        if len(p) == 0:
            return
        links = np.bincount(p, weights=count[q], minlength=len(ids)) + np.bincount(q, weights=count[p], minlength=len(ids))
        # the smallest class of each group of this block: its spanning edges
        order = np.argsort(ids, kind="stable")
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.arange(len(ids))
        root = rank.copy()
        while True:
            new = root.copy()
            np.minimum.at(new, p, root[q])
            np.minimum.at(new, q, root[p])
            new = np.minimum(new, new[order[new]])
            if (new == root).all():
                break
            root = new
        linked = np.flatnonzero(links > 0)
        out += zip(ids[linked].tolist(), links[linked].astype(np.int64).tolist(), ids[order[root[linked]]].tolist())

    def run(batches):
        group, at = [], None
        for batch in batches:
            out: list = []
            for key, cell, *row in zip(*(batch.column(i).to_pylist() for i in range(8))):
                if (key, cell) != at:
                    if len(group) > 1:
                        compare(group, out)
                    group, at = [], (key, cell)
                group.append(row)
            yield _found(out)
        out = []
        if len(group) > 1:
            compare(group, out)
        yield _found(out)
    return run


def _found(out: list) -> pa.RecordBatch:
    cols = list(zip(*out)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["id", "links", "near"])


def links(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
          threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row (see the module text)."""
    spark = df.sparkSession
    vector = F.col(vector_col).cast("array<double>")
    whole = (F.col("label").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)
             & F.coalesce(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
             & F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False)))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), vector.alias("vector"))
    rows = rows.withColumn("digest", F.when(whole & F.col("vec_id").isNotNull(), F.sha2(F.to_json(F.struct("label", "vector")), 256)))
    rows = written(rows, "vectors")
    # a class: equal vectors of one label
    classes = written(rows.where("digest is not null").groupBy("digest").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("vector").alias("vector")), "vector-classes")
    sample = classes.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toPandas()  # bounded
    pivots: dict[int, np.ndarray] = {}
    for dim, part in sample.groupby(sample["vector"].map(len)):
        pivots[int(dim)] = choose(_unit(part["vector"].tolist()))
    indexed = (classes.select("label", "id", "vector", "n")
               .mapInArrow(_indexer(pivots), "id long, n long, lists array<struct<key: long, top: int>>, pivots binary, unit binary"))
    indexed = written(indexed, "vector-index")
    posts = indexed.select("id", F.explode("lists").alias("l")).select("id", "l.key", "l.top")
    lists = posts.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    lists = lists.select("key", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    posts = posts.join(lists, "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    meet = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        (F.least(F.col("block"), o).cast("long") * F.col("blocks") + F.greatest(F.col("block"), o)).alias("cell"),
        F.when(o == F.col("block"), 0).when(F.col("block") < o, 1).otherwise(2).alias("side")))
    cells = (posts.select("key", "top", "id", F.explode(meet).alias("c")).select("key", "top", "c.cell", "c.side", "id")
             .join(indexed.select("id", "n", "pivots", "unit"), "id").select("key", "cell", "side", "id", "n", "top", "pivots", "unit"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = (cells.repartition(width, "key", "cell").sortWithinPartitions("key", "cell")
             .mapInArrow(_comparer(threshold), "id long, links long, near long"))
    found = written(found, "vector-links")
    comps = connected(found.select(F.col("id").alias("a"), F.col("near").alias("b")))
    degree = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = (classes.select("digest", "id", "n").join(degree, "id", "left").join(comps, "id", "left")
             .select("digest", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", "id").alias("component")))
    component = F.coalesce("component", "vec_id")
    return (rows.select("vec_id", "digest").join(named, "digest", "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                    F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept")))
