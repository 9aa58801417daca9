"""Vector codes by part-wise k-means over metric trees (operator 11).

A vector becomes whole numbers floor(``SCALE`` * x) and is cut into equal parts;
each part position has a codebook of a few entries, improved by rounds of
assignment (squared Euclidean distance, ties to the lower index) and floored
means, and a vector's code lists its nearest entries.

Trees. The rows of a task are cut into runs of ``CHUNK`` vectors, and each part
position of a run gets a metric tree, built once and written beside the ids.
Building is middle-out: about sqrt(n) anchors, each new one the point farthest
from the anchor of the largest radius, take over the points that are nearer to
them (a point within half the anchors' distance of its own anchor is not looked
at); anchors are merged upwards, the pair with the smallest common ball first,
and an anchor with many points is treated in the same way downwards. A ball
caches pivot, radius, count and sum of its points; equal parts are one weighted
point.

Rounds. From the root down, a ball inherits its parent's list of candidate
entries and strikes those whose distance to the pivot exceeds the best by more
than twice the radius: no point of the ball can be nearest to them, nor tie. A
ball with one candidate is owned whole: its cached sum and count go to the entry
and nothing below is read. Points of leaves are compared exactly, in whole
numbers, with the candidates left. So all results are those of plain k-means.

Only sums per (part, entry) leave a task (``parts`` * ``entries`` * (width + 1)
rows a task, whatever it holds); the codebooks are as small. Trees are Parquet
in the shared folder: a lost executor's rounds are read again.

Defined results: rows with a null vector, null or non-finite components, or a
length other than that of the smallest kept id are dropped; null ids come last
among the ids and keep their rows; null labels are one group; repeated rows count
as often as they occur; fewer kept rows than ``entries``: as many entries; other
columns are not read; no kept row: no rows. A length that ``parts`` does not
divide, or a component of 2**14 or more (squares would leave 64 bits), raises.
"""

from __future__ import annotations

import hashlib
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import written

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
CHUNK = 4096
LEAF = 32
SALTS = 32
_MOST = 1 << 26
_FIELDS = ("points", "weight", "row", "lo", "hi", "pivot", "radius", "total", "count", "left", "right")


def _distance(points: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - pivot) ** 2).sum(axis=-1))


def _anchors(points: np.ndarray) -> list[np.ndarray]:
    """Indexes of the points of about sqrt(n) anchors."""
    n = len(points)
    pivots = [points[0]]
    owned, away = [np.arange(n)], [_distance(points, points[0])]
    while len(pivots) < max(2, int(np.sqrt(n))):
        widest = max(range(len(away)), key=lambda a: away[a].max(initial=-1.0))
        if away[widest].max(initial=0.0) == 0:
            break
        new = points[owned[widest][away[widest].argmax()]]
        taken, their = [], []
        for a in range(len(pivots)):
            far = away[a] > float(_distance(pivots[a], new)) / 2
            if not far.any():
                continue
            there = np.flatnonzero(far)
            d = _distance(points[owned[a][there]], new)
            nearer = d < away[a][there]
            if nearer.any():
                there = there[nearer]
                taken.append(owned[a][there])
                their.append(d[nearer])
                stay = np.ones(len(owned[a]), bool)
                stay[there] = False
                owned[a], away[a] = owned[a][stay], away[a][stay]
        pivots.append(new)
        owned.append(np.concatenate(taken))
        away.append(np.concatenate(their))
    return [o for o in owned if len(o)]


def _grow(points: np.ndarray, index: np.ndarray):
    """Nested tree over ``index``: an index array (leaf) or (left, right)."""
    if len(index) <= LEAF:
        return index
    groups = _anchors(points[index])
    if len(groups) == 1:
        return index
    nodes = [_grow(points, index[g]) for g in groups]
    centre = np.array([points[index[g]].mean(axis=0) for g in groups])
    size = np.array([len(g) for g in groups], float)
    radius = np.array([_distance(points[index[g]], c).max() for g, c in zip(groups, centre)])

    def common(i):
        """Radius of the ball around the common centre of i and each other."""
        weight = (size / (size + size[i]))[:, None]
        middle = centre * weight + centre[i] * (1 - weight)
        out = np.maximum(_distance(centre, middle) + radius, _distance(centre[i], middle) + radius[i])
        out[i] = np.inf
        return out, middle
    ball = np.array([common(i)[0] for i in range(len(nodes))])
    for _ in range(len(nodes) - 1):
        i, j = divmod(int(ball.argmin()), len(nodes))
        both, middle = common(i)
        nodes[i] = (nodes[i], nodes[j])
        centre[i], radius[i], size[i] = middle[j], both[j], size[i] + size[j]
        size[j], radius[j] = 1.0, np.inf  # struck
        ball[j, :] = ball[:, j] = np.inf
        ball[i] = np.where(np.isfinite(radius), common(i)[0], np.inf)
        ball[:, i] = ball[i]
        root = i
    return nodes[root]


def build(parts: np.ndarray) -> dict[str, np.ndarray]:
    """The tree of whole-number points (n, width) as flat arrays; ``row`` is each
    given row's place among the ordered distinct points."""
    distinct, inverse, weight = np.unique(parts, axis=0, return_inverse=True, return_counts=True)
    points = distinct.astype(float)
    order: list[np.ndarray] = []
    nodes: list[list] = []  # lo, hi, left, right
    at = 0
    stack = [(_grow(points, np.arange(len(points))), -1, 0)]
    while stack:  # depth first, so that a ball's points are one range
        node, parent, side = stack.pop()
        if parent >= 0:
            nodes[parent][2 + side] = len(nodes)
        me = len(nodes)
        nodes.append([at, at, -1, -1])
        if isinstance(node, tuple):
            stack += [(node[1], me, 1), (node[0], me, 0)]
        else:
            order.append(node)
            at += len(node)
            nodes[me][1] = at
    for node in reversed(nodes):  # children come after their parent
        if node[2] >= 0:
            node[1] = nodes[node[3]][1]
    lo, hi, left, right = np.array(nodes, np.int64).T
    order = np.concatenate(order)
    distinct, weight = distinct[order], weight[order].astype(np.int64)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    zero = np.zeros((1, distinct.shape[1]), np.int64)
    sums, counts = np.concatenate([zero, np.cumsum(distinct * weight[:, None], axis=0)]), np.concatenate([[0], np.cumsum(weight)])
    total, count = sums[hi] - sums[lo], counts[hi] - counts[lo]
    pivot = total / count[:, None]
    radius = np.array([_distance(distinct[a:b], p).max() for a, b, p in zip(lo, hi, pivot)])
    return dict(zip(_FIELDS, (distinct, weight, place[inverse.reshape(-1)], lo, hi, pivot, radius, total, count, left, right)))


def owners(tree: dict[str, np.ndarray], entries: np.ndarray, of_points: bool):
    """(sums, counts) per entry; with ``of_points`` the nearest entry of each
    ordered distinct point as well (else None)."""
    k = len(entries)
    sums, counts = np.zeros((k, entries.shape[1]), np.int64), np.zeros(k, np.int64)
    owner = np.zeros(len(tree["points"]), np.int64) if of_points else None
    node, listed = np.zeros(1, np.int64), np.ones((1, k), bool)
    while len(node):
        d = np.sqrt(((tree["pivot"][node][:, None, :] - entries[None]) ** 2).sum(axis=2))
        d[~listed] = np.inf
        best = d.min(axis=1)
        # rounding of the distances is far below this margin
        reach = best + 2 * tree["radius"][node] + 1e-9 * best + 1e-6
        listed = listed & (d <= reach[:, None])
        whole = listed.sum(axis=1) == 1
        mine = listed[whole].argmax(axis=1)
        np.add.at(sums, mine, tree["total"][node[whole]])
        np.add.at(counts, mine, tree["count"][node[whole]])
        if of_points:
            for i, e in zip(node[whole], mine):
                owner[tree["lo"][i]:tree["hi"][i]] = e
        node, listed = node[~whole], listed[~whole]
        leaf = tree["left"][node] < 0
        if leaf.any():
            lo, hi = tree["lo"][node[leaf]], tree["hi"][node[leaf]]
            n = hi - lo
            at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            points = tree["points"][at]
            away = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
            away[~np.repeat(listed[leaf], n, axis=0)] = np.iinfo(np.int64).max
            mine = away.argmin(axis=1)
            np.add.at(sums, mine, points * tree["weight"][at][:, None])
            np.add.at(counts, mine, tree["weight"][at])
            if of_points:
                owner[at] = mine
        node, listed = node[~leaf], listed[~leaf]
        node, listed = np.concatenate([tree["left"][node], tree["right"][node]]), np.concatenate([listed, listed])
    return (sums, counts), owner


def _pack(tree: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **tree)
    return out.getvalue()


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as held:
        return {k: held[k] for k in held.files}


def whole_numbers(column: pa.Array, width: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.floor(values * SCALE).reshape(-1, width)
    if len(out) and np.abs(out).max() >= _MOST:
        raise ValueError(f"a vector component of {_MOST // SCALE} or more")
    return out.astype(np.int64)


def _planter(width: int, parts: int):
    size = width // parts

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                rows = batch.slice(at, CHUNK)
                x = whole_numbers(rows.column(2), width)
                trees = [_pack(build(x[:, p * size:(p + 1) * size])) for p in range(parts)]
                one = [pa.array([rows.column(i).to_pylist()], pa.list_(rows.column(i).type)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*one, pa.array([trees], pa.list_(pa.binary()))], names=["ids", "labels", "trees"])
    return run


def _summer(books: np.ndarray):
    parts, k, size = books.shape

    def run(batches):
        total = np.zeros((parts, k, size + 1), np.int64)
        for batch in batches:
            for row in batch.column(0):
                for p, tree in enumerate(row.values):
                    (sums, counts), _ = owners(_unpack(tree.as_py()), books[p], False)
                    total[p, :, :size] += sums
                    total[p, :, size] += counts
        part, entry, place = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(place, pa.int32()), pa.array(total[part, entry, place])],
                                         names=["part", "entry", "place", "n"])
    return run


def _coder(books: np.ndarray):
    def run(batches):
        for batch in batches:
            for ids, labels, trees in zip(*(batch.column(i) for i in range(3))):
                codes, error = [], 0
                for p, data in enumerate(trees.values):
                    tree = _unpack(data.as_py())
                    _, owner = owners(tree, books[p], True)
                    away = ((tree["points"] - books[p][owner]) ** 2).sum(axis=1)
                    codes.append(owner[tree["row"]])
                    error = error + away[tree["row"]]
                digits = np.array([f"{i:02x}" for i in range(books.shape[1])])
                code = digits[codes[0]]
                for c in codes[1:]:
                    code = np.char.add(code, digits[c])
                yield pa.RecordBatch.from_arrays([ids.values, labels.values, pa.array(code.tolist(), pa.string()), pa.array(error, pa.int64())],
                                                 names=["vec_id", "label", "code", "error"])
    return run


def usable(vector: str):
    """Column: the vector is there and all its components are finite numbers."""
    fine = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & fine


def codes(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
          parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, label, code, error, label_error, codebooks_sha256`` of every usable row."""
    label_type, id_type = df.schema[label_col].dataType.simpleString(), df.schema[id_col].dataType.simpleString()
    good = df.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")).where(usable("vector"))
    smallest = good.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector")
    first = [r["vector"] for r in smallest.collect()]
    if not first:
        return good.select("vec_id", "label", F.lit("").alias("code"), *(F.lit(0).cast("long").alias(c) for c in ("error", "label_error")),
                           F.lit("").alias("codebooks_sha256"))
    width = len(first[0])
    if width % parts:
        raise ValueError(f"vectors of {width} components do not make {parts} equal parts")
    first = whole_numbers(pa.array([v for v in first if len(v) == width], pa.list_(pa.float64())), width)
    books = first.reshape(len(first), parts, width // parts).transpose(1, 0, 2).copy()
    planted = good.where(F.size("vector") == width).mapInArrow(_planter(width, parts), f"ids array<{id_type}>, labels array<{label_type}>, trees array<binary>")
    planted = written(planted, "metric-trees")
    for _ in range(rounds):
        sums = planted.select("trees").mapInArrow(_summer(books), "part int, entry int, place int, n long")
        found = {(r["part"], r["entry"], r["place"]): int(r["n"]) for r in
                 sums.groupBy("part", "entry", "place").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()}
        books = books.copy()
        size = books.shape[2]
        for p in range(parts):
            for e in range(books.shape[1]):
                if (n := found.get((p, e, size), 0)):
                    books[p, e] = [found.get((p, e, i), 0) // n for i in range(size)]
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    coded = written(planted.mapInArrow(_coder(books), f"vec_id {id_type}, label {label_type}, code string, error long"), "vector-codes")
    # one total per label, met in salted slices: a hot label's rows are many tasks
    per = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    per = per.select("of", "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("slice"))
    salted = coded.withColumn("own", F.pmod(F.xxhash64("vec_id", "code", "error"), F.lit(SALTS)).cast("int"))
    same = F.col("label").eqNullSafe(F.col("of")) & (F.col("own") == F.col("slice"))
    return salted.join(per, same).select("vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
