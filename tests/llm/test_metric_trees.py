import hashlib
import math

import numpy as np
import pytest

from tessera.llm import metric_trees as M


def plain(rows, parts=8, entries=16, rounds=6):
    """k-means of each part position, one vector after the other."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    x = np.array([[math.floor(4096 * v) for v in r[1]] for r in rows], dtype=object)
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))[:entries]
    size = x.shape[1] // parts
    books = [[list(x[i][p * size:(p + 1) * size]) for i in first] for p in range(parts)]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), n) for n, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            owned = {}
            for v in x:
                v = v[p * size:(p + 1) * size]
                owned.setdefault(nearest(v, books[p])[1], []).append(v)
            for e, vs in owned.items():
                books[p][e] = [sum(c) // len(vs) for c in zip(*vs)]
    out = []
    for r, v in zip(rows, x):
        best = [nearest(v[p * size:(p + 1) * size], books[p]) for p in range(parts)]
        out.append((r[0], r[2], "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best)))
    per = {}
    for _, label, _, d in out:
        per[label] = per.get(label, 0) + d
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, label, c, d, per[label], digest) for i, label, c, d in out), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("chunk, leaf", [(4096, 32), (50, 4), (7, 1)])
def test_equals_plain_k_means(spark, monkeypatch, chunk, leaf):
    monkeypatch.setattr(M, "CHUNK", chunk)
    monkeypatch.setattr(M, "LEAF", leaf)
    r = np.random.default_rng(chunk)
    rows = [(int(i), [float(v) for v in r.normal(size=16).astype(np.float32)], int(r.integers(0, 4)) or None) for i in r.permutation(300)]
    rows += [(1000 + i, rows[5][1], 1) for i in range(150)]  # a hot vector
    rows += [(2000, None, 1), (2001, [1.0, None] * 8, 1), (2002, [float("nan")] * 16, None), (2003, [float("inf")] + [0.0] * 15, 2), (None, [0.0] * 16, 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    assert got(M.codes(df)) == plain(rows)


def test_ties_go_to_the_lower_index(spark):
    grid = [[float(a) / 4096, float(b) / 4096] * 8 for a in range(6) for b in range(6)]
    rows = [(i, v, 1) for i, v in enumerate(grid * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert got(M.codes(df)) == plain(rows)


def test_trees_hold_every_point_once():
    r = np.random.default_rng(2)
    for n, spread in ((1, 5), (40, 3), (500, 1000), (3000, 100_000)):
        x = r.integers(-spread, spread, (n, 8))
        t = M.build(x)
        assert (t["points"][t["row"]] == x).all() and t["count"][0] == n and (t["total"][0] == x.sum(axis=0)).all()
        for lo, hi, pivot, radius, left, right in zip(*(t[k] for k in ("lo", "hi", "pivot", "radius", "left", "right"))):
            assert (np.sqrt(((t["points"][lo:hi] - pivot) ** 2).sum(axis=1)) <= radius + 1e-6).all()
            assert left < 0 or (t["lo"][left], t["hi"][left], t["hi"][right]) == (lo, t["lo"][right], hi)


def test_balls_are_owned_whole():
    """Far-apart groups: no ball below the groups is read, no leaf compared."""
    r = np.random.default_rng(3)
    centres = r.integers(-10 ** 6, 10 ** 6, (16, 8))
    x = np.repeat(centres, 200, axis=0) + r.integers(-50, 50, (3200, 8))
    t = M.build(x)
    seen = []

    class Watched(dict):
        def __getitem__(self, key):
            seen.append(key)
            return dict.__getitem__(self, key)
    (sums, counts), _ = M.owners(Watched(t), centres, False)
    assert (counts == 200).all() and "points" not in seen
    assert (sums == np.array([x[i * 200:(i + 1) * 200].sum(axis=0) for i in range(16)])).all()


def test_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, label string, code string, error int"
    none = spark.createDataFrame([(1, None, "a", "x", 1)], schema)
    assert M.codes(none).count() == 0 and M.codes(none.where("false")).columns == M.codes(none).columns
    rows = [(3, [0.5] * 8, None), (3, [0.5] * 8, None), (4, [-0.25] * 8, "b")]
    assert got(M.codes(spark.createDataFrame([(*r, "x", 1) for r in rows] + [(5, [1.0] * 3, "b", "y", 2)], schema))) == plain(rows)
    with pytest.raises(ValueError):
        M.codes(spark.createDataFrame([(1, [0.5] * 7, "a", "x", 1)], schema))
    with pytest.raises(Exception, match="component"):
        M.codes(spark.createDataFrame([(1, [1e6] * 8, "a", "x", 1)], schema)).collect()
