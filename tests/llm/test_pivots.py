import math

import numpy as np
import pytest
from conftest_llm import components_of

from tessera.llm import pivots
from tessera.llm.pivots import links


def brute(rows, threshold=0.98):
    ok = [(i, np.array(v, float), l) for i, v, l in rows
          if i is not None and l is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    pairs, degree = [], {}
    for x, (i, a, l) in enumerate(ok):
        for j, b, m in ok[x + 1:]:
            if l == m and len(a) == len(b) and (a / np.linalg.norm(a)) @ (b / np.linalg.norm(b)) >= threshold:
                pairs.append((i, j))
                for k in (i, j):
                    degree[k] = degree.get(k, 0) + 1
    return degree, components_of([i for i, _, _ in rows if i is not None], pairs)


def cluster(r, base, n, spread):
    return [base + r.normal(0, spread, len(base)) for _ in range(n)]


def vectors(seed, dim=32):
    r = np.random.default_rng(seed)
    out = list(r.normal(size=(500, dim)))
    for n, spread in ((150, 0.06), (40, 0.1), (30, 0.14), (10, 0.02)):
        out += cluster(r, r.normal(size=dim), n, spread)
    out += [out[600]] * 200 + [out[3] * 4.0] * 3
    labels = r.integers(0, 3, len(out))
    order = r.permutation(len(out))
    return [(int(i), [float(np.float32(x)) for x in out[i]], int(labels[i])) for i in order]


@pytest.mark.parametrize("block", [pivots.BLOCK, 16])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(pivots, "BLOCK", block)
    rows = vectors(1)
    degree, comp = brute(rows)
    got = links(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)).collect()
    found = sum(r["n_links"] for r in got)
    assert len(got) == len(rows)
    assert all(r["n_links"] <= degree.get(r["vec_id"], 0) for r in got)  # none below the threshold
    assert found >= 0.995 * sum(degree.values())
    assert sum(r["component_id"] == comp[r["vec_id"]] for r in got) >= 0.99 * len(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1),
            (7, [0.0, 0.0], 1), (8, [0.0, 0.0], 1), (9, [1.0, nan], 1), (10, [inf, 0.0], 1), (11, [1.0, None], 1), (12, [1.0, 0.0, 0.0], 1),
            (13, [1.0, 0.001, 0.0], 1), (None, [1.0, 0.0], 1), (14, [0.0, -1.0], 1)]
    df = spark.createDataFrame([(*x, 1, 2, "z") for x in rows], "vec_id long, embedding array<float>, label int, id int, n int, digest string")
    got = [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in links(df).collect()]
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11, 14)]
    want = [(1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (None, 0, None, True), (12, 1, 12, True), (13, 1, 12, False), *alone]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert links(df.where("vec_id = -1")).count() == 0


def test_pivots_lie_apart():
    r = np.random.default_rng(3)
    base = r.normal(size=16)
    x = np.array(cluster(r, base, 50, 0.02) + list(r.normal(size=(50, 16))))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    p = pivots.choose(x)
    s = p @ p.T
    assert 30 < len(p) <= 51 and (s[~np.eye(len(p), dtype=bool)] < pivots.APART).all()
