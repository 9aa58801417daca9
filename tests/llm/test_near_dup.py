import random

import numpy as np
import pyarrow as pa
import pytest

from conftest_llm import components_of, shingle_set, words
from tessera.llm import near_dup
from tessera.llm.near_dup import layout, near_duplicates, super_min_hash
from tessera.llm.shared import connected, shingle_sets


def brute(rows, k, percent):
    sets = {i: shingle_set(t, k) for i, t in rows}
    ids, pairs = sorted(sets), []
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                pairs.append((a, b))
    comp = components_of(ids, pairs)
    return {i: (len(sets[i]), comp[i]) for i in ids}


def corpus(seed=1):
    """Random texts with copies, a hot group of near copies that are not all
    alike, a shared passage and short texts."""
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(800)]
    texts = [" ".join(r.choices(vocab, k=r.randrange(1, 120))) for _ in range(120)]
    base = r.choices(vocab, k=90)
    for _ in range(80):
        t = list(base)
        for _ in range(r.randrange(0, 9)):
            t[r.randrange(len(t))] = r.choice(vocab)
        texts.append(" ".join(t))
    passage = " ".join(r.choices(vocab, k=55))
    texts += [passage + " " + " ".join(r.choices(vocab, k=r.randrange(0, 60))) for _ in range(30)]
    texts += r.choices(texts, k=30) + [t.upper() for t in r.choices(texts, k=10)] + ["a b", "A b", "a", "", " "]
    r.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_equals_brute_force(spark, k, percent):
    rows = corpus()
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), k=k, percent=percent).collect()
    want = brute(rows, k, percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert len(got) == len(rows)


def test_small_blocks_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 4)
    rows = corpus(2)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=3, percent=85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: c for i, (_, c) in brute(rows, 3, 85).items()}


def test_odd_rows(odd_docs, no_docs):
    rows = sorted(((r["doc_id"] or 0, r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(odd_docs, k=3, percent=85).collect()))
    by_id = {}
    for r in rows:
        by_id.setdefault(r[0], []).append(r[1:])
    assert by_id[1] == [(9, 1, True)] * 2 and by_id[2] == [(9, 1, False)]
    assert by_id[3] == [(0, 3, True)] and by_id[4] == [(0, 4, True)] and by_id[5] == [(0, 5, True)]
    assert by_id[6] == [(1, 6, True)] and by_id[7] == [(1, 6, False)]
    assert all(c is None and kept for _, c, kept in by_id[0]) and len(by_id[0]) == 2
    assert near_duplicates(no_docs).count() == 0


def test_signature_estimates_similarity():
    r = np.random.default_rng(5)
    pool = r.integers(0, 1 << 63, 3000).astype(np.uint64)
    for share in (0.5, 0.85):
        n = 600
        both = int(round(2 * n * share / (1 + share)))
        a, b = np.unique(pool[:n]), np.unique(np.concatenate([pool[n - both:n], pool[1000:1000 + n - both]]))
        sig = super_min_hash([a, b], 256)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((sig[0] == sig[1]).mean() - true) < 0.08


def test_signature_ignores_slices_and_order():
    r = np.random.default_rng(6)
    sets = [np.unique(r.integers(0, 1 << 63, n).astype(np.uint64)) for n in (1, 5, 300, 2000, 0)]
    a, b = super_min_hash(sets, 64), super_min_hash(sets, 64, slice_size=100)
    assert (a == b).all() and np.isinf(a[4]).all()


def test_layout_misses_little():
    for percent in (80, 85, 95):
        bands, rows = layout(percent)
        assert bands * rows <= 128 and (1 - (percent / 100) ** rows) ** bands <= 1e-6


def test_shingles_of_any_bytes():
    texts = ["a b c d", "A B c D", "é É x", "", None, "x", "x y", "x\x0by\x0cz", "a" * 70_000 + " b c"]
    sets = shingle_sets(pa.array(texts), 3)
    assert [len(s) for s in sets] == [len(shingle_set(t, 3)) for t in texts]
    assert (sets[0] == sets[1]).all() and (sets[7] != sets[0][:1]).all()


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 60)] + [(5, 5)]
    got = {r["id"]: r["component"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 60)}}


def _sets_of(texts, k=3):
    return [s.tobytes() for s in shingle_sets(pa.array(texts), k)]


def _cells(side, comp, sets, bucket=1, cell=0):
    n = len(sets)
    return pa.RecordBatch.from_arrays([pa.array([bucket] * n), pa.array([cell] * n), pa.array(side), pa.array(range(n)), pa.array(comp), pa.array(sets, pa.binary())],
                                      names=["bucket", "cell", "side", "id", "comp", "hashes"])


def _links(batch, percent=85):
    return [(r["a"], r["b"]) for r in pa.Table.from_batches(near_dup._block_links(percent)([batch])).to_pylist()]


def test_block_returns_spanning_links_only():
    """200 near copies in components of their own: 199 links, not 19,900."""
    base = words(120, 1)
    sets = _sets_of([" ".join(base[:60] + [f"x{i}"] + base[61:]) for i in range(200)])
    got = _links(_cells([0] * 200, list(range(200)), sets))
    assert len(got) == 199 and set(components_of(range(200), got).values()) == {0}
    joined = [0] * 199 + [199]  # one component and one row that still has to join it
    assert len(_links(_cells([0] * 200, joined, sets))) == 1
    assert _links(_cells([0] * 200, [7] * 200, sets)) == []
    # two blocks of a bucket: only rows of different sides meet
    got = _links(_cells([1] * 100 + [2] * 100, list(range(200)), sets))
    assert len(got) == 199 and all(a < 100 <= b for a, b in got)


def test_many_texts_just_below_the_threshold(spark):
    """2,000 texts that are 0.75 to 0.84 alike share buckets but link only where
    the full sets say so; no stage returns more rows than it got members."""
    r = random.Random(9)
    base = words(150, 2)
    texts = []
    for _ in range(2000):
        t = list(base)
        for at in r.sample(range(0, 150, 5), 6):
            t[at] = f"y{r.randrange(10 ** 6)}"
        texts.append(" ".join(t))
    rows = list(enumerate(texts))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=3, percent=85).collect()
    sets = [np.frombuffer(s, np.uint64) for s in _sets_of(texts)]
    pairs = []  # brute force over all pairs
    flat, sizes = np.unique(np.concatenate(sets), return_inverse=True)[1], np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    for i in range(2000):
        mark = np.zeros(flat.max() + 1, np.int64)
        mark[flat[starts[i]:starts[i] + sizes[i]]] = 1
        both = np.add.reduceat(mark[flat], starts)
        pairs += [(i, int(j)) for j in np.flatnonzero(100 * both >= 85 * (sizes + sizes[i] - both)) if j > i]
    want = components_of(range(2000), pairs)
    assert {x["doc_id"]: x["component_id"] for x in got} == want
    assert len(set(want.values())) > 500  # most texts are linked with nothing


def test_one_id_with_two_texts(spark):
    a, b = " ".join(words(40, 3)), " ".join(words(40, 4))
    near = a + " tail"
    rows = [(5, a), (5, b), (5, b), (6, near), (7, b + " end"), (8, "nothing like it at all")]
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=3, percent=85).collect()}
    assert got == {5: 5, 6: 5, 7: 5, 8: 8}
