import random

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import words

from tessera.llm import toxicity, weak_label

RUDE = ["idiot", "moron", "scum", "trash", "pathetic"]


def labelled(n, seed):
    """(doc_id, text, lang, toxic): a quarter carries rude words."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        w = words(r.randrange(20, 160), seed * 100_000 + i)
        toxic = i % 4 == 0
        for _ in range(r.randrange(2, 5) if toxic else 0):
            w.insert(r.randrange(len(w)), r.choice(RUDE) + r.choice(["", ",", "."]))
        rows.append((i, " ".join(w), r.choice(["en", "de"]), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def toxic_model(spark):
    rows = labelled(1200, 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    return toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"))


def test_toxicity_held_out(spark, toxic_model):
    rows = labelled(600, 4)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    got = toxicity.score(docs, toxic_model).select("toxic", (toxicity.F.col("score") >= 0.3).alias("hit"), "score").collect()
    hits = [r["toxic"] for r in got if r["hit"]]
    assert sum(hits) >= 0.9 * 150 and sum(hits) >= 0.9 * len(hits)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_toxicity_thresholds_by_language(spark, toxic_model):
    assert set(toxic_model.thresholds) == {"en", "de"} and all(0 <= t <= 1 for t in toxic_model.thresholds.values())


def test_toxicity_threshold_of_a_rare_language(spark, monkeypatch):
    """Labels beyond the sample count for the thresholds."""
    monkeypatch.setattr(toxicity, "SAMPLE", 400)
    rows = [(i, t, "xx" if i % 16 == 0 else lang, y) for i, t, lang, y in labelled(1600, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    assert "xx" in toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic")).thresholds


def test_toxicity_long_text_equals_its_slices(toxic_model):
    text = " ".join(words(5000, 1)) + " idiot moron scum " + " ".join(words(300, 2))
    tokens, offs = toxicity.token_buckets(pa.array([text, "short text", "", None]))
    whole = toxicity._responses(toxic_model, tokens, offs)
    sliced = toxicity._responses(toxic_model, tokens, offs, slice_size=64)
    assert np.allclose(whole, sliced, atol=1e-6) and whole[2] == whole[3]


def test_toxicity_odd_rows(odd_docs, no_docs, toxic_model, spark):
    got = toxicity.score(odd_docs, toxic_model)  # its own score column is replaced
    assert sorted(got.columns) == sorted(odd_docs.columns)
    rows = got.collect()
    assert len(rows) == 12 and all(r["score"] is not None for r in rows)
    assert len({r["score"] for r in rows if not (r["text"] or "").strip()}) == 1
    assert toxicity.score(no_docs, toxic_model).count() == 0
    nothing = toxicity.fit(odd_docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r["score"] for r in toxicity.score(odd_docs, nothing).collect()} == {0.0}
    one = toxicity.fit(odd_docs, spark.createDataFrame([(3, 1), (7, 1), (None, 0), (4, None)], "doc_id long, toxic int"))
    assert {r["score"] for r in toxicity.score(odd_docs, one).collect()} <= {0.0, 1.0}


def spoilt(w, kind):
    if kind == 0:
        return " ".join(x + random.Random(x).choice(["***", "$$$", "%%%"]) for x in w)
    if kind == 1:
        return " ".join(x.upper() + "!!" for x in w)
    if kind == 2:
        return " ".join(x for w1 in w[:8] for x in [w1] * 12)
    return " | ".join(w)


def test_quality_without_labels(spark):
    r = random.Random(8)
    rows = []
    for i in range(800):
        w = words(r.randrange(30, 200), 77 * 100_000 + i)
        w = [x + ("." if j % 9 == 8 else "," if j % 7 == 6 else "") for j, x in enumerate(w)]
        good = i % 6 != 0
        rows.append((i, " ".join(w) if good else spoilt(w, i // 6 % 4), good))
    docs = spark.createDataFrame(rows, "doc_id long, text string, good boolean")
    model = weak_label.fit(docs.select("doc_id", "text"))
    got = weak_label.score(docs, model, posterior="posterior").collect()
    good = [x["score"] >= weak_label.KEEP for x in got if x["good"]]
    bad = [x["score"] >= weak_label.KEEP for x in got if not x["good"]]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_em_finds_accuracies():
    r = np.random.default_rng(2)
    n, count = len(weak_label.LABELLERS), 40_000
    good = r.random(count) < 0.8
    accuracy = r.uniform(0.75, 0.95, n)
    votes = np.zeros((count, n), int)
    for i in range(n):
        right = r.random(count) < accuracy[i]
        votes[:, i] = np.where(r.random(count) < 0.5, 0, np.where(right == good, weak_label.GOOD, weak_label.BAD))
    patterns, times = np.unique((votes * 3 ** np.arange(n)).sum(axis=1), return_counts=True)
    model = weak_label.estimate(patterns, times.astype(float))
    assert abs(model.prior - 0.8) < 0.03
    given = model.votes[:, 1, weak_label.GOOD] / (model.votes[:, 1, weak_label.GOOD] + model.votes[:, 1, weak_label.BAD])
    assert np.abs(given - accuracy).max() < 0.05


def test_quality_odd_rows(odd_docs, no_docs):
    model = weak_label.fit(odd_docs)
    rows = weak_label.score(odd_docs, model).collect()
    assert len(rows) == 12 and len({r["score"] for r in rows if not (r["text"] or "").strip()}) == 1
    assert len({r["score"] for r in rows if r["doc_id"] == 1}) == 1
    empty = weak_label.fit(no_docs)
    assert weak_label.score(no_docs, empty).count() == 0
    assert all(r["score"] >= weak_label.KEEP for r in weak_label.score(odd_docs, empty).collect())
