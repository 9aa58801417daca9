import random

import corpus_pipeline as P
import numpy as np
import public_tokenizers
import pytest
from conftest_llm import words

from tessera.llm.pieces import Encoder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
RUDE = ["idiot", "moron", "scum", "trash", "pathetic"]


def documents(n=900, seed=21):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        w = words(r.randrange(40, 120), seed * 100_000 + i)
        w = [x + ("." if j % 9 == 8 else "") for j, x in enumerate(w)]
        kind = "toxic" if i % 7 == 0 else "low" if i % 11 == 0 else "clean"
        if kind == "toxic":
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(RUDE))
        text = " ".join(w) if kind != "low" else " ".join(x + "***" for x in w)
        rows.append((i, text, r.choice(["en", "de"]), r.choice(["a", "a", "b", "c", None]), kind))
    for i in range(40):  # near copies of clean documents, one word changed
        base = rows[i * 3 + 1]
        if base[4] == "clean":
            w = base[1].split()
            w[len(w) // 2] = "changed"
            rows.append((n + i, " ".join(w), base[2], base[3], "copy"))
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    rows = documents()
    spark.createDataFrame([(i, t, lang, s, len(t)) for i, t, lang, s, _ in rows], "doc_id long, text string, lang string, source string, n_chars long") \
        .repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(k == "toxic")) for i, _, _, _, k in rows if i % 2 == 0 or i % 7 == 0], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    kind = {i: k for i, _, _, _, k in documents()}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = {i: None for i in kind}
    for name, stage in P.STAGES[:-1]:
        docs = P.written(stage(spark, docs, folder), "test-stage")
        assert docs.columns == COLUMNS
        ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
        gone = [kind[i] for i in left if i not in set(ids)]
        if name == "toxicity":
            assert gone.count("toxic") >= 0.9 * sum(k == "toxic" for k in kind.values()) and gone.count("clean") <= 10
        elif name == "quality classifier":
            assert gone.count("low") >= 0.9 * sum(kind[i] == "low" for i in left) and gone.count("clean") <= 10
        elif name.startswith("MinHash"):
            assert set(gone) <= {"copy"} and gone.count("copy") >= 20 and len(ids) == len(set(ids))
        left = dict.fromkeys(ids)
    counts = np.unique(ids, return_counts=True)[1]
    assert counts.max() <= 3 and counts.max() > 1  # the mix repeats rows


def test_run(spark, folder):
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        encoder = Encoder(f.read())
    rows = P.run(spark, folder).collect()
    text = {i: t for i, t, _, _, _ in documents()}
    assert rows and all(np.frombuffer(r["ids"], "<u4").tolist() == encoder.library.encode(text[r["doc_id"]], add_bos=True, add_eos=True) for r in rows)


def test_odd_rows(spark, folder, odd_docs, no_docs, monkeypatch):
    """Nulls, empty and very long texts, repeated rows, clashing columns: every
    stage keeps the columns and loses no row but by its rule."""
    monkeypatch.setattr(P.toxicity, "fit", lambda docs, labels: P.toxicity.Model(constant=0.1))
    docs = odd_docs.withColumn("n_chars", P.F.lit(1).cast("long"))
    columns, n = docs.columns, []
    for _, stage in P.STAGES[:-1]:
        docs = P.written(stage(spark, docs, folder), "test-stage")
        assert docs.columns == columns
        n.append(sorted((r["doc_id"] or 0, len(r["text"] or "")) for r in docs.collect()))
    assert len(n[0]) == 12  # nothing is toxic
    low = {r[0] for r in n[1]}
    assert {1, 6, 7, 8, 9} >= low - {0, 2, 3, 4, 5} and len(n[1]) <= 12
    groups = [r for r in n[2] if r[1] == 44]  # the same sentence under ids 1, 1 and 2
    assert len(groups) == (1 if any(r[1] == 44 for r in n[1]) else 0)
    assert len([r for r in n[2] if r[1] == 0]) == len([r for r in n[1] if r[1] == 0])  # wordless texts link with nothing
    assert all(n[3].count(r) <= 3 * n[2].count(r) for r in n[3])
    encoded = P.STAGES[-1][1](spark, docs, folder)
    assert encoded.count() == len(n[3])
    empty = no_docs.withColumn("n_chars", P.F.lit(1).cast("long"))
    for _, stage in P.STAGES:
        empty = P.written(stage(spark, empty, folder), "test-stage")
    assert empty.count() == 0


def test_toxicity_is_decided_by_language(spark, folder, monkeypatch):
    monkeypatch.setattr(P.toxicity, "fit", lambda docs, labels: P.toxicity.Model(constant=0.5, thresholds={"en": 0.6, "de": 0.4}))
    docs = spark.createDataFrame([(1, "a", "en"), (2, "b", "de"), (3, "c", "fr"), (4, "d", None)], "doc_id long, text string, lang string")
    assert [r["doc_id"] for r in P.drop_toxic(spark, docs, folder).collect()] == [1]


def test_repeated_rows_leave_one(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (3, "other words of a text")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in P.drop_near_duplicates(spark, docs, "").collect()) == [1, 3]


def test_an_id_with_two_texts_keeps_the_unique_one(spark):
    a, b = " ".join(words(60, 1)), " ".join(words(60, 2))
    docs = spark.createDataFrame([(5, a), (5, b), (1, a), (None, b), (None, None), (None, None)], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in P.drop_near_duplicates(spark, docs, "").collect()) == sorted(
        [(1, a), (5, b), (0, ""), (0, "")])


@pytest.mark.parametrize("doc_id", [None, 7])
def test_mix_of_rows_without_ids_of_their_own(spark, doc_id):
    """Rows that share a null (or one) id take the copies that the mix decides,
    source by source."""
    rows = [(doc_id, " ".join(["w"] * (1 + i % 5 if i % 2 else 4)), "abc"[i % 3], i) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n int").repartition(3)
    got = P.mix_sources(spark, docs, "").collect()
    size, taken, times = {}, {}, {}
    for _, t, s, _ in rows:
        size[s] = size.get(s, 0) + len(t.split())
    for r in got:
        taken[r["source"]] = taken.get(r["source"], 0) + len(r["text"].split())
        times[r["n"]] = times.get(r["n"], 0) + 1
    total = sum(size.values())
    assert all(abs(taken[s] - w / 8 * total) <= 0.03 * total for s, w in zip("abc", (5, 2, 1)))
    assert max(times.values()) <= 3
    same = P.balance.mixed(docs).groupBy("source").agg(P.F.sum(P.F.col("copies") * P.F.col("size")).alias("t")).collect()
    assert all(abs(r["t"] - taken[r["source"]]) <= 0.02 * total for r in same)
