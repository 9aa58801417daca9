import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from conftest_llm import words
from tessera.llm import head_tail as H


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def bucket(f):
    return zlib.crc32(f.encode()) % 10_000


def plain(docs, target, percent=25):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(bucket(f) for f in features(text))
    for text in target:
        t.update(bucket(f) for f in features(text))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log(((t[b] + 1) * (big_s + 10_000)) / ((s[b] + 1) * (big_t + 10_000)))) for b in range(10_000)]
    out = []
    for i, text in docs:
        f = features(text)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if (r[1] + 1) // 2 >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    rank = {r: n + 1 for n, r in enumerate(able[:percent * len(able) // 100])}
    return sorted(((*r, rank.get(r)) for r in out), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("n_words, n_pairs", [(0, 0), (3, 2), (200, 500), (H.WORDS, H.PAIRS)])
def test_buckets_are_the_crc_whatever_the_head(spark, n_words, n_pairs):
    r = random.Random(1)
    pool = ["a", "the", "cat", "eightlet", "ninelette", "é", "日本語", "x" * 300, "4", "I", "B2b", "🙂"]
    texts = [" ".join(r.choices(pool, k=r.randrange(0, 40))) + r.choice(["", ".", "!!", " \x00 "]) for _ in range(300)] + [None, "", " ", "a", "A--b", "É é"]
    head = H.fit_head(spark.createDataFrame([(t,) for t in texts], "text string"), n_words, n_pairs)
    assert len(head.keys) <= n_words
    for found, t in zip(H.buckets_of(pa.array(texts), head), texts):
        assert found.tolist() == [bucket(f) for f in features(t)], t


def test_equals_a_plain_version(spark):
    r = random.Random(5)
    docs = [(i, " ".join(words(r.randrange(0, 90), i % 150))) for i in range(400)] + [(400, None), (401, ""), (402, "ONE Two " * 3000)]
    target = [" ".join(words(200, i)) for i in range(20)] + [None]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    assert got(H.resample(df, aim)) == plain(docs, target)
    assert got(H.resample(df.repartition(2), aim, words=7, pairs=9)) == plain(docs, target)


def test_document_tables(spark):
    d = "/root/testdata/sf0.01"
    docs, aim = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet")
    want = plain([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], [r["text"] for r in aim.collect()])
    assert got(H.resample(docs, aim)) == want


def test_odd_rows(spark, odd_docs, no_docs):
    aim = spark.createDataFrame([("the cat",)], "text string")
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert got(H.resample(odd_docs, aim)) == plain(rows, ["the cat"])
    assert H.resample(no_docs, aim).count() == 0
    assert got(H.resample(odd_docs, aim.where("false"))) == plain(rows, [])


def test_one_id_for_all(spark):
    """Rows that share a null id and a text tie; ranks stay gapless."""
    docs = [(None, " ".join(words(30, 1)))] * 200 + [(3, " ".join(words(30, 2)))] * 200
    out = H.resample(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame([("x",)], "text string")).collect()
    assert sorted(r["rank"] for r in out if r["rank"]) == list(range(1, 101)) and len(out) == 400
