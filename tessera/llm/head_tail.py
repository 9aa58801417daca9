"""Importance resampling towards a target text by hashed word runs (operator 12).

Features of a text are its words (ASCII letters lower-cased, digits, all from
U+0080) and its pairs of neighbouring words joined by a blank, repeats counted.
A feature's bucket is the CRC-32 of its UTF-8 bytes modulo ``BUCKETS``. From the
bucket totals of the corpus and of the target comes one whole gain per bucket;
a document's weight is the floored mean of its features' gains, and a Gumbel
draw by document id makes the highest scores a sample without replacement.

Head and tail. The vocabulary is split: the ``WORDS`` most frequent words of up
to eight bytes (their bytes are the key itself, so a hit is exact) and the
``PAIRS`` most frequent pairs of them are counted over all documents and sent to
the tasks: the exact CRC state behind each head word, and the bucket of each
head pair. Features not in the head (rare or long words) are run through the CRC
directly, from the state behind the first word's blank on. Both give the same
numbers, so the head changes the time only, never a result.

The first pass writes the bucket numbers of each document (two bytes a feature)
beside its id, so texts are read three times (words, pairs, buckets) and totals
and weights come from that table. Totals are summed per task (``BUCKETS`` rows a
task at most) before the shuffle; the gains (``BUCKETS`` numbers) go to the
tasks. Broadcast: two tables of 2**19 slots, 13 MB in all, whatever the input.

Ranks: scores are whole numbers in a narrow range, counted per score; the cut
score falls out of these counts, and only rows at or above it are ranked, in
ranges of (score, id).

Defined results: null, empty or wordless text: no features, weight 0; a null id
draws as an empty id; repeated rows are separate documents (ties in any order);
very long texts are read whole; other columns are not read; an empty corpus
gives no rows; an empty target has totals 0.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import runs, text_bytes, word_spans, written
from tessera.operators.ranges import asc, desc
from tessera.operators.windows import global_rank

BUCKETS = 10_000
WORDS = 1 << 15
PAIRS = 1 << 17
LEAST = 20
PERCENT = 25
_SLOTS = 19
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_FULL = np.uint32(0xFFFFFFFF)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def _advance(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC states after the bytes of each span."""
    state = state.copy()
    order = np.argsort(starts - ends, kind="stable")  # longest first
    lengths = (ends - starts)[order]
    alive = len(order)
    for k in range(int(lengths[0]) if alive else 0):
        alive = int(np.searchsorted(-lengths, -k, "left"))  # spans longer than k
        now = order[:alive]
        s = state[now]
        state[now] = _CRC[(s ^ data[starts[now] + k]) & 0xFF] ^ (s >> np.uint32(8))
    return state


def _blank(state: np.ndarray) -> np.ndarray:
    return _CRC[(state ^ np.uint32(32)) & 0xFF] ^ (state >> np.uint32(8))


def _folded(column: pa.Array):
    """Lower-cased bytes, word starts and ends, words before each text."""
    data, offs = text_bytes(column)
    starts, ends, count = word_spans(data, offs, letters=True)
    data = data + np.uint8(32) * ((data >= 65) & (data <= 90)).astype(np.uint8)
    return data, starts, ends, count


def _packed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The bytes of words of up to eight bytes as one number; longer words: 0."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    view = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    length = ends - starts
    keep = np.minimum(length, 8).astype(np.uint64)
    mask = np.where(keep == 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (keep % np.uint64(8) * np.uint64(8))) - np.uint64(1))
    return np.where(length <= 8, view[starts].astype(np.uint64) & mask, np.uint64(0))


def _slot(keys: np.ndarray) -> np.ndarray:
    return (keys * _MULTIPLY >> np.uint64(64 - _SLOTS)).astype(np.int64)


class Head:
    """Lookup tables of the frequent words and pairs (see the module text). Of
    two keys of one slot the more frequent stays; the other is tail."""

    def __init__(self, words: list[int], pairs: list[int] = ()):
        self.words = np.zeros(1 << _SLOTS, np.uint64)
        self.index = np.full(1 << _SLOTS, -1, np.int32)
        keys = np.array([w & 0xFFFFFFFFFFFFFFFF for w in words], np.uint64)
        first = self._place(self.words, keys)
        self.keys = keys[first]
        self.index[_slot(self.keys)] = np.arange(len(self.keys))
        raw = self.keys.astype("<u8").view(np.uint8)
        length = 8 - (raw.reshape(-1, 8)[:, ::-1] != 0).argmax(axis=1) if len(self.keys) else np.zeros(0, np.int64)
        at = np.arange(len(self.keys)) * 8
        self.states = _advance(np.full(len(at), _FULL), raw, at, at + length)
        self.spaced = _blank(self.states)  # behind the blank that joins a pair
        self.pairs = np.zeros(1 << _SLOTS, np.uint64)
        self.buckets = np.zeros(1 << _SLOTS, np.uint16)
        if len(pairs):
            keys = np.array(pairs, np.uint64)
            keys = keys[self._place(self.pairs, keys + np.uint64(1))]
            a, b = (keys >> np.uint64(20)).astype(np.int64), (keys & np.uint64(0xFFFFF)).astype(np.int64)
            state = _advance(self.spaced[a], raw, b * 8, b * 8 + length[b])
            self.buckets[_slot(keys + np.uint64(1))] = (state ^ _FULL) % np.uint32(BUCKETS)

    @staticmethod
    def _place(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
        first = np.sort(np.unique(_slot(keys), return_index=True)[1]) if len(keys) else np.zeros(0, np.int64)
        table[_slot(keys[first])] = keys[first]
        return first

    def find(self, packed: np.ndarray) -> np.ndarray:
        """Index of each word in the head, or -1."""
        at = _slot(packed)
        return np.where((self.words[at] == packed) & (packed != 0), self.index[at], -1)


def _pair_keys(index: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first words of all pairs, keys of the pairs; words of the tail: 0)."""
    inner = np.ones(max(len(index) - 1, 0), bool)
    cut = count[1:-1]
    inner[cut[(cut > 0) & (cut < len(index))] - 1] = False  # a pair does not cross texts
    first = np.flatnonzero(inner)
    a, b = index[first].astype(np.int64), index[first + 1].astype(np.int64)
    key = np.where((a >= 0) & (b >= 0), (a << 20 | b) + 1, 0).astype(np.uint64)
    return first, key


def buckets_of(column: pa.Array, head: Head) -> list[np.ndarray]:
    """Bucket numbers (uint16) of each text's features, repeats included."""
    out: list[np.ndarray] = []
    for part in runs(column):
        data, starts, ends, count = _folded(part)
        if len(starts) == 0:
            out += [np.zeros(0, np.uint16)] * len(part)
            continue
        index = head.find(_packed(data, starts, ends))
        tail = np.flatnonzero(index < 0)
        state = head.states[index] if len(head.states) else np.zeros(len(index), np.uint32)
        state[tail] = _advance(np.full(len(tail), _FULL), data, starts[tail], ends[tail])
        single = ((state ^ _FULL) % np.uint32(BUCKETS)).astype(np.uint16)
        first, key = _pair_keys(index, count)
        at = _slot(key)
        known = (head.pairs[at] == key) & (key != 0)
        double = head.buckets[at]
        rest = first[~known]
        direct = _advance(_blank(state[rest]), data, starts[rest + 1], ends[rest + 1])
        double[~known] = (direct ^ _FULL) % np.uint32(BUCKETS)
        pairs = np.searchsorted(first, count)
        out += [np.concatenate([single[a:b], double[c:d]]) for a, b, c, d in zip(count[:-1], count[1:], pairs[:-1], pairs[1:])]
    return out


def _tally(take):
    """Counts of the keys that ``take(column part)`` gives, per about 2 MB of text."""
    def run(batches):
        for batch in batches:
            for part in runs(batch.column(0)):
                keys, n = np.unique(take(part), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])
    return run


def _most(counts: DataFrame, n: int) -> list[int]:
    """The most frequent keys: all of the frequencies that ``n`` keys or fewer
    reach. Only they come to the driver; the window has one row per frequency."""
    counts = counts.where("key <> 0").groupBy("key").agg(F.sum("n").alias("n"))
    per = counts.groupBy("n").agg(F.count("*").alias("keys"))
    cut = per.select("n", F.sum("keys").over(Window.orderBy(F.desc("n"))).alias("upto")).where(F.col("upto") <= n).select(F.min("n")).scalar()
    return [r["key"] for r in sorted(counts.where(F.col("n") >= cut).collect(), key=lambda r: (-r["n"], r["key"]))]


def fit_head(texts: DataFrame, words: int = WORDS, pairs: int = PAIRS) -> Head:
    """The head of all texts (one string column). The driver gets ``words`` and
    ``pairs`` numbers at most."""
    spark = texts.sparkSession

    def short_words(part):
        data, starts, ends, _ = _folded(part)
        return _packed(data, starts, ends)
    chosen = _most(texts.mapInArrow(_tally(short_words), "key long, n long"), words)
    held = spark.sparkContext.broadcast(Head(chosen))

    def head_pairs(part):
        data, starts, ends, count = _folded(part)
        return _pair_keys(held.value.find(_packed(data, starts, ends)), count)[1]
    both = _most(texts.mapInArrow(_tally(head_pairs), "key long, n long"), pairs)
    return Head(chosen, [k - 1 for k in both])


def _bucketed(held):
    def run(batches):
        for batch in batches:
            found = buckets_of(batch.column(1), held.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f.tobytes() for f in found], pa.binary())], names=["doc_id", "buckets"])
    return run


def _totals(batches):
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for b in batch.column(0):
            total += np.bincount(np.frombuffer(b.as_buffer(), np.uint16), minlength=BUCKETS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])


def totals(buckets: DataFrame) -> np.ndarray:
    """Features per bucket over all rows of ``buckets`` (binary)."""
    rows = buckets.mapInArrow(_totals, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed ratio) of each bucket."""
    s_all, t_all = int(corpus.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log(((t + 1) * s_all) / ((s + 1) * t_all))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def _weigher(gain: np.ndarray):
    def run(batches):
        for batch in batches:
            features = [np.frombuffer(b.as_buffer(), np.uint16) for b in batch.column(1)]
            weight = [int(gain[f].sum()) // len(f) if len(f) else 0 for f in features]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(f) for f in features], pa.int64()), pa.array(weight, pa.int64())],
                                             names=["doc_id", "n_features", "weight"])
    return run


def gumbel(id_col: str = "doc_id", seed: int = 7):
    """Column: floor(-1000 * ln(-ln(u))) of the id's uniform draw."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
             percent: int = PERCENT, least: int = LEAST, seed: int = 7, words: int = WORDS, pairs: int = PAIRS) -> DataFrame:
    """``doc_id, n_features, weight, score, rank``: all rows of ``docs``; rank of
    those drawn, ``percent`` of the rows with ``least`` words or more."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    held = spark.sparkContext.broadcast(fit_head(texts, words, pairs))
    schema = "doc_id long, buckets binary"
    rows = written(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_bucketed(held), schema), "run-buckets")
    wanted = target.select(F.lit(0).cast("long").alias("doc_id"), F.col(target_text).cast("string").alias("text")).mapInArrow(_bucketed(held), schema)
    gain = gains(totals(rows.select("buckets")), totals(wanted.select("buckets")))
    scored = rows.mapInArrow(_weigher(gain), "doc_id long, n_features long, weight long").withColumn("score", F.col("weight") + gumbel("doc_id", seed))
    scored = written(scored, "run-scores")
    long_enough = F.col("n_features") >= 2 * least - 1
    # rows per score: as many as there are scores, a bounded range of whole numbers
    per = scored.where(long_enough).groupBy("score").agg(F.count("*").alias("n"))
    per = per.withColumn("before", F.sum("n").over(Window.orderBy(F.desc("score"))) - F.col("n"))
    n = scored.where(long_enough).count()
    draw = percent * n // 100
    cut = per.where(F.col("before") < draw).agg(F.min("score")).first()[0]
    columns = ["doc_id", "n_features", "weight", "score"]
    if cut is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    high = long_enough & (F.col("score") >= cut)
    ranked = global_rank(scored.where(high), [desc("score"), asc("doc_id", nulls_first=False)], "rank")
    ranked = ranked.select(*columns, F.when(F.col("rank") <= draw, F.col("rank")).alias("rank"))
    return ranked.unionByName(scored.where(~high).select(*columns, F.lit(None).cast("long").alias("rank")))
