"""Quality by weak labels (operator 7).

Ten heuristic labellers each vote bad, good or nothing on every document.
``fit`` counts the vote patterns over all documents (one Spark aggregate; at
most 3 ** labellers rows), and expectation-maximisation on those counts
estimates how often each labeller gives each vote on good and on bad documents
(labellers overlap; none is trusted beforehand beyond a weak prior). The
posterior of its pattern is a document's soft label; the posteriors of a
bounded sample (``SAMPLE`` rows, smallest id hash) train a hashed linear scorer
on word shapes, shape pairs and repetition. ``score`` applies it to every text.

No labels table is read. Defined results: null or wordless texts get no votes;
their posterior is that of silence and their score the scorer's bias; repeated
rows score alike; null ids are scored; an empty table gives no rows (the model
then keeps everything). A document is kept when its score is at least ``KEEP``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tessera.llm.shared import lean, mix, runs, span_hashes, text_bytes, without, word_spans, written

LABELLERS = ("symbols", "symbol_tails", "capitals", "shouting", "letterless", "stutter", "variety",
             "sentences", "word_length", "one_word")
SILENT, BAD, GOOD = 0, 1, 2
SAMPLE = 20_000
KEEP = 0.5
DIMS = 1 << 13
#: Pseudo-counts (class, vote): a labeller is rather right than wrong.
_PRIOR = np.array([[1.0, 2.0, 0.5], [1.0, 0.5, 2.0]])


@dataclass
class Model:
    prior: float = 1.0
    votes: np.ndarray | None = None      # (labeller, class, vote) probabilities
    weights: np.ndarray | None = None
    bias: float = 4.0

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of good of base-3 vote patterns."""
        if self.votes is None:
            return np.ones(len(patterns))
        each = _unpack(patterns)
        logs = np.log(np.array([1 - self.prior, self.prior]))[None, :] + np.zeros((len(patterns), 2))
        for i in range(len(LABELLERS)):
            logs += np.log(self.votes[i][:, each[:, i]]).T
        return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -500, 500)))


def _unpack(patterns: np.ndarray) -> np.ndarray:
    return np.asarray(patterns, np.int64)[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


class _Words:
    """Word positions, hashes and per-text sums of a batch of texts."""

    def __init__(self, column: pa.Array):
        self.data, offs = text_bytes(column)
        self.starts, self.ends, self.count = word_spans(self.data, offs)
        self.hashes = span_hashes(self.data, self.starts, self.ends)
        self.n = np.diff(self.count)
        self.owner = np.repeat(np.arange(len(self.n)), self.n)
        self.same = np.zeros(len(self.hashes), bool)
        if len(self.hashes):
            self.same[1:] = (self.hashes[1:] == self.hashes[:-1]) & (self.owner[1:] == self.owner[:-1])

    def per_text(self, of_word: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights=of_word, minlength=len(self.n))

    def in_word(self, of_byte: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(of_byte, dtype=np.int64)])
        return sums[self.ends] - sums[self.starts]


def vote_patterns(column: pa.Array) -> np.ndarray:
    """Base-3 pattern of the labellers' votes on each text."""
    return np.concatenate([np.zeros(0, np.int64), *(_votes_of(part) for part in runs(column))])


def _votes_of(column: pa.Array) -> np.ndarray:
    w = _Words(column)
    d, n, words = w.data, np.maximum(w.n, 1), len(w.hashes)
    votes = np.zeros((len(w.n), len(LABELLERS)), np.int64)
    if words == 0:
        return np.zeros(len(w.n), np.int64)
    upper, lower = (d >= 65) & (d <= 90), (d >= 97) & (d <= 122)
    other = (d >= 128) | ((d >= 48) & (d <= 57))
    plain = np.isin(d, np.frombuffer(b".,;:'\"!?()-", np.uint8))
    symbol = (d > 32) & (d < 127) & ~(upper | lower | other | plain)
    size = w.per_text(w.ends - w.starts)
    letters = np.maximum(w.per_text(w.in_word(upper | lower)), 1)

    def put(name, bad, good=None):
        col = votes[:, LABELLERS.index(name)]
        if good is not None:
            col[good] = GOOD
        col[bad] = BAD

    put("symbols", w.per_text(w.in_word(symbol)) / np.maximum(size, 1) >= 0.08)
    put("symbol_tails", w.per_text(symbol[w.ends - 1] & symbol[np.maximum(w.ends - 2, 0)] & (w.ends - w.starts > 2)) / n >= 0.15)
    caps = w.per_text(w.in_word(upper)) / letters
    put("capitals", (caps >= 0.3) & (letters >= 20), caps <= 0.1)
    put("shouting", w.per_text(w.in_word(d == 33)) / n >= 0.15)
    put("letterless", w.per_text(w.in_word(upper | lower | other) == 0) / n >= 0.15)
    put("stutter", (w.per_text(w.same) / n >= 0.1) & (w.n >= 10))
    order = np.lexsort((w.hashes, w.owner))
    h, o = w.hashes[order], w.owner[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])])
    runs = np.diff(np.append(np.flatnonzero(new), words))
    most, kinds = np.zeros(len(w.n)), np.bincount(o[new], minlength=len(w.n))
    np.maximum.at(most, o[new], runs)
    put("variety", (kinds / n <= 0.1) & (w.n >= 30), kinds / n >= 0.4)
    ends = w.per_text(np.isin(d[w.ends - 1], np.frombuffer(b".,;:?", np.uint8))) / n
    put("sentences", np.zeros(len(n), bool), (ends >= 0.02) & (ends <= 0.5) & (w.n >= 5))
    mean = size / n
    put("word_length", (mean > 16) | (mean < 1.5), (mean >= 2.5) & (mean <= 10))
    put("one_word", (most / n >= 0.25) & (w.n >= 12))
    return (votes * 3 ** np.arange(len(LABELLERS))).sum(axis=1)


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, dimension, value) of the hashed features: shares of word shapes,
    of neighbouring shapes and of repeated words."""
    w = _Words(column)
    d = w.data
    kind = np.where(d >= 128, 4, d)
    kind[(d >= 65) & (d <= 90)] = 1
    kind[(d >= 97) & (d <= 122)] = 2
    kind[(d >= 48) & (d <= 57)] = 3
    if len(w.hashes) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    turn = np.ones(len(d), bool)
    turn[1:] = kind[1:] != kind[:-1]
    turn[w.starts] = True
    at = np.concatenate([[0], np.cumsum(turn)])
    shape = span_hashes(kind[turn].astype(np.uint8), at[w.starts], at[w.ends])
    pair = mix(shape[:-1] * np.uint64(31) + shape[1:])
    inside = w.owner[1:] == w.owner[:-1]
    owner = np.concatenate([w.owner, w.owner[1:][inside], w.owner[w.same]])
    dim = np.concatenate([shape, pair[inside], np.full(w.same.sum(), 77, np.uint64)]) % np.uint64(DIMS)
    cell, times = np.unique(owner * DIMS + dim.astype(np.int64), return_counts=True)
    owner, dim = cell // DIMS, cell % DIMS
    return owner, dim, np.sqrt(times / w.n[owner])


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> Model:
    """Expectation-maximisation on pattern counts."""
    each = _unpack(patterns)
    bad = (each == BAD).any(axis=1)
    good = np.where(bad, 0.2, 0.95)
    model = Model()
    for _ in range(rounds):
        mass = np.stack([(1 - good) * counts, good * counts])
        votes = np.empty((len(LABELLERS), 2, 3))
        for i in range(len(LABELLERS)):
            for v in range(3):
                votes[i, :, v] = mass[:, each[:, i] == v].sum(axis=1)
        votes += _PRIOR
        model.votes = votes / votes.sum(axis=2, keepdims=True)
        model.prior = float((mass[1].sum() + 1) / (counts.sum() + 2))
        new = model.posterior(patterns)
        if np.abs(new - good).max() < 1e-6:
            break
        good = new
    return model


def _probability(found: tuple, n: int, weights: np.ndarray, bias: float) -> np.ndarray:
    owner, dim, value = found
    z = np.bincount(owner, weights=value * weights[dim], minlength=n) + bias
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(owner: np.ndarray, dim: np.ndarray, value: np.ndarray, target: np.ndarray, steps: int = 400, rate: float = 0.3,
          ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels (full batches, Adagrad)."""
    weights, bias, total = np.zeros(DIMS), 0.0, np.full(DIMS + 1, 1e-8)
    for _ in range(steps):
        err = (_probability((owner, dim, value), len(target), weights, bias) - target) / len(target)
        g = np.append(np.bincount(dim, weights=value * err[owner], minlength=DIMS) + ridge * weights / len(target), err.sum())
        total += g * g
        move = rate * g / np.sqrt(total)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, float(bias)


def votes(docs: DataFrame, text_col: str = "text", name: str = "pattern") -> DataFrame:
    """``docs`` with the long column ``name``: base-3 votes of ``LABELLERS``."""
    docs = without(docs, [name], text_col)
    columns = docs.columns

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(vote_patterns(batch.column(columns.index(text_col))), pa.int64())], names=[*columns, name])
    return docs.mapInArrow(lean(run), StructType([*docs.schema.fields, StructField(name, LongType())]))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Labeller accuracies from all documents, scorer from a bounded sample."""
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    counts = votes(slim).groupBy("pattern").agg(F.count("*").alias("n")).toPandas()  # 3 ** labellers rows at most
    if counts.empty:
        return Model()
    model = estimate(counts.pattern.to_numpy(), counts.n.to_numpy().astype(float))
    ids = slim.where("id is not null").select("id").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).distinct()

    def sample(batches):
        for batch in batches:
            good = model.posterior(vote_patterns(batch.column(1)))
            dims, parts = [], []
            for run in runs(batch.column(1)):
                owner, dim, value = features(run)
                cut = np.searchsorted(owner, np.arange(len(run) + 1))
                dims += [dim[a:b].astype(np.uint16).tobytes() for a, b in zip(cut[:-1], cut[1:])]
                parts += [value[a:b].astype(np.float32).tobytes() for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(good), pa.array(dims, pa.binary()), pa.array(parts, pa.binary())],
                                             names=["id", "good", "dims", "parts"])
    # at most SAMPLE ids: a bounded broadcast
    rows = (written(slim.join(F.broadcast(ids), "id").mapInArrow(lean(sample), "id long, good double, dims binary, parts binary"), "quality-sample")
            .orderBy(F.xxhash64("id"), "id", "dims").limit(SAMPLE).toPandas())
    if len(rows):
        dims = [np.frombuffer(b, np.uint16) for b in rows.dims]
        owner = np.repeat(np.arange(len(rows)), [len(x) for x in dims])
        value = np.concatenate([np.frombuffer(b, np.float32) for b in rows.parts]).astype(float)
        model.weights, model.bias = train(owner, np.concatenate(dims).astype(np.int64), value, rows.good.to_numpy())
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", posterior: str | None = None, name: str = "score") -> DataFrame:
    """``docs`` with the scorer's probability of good (and, if ``posterior`` is
    named, the label model's); columns of these names are replaced."""
    added = [name] + ([posterior] if posterior else [])
    docs = without(docs, added, text_col)
    columns, shared = docs.columns, docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        weights = m.weights if m.weights is not None else np.zeros(DIMS)
        for batch in batches:
            text = batch.column(columns.index(text_col))
            each = [_probability(features(part), len(part), weights, m.bias) for part in runs(text)]
            out = [pa.array(np.concatenate([np.zeros(0), *each]))]
            if posterior:
                out.append(pa.array(m.posterior(vote_patterns(text))))
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], names=[*columns, *added])
    return docs.mapInArrow(lean(run), StructType([*docs.schema.fields, *(StructField(c, DoubleType()) for c in added)]))
