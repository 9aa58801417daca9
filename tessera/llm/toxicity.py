"""Convolutional toxicity classifier (operator 3).

``fit(docs, labels)`` trains a small network in numpy on a bounded sample of
labelled rows; ``score(docs, model)`` adds ``score`` to every document.

Network: a word is the sum of the hashed embeddings of the word and of its
first 5 and 7 bytes (words share what their stems share); filters of widths 1,
2 and 3 run over the whole text, each keeps its maximum (max pooling), and a
logistic layer joins them. The first embedding component starts from the
bucket's shrunken log-odds on one part of the sample, and the network trains on
another, so that no row teaches both. Only the text is an input of a score.

Bounds: ``SAMPLE`` labelled rows (smallest id hash; 20,000), of which at most
``NET_ROWS`` (4,000) train the network; each such row's whole text counts.

Thresholds by language: ``fit`` also returns one per language, where F1 is best
on all labelled rows that taught neither the log-odds nor the network: a part
reserved by id hash (1 in ``RESERVED`` of the rows outside the network's part, at
every size) and whatever the bounds above leave over. The scores of all documents
are joined to the labels by id, counted per language and hundredth. Languages
with fewer than ``MIN_TOXIC`` toxic rows there keep ``THRESHOLD``.

Defined results: null and empty texts score like each other (the network's
value without words); null ids are scored; repeated rows score alike; with no
labelled rows, or labels of one class, all scores are that class's rate (0 if
none); labels with null toxic are not used; repeated labels count repeatedly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tessera.llm.shared import lean, runs, span_hashes, text_bytes, without, word_spans, written

SAMPLE = 20_000
NET_ROWS = 4_000
THRESHOLD = 0.3
MIN_TOXIC = 20
RESERVED = 3
BUCKETS = 1 << 16
DIM = 8
FILTERS = 8
WIDTHS = (1, 2, 3)
PARTS = (None, 5, 7)
PAD = max(WIDTHS) - 1


@dataclass
class Model:
    embedding: np.ndarray | None = None
    kernels: list = field(default_factory=list)
    bias: np.ndarray | None = None
    out: np.ndarray | None = None
    base: float = 0.0
    constant: float | None = 0.0
    thresholds: dict = field(default_factory=dict)


def token_buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(words, len(PARTS)) buckets of all texts and the n + 1 word offsets."""
    data, offs = text_bytes(column)
    starts, ends, count = word_spans(data, offs, letters=True)
    cols = []
    for i, part in enumerate(PARTS):
        stop = ends if part is None else np.minimum(ends, starts + part)
        cols.append((span_hashes(data, starts, stop) + np.uint64(i * 7919)) % np.uint64(BUCKETS))
    return np.stack(cols, axis=1).astype(np.uint16), count


def _maxima(model: Model, tokens: np.ndarray) -> np.ndarray:
    """Largest response of each filter over one run of words."""
    x = np.zeros((max(len(tokens), 1) + PAD, DIM), np.float32)
    x[:len(tokens)] = model.embedding[tokens].sum(axis=1)
    n = len(x) - PAD
    return np.concatenate([sum(x[j:n + j] @ k[j] for j in range(len(k))).max(axis=0) for k in model.kernels])


def _responses(model: Model, tokens: np.ndarray, offs: np.ndarray, slice_size: int = 1 << 17) -> np.ndarray:
    """Score of each text; long texts in overlapping slices (a maximum of
    maxima), short ones many at a time."""
    best = np.full((len(offs) - 1, len(WIDTHS) * FILTERS), -np.inf, np.float32)
    at = 0
    while at < len(offs) - 1:
        if offs[at + 1] - offs[at] > slice_size:
            for lo in range(int(offs[at]), int(offs[at + 1]), slice_size):
                best[at] = np.maximum(best[at], _maxima(model, tokens[lo:min(lo + slice_size + PAD, offs[at + 1])]))
            at += 1
            continue
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + slice_size, "right")) - 1)
        size = np.maximum(np.diff(offs[at:to + 1]), 1)
        first = np.concatenate([[0], np.cumsum(size + PAD)[:-1]])
        x = np.zeros((int((size + PAD).sum()) + PAD, DIM), np.float32)
        row = np.arange(offs[at], offs[to]) - np.repeat(offs[at:to] - first, np.diff(offs[at:to + 1]))
        x[row] = model.embedding[tokens[offs[at]:offs[to]]].sum(axis=1)
        n = len(x) - PAD
        real = np.repeat(np.tile([True, False], to - at), np.stack([size, np.full(to - at, PAD)], axis=1).reshape(-1))
        for i, k in enumerate(model.kernels):
            y = sum(x[j:n + j] @ k[j] for j in range(len(k)))
            y[~real] = -np.inf
            best[at:to, i * FILTERS:(i + 1) * FILTERS] = np.maximum.reduceat(y, first, axis=0)
        at = to
    z = np.maximum(best + model.bias, 0) @ model.out + model.base
    return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))


def scores(model: Model, column: pa.Array) -> np.ndarray:
    if model.constant is not None:
        return np.full(len(column), model.constant)
    return np.concatenate([np.zeros(0), *(_responses(model, *token_buckets(part)) for part in runs(column))])


def train(texts: list[np.ndarray], y: np.ndarray, odds: np.ndarray, epochs: int = 6, seed: int = 7) -> Model:
    """Network from bucket arrays (words, parts) and 0/1 labels."""
    if len(y) == 0 or y.min() == y.max():
        return Model(constant=float(y.mean()) if len(y) else 0.0)
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.02, (BUCKETS, DIM)).astype(np.float32)
    emb[:, 0] = odds
    kernels = [rng.normal(0, 0.1, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for k in kernels:
        k[:, 0, :] = np.abs(k[:, 0, :]) + 0.2
    model = Model(emb, kernels, np.full(len(WIDTHS) * FILTERS, -0.5, np.float32),
                  np.full(len(WIDTHS) * FILTERS, 0.1, np.float32), float(np.log(y.mean() / (1 - y.mean()))) - 1.0, None)
    dense = [*kernels, model.bias, model.out]
    m, v = [np.zeros_like(p) for p in dense], [np.zeros_like(p) for p in dense]
    step, rate = 0, 0.01
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), 16):
            grads, g_base, touched = [np.zeros_like(p) for p in dense], 0.0, []
            rows = order[lo:lo + 16]
            for r in rows:
                t = texts[r]
                x = np.zeros((max(len(t), 1) + PAD, DIM), np.float32)
                x[:len(t)] = emb[t].sum(axis=1)
                n = len(x) - PAD
                tops, where = [], []
                for k in kernels:
                    z = sum(x[j:n + j] @ k[j] for j in range(len(k)))
                    top = z.argmax(axis=0)
                    where.append(top)
                    tops.append(z[top, np.arange(FILTERS)])
                a = np.concatenate(tops) + model.bias
                h = np.maximum(a, 0)
                err = 1 / (1 + np.exp(-np.clip(float(h @ model.out) + model.base, -30, 30))) - y[r]
                dh = err * model.out * (a > 0)
                grads[-1] += err * h
                grads[-2] += dh
                g_base += err
                for i, k in enumerate(kernels):
                    d = dh[i * FILTERS:(i + 1) * FILTERS]
                    for j in range(len(k)):
                        at = where[i] + j
                        grads[i][j] += x[at].T * d
                        ok = (at < len(t)) & (d != 0)
                        if ok.any():
                            touched.append((t[at[ok]], (k[j][:, ok] * d[ok]).T))
            step += 1
            scale = 1 / len(rows)
            for i, p in enumerate(dense):
                g = grads[i] * scale
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p -= rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
            model.base -= rate * 3 * g_base * scale
            for words, g in touched:
                for c in range(words.shape[1]):
                    np.add.at(emb, words[:, c], -0.05 * scale * g)
    return model


def _features(batches):
    for batch in batches:
        words = []
        for part in runs(batch.column(1)):
            tokens, offs = token_buckets(part)
            words += [tokens[a:b].tobytes() for a, b in zip(offs[:-1], offs[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(words, pa.binary()), *batch.columns[2:]], names=["id", "words", "toxic", "part", "lang"])


def _bucket_counts(batches):
    toxic, rows = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for words, y in zip(batch.column(0), batch.column(1).to_pylist()):
            seen = np.unique(np.frombuffer(words.as_buffer(), np.uint16))
            rows[seen] += 1
            toxic[seen] += y
    at = np.flatnonzero(rows)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(toxic[at]), pa.array(rows[at])], names=["bucket", "t", "n"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        lang_col: str | None = "lang") -> Model:
    """Train on a bounded sample of ``labels`` (see the module text)."""
    crc = F.crc32(F.col(id_col).cast("string"))
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .select(F.col(id_col).cast("long").alias("id"), (F.col(label_col) > 0).cast("int").alias("toxic"),
                     (F.pmod(crc, F.lit(4)) == 3).cast("int").alias("part")))
    reserved = (F.col("part") == 0) & (F.pmod(F.xxhash64(F.lit(17), "id"), F.lit(RESERVED)) == 0) if lang_col else F.lit(False)
    picked = known.where(~reserved).orderBy(F.xxhash64("id"), "id", "toxic").limit(SAMPLE)
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), lang.alias("lang"))
    # at most SAMPLE rows of two numbers: a bounded broadcast, so texts stay where they were read
    rows = written(texts.join(F.broadcast(picked), "id").select("id", "text", "toxic", "part", "lang")
                   .mapInArrow(lean(_features), "id long, words binary, toxic int, part int, lang string"), "toxic-sample")
    total, bad = rows.where("part = 0").agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    rate = (bad + 0.5) / (total + 1)
    counts = (rows.where("part = 0").select("words", "toxic").mapInArrow(lean(_bucket_counts), "bucket long, t long, n long")
              .groupBy("bucket").agg(F.sum("t").alias("t"), F.sum("n").alias("n")).toPandas())  # BUCKETS rows at most
    odds = np.zeros(BUCKETS, np.float32)
    p = (counts.t.to_numpy() + 4 * rate) / (counts.n.to_numpy() + 4)
    odds[counts.bucket.to_numpy()] = np.log(p / (1 - p)) - np.log(rate / (1 - rate))
    half = rows.where("part = 1").withColumn("turn", F.xxhash64(F.lit(11), "id"))
    net = half.orderBy("turn", "id", "toxic", "words").limit(NET_ROWS).select("words", "toxic", "turn").toPandas()  # bounded sample
    unpack = lambda b: np.frombuffer(b, np.uint16).reshape(-1, len(PARTS))
    model = train([unpack(b) for b in net.words], net.toxic.to_numpy(), odds)
    if lang_col and model.constant is None:
        # at most SAMPLE ids: a bounded broadcast
        taught = rows.where("part = 0").select("id").unionByName(half.where(F.col("turn") <= int(net.turn.max())).select("id"))
        model.thresholds = _thresholds(texts, known.join(F.broadcast(taught.distinct()), "id", "left_anti"), model)
    return model


def _thresholds(texts: DataFrame, known: DataFrame, model: Model, steps: int = 100) -> dict:
    """Threshold per language from the documents ``texts`` (id, text, lang) that
    ``known`` (id, toxic) labels. Texts are scored where they are read."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            s = scores(shared.value, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array((s * steps).astype(np.int64))], names=["id", "lang", "bin"])
    hist = (texts.select("id", "text", "lang").mapInArrow(lean(run), "id long, lang string, bin long").join(known.select("id", "toxic"), "id")
            .groupBy("lang", "bin").agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).toPandas())
    out = {}
    for lang, part in hist.groupby("lang"):
        t, n = np.zeros(steps + 1), np.zeros(steps + 1)
        t[part.bin], n[part.bin] = part.t, part.n
        if t.sum() >= MIN_TOXIC:
            hit, flagged = t[::-1].cumsum()[::-1], n[::-1].cumsum()[::-1]
            f1 = 2 * hit / (flagged + t.sum())
            best = np.flatnonzero(f1 >= f1.max() - 1e-9)
            out[lang] = float(best[np.abs(best / steps - THRESHOLD).argmin()] / steps)
    return out


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a double column ``name``, 0 to 1 (higher: toxic likelier);
    a column of that name is replaced."""
    docs = without(docs, [name], text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns

    def run(batches):
        for batch in batches:
            text = batch.column(columns.index(text_col))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores(shared.value, text), pa.float64())], names=[*columns, name])
    return docs.mapInArrow(lean(run), StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def language_threshold(model: Model, lang_col: str = "lang"):
    """Column: the threshold of the row's language."""
    out = F.lit(THRESHOLD)
    for lang, t in sorted(model.thresholds.items()):
        out = F.when(F.col(lang_col) == lang, t).otherwise(out)
    return out
