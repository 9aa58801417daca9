"""Offset-preserving SentencePiece encoding and decoding (operator 4).

``encode(df, model)`` adds to each row ``ids`` (little-endian unsigned 32-bit
token ids), ``begins`` and ``ends`` (byte span of each token in the original
UTF-8 text, same packing) and ``decoded`` (the library's ``decode(ids)``).

Steps per text: (1) the text is normalised here, by longest-prefix lookups in
the model's compiled character map (its double-array trie), user-defined pieces
first, and every normalised byte records the source offset it came from;
(2) the normalised text is segmented by the library under the same vocabulary
with its own normaliser switched off, word by word through a bounded cache
(``CACHE`` words) where the vocabulary proves that no piece crosses a word start; (3) the lengths
of the pieces are summed into normalised offsets and projected to source bytes.

Defined results: null text is the empty text (begin and end ids only); very
long texts are encoded whole; ids in the text that look like control pieces are
ordinary text; tables may be empty, rows repeated, extra columns are kept.
Begin and end ids have empty spans at the ends of the text.
"""

from __future__ import annotations

import re
import struct
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from tessera.llm.shared import lean, row_runs, without

SPACE = "▁"
CACHE = 100_000
_UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 2, 3, 4, 5, 6


def _varint(b: bytes, at: int) -> tuple[int, int]:
    shift = out = 0
    while True:
        out |= (b[at] & 127) << shift
        at += 1
        if b[at - 1] < 128:
            return out, at
        shift += 7


def fields(b: bytes):
    """(field, wire type, value, start, end) of a protocol-buffer message."""
    at = 0
    while at < len(b):
        start = at
        key, at = _varint(b, at)
        wire = key & 7
        if wire == 0:
            value, at = _varint(b, at)
        elif wire == 2:
            n, at = _varint(b, at)
            value, at = b[at:at + n], at + n
        else:
            n = {5: 4, 1: 8}[wire]
            value, at = b[at:at + n], at + n
        yield key >> 3, wire, value, start, at


def _length_prefixed(field: int, body: bytes) -> bytes:
    n, out = len(body), bytearray([field << 3 | 2])
    while n >= 128:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out) + bytes([n]) + body


class CharMap:
    """The compiled character map: double-array trie over UTF-8 bytes."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4:4 + size], "<u4").tolist()
        self.strings = blob[4 + size:]
        self.cache: dict[int, bytes] = {}

    def longest(self, text: bytes, at: int) -> tuple[int, bytes]:
        """Bytes matched at ``at`` (0: none) and their replacement."""
        units, node, found, value = self.units, 0, 0, 0
        unit = units[0]
        node ^= (unit >> 10) << ((unit & 512) >> 6)
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                found, value = i + 1 - at, units[node] & 0x7FFFFFFF
        if not found:
            return 0, b""
        if value not in self.cache:
            self.cache[value] = self.strings[value:self.strings.index(b"\0", value)]
        return found, self.cache[value]


class Normalizer:
    """Normalised text and, for each of its bytes and its end, the source byte."""

    def __init__(self, charsmap: bytes, dummy_prefix: bool, squeeze: bool, escape: bool, suffix: bool, user: list[bytes]):
        self.map = CharMap(charsmap) if charsmap else None
        self.dummy, self.squeeze, self.escape, self.suffix = dummy_prefix, squeeze, escape, suffix
        self.space = SPACE.encode() if escape else b" "
        self.user = re.compile(b"|".join(re.escape(u) for u in sorted(user, key=len, reverse=True))) if user else None
        self.plain = self.map is None and not squeeze and not suffix and self.user is None

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        if not text:
            return b"", np.zeros(1, np.int64)
        return self._plain(text) if self.plain else self._walk(text)

    def _plain(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """No map: every character stands for itself, blanks are escaped."""
        data = np.frombuffer(text, np.uint8)
        first = np.maximum.accumulate(np.where((data & 0xC0) == 0x80, 0, np.arange(len(data))))
        align = np.repeat(first, np.where(data == 32, len(self.space), 1))
        head = self.space if self.dummy else b""
        return head + text.replace(b" ", self.space), np.concatenate([np.zeros(len(head), np.int64), align, [len(text)]])

    def _prefix(self, text: bytes, at: int) -> tuple[bytes, int]:
        if self.user is not None and (m := self.user.match(text, at)):
            return m[0], len(m[0])
        if self.map is not None:
            n, new = self.map.longest(text, at)
            if n:
                return new, n
        lead = text[at]
        n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return text[at:at + n], n

    def _walk(self, text: bytes) -> tuple[bytes, np.ndarray]:
        out, align, at = bytearray(), [], 0
        if self.squeeze:
            while at < len(text):
                new, n = self._prefix(text, at)
                if new != b" ":
                    break
                at += n
            if at == len(text):
                return b"", np.array([at], np.int64)

        def blank():
            out.extend(self.space)
            align.extend([at] * len(self.space))
        if self.dummy and not self.suffix:
            blank()
        after_blank = self.squeeze
        while at < len(text):
            new, n = self._prefix(text, at)
            if after_blank:
                new = new.lstrip(b" ")
            if new:
                shown = new.replace(b" ", self.space)
                out.extend(shown)
                align.extend([at] * len(shown))
                after_blank = new.endswith(b" ")
            at += n
            after_blank = after_blank and self.squeeze
        if self.squeeze:
            while out.endswith(self.space):
                at = align[len(out) - len(self.space)]
                del out[-len(self.space):], align[len(out):]
        if self.dummy and self.suffix:
            blank()
        return bytes(out), np.array([*align, at], np.int64)


class Encoder:
    """One model: own normaliser, the library's segmentation and decoding."""

    def __init__(self, model: bytes):
        import sentencepiece
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bos, self.eos = self.library.bos_id(), self.library.eos_id()
        pieces, norm, trainer, bare = [], {}, {}, bytearray()
        for field, _, value, start, end in fields(model):
            if field == 1:
                piece = {f: v for f, _, v, _, _ in fields(value)}
                pieces.append((piece.get(1, b""), piece.get(3, 1)))
            elif field == 2:
                trainer = {f: v for f, _, v, _, _ in fields(value)}
            elif field == 3:
                norm = {f: v for f, _, v, _, _ in fields(value)}
            if field != 3:
                bare += model[start:end]
        # the same vocabulary with an identity normaliser: no prefix, nothing squeezed or escaped
        bare += _length_prefixed(3, bytes([1 << 3 | 2, 8]) + b"identity" + bytes([3 << 3, 0, 4 << 3, 0, 5 << 3, 0]))
        self.bare = sentencepiece.SentencePieceProcessor(model_proto=bytes(bare))
        self.normalize = Normalizer(norm.get(2, b""), bool(norm.get(3, 1)), bool(norm.get(4, 1)), bool(norm.get(5, 1)),
                                    bool(trainer.get(24, 0)), [p for p, kind in pieces if kind == _USER])
        self.sizes = np.array([1 if kind == _BYTE else 0 if kind == _CONTROL else len(p) for p, kind in pieces], np.int64)
        self.unknown = np.array([kind == _UNKNOWN for _, kind in pieces])
        # a piece with a blank after another character would cross word starts
        crossing = any(SPACE in s.lstrip(SPACE) for s in (p.decode("utf-8", "replace") for p, kind in pieces if kind not in (_BYTE, _CONTROL)))
        has_bytes = any(kind == _BYTE for _, kind in pieces)
        self.by_word = has_bytes and not crossing and bool(norm.get(5, 1)) and not trainer.get(24, 0)
        self.words: dict[str, bytes] = {}

    def learn(self, normals: list[str]) -> None:
        """Segment the words of some normalised texts that the cache lacks, in
        one call; the cache starts anew when it would pass ``CACHE`` words."""
        if not self.by_word:
            return
        seen = {w for n in normals if self._splits(n) for w in n.split(SPACE)}
        seen.discard("")
        new = [w for w in seen if w not in self.words]
        if len(self.words) + len(new) > CACHE:
            self.words.clear()
            new = list(seen)
        for w, ids in zip(new, self.bare.encode([SPACE + w for w in new], num_threads=1) if new else ()):
            self.words[w] = struct.pack(f"<{len(ids)}I", *ids)

    def _splits(self, normal: str) -> bool:
        return self.by_word and SPACE * 2 not in normal and normal.startswith(SPACE) and not normal.endswith(SPACE)

    def _segment(self, normal: str) -> bytes:
        if self._splits(normal):
            known = self.words
            try:
                return b"".join([known[w] for w in normal.split(SPACE)[1:]])
            except KeyError:
                pass
        return np.array(self.bare.encode(normal), "<u4").tobytes()

    def encode_all(self, texts: list[str], slice_size: int = 1 << 20):
        """``encode`` of each text, words learnt for some texts at a time."""
        at = 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size + len(texts[to]) <= slice_size):
                size += len(texts[to])
                to += 1
            some = [self.normalize(t.encode()) for t in texts[at:to]]
            self.learn([n.decode() for n, _ in some])
            for text, (normal, align) in zip(texts[at:to], some):
                yield self._project(len(text.encode()), normal, align)
            at = to

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids with begin and end ids, and their byte spans in the text."""
        return next(self.encode_all([text]))

    def _project(self, whole: int, normal: bytes, align: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inner = np.frombuffer(self._segment(normal.decode()), "<u4")
        size = self.sizes[inner]
        gap = self.unknown[inner]
        if gap.any():
            size = self._unknown_sizes(normal.decode(), len(inner))
        ends = np.cumsum(size)
        if (ends[-1] if len(ends) else 0) != len(normal):
            raise ValueError("pieces do not cover the normalised text")
        begin, end = align[ends - size], align[ends]
        return (np.concatenate([[self.bos], inner, [self.eos]]).astype("<u4"),
                np.concatenate([[0], begin, [whole]]).astype("<u4"), np.concatenate([[0], end, [whole]]).astype("<u4"))

    def _unknown_sizes(self, normal: str, n: int) -> np.ndarray:
        """Unknown pieces (models without byte pieces) have the size of their text."""
        found = self.bare.encode(normal, return_type="proto").pieces
        return np.array([len(p.surface.encode()) for p in found], np.int64)

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist())


def encode(df: DataFrame, model_path: str, text_col: str = "text", spans: bool = True) -> DataFrame:
    """``df`` with ``ids``, ``decoded`` and (``spans``) ``begins``, ``ends``;
    columns of these names are replaced."""
    model = df.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())  # a vocabulary file, under a few MB
    names = ["ids", "decoded"] + ["begins", "ends"] * spans
    df = without(df, names, text_col)
    columns = df.columns

    def run(batches):
        encoder = Encoder(model.value)
        for whole in batches:
            for at, n in row_runs(whole.column(columns.index(text_col))):
                batch, out = whole.slice(at, n), []
                texts = [t or "" for t in batch.column(columns.index(text_col)).to_pylist()]
                for ids, begin, end in encoder.encode_all(texts):
                    row = (ids.tobytes(), encoder.decode(ids), begin.tobytes(), end.tobytes())
                    out.append(row[:len(names)])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *(pa.array(a, pa.string() if name == "decoded" else pa.binary()) for name, a in zip(names, zip(*out)))],
                    names=[*columns, *names])
    added = [StructField(n, StringType() if n == "decoded" else BinaryType()) for n in names]
    return df.mapInArrow(lean(run), StructType([*df.schema.fields, *added]))
