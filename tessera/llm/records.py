"""Length-delimited binary records of token ids (operator 8).

``write(df, tokenizer)`` encodes every text, appends an end id and writes the
sequences in ascending id order as record files with an offset index each;
``read`` returns them in file order, ``read_shuffled`` in a seeded random order
through the index alone.

File format (little-endian). ``part-NNNNN.rec``: the magic ``TSREC1``, one byte
ids' width (2 or 4), one zero byte; then frames
    length u64 | masked CRC of the length bytes u32 | payload | masked CRC of the payload u32
A payload is ``has_id u8, id i64`` and the ids. The mask rotates a CRC-32 by 15
bits and adds a constant, so that a CRC of data that holds CRCs stays useful.
``part-NNNNN.idx``: one ``offset u64, length u64`` per frame, then one masked
CRC u32 of all of them.

Scale. Texts are encoded where they are read, only ids are shuffled, once, into
range slices whose split ids are one number per file. A task streams its slice
into a file of a name of its own and renames it when it is complete, so a lost
executor leaves no half file and a second attempt writes the same bytes. The
driver sees one row (records, tokens) per file, from which a file's first token
number follows.

Encoding goes through the tokenizer library; as no token of such a vocabulary
crosses blanks, distinct blank-separated strings are encoded once per slice of
texts and kept in a bounded cache (two
generations of about ``CACHE`` strings).

Defined results: null text is empty (the end id alone); null ids come first and
are null when read back; rows with equal ids follow by their ids; an empty
table makes no files and reads as no rows; extra columns are not stored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.shared import row_runs, scratch

MAGIC = b"TSREC1"
CACHE = 125_000
#: a letter whose lower case is one letter, then marks up to a blank
_TAIL = re.compile(r"([A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f])([.,;:!?|$%&#*]+(?= |$))")
_LETTERS = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+")
_MASK_ADD = 0xA282EAD8
_HEAD, _HEAD_SIZE = "<QI", 12
_ID, _ID_SIZE = "<Bq", 9


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK_ADD) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def unframe(data: bytes, at: int) -> tuple[bytes, int]:
    """Payload of the frame at ``at`` and the place after it."""
    length, crc = struct.unpack_from(_HEAD, data, at)
    if masked(data[at:at + 8]) != crc:
        raise ValueError("record length is damaged")
    at += _HEAD_SIZE
    payload = data[at:at + length]
    if len(payload) != length or struct.unpack_from("<I", data, at + length)[0] != masked(payload):
        raise ValueError("record is damaged")
    return payload, at + length + 4


def storage(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that executors share."""
    if re.match(r"[a-z0-9]+://", uri) and not uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", uri)


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others, in order, for the characters from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


class Encoder:
    """Ids of texts as packed bytes; words learnt for some texts at a time."""

    def __init__(self, tokenizer: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_str(tokenizer)
        self.width = 2 if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 and end_id < 1 << 16 else 4
        spec = json.loads(tokenizer)
        model, added = spec["model"], spec.get("added_tokens", [])
        pre = json.dumps(spec.get("pre_tokenizer"))
        # texts may be cut at blanks when blanks are removed before the merges and no added token takes them in
        self.by_word = ("\\\\s" in pre and '"Removed"' in pre and spec.get("post_processor") is None and model.get("dropout") is None
                        and not any(a["lstrip"] or a["rstrip"] or a["single_word"] or re.search(r"\s", a["content"]) for a in added))
        self.code, self.end = f"<u{self.width}", struct.pack("<H" if self.width == 2 else "<I", end_id)
        # words of letters only are one token before the merges: the merges alone are needed
        norm, steps = (spec.get(k) or {} for k in ("normalizer", "pre_tokenizer"))
        steps = steps.get("pretokenizers", [])
        self.direct = (self.by_word and [n["type"] for n in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
                       and [p["type"] for p in steps] == ["Split", "ByteLevel"] and r"|[\p{L}]+|" in steps[0]["pattern"].get("Regex", "")
                       and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"])
        self.alphabet = _byte_letters()
        self.folds = '"Lowercase"' in json.dumps(spec.get("normalizer"))
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _packed(self, texts: list[str]) -> list[bytes]:
        kind = "H" if self.width == 2 else "I"
        found = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return [struct.pack(f"<{len(i)}{kind}", *i) for i in found]

    def _split(self, text: str) -> list[str]:
        """Strings between blanks, with ASCII marks after a letter or digit
        apart (a run of marks is a token of its own). ASCII case is folded
        where the tokenizer folds it anyway and no special token is near."""
        if self.folds and "<|" not in text and text.isascii():
            text = text.lower()
        text = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
        return _TAIL.sub(r"\1 \2", text).split(" ")

    def _learn(self, seen: set[str]) -> dict[str, bytes]:
        """Ids of some strings. Two generations: what is used again moves to
        the younger, which becomes the older when it is full."""
        young, old = self.words, self.older
        if len(young) > CACHE:
            self.older = old = young
            self.words = young = {}
        new = []
        for w in seen:
            if w not in young:
                if w in old:
                    young[w] = old[w]
                else:
                    new.append(w)
        whole = [w for w in new if not (self.direct and _LETTERS.fullmatch(w))]
        young.update(zip(whole, self._packed(whole)))
        kind, merges, alphabet = "H" if self.width == 2 else "I", self.library.model.tokenize, self.alphabet
        for w in new:
            if w not in young:
                ids = [t.id for t in merges(w.lower().encode().decode("latin-1").translate(alphabet))]
                young[w] = struct.pack(f"<{len(ids)}{kind}", *ids)
        return young

    def encode_all(self, texts: list[str], slice_size: int = 1 << 21):
        at = 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size + len(texts[to]) <= slice_size):
                size += len(texts[to])
                to += 1
            if self.by_word:
                split = [self._split(t) for t in texts[at:to]]
                known = self._learn(set().union(*split))
                yield from (b"".join([known[w] for w in words]) + self.end for words in split)
            else:
                yield from (ids + self.end for ids in self._packed(texts[at:to]))
            at = to


def write(df: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None, files: int | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> tuple[str, list[tuple[int, int, int]]]:
    """Write the record files; (folder, [(file number, records, tokens)])."""
    spark = df.sparkSession
    folder = folder or scratch(spark, "records")
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tokenizer = spark.sparkContext.broadcast(Path(tokenizer_path).read_text(encoding="utf-8"))  # a vocabulary file, a few MB
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    splits = rows.select("doc_id").approxQuantile("doc_id", [i / files for i in range(1, files)], 1 / (8 * files)) if files > 1 else []
    cuts = np.unique(np.array(splits, dtype=np.float64))  # one number per file

    @F.pandas_udf("int")
    def slice_of(ids: pd.Series) -> pd.Series:
        part = np.searchsorted(cuts, ids.to_numpy(dtype=np.float64, na_value=np.nan), side="right")
        return pd.Series(np.where(ids.isna(), 0, part))

    def encode(batches):
        encoder = Encoder(tokenizer.value, end_id)
        for whole in batches:
            for at, n in row_runs(whole.column(1)):
                batch = whole.slice(at, n)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(encoder.encode_all(texts)), pa.binary())], names=["doc_id", "ids"])

    width = Encoder(tokenizer.value, end_id).width

    def store(batches):
        system, root = storage(folder)
        system.create_dir(root, recursive=True)
        part, records, tokens, index, out, at = None, 0, 0, [], None, 0
        temporary = f"{root}/.{uuid.uuid4().hex}"
        for batch in batches:
            for doc_id, ids, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if out is None:
                    part, out = number, system.open_output_stream(f"{temporary}.rec")
                    at = out.write(MAGIC + bytes([width, 0]))
                f = frame(struct.pack(_ID, doc_id is not None, doc_id or 0) + ids)
                out.write(f)
                index.append(struct.pack("<QQ", at, len(f)))
                at, records, tokens = at + len(f), records + 1, tokens + len(ids) // width
        if out is not None:
            out.close()
            with system.open_output_stream(f"{temporary}.idx") as i:
                body = b"".join(index)
                i.write(body + struct.pack("<I", masked(body)))
            for end in ("rec", "idx"):
                system.move(f"{temporary}.{end}", f"{root}/part-{part:05d}.{end}")
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([records]), pa.array([tokens])], names=["file", "records", "tokens"])

    dealt = (rows.mapInArrow(encode, "doc_id long, ids binary").withColumn("part", slice_of("doc_id"))
             .repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions(F.asc_nulls_first("doc_id"), "ids"))
    summary = dealt.mapInArrow(store, "file int, records long, tokens long").collect()  # one row per file
    return folder, sorted((r["file"], r["records"], r["tokens"]) for r in summary)


def _record(payload: bytes, width: int) -> tuple[int | None, np.ndarray]:
    has_id, doc_id = struct.unpack_from(_ID, payload)
    return doc_id if has_id else None, np.frombuffer(payload, f"<u{width}", offset=_ID_SIZE).astype("<u4")


def read(spark: SparkSession, folder: str, summary: list[tuple[int, int, int]], step: int = 8 << 20) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every record, one task per file.
    ``start``: tokens of all records before; ``ids``: unsigned 32-bit."""
    schema = "doc_id long, start long, n_tokens long, ids binary"
    starts, total = {}, 0
    for number, _, tokens in summary:
        starts[number] = total
        total += tokens
    if not starts:
        return spark.createDataFrame([], schema)

    def run(batches):
        for number in (int(n) for batch in batches for n in batch.column(0).to_pylist()):
            system, root = storage(folder)
            with system.open_input_stream(f"{root}/part-{number:05d}.rec") as f:
                head = f.read(len(MAGIC) + 2)
                if head[:len(MAGIC)] != MAGIC:
                    raise ValueError("not a record file")
                width, start, left = head[len(MAGIC)], starts[number], b""
                while True:
                    more = f.read(step)
                    left, at, out = left + more, 0, []
                    while at + _HEAD_SIZE <= len(left) and at + _HEAD_SIZE + struct.unpack_from(_HEAD, left, at)[0] + 4 <= len(left):
                        payload, at = unframe(left, at)
                        doc_id, ids = _record(payload, width)
                        out.append((doc_id, start, len(ids), ids.tobytes()))
                        start += len(ids)
                    left = left[at:]
                    if out:
                        yield _batch(out)
                    if not more:
                        break
                if left:
                    raise ValueError("record file ends within a frame")
    named = F.element_at(F.array(*[F.lit(n) for n in starts]), (F.col("id") + 1).cast("int"))
    numbers = spark.range(0, len(starts), 1, len(starts)).select(named.alias("file"))
    return numbers.mapInArrow(run, schema)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    doc_id, start, n, ids = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(doc_id, pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                                      names=["doc_id", "start", "n_tokens", "ids"])


def read_shuffled(spark: SparkSession, folder: str, summary: list[tuple[int, int, int]], seed: int, tasks: int | None = None) -> DataFrame:
    """``doc_id, ids`` of every record in a seeded random order: index entries
    are dealt over the tasks at random and frames are read by offset."""
    numbers = [n for n, _, _ in summary]
    if not numbers:
        return spark.createDataFrame([], "doc_id long, ids binary")

    def entries(batches):
        for number in (numbers[int(i)] for batch in batches for i in batch.column(0).to_pylist()):
            system, root = storage(folder)
            with system.open_input_stream(f"{root}/part-{number:05d}.idx") as f:
                body = f.read()
            if struct.unpack("<I", body[-4:])[0] != masked(body[:-4]):
                raise ValueError("index is damaged")
            at = np.frombuffer(body[:-4], "<u8").reshape(-1, 2).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), number)), pa.array(at[:, 0]), pa.array(at[:, 1])], names=["file", "offset", "size"])

    def fetch(batches):
        system, root = storage(folder)
        open_files: dict[int, tuple] = {}
        for batch in batches:
            out = []
            for number, offset, size in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if number not in open_files:
                    if len(open_files) >= 64:
                        open_files.popitem()[1][0].close()
                    f = system.open_input_file(f"{root}/part-{number:05d}.rec")
                    open_files[number] = (f, f.read_at(len(MAGIC) + 2, 0)[len(MAGIC)])
                f, width = open_files[number]
                out.append(_record(unframe(f.read_at(size, offset), 0)[0], width))
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in out], pa.int64()), pa.array([i.tobytes() for _, i in out], pa.binary())], names=["doc_id", "ids"])
    index = spark.range(0, len(numbers), 1, len(numbers)).mapInArrow(entries, "file long, offset long, size long")
    order = F.xxhash64(F.lit(seed), "file", "offset")
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return index.repartition(tasks, order).sortWithinPartitions(order).mapInArrow(fetch, "doc_id long, ids binary")
