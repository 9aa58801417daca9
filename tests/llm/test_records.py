import glob
import random
import struct

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import records
from tessera.llm.records import Encoder, frame, masked, read, read_shuffled, storage, unframe, write

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = [" ", "\n", "\t", " ", "\x1c", "A", "b", "É", "é", "Σ", "ς", "'s", "'LL", "1", "½", "日", "😀", "<|endoftext|>", "́", ".", "!?", "İ", "ß",
            "\x00", "\x85", "The", "end.", "x,", "(a)"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as f:
        return Encoder(f.read(), 1)


def test_equals_the_library(library, encoder, monkeypatch):
    r = random.Random(5)
    texts = ["".join(r.choice(ALPHABET) for _ in range(r.randrange(40))) for _ in range(3000)] + ["", "a" * 5000, "word " * 3000]
    want = [e.ids + [1] for e in library.encode_batch(texts, add_special_tokens=False)]
    assert encoder.by_word and [np.frombuffer(b, encoder.code).tolist() for b in encoder.encode_all(texts)] == want
    monkeypatch.setattr(records, "CACHE", 20)
    assert [np.frombuffer(b, encoder.code).tolist() for b in encoder.encode_all(texts, slice_size=500)] == want


def test_letter_words_need_the_merges_alone(library, encoder):
    r = random.Random(8)
    letters = [chr(c) for c in [*range(65, 91), *range(97, 123), *range(0xC0, 0x180)] if chr(c).isalpha() and c != 0x130]
    texts = ["".join(r.choices(letters, k=r.randrange(1, 14))) for _ in range(4000)]
    assert encoder.direct
    assert [np.frombuffer(b, encoder.code).tolist()[:-1] for b in encoder.encode_all(texts)] == [
        e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_frames_find_damage():
    data = frame(b"some payload") + frame(b"")
    payload, at = unframe(data, 0)
    assert payload == b"some payload" and unframe(data, at) == (b"", len(data))
    for i in range(len(data)):
        bad = bytearray(data)
        bad[i] ^= 1
        with pytest.raises((ValueError, struct.error)):
            _, at = unframe(bytes(bad), 0)
            unframe(bytes(bad), at)
    assert masked(b"") == 0xA282EAD8


def expected(rows, library):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out, start = [], 0
    for d, t in order:
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        out.append((d, start, ids))
        start += len(ids)
    return out


def test_round_trip(spark, library):
    r = random.Random(6)
    rows = [(i * 7 % 1000 - 300, " ".join(r.choice(ALPHABET) for _ in range(r.randrange(30)))) for i in range(1000)] + [(None, "no id")]
    df = spark.createDataFrame([(*x, 1, 2) for x in rows], "doc_id long, text string, ids int, part int").repartition(6)
    folder, summary = write(df, PATH, 1, files=5)
    assert sum(n for _, n, _ in summary) == 1001 and 1 < len(summary) <= 5
    got = [(x["doc_id"], x["start"], np.frombuffer(x["ids"], "<u4").tolist()) for x in read(spark, folder, summary, step=1000).collect()]
    assert got == expected(rows, library)
    _, root = storage(folder)
    assert len(glob.glob(f"{root}/part-*.rec")) == len(glob.glob(f"{root}/part-*.idx")) == len(summary)
    assert not [f for f in glob.glob(f"{root}/.*") if not f.endswith(".crc")]
    one, two, other = ([x["doc_id"] for x in read_shuffled(spark, folder, summary, seed, tasks=4).collect()] for seed in (1, 1, 2))
    assert one == two and one != other and sorted(one, key=str) == sorted((d for d, _, _ in got), key=str)
    shuffled = {x["doc_id"]: x["ids"] for x in read_shuffled(spark, folder, summary, 3).collect()}
    assert all(np.frombuffer(shuffled[d], "<u4").tolist() == ids for d, _, ids in got)


def test_damaged_file_is_refused(spark):
    folder, summary = write(spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), PATH, 1, files=1)
    name = f"{storage(folder)[1]}/part-{summary[0][0]:05d}.rec"
    with open(name, "r+b") as f:
        f.seek(-6, 2)
        f.write(b"\xff")
    with pytest.raises(Exception, match="damaged"):
        read(spark, folder, summary).collect()


def test_odd_rows(spark, odd_docs, no_docs, library):
    folder, summary = write(odd_docs, PATH, 1, files=3)
    got = read(spark, folder, summary).collect()
    assert len(got) == 12 and [r["start"] for r in got] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in got])[:-1]]).tolist()
    by_id = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in got}
    assert by_id[3] == by_id[4] == by_id[5] == [1]
    assert [r["doc_id"] for r in got[:2]] == [None, None]
    folder, summary = write(no_docs, PATH, 1)
    assert summary == [] and read(spark, folder, summary).count() == 0 and read_shuffled(spark, folder, summary, 1).count() == 0
