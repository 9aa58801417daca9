import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pytest

from tessera.llm import pieces
from tessera.llm.pieces import CharMap, Encoder, Normalizer, encode

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = [" ", "  ", "\n", "▁", "a", "b.", "é", "é", "日", "😀", "<s>", "\t", "0", "the ", "\x00", "ﬁ", "</s>", "\r"]


@pytest.fixture(scope="module")
def encoder():
    with open(MODEL, "rb") as f:
        return Encoder(f.read())


def random_texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randrange(50))) for _ in range(n)]


def test_equals_the_library(encoder):
    texts = random_texts(800, 1) + ["", " ", "x" * 20_000, "word " * 5000]
    for text, (ids, begins, ends) in zip(texts, encoder.encode_all(texts)):
        want = encoder.library.encode(text, return_type="proto")
        assert ids.tolist() == encoder.library.encode(text, add_bos=True, add_eos=True)
        assert begins[1:-1].tolist() == [p.begin for p in want.pieces] and ends[1:-1].tolist() == [p.end for p in want.pieces]
        assert encoder.decode(ids) == encoder.library.decode(ids.tolist())


def test_small_cache_gives_the_same(encoder, monkeypatch):
    texts = random_texts(200, 2)
    want = [i.tolist() for i, _, _ in encoder.encode_all(texts)]
    monkeypatch.setattr(pieces, "CACHE", 5)
    assert [i.tolist() for i, _, _ in encoder.encode_all(texts, slice_size=100)] == want


def double_array(entries: dict[bytes, bytes]) -> bytes:
    """A compiled character map of a few entries, laid out by first fit."""
    strings, value_of = bytearray(), {}
    for key, new in entries.items():
        value_of[key] = len(strings)
        strings += new + b"\0"
    units, used = {0: 0}, {0}

    def put(node, prefix):
        nexts = sorted({k[len(prefix)] for k in entries if len(k) > len(prefix) and k.startswith(prefix)})
        leaf = prefix in entries
        labels = ([0] if leaf else []) + nexts
        base = next(b for b in range(1, 1 << 20) if all((b ^ c) not in used for c in labels))
        offset = node ^ base
        units[node] |= (offset << 10) | (256 if leaf else 0)
        for c in labels:
            used.add(base ^ c)
            units[base ^ c] = value_of[prefix] | 1 << 31 if c == 0 and leaf else c
        for c in nexts:
            put(base ^ c, prefix + bytes([c]))
    put(0, b"")
    body = b"".join(struct.pack("<I", units.get(i, 0)) for i in range(max(units) + 1))
    return struct.pack("<I", len(body)) + body + bytes(strings)


def test_longest_prefix_through_the_map():
    blob = double_array({"ﬁ".encode(): b"fi", b"ab": b"X", b"abc": b"YY", b"\t": b" ", "é".encode(): "é".encode()})
    trie = CharMap(blob)
    assert trie.longest(b"abcd", 0) == (3, b"YY") and trie.longest(b"abx", 0) == (2, b"X")
    assert trie.longest(b"ax", 0) == (0, b"") and trie.longest("xﬁ".encode(), 1) == (3, b"fi")
    n = Normalizer(blob, True, True, True, False, [])
    text = "\t ab  ﬁé abc ".encode()
    out, align = n(text)
    assert out.decode() == "▁X▁fié▁YY" and len(align) == len(out) + 1
    source = {out[:i].decode(errors="ignore"): int(align[i]) for i in (3, 4, 7, 8, 9)}
    assert source == {"▁": 2, "▁X": 4, "▁X▁": 6, "▁X▁f": 6, "▁X▁fi": 9}
    assert align[-1] == text.rindex(b" ")


def test_walk_equals_the_plain_path(encoder):
    n = encoder.normalize
    for text in random_texts(300, 3):
        if text:
            a, b = n._plain(text.encode()), n._walk(text.encode())
            assert a[0] == b[0] and a[1].tolist() == b[1].tolist()


def test_user_pieces_come_first():
    n = Normalizer(double_array({b"a": b"b"}), False, False, True, False, [b"aa", b"aab"])
    assert n(b"aaba")[0] == b"aabb" and n(b"aaa")[0] == b"aab"


def test_odd_rows(odd_docs, no_docs, encoder):
    rows = encode(odd_docs, MODEL).collect()
    assert len(rows) == 12
    for r in rows:
        text = r["text"] or ""
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert ids == encoder.library.encode(text, add_bos=True, add_eos=True) and r["decoded"] == encoder.library.decode(ids)
        ends = np.frombuffer(r["ends"], "<u4")
        assert len(ends) == len(ids) and ends[-1] == len(text.encode())
        assert hashlib.sha256(r["ids"]).digest()
    assert encode(no_docs, MODEL).count() == 0
