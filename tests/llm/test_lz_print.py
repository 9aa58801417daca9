import hashlib
import random

import numpy as np

from tessera.llm import lz_print
from tessera.llm.lz_print import compare_next, edited, fingerprint, likeness, parse


def plain_phrases(text):
    seen, now = set(), ""
    for c in text:
        now += c
        if now not in seen:
            seen.add(now)
            now = ""
    return seen


def cut(text, cuts):
    return {text[a:b] for a, b in zip(cuts, cuts[1:])}


def test_parse_is_lz78():
    r = random.Random(1)
    for _ in range(300):
        text = "".join(r.choice("abé😀") for _ in range(r.randrange(80))) * r.randrange(1, 4)
        seen, cuts = set(), [0]
        parse(text, seen, cuts, len(text))
        assert seen == plain_phrases(text) == cut(text, cuts)


def test_parse_can_stop_and_go_on():
    r = random.Random(2)
    for _ in range(300):
        head, a = ("".join(r.choice("abc") for _ in range(r.randrange(40))) for _ in range(2))
        seen, cuts = set(), [0]
        parse(head + a, seen, cuts, len(head))
        parse(head + a, seen, cuts, len(head + a))
        assert seen == plain_phrases(head + a)


def test_degenerate_text_is_linear():
    seen, cuts = set(), [0]
    parse("a" * 1_000_000, seen, cuts, 1_000_000)
    assert len(seen) == 1413


def test_likeness_of_signatures():
    same, r = "some text of a page, long enough to have phrases " * 3, random.Random(3)
    assert likeness(fingerprint(same), fingerprint(same)) == 1.0
    assert likeness(fingerprint(""), fingerprint("")) == 1.0 and likeness(fingerprint(""), fingerprint("a")) == 0.0
    a = "".join(r.choice("abcdefgh ") for _ in range(4000))
    b = "".join(r.choice("stuvwxyz ") for _ in range(4000))
    pa, pb = plain_phrases(a), plain_phrases(a[:2000] + b[:2000])
    true = len(pa & pb) / len(pa | pb)
    assert abs(likeness(fingerprint(a), fingerprint(a[:2000] + b[:2000])) - true) < 0.15
    assert likeness(fingerprint(a), fingerprint(b)) < 0.05


def expected(rows):
    """(doc_id, n_chars, sha of the edit, likenesses) by a plain loop."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        e = edited(t, nxt)
        f = fingerprint(t)
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), likeness(f, fingerprint(e)), likeness(f, fingerprint(nxt))))
    return sorted(out, key=str)


def got(df, **how):
    return sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in compare_next(df, **how).collect()), key=str)


def test_next_rows_across_slices(spark):
    r = random.Random(4)
    rows = [(i * 3 - 50, "".join(r.choice("ab cdé") for _ in range(r.randrange(0, 60)))) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for slices in (1, 2, 7, 40, 400):
        assert got(df, slices=slices) == expected(rows)


def test_small_tables(spark, no_docs):
    for rows in ([(5, "only one row")], [(5, "a"), (None, "b")], [(None, "x"), (None, None)], [(1, "t")] * 3):
        assert got(spark.createDataFrame(rows, "doc_id long, text string")) == expected(rows)
    assert compare_next(no_docs).count() == 0


def test_odd_rows(odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    assert got(odd_docs, slices=5) == expected(rows)
    prints = {r["fingerprint"] for r in compare_next(odd_docs).collect() if r["doc_id"] in (1, 2)}
    assert len(prints) == 1 and len(prints.pop()) <= 8 * lz_print.SIZE
    assert np.all(fingerprint("abc") == np.sort(fingerprint("abc")))
