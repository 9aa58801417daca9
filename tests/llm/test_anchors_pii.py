import random
import re

import pytest

from tessera.llm import anchors_pii as P

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    """The base kinds by their patterns."""
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", m[0])
            if kind == "ip":
                ok = all(int(p) <= 255 for p in m[0].split("."))
            elif kind == "card":
                total = sum(int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits)))
                ok = 16 <= len(digits) <= 19 and total % 10 == 0
            else:
                ok = kind == "email" or 8 <= len(digits) <= 15
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def base_of(text):
    return [s for s in P.spans(text) if s[0] in P.BASE]


@pytest.mark.parametrize("alphabet, n", [("ab1.@-+", 30_000), ("0159.- +()", 30_000), ("é1.😀+ 2", 10_000), ("1.", 3_000), ("0123456789 -", 10_000), ("a@.b_%+", 10_000)])
def test_base_equals_the_patterns(alphabet, n):
    r = random.Random(alphabet)
    for _ in range(n):
        text = "".join(r.choices(alphabet, k=r.randrange(0, 60)))
        assert base_of(text) == plain(text), text


def test_base_equals_the_patterns_on_documents(spark, tiny):
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect():
        assert P.spans(r["text"]) == plain(r["text"])  # and the added kinds find nothing in them


def test_valid_cards_with_separators():
    r = random.Random(3)
    for n in range(14, 22):
        for _ in range(200):
            digits = "".join(r.choices("0123456789", k=n - 1))
            digits += next(c for c in "0123456789" if P.luhn(digits + c))
            text = "x " + "".join(d + r.choice(["", "", " ", "-"]) for d in digits) + r.choice(["", "z", " 5x", "--1"])
            assert base_of(text) == plain(text)


def test_added_kinds():
    t = "IBAN: DE89 3704 0044 0532 0130 00, see https://bob:pa55@host.example/x and Account no. 1234-5678-90; SSN 123-45-6789."
    got = {(k, t[a:b]) for k, a, b in P.spans(t) if k in P.ADDED}
    assert got == {("iban", "DE89 3704 0044 0532 0130 00"), ("login", "bob:pa55"), ("account", "1234-5678-90"), ("ssn", "123-45-6789")}
    for t in ("IBAN DE88 3704 0044 0532 0130 00", "http://host:80/a@b", "an account of 12345 things", "accounting 1234567", "ssn 000-12-3456",
              "SSN 123-45-67890", "https://user@host/", "mailto://:x@y", "on account of the cat", "iban", "account", "://", "SSN "):
        assert not [s for s in P.spans(t) if s[0] in P.ADDED], t


def test_long_texts_are_linear():
    """The patterns need squared time on such texts: short ones are compared."""
    for unit in ("1.", "a", "+1", "a@", "12 ", "://a:", "iban ", "1.1.1.1.@b.c "):
        assert base_of(unit * 300) == plain(unit * 300)
        P.spans(unit * 100_000)


def test_odd_rows(odd_docs, no_docs):
    got = P.find(odd_docs).collect()
    assert len(got) == 12 and all(r["spans"] == [] for r in got) and got[0]["ids"] == "k"
    assert P.find(no_docs).count() == 0
    again = P.find(odd_docs.withColumnRenamed("key", "spans"))
    assert again.columns.count("spans") == 1


def test_masked(spark):
    docs = spark.createDataFrame([(1, "mail a.b@c.de or +1 (555) 010-9999 now"), (2, None), (3, "nothing")], "doc_id long, text string")
    assert [r["text"] for r in P.masked(docs).orderBy("doc_id").collect()] == ["mail [email] or [phone] now", None, "nothing"]


def test_query_equals_the_patterns(spark, tiny):
    import hashlib
    from collections import Counter

    from tessera.llm import catalog
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    rows = catalog.QUERIES["op13_anchor_expansion"](spark, tiny).collect()
    assert len(rows) == len(text)
    for r in rows:
        found = plain(text[r["doc_id"]])
        n = Counter(k for k, _, _ in found)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        assert tuple(r[f"n_{k}"] for k in P.BASE) == tuple(n[k] for k in P.BASE)
        assert r["spans"] == listed and r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
