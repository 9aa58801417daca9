"""Personal data by anchor expansion (operator 13).

One Aho-Corasick pass over a text finds its anchors: at-signs, plus-signs,
digits, scheme marks and identifier cues. From each anchor a local parser reads
to the left and right and checks what it read; nothing else of the text is
looked at again. ``find(df)`` returns per row the spans (kind, start, end; code
points, end exclusive).

Base kinds, each leftmost and non-overlapping within its kind:

* ``email``  local part and dotted domain around an at-sign;
* ``ip``     four runs of digits joined by dots, each at most 255;
* ``card``   digits with single blanks or hyphens between, 16 to 19, Luhn;
* ``phone``  a plus-sign, digits and ``( ) . -`` or blanks, 8 to 15 digits.

A match that fails its check is dropped and not tried again at a shorter length.

Added kinds (they never replace a base span and are validated strictly):

* ``login``    ``user:password`` between a scheme mark and an at-sign;
* ``iban``     after the cue IBAN: two letters, two check digits, 11 to 30 more
  characters in groups by single blanks, remainder 97;
* ``account``  after a cue (account, acct, konto, cuenta, compte, with no., number,
  nr, ``#`` or ``:`` between): 6 to 18 digits, single blanks or hyphens between;
* ``ssn``      after the cue SSN or social security: ddd-dd-dddd, no part zeros only.

All runs are read forwards once per kind (a parser starts behind the end of its
last match), so very long texts cost linear time.

Defined results: null or empty text: no spans; null ids, repeated rows and ties:
each row by itself; other columns stay (those that the new columns would clash
with are replaced); an empty table gives no rows.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import without

BASE = ("email", "ip", "card", "phone")
ADDED = ("login", "iban", "account", "ssn")
KINDS = BASE + ADDED

_DIGITS = frozenset("0123456789")
_ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") | _DIGITS
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")
_GAPS = frozenset(" -")
_CUES = {"iban": ("iban",), "account": ("account", "acct", "konto", "cuenta", "compte"), "ssn": ("ssn", "social security number", "social security")}
_LEAD = re.compile(r"(?:\s{0,3}(?:number|no\.?|nr\.?|num\.?|#|:|=|is)){0,3}\s{0,3}", re.I)
#: Characters between a scheme mark and the at-sign of a login at most.
LOGIN = 256


@lru_cache(1)
def _automaton():
    import ahocorasick
    found = ahocorasick.Automaton()
    for c in _DIGITS:
        found.add_word(c, "digit")
    found.add_word("@", "at")
    found.add_word("+", "plus")
    found.add_word("://", "scheme")
    for kind, words in _CUES.items():
        for word in words:
            for form in {word, word.upper(), word.capitalize(), word.title()}:
                found.add_word(form, kind)
    found.make_automaton()
    return found


def _run(text: str, at: int, kept: frozenset) -> int:
    """The first place from ``at`` whose character is not in ``kept``."""
    n = len(text)
    while at < n and text[at] in kept:
        at += 1
    return at


def _email(text: str, at: int, done: int):
    """Around the at-sign ``at``; the local part starts at ``done`` or later."""
    start = at
    while start > done and text[start - 1] in _LOCAL:
        start -= 1
    end = _run(text, at + 1, _LABEL)
    if start == at or end == at + 1:
        return None
    labels = 0
    while end < len(text) and text[end] == ".":
        to = _run(text, end + 1, _LABEL)
        if to == end + 1:
            break
        end, labels = to, labels + 1
    return (start, end) if labels else None


def _addresses(text: str, at: int):
    """Dotted runs of digits from ``at``: (matches of four runs, end of the chain)."""
    runs = []
    end = at
    while True:
        to = _run(text, end, _DIGITS)
        runs.append((end, to))
        if to + 1 < len(text) and text[to] == "." and text[to + 1] in _DIGITS:
            end = to + 1
        else:
            break
    out = []
    for i in range(0, len(runs) - 3, 4):
        four = runs[i:i + 4]
        if all(len(p := text[a:b].lstrip("0")) <= 3 and int(p or "0") <= 255 for a, b in four):
            out.append((four[0][0], four[3][1]))
    return out, runs[-1][1]


def _chain(text: str, at: int) -> int:
    """End of the digits from ``at`` with single blanks or hyphens between."""
    n = len(text)
    end = _run(text, at, _DIGITS)
    while end + 1 < n and text[end] in _GAPS and text[end + 1] in _DIGITS:
        end = _run(text, end + 1, _DIGITS)
    return end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if c in _DIGITS)


def _phone(text: str, at: int):
    """From the plus-sign ``at``: (end of the match or None)."""
    if at + 1 >= len(text) or text[at + 1] not in _DIGITS:
        return None
    end = _run(text, at + 2, _PHONE)
    while end > at + 2 and text[end - 1] not in _DIGITS:
        end -= 1
    return end if end >= at + 4 else None


def _login(text: str, at: int):
    """``user:password`` from ``at`` (behind the scheme mark) to an at-sign."""
    colon = 0
    for i in range(at, min(len(text), at + LOGIN)):
        c = text[i]
        if c == "@":
            return (at, i) if colon > at and i > colon + 1 else None
        if c == ":" and not colon:
            colon = i
        elif c in "/?#" or c.isspace():
            return None
    return None


def _iban(text: str, at: int):
    m = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])").match(text, at)
    if not m:
        return None
    plain = m[0].replace(" ", "")
    return m.span() if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1 else None


def _account(text: str, at: int):
    if at >= len(text) or text[at] not in _DIGITS:
        return None
    end = _chain(text, at)
    return (at, end) if 6 <= len(_only_digits(text[at:end])) <= 18 and (end == len(text) or text[end] not in _ALNUM) else None


def _ssn(text: str, at: int):
    m = re.compile(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])").match(text, at)
    return m.span() if m else None


_AFTER_CUE = {"iban": _iban, "account": _account, "ssn": _ssn}


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a text, by kind (``KINDS``), then start."""
    if not text:
        return []
    out: dict[str, list] = {k: [] for k in KINDS}
    done = dict.fromkeys(KINDS, 0)
    dotted = 0
    for last, anchor in _automaton().iter(text):
        if anchor == "digit":
            if last >= done["card"]:
                done["card"] = end = _chain(text, last)
                if end - last >= 16:
                    digits = _only_digits(text[last:end])
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        out["card"].append((last, end))
            if last >= dotted:
                found, dotted = _addresses(text, last)
                out["ip"] += found
        elif anchor == "at":
            if (found := _email(text, last, done["email"])):
                out["email"].append(found)
                done["email"] = found[1]
        elif anchor == "plus":
            if last >= done["phone"] and (end := _phone(text, last)):
                done["phone"] = end
                if 8 <= len(_only_digits(text[last:end])) <= 15:
                    out["phone"].append((last, end))
        elif anchor == "scheme":
            if last + 1 >= done["login"] and (found := _login(text, last + 1)):
                out["login"].append(found)
                done["login"] = found[1]
        else:
            at = last + 1
            if at < len(text) and text[at] in _ALNUM:
                continue  # the cue goes on as another word
            at = _LEAD.match(text, at).end()
            if at >= done[anchor] and (found := _AFTER_CUE[anchor](text, at)):
                out[anchor].append(found)
                done[anchor] = found[1]
    return [(k, a, b) for k in KINDS for a, b in out[k]]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _finder(at: int, name: str):
    def run(batches):
        for batch in batches:
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in spans(t.as_py())] for t in batch.column(at)]
            yield batch.append_column(name, pa.array(found, _SPANS))
    return run


def find(df: DataFrame, text_col: str = "text", name: str = "spans") -> DataFrame:
    """``df`` with the array of spans of ``text_col``."""
    df = without(df, [name.lower()], text_col)
    at = df.columns.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{name}` array<struct<kind: string, start: long, end: long>>"
    return df.mapInArrow(_finder(at, name), schema)


def listed(column, kinds=KINDS):
    """Column: ``kind:start:end`` of the spans of these kinds, comma-joined."""
    mine = F.filter(column, lambda s: s["kind"].isin(*kinds))
    return F.concat_ws(",", F.transform(mine, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def count_of(column, kind: str):
    """Column: number of spans of a kind."""
    return F.size(F.filter(column, lambda s: s["kind"] == kind)).cast("long")


def masked(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with every span of ``text_col`` replaced by its kind in brackets.
    Overlapping spans become one, under the kind of the first."""
    names = df.columns
    held = find(df, text_col, name="_pii")
    at = held.columns.index(text_col)

    def run(batches):
        for batch in batches:
            texts = [_masked(t.as_py()) if s else t.as_py() for t, s in zip(batch.column(at), batch.column("_pii").to_pylist())]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type)).select(names)
    return held.mapInArrow(run, df.schema)


def _masked(text: str) -> str:
    out, at, found = [], 0, sorted(spans(text), key=lambda s: (s[1], -s[2]))
    for kind, a, b in found:
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join(out) + text[at:]
