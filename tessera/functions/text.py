"""Token patterns, word lists and text helpers."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's ``\w`` is Unicode letters, digits (incl. other numbers like '½') and
# '_'; Java's is ASCII only, so the class is spelled with Unicode properties.
WORD_CHARS = r"\p{L}\p{N}_"
# word count accepts both apostrophes; sentiment accepts only the ASCII one
WORDCOUNT_TOKEN = r"[" + WORD_CHARS + r"'’]+"
SENTIMENT_TOKEN = r"[" + WORD_CHARS + r"']+"

# ---- FIXED VALUES (must equal the reference's keyword sentiment lists) ----
POSITIVE_WORDS = [
    "good", "great", "awesome", "amazing", "excellent", "fantastic",
    "wonderful", "love", "loved", "loving", "happy", "glad", "excited",
    "best", "beautiful", "nice", "fun", "cool", "perfect", "thanks",
    "thank", "grateful", "yay", "lol", "haha", "smile", "smiling",
    "enjoy", "enjoyed", "enjoying", "sweet", "cute", "proud", "win",
    "winning", "success", "brilliant", "fabulous", "delighted", "blessed",
]
NEGATIVE_WORDS = [
    "bad", "sad", "hate", "hated", "hating", "angry", "mad", "upset",
    "sorry", "sick", "tired", "hurt", "cry", "crying", "annoying",
    "annoyed", "terrible", "horrible", "awful", "worst", "sucks",
    "ugh", "boring", "bored", "stupid", "worried", "worry", "pain",
    "broken", "miss", "missing", "lonely", "depressed", "fail",
    "failed", "disappointed", "disappointing", "hurts", "damn", "ugly",
]
# extra stop words added on top of the general English list
EXTRA_STOP_WORDS = ["lol", "think", "im", "today"]
# ---- end of fixed values ----


def tokens(text, pattern: str = WORDCOUNT_TOKEN) -> Column:
    """L1: lower-cased regex tokens as array<string>."""
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(t), F.lit("(" + pattern + ")"), 1)


def explode_words(df, arr: Column, name: str = "word", keep=()):
    """One row per array element. ``explode_outer`` + a null filter after the
    generator: a plain ``explode`` makes the optimizer infer ``size(arr) > 0``
    and push it below the projection, evaluating the whole text pipeline twice."""
    return (df.select(*keep, F.explode_outer(arr).alias(name))
              .filter(F.col(name).isNotNull()))


def count_members(arr: Column, words) -> Column:
    """How many elements of ``arr`` are in ``words`` (duplicates count)."""
    lit = F.array(*[F.lit(w) for w in words])
    return F.size(F.filter(arr, lambda x: F.array_contains(lit, x))).cast("long")


# a reference after its '&': decimal, hexadecimal, or a name of up to 32 characters
_REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_TOO_LARGE = 0x110000


def _map_of(values: dict[str, str]) -> Column:
    """A map value of the plan (folded from its JSON text)."""
    return F.from_json(F.lit(json.dumps(values)), "map<string,string>")


def _numbered() -> dict[str, str]:
    """Numbers that stand for other characters than their own: zero, carriage
    return, and the bytes of the Windows code page 1252."""
    windows = {str(n): bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xa0)}
    return {"0": "\ufffd", str(0x0d): "\r", **windows}


def _character(n: Column) -> Column:
    """The text of a numeric reference, as HTML 5 reads it."""
    nothing = (n.between(0x1, 0x8) | n.between(0xb, 0xb) | n.between(0xe, 0x1f) | n.between(0x7f, 0x9f)
               | n.between(0xfdd0, 0xfdef) | (n.bitwiseAND(0xfffe) == 0xfffe))
    return (F.coalesce(F.element_at(_map_of(_numbered()), n.cast("string")),
                       F.when(n.between(0xd800, 0xdfff) | (n >= _TOO_LARGE), "\ufffd").when(nothing, "")
                        .otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))))


def _resolve(ref: Column, rest: Column) -> Column:
    """The text of a reference and of what follows it, up to the next '&'."""
    decimal, hexadecimal = F.regexp_extract(ref, "^#0*([0-9]+)", 1), F.regexp_extract(ref, "^#[xX]0*([0-9a-fA-F]+)", 1)
    number = (F.when(F.length(hexadecimal) > 6, _TOO_LARGE).when(F.length(decimal) > 7, _TOO_LARGE)
              .when(ref.rlike("^#[xX]"), F.conv(hexadecimal, 16, 10).cast("long")).otherwise(decimal.cast("long")))
    bare = {k: v for k, v in html5.items() if not k.endswith(";")}
    known = _map_of(html5)
    tries = [F.element_at(known, ref)]
    # the longest name without a semicolon that the text begins with
    for n in range(max(map(len, bare)), 1, -1):
        tries.append(F.when(F.length(ref) > n, F.concat(F.element_at(_map_of(bare), F.substring(ref, 1, n)), F.substr(ref, F.lit(n + 1)))))
    named = F.coalesce(*tries, F.concat(F.lit("&"), ref))
    return F.concat(F.when(ref == "", F.lit("&")).when(ref.startswith("#"), _character(number)).otherwise(named), rest)


def html_unescape(text) -> Column:
    """Character references to characters, as HTML 5 reads them (names with and
    without semicolon, longest prefix, numbers and their exceptions), with built-in
    functions only. The text is cut at '&'; each piece begins with at most one
    reference. Texts without '&' are left alone."""
    t = F.col(text) if isinstance(text, str) else text
    parts = F.split(t, "&")
    refs = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: F.struct(F.regexp_extract(x, _REFERENCE, 1).alias("r"), x.alias("x")))
    texts = F.transform(refs, lambda x: _resolve(x["r"], F.substr(x["x"], F.length(x["r"]) + 1)))
    return F.when(t.contains("&"), F.concat(parts[0], F.array_join(texts, ""))).otherwise(t)


# Python's Unicode whitespace, spelled out so every regex engine agrees on it
WHITESPACE = r"\t\n\x0B\f\r\x1C-\x1F\x{85}\p{Z}"


def letters_only_words(text: Column, without: Column | None = None) -> Column:
    """L2 core: lower, keep ASCII letters and whitespace, split on whitespace runs;
    ``without`` (words joined by ``,``, with a comma before the first) are left out.
    Each word is looked up in that text by its bytes, not by an alternation of the
    regular expression."""
    kept = F.regexp_replace(F.lower(text), "[^a-zA-Z" + WHITESPACE + "]+", "")
    # what is left is letters and whitespace: the words are the letter runs
    if without is None:
        return F.regexp_extract_all(kept, F.lit("([a-zA-Z]+)"), 1)
    # the comma at the front lists the empty word, which a split leaves at the ends
    return F.filter(F.split(kept, "[" + WHITESPACE + "]+"), lambda w: F.call_function("find_in_set", w, without) == 0)
