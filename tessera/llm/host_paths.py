"""Main text of web pages by consensus paths of a host (operator 9).

Per page, every container (article, main, section, div, ...) has a generalised
path: the tags from the body down, each with its classes, digits replaced.
``extract(df)`` scores the paths of each page by the share of the page's
non-boilerplate, non-link text below them. Each page votes for its deepest path
whose share comes within ``NEAR`` of its best; the root is no candidate while
any container holds ``LEAST`` of the text. A host has one winning path per
template: every path with ``VOTES`` votes or more, and ``FEW`` of all votes of
the host. Each page is read again around the winning path with most votes among
those that hold ``LEAST`` of its text. A page without one (rare host, rare
template, only the root won), or where more than ``MUCH`` of the non-link text
would be left out, uses the rule on its own paths.

The path finds the article; everything below it is read. What lies elsewhere on
the page (title, lead, a second body; side boxes, bylines, adverts) is decided by
the host's second vote, on every path that ``VOTES`` pages or more, and ``FEW`` of
the host's, hold text at. A page votes for a path as part of the article when most
of the non-link text right there reads like one: it stands in paragraphs, headings,
lists, quotations or preformatted text, ends as a sentence, lies in a container
named as a part of an article, or has ``WORDS`` words or more. A path is read if
more than half of its pages say so *and* its text varies between pages: it does not
where each text comes ``SAME`` times or more on average, compared with the winning
path of the host (so hosts whose pages are copied keep their text). One page's
reading is thus overruled by the host's, both ways: a byline that ends in a full
stop on some pages stays out, a short label-like lead of a path that is prose
elsewhere stays in. Only paths without a vote (rare ones, hosts of one page) are
judged by the page's own reading. Link lists outside the path are never read.

Only votes and text digests are shuffled, pre-aggregated per task and counted first
by digest; a host's paths are few however many pages it has. Winners (one row per host; ``FEW`` bounds its
lists) are joined by host; Spark decides on a broadcast by size, and splits a hot
host's pages otherwise.

Text: character references decoded, white space inside a block made one space,
blocks trimmed and joined by one space in page order. Menus, page headers,
footers, asides, forms, adverts, notices, comments, scripts, styles and hidden
parts are left out by tag, role or class word; a header inside the article
keeps its headings; inside an article, class words that also head chapters count
only as whole names. Unclosed and misnested tags are tolerated; a page may end
anywhere.

Defined results: null or empty html: empty text; null or odd url: the host is
empty and votes with its like; pages without text vote for nothing; repeated
rows are separate pages; extra columns are ignored; no rows: no rows.
"""

from __future__ import annotations

import hashlib
import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import written

NEAR = 0.9
LEAST = 0.3
MUCH = 0.6
WORDS = 20
VOTES = 2
SAME = 3
FEW = 0.02

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[a-z]+")
_HEADING = re.compile(r"h[1-6]\Z")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
_CONTAINER = frozenset("body article main section div center td".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp small "
                    "span strike strong sub sup time tt u var wbr".split())
_ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                    "h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}, "p": {"p"}}
_LISTS = frozenset("ul ol menu dl table select body".split())
_SKIP_TAG = frozenset("nav footer aside form script style noscript template iframe button select textarea svg canvas object dialog menu head "
                      "title audio video map".split())
_SKIP_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_SKIP_WORD = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion banner sidebar sidebars aside "
    "widget widgets nav navbar navigation menu menus breadcrumb breadcrumbs masthead topbar toolbar footer comment comments disqus reply "
    "replies respond share sharing social related recommended recommendations cookie cookies consent gdpr notice notices popup modal overlay "
    "newsletter subscribe subscription signup login register pagination pager form".split())
#: Skip words that also head chapters ("social-history", "form-of-government"): inside an article only as a whole name.
_CHAPTER_WORD = frozenset("social form notice notices reply promotion subscription register menu menus respond".split())
_PROSE_TAG = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt blockquote pre article main".split())
_PROSE_WORD = frozenset("title headline heading subtitle subtitles intro introduction lead lede standfirst summary abstract teaser content article "
                        "post entry story text body more part section chapter conclusion caption".split())
_SENTENCE = re.compile(r"[.!?\u2026\u3002\uff01\uff1f\u0964\u061f][\"'\u201d\u2019\u00bb)\]]*\Z")


class Page:
    """Blocks of a page: ``blocks`` (node, text, share of non-link text, marked
    as prose) and ``nodes`` (parent, generalised path)."""

    def __init__(self, html: str):
        self.nodes: list[tuple[int, str]] = [(-1, "")]
        self.blocks: list[tuple[int, str, float, bool]] = []
        self._stack: list[tuple[str, int, bool, bool, bool]] = []  # tag, node, skipped, in a header, named as prose
        self._text: list[str] = []
        self._links = self._length = 0
        self._read(html)

    def _top(self) -> tuple[str, int, bool, bool, bool]:
        return self._stack[-1] if self._stack else ("", 0, False, False, False)

    def _flush(self) -> None:
        if self._text:
            words = unescape("".join(self._text)).split()
            if words:
                free = 1 - self._links / self._length if self._length else 1.0
                nearest = next((t[4] for t in reversed(self._stack) if t[0] in _CONTAINER), False)
                prose = nearest or any(t[0] in _PROSE_TAG for t in self._stack) or _SENTENCE.search(words[-1]) is not None
                self.blocks.append((self._top()[1], " ".join(words), free, prose))
            self._text = []
        self._links = self._length = 0

    def _add(self, text: str) -> None:
        if not text:
            return
        _, _, skipped, header, _ = self._top()
        if skipped or header and not any(_HEADING.match(t[0]) for t in self._stack):
            return
        self._text.append(text)
        n = len(text.strip())
        self._length += n
        if any(t[0] == "a" for t in self._stack):
            self._links += n

    def _pop_to(self, at: int) -> None:
        if any(t[0] not in _INLINE for t in self._stack[at:]):
            self._flush()
        del self._stack[at:]

    def _open(self, tag: str, attributes: str) -> None:
        if tag in _ENDS_P:
            for i in range(len(self._stack) - 1, -1, -1):
                if self._stack[i][0] == "p":
                    self._pop_to(i)
                    break
                if self._stack[i][0] in _CONTAINER:
                    break
        if tag in _SIBLINGS and tag != "p":
            for i in range(len(self._stack) - 1, -1, -1):
                if self._stack[i][0] in _SIBLINGS[tag]:
                    self._pop_to(i)
                    if tag != "tr" or not self._stack or self._stack[-1][0] != "tr":
                        break
                elif self._stack[i][0] in _LISTS or self._stack[i][0] == "tr" and tag != "tr":
                    break
        if tag not in _INLINE:
            self._flush()
        if tag in _VOID:
            return
        _, node, skipped, header, _ = self._top()
        classes: list[str] = []
        prose = False
        if not skipped:
            skipped = tag in _SKIP_TAG
            if attributes.strip():
                for m in _ATTRIBUTE.finditer(attributes):
                    name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
                    if name == "class":
                        classes = value.split()
                    if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
                        skipped = True
                    elif name == "role":
                        skipped = skipped or value in _SKIP_ROLE
                    if name in ("class", "id") and tag != "body":
                        prose = prose or not _PROSE_WORD.isdisjoint(_WORD.findall(value))
                    if name in ("class", "id") and tag not in ("body", "html", "article", "main"):
                        found = _SKIP_WORD.intersection(_WORD.findall(value))
                        if found and any(t[0] in ("article", "main") for t in self._stack):
                            found -= _CHAPTER_WORD.difference(value.split())
                        skipped = skipped or bool(found)
        if tag == "header":
            header = True
            skipped = skipped or not any(t[0] in ("article", "main") for t in self._stack)
        if tag in _CONTAINER and tag != "body" and not skipped:
            parent = self.nodes[node][1]
            if not any(t[0] in ("article", "main") for t in self._stack):  # an article is read as a whole
                step = ".".join([tag, *sorted(set(re.sub(r"\d+", "#", c) for c in classes))])
                self.nodes.append((node, f"{parent}>{step}" if parent else step))
                node = len(self.nodes) - 1
        self._stack.append((tag, node, skipped, header, prose))

    def _close(self, tag: str) -> None:
        for i in range(len(self._stack) - 1, -1, -1):
            if self._stack[i][0] == tag:
                self._pop_to(i)
                return
            if tag in _INLINE and self._stack[i][0] not in _INLINE:
                return
            if tag == "p" and self._stack[i][0] in _CONTAINER:
                return

    def _read(self, html: str) -> None:
        at, end = 0, len(html)
        while at < end:
            m = _TAG.search(html, at)
            if m is None:
                self._add(html[at:])
                break
            self._add(html[at:m.start()])
            at = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:
                self._close(tag)
            elif tag in _RAW:
                closing = re.compile(f"</{re.escape(tag)}[^>]*>", re.I | re.A).search(html, at)
                at = closing.end() if closing else end
            else:
                self._open(tag, m[3])
        self._stack.clear()
        self._flush()

    def shares(self) -> dict[str, float]:
        """Share of the page's non-link text below each path."""
        out: dict[str, float] = {}
        total = 0.0
        for node, text, free, _ in self.blocks:
            weight = len(text) * free
            total += weight
            seen = set()
            while node >= 0:
                parent, path = self.nodes[node]
                if path not in seen:
                    seen.add(path)
                    out[path] = out.get(path, 0.0) + weight
                node = parent
        return {p: w / total for p, w in out.items()} if total > 0 else {}

    def digests(self) -> dict[str, int]:
        """Digest of the text below each path."""
        texts: dict[str, list[str]] = {}
        for node, text, _, _ in self.blocks:
            seen = set()
            while node >= 0:
                node, path = self.nodes[node]
                if path not in seen:
                    seen.add(path)
                    texts.setdefault(path, []).append(text)
        return {p: int.from_bytes(hashlib.blake2b("\n".join(t).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True) for p, t in texts.items()}

    def _reads(self) -> list[bool]:
        """Per block: reads like a part of an article."""
        bare: dict[str, int] = {}
        for node, text, free, prose in self.blocks:
            if not prose and free >= 0.5:
                own = self.nodes[node][1]
                bare[own] = bare.get(own, 0) + text.count(" ") + 1
        return [free >= 0.5 and (prose or bare[self.nodes[node][1]] >= WORDS) for node, _, free, prose in self.blocks]

    def parts(self) -> dict[str, bool]:
        """Whether most of the non-link text right at each path reads like a part
        of an article (paths with links alone: no entry)."""
        weights: dict[str, list[float]] = {}
        for (node, text, free, _), reads in zip(self.blocks, self._reads()):
            if free >= 0.5:
                weights.setdefault(self.nodes[node][1], [0.0, 0.0])[reads] += len(text) * free
        return {p: yes > no for p, (no, yes) in weights.items()}

    def _kept(self, path: str, votes: dict[str, bool] | None = None) -> list[bool]:
        """Per block: below ``path``, or part of the article elsewhere. ``votes``
        has the host's word on a path; without one the page's own reading counts."""
        votes = votes or {}
        inside: list[bool] = []
        for parent, own in self.nodes:  # parents come first
            inside.append(own == path or parent >= 0 and inside[parent])
        return [inside[node] or free >= 0.5 and votes.get(self.nodes[node][1], reads)
                for (node, _, free, _), reads in zip(self.blocks, self._reads())]

    def text(self, path: str, votes: dict[str, bool] | None = None) -> str:
        return " ".join(b[1] for b, kept in zip(self.blocks, self._kept(path, votes)) if kept)

    def left_out(self, path: str, votes: dict[str, bool] | None = None) -> float:
        """Share of the page's non-link text that ``text`` leaves out."""
        weights = [len(text) * free for _, text, free, _ in self.blocks]
        total = sum(weights)
        return sum(w for w, kept in zip(weights, self._kept(path, votes)) if not kept) / total if total > 0 else 0.0


def best_path(shares: dict[str, float]) -> str:
    """The deepest path within ``NEAR`` of the largest share."""
    if not shares:
        return ""
    top = max(shares.values())
    return max((p for p, s in shares.items() if s >= NEAR * top), key=lambda p: (p.count(">") + (p != ""), shares[p], p))


def vote(shares: dict[str, float]) -> str:
    """The path a page votes for: the root only if no container holds ``LEAST``."""
    below = {p: s for p, s in shares.items() if p}
    return best_path(below) if max(below.values(), default=0.0) >= LEAST else ""


_VOTES = pa.schema([("host", pa.string()), ("path", pa.string()), ("vote", pa.int64()), ("part", pa.int64()), ("seen", pa.int64()), ("digest", pa.int64())])


def _votes(batches):
    for batch in batches:
        out = []
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            page = Page(html or "")
            shares = page.shares()
            chosen = vote(shares) if shares else None
            parts = page.parts()
            out += [(host, p, int(p == chosen), int(parts.get(p, False)), int(p in parts), d) for p, d in page.digests().items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [()] * len(_VOTES), _VOTES)], schema=_VOTES)


def _texts(batches):
    for batch in batches:
        out, used = [], []
        for html, paths, read, unread in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5))):
            page = Page(html or "")
            shares = page.shares()
            own = best_path(shares)
            path = next((p for p in paths or () if shares.get(p, 0.0) >= LEAST), own)
            votes = {**dict.fromkeys(read or (), True), **dict.fromkeys(unread or (), False)}
            path, votes = next(((p, v) for p, v in ((path, votes), (own, votes)) if page.left_out(p, v) <= MUCH), (own, None))
            out.append(page.text(path, votes))
            used.append(path)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array(used, pa.string())],
                                         names=["page_id", "url", "text", "path"])


def host_of(url):
    """Column: lower-case host of a url; empty if it has none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def winners(pages: DataFrame) -> DataFrame:
    """``host, paths, read, unread`` from ``host, html``: each host's winning
    paths, most votes first, and its word on the paths it voted on."""
    votes = pages.select("host", "html").mapInArrow(_votes, "host string, path string, vote long, part long, seen long, digest long")
    votes = (votes.groupBy("host", "path", "digest")
             .agg(F.sum("vote").alias("votes"), F.sum("part").alias("part"), F.sum("seen").alias("seen"), F.count("*").alias("pages"))
             .groupBy("host", "path")
             .agg(*[F.sum(c).alias(c) for c in ("votes", "part", "seen", "pages")], F.count("*").alias("texts")))
    votes = written(votes, "host-votes")
    enough = F.greatest(F.lit(VOTES), F.col("all") * FEW)
    wins = (F.col("path") != "") & (F.col("votes") >= enough)
    every = votes.groupBy("host").agg(F.sum("votes").alias("all"))
    votes = votes.join(every, "host").withColumn("wins", wins)
    varied = votes.where("wins").groupBy("host").agg(F.min(F.col("texts") / F.col("pages")).alias("varied"))
    votes = votes.join(varied, "host")
    repeats = (F.col("path") != "") & (F.col("pages") >= F.greatest(F.lit(SAME), enough)) & (F.col("texts") * SAME <= F.col("pages") * F.col("varied"))
    unread = (repeats | (F.col("seen") >= enough) & (F.col("part") * 2 <= F.col("seen"))) & ~F.col("wins")
    read = ~repeats & (F.col("seen") >= enough) & (F.col("part") * 2 > F.col("seen"))
    rank = F.struct((-F.col("votes")).alias("votes"), (-F.size(F.split("path", ">"))).alias("depth"), "path")
    paths = [F.sort_array(F.collect_list(F.when(which, F.col("path")))).alias(name) for name, which in (("read", read), ("unread", unread))]
    return (votes.where(F.col("wins") | read | unread).groupBy("host")
            .agg(F.sort_array(F.collect_list(F.when(F.col("wins"), rank)))["path"].alias("paths"), *paths))


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, path`` (see the module text)."""
    pages = df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"),
                      host_of(F.col(url_col)).alias("host"))
    won = written(winners(pages), "host-paths")
    schema = f"page_id {df.schema[id_col].dataType.simpleString()}, url string, text string, path string"
    return (pages.join(won, "host", "left").select("page_id", F.col("url").cast("string"), "html", "paths", "read", "unread").mapInArrow(_texts, schema))
