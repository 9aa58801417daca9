"""Table cells and links out of HTML text held in a column.

Parsing runs inside ``mapInPandas`` with the standard library's
``html.parser``, one page at a time, so pages are spread over all tasks and
no page passes through the driver. Choosing the table and the cells is then
ordinary DataFrame work (windows over a page), not Python.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELL_SCHEMA = ("page long, table_idx int, row_idx int, cell_idx int, is_data boolean, "
               "text string, has_link boolean, table_class string, header_text string")
LINK_SCHEMA = "page long, link_idx int, href string, text string"


class _TableParser(HTMLParser):
    """Collects (table, row, cell) records; cell text is the concatenation of
    its stripped text fragments. Rows of a nested table belong to the inner table."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out = []
        self.stack = []          # open tables: [table_idx, row_idx, cell_idx, class]
        self.n_tables = 0
        self.cell = None         # [is_data, fragments, has_link]

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            cls = dict(attrs).get("class") or ""
            self.stack.append([self.n_tables, -1, -1, cls])
            self.n_tables += 1
        elif not self.stack:
            return
        elif tag == "tr":
            self._close_cell()
            self.stack[-1][1] += 1
            self.stack[-1][2] = -1
        elif tag in ("td", "th"):
            self._close_cell()
            if self.stack[-1][1] < 0:      # cell before any <tr>: implicit row
                self.stack[-1][1] = 0
            self.stack[-1][2] += 1
            self.cell = [tag == "td", [], False]
        elif tag == "a" and self.cell is not None:
            self.cell[2] = True

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr"):
            self._close_cell()
        elif tag == "table" and self.stack:
            self._close_cell()
            self.stack.pop()

    def handle_data(self, data):
        if self.cell is not None:
            piece = data.strip()
            if piece:
                self.cell[1].append(piece)

    def _close_cell(self):
        if self.cell is not None and self.stack:
            t, r, c, cls = self.stack[-1]
            self.out.append((t, r, c, self.cell[0], "".join(self.cell[1]), self.cell[2], cls))
        self.cell = None


class _LinkParser(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.links = []
        self.open = None

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.open = [dict(attrs).get("href"), []]

    def handle_data(self, data):
        if self.open is not None:
            self.open[1].append(data)

    def handle_endtag(self, tag):
        if tag == "a" and self.open is not None:
            self.links.append((self.open[0], "".join(self.open[1]).strip()))
            self.open = None


def _with_ids(rows, cols):
    """Rows as a frame; page ids come as text, so that a null among them does not
    turn the others into doubles, and stay null where they were."""
    out = pd.DataFrame(rows, columns=cols)
    out["page"] = pd.array([None if r[0] is None else int(r[0]) for r in rows], dtype="Int64")
    return out


def _cells(batches, id_col, html_col):
    cols = ["page", "table_idx", "row_idx", "cell_idx", "is_data", "text", "has_link", "table_class", "header_text"]
    for pdf in batches:
        rows = []
        for pid, doc in zip(pdf[id_col], pdf[html_col]):
            if doc is None:
                continue
            p = _TableParser()
            p.feed(doc)
            p.close()
            p._close_cell()
            head = {}
            for t, r, _, _, text, _, _ in p.out:
                if r == 0:
                    head[t] = head.get(t, "") + text
            rows.extend((pid, *r, head.get(r[0])) for r in p.out)
        yield _with_ids(rows, cols)


def extract_html_tables(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """Every table cell of every page: (page, table_idx, row_idx, cell_idx,
    is_data, text, has_link, table_class, header_text); ``header_text`` is the
    text of the table's first row. One parse per page: what follows are
    windows over the cells of a page."""
    src = df.select(F.col(id_col).cast("long").cast("string").alias(id_col), html_col)
    return src.mapInPandas(lambda it: _cells(it, id_col, html_col), CELL_SCHEMA)


def pick_table(cells: DataFrame, header_words, table_class: str | None = None) -> DataFrame:
    """Per page keep the first table whose first row's text holds every word.

    ``table_class`` keeps only tables whose class attribute lists that class.
    """
    ok = F.col("header_text").isNotNull()
    if table_class:
        ok = ok & F.array_contains(F.split(F.col("table_class"), r"\s+"), table_class)
    for w in header_words:
        ok = ok & F.col("header_text").contains(w)
    first = F.min("table_idx").over(Window.partitionBy("page"))
    return cells.filter(ok).withColumn("_first", first).filter(F.col("table_idx") == F.col("_first")).drop("_first")


def link_value_pairs(cells: DataFrame, min_cells: int = 3) -> DataFrame:
    """Per data row with at least ``min_cells`` data cells: the first cell holding
    a link (``name``) and the cell after it (``value_text``)."""
    row = Window.partitionBy("page", "table_idx", "row_idx")
    order = row.orderBy("cell_idx")
    data = cells.filter(F.col("is_data")).withColumns({
        "_n": F.count(F.lit(1)).over(row), "_link": F.min(F.when(F.col("has_link"), F.col("cell_idx"))).over(row),
        "_next_idx": F.lead("cell_idx").over(order), "value_text": F.lead("text").over(order)})
    # a row without a cell after the link cell is dropped
    hit = data.filter((F.col("_n") >= min_cells) & (F.col("cell_idx") == F.col("_link")) & (F.col("_next_idx") == F.col("cell_idx") + 1))
    return hit.select("page", "table_idx", "row_idx", F.col("text").alias("name"), "value_text")


def _links(batches, id_col, html_col):
    for pdf in batches:
        rows = []
        for pid, doc in zip(pdf[id_col], pdf[html_col]):
            if doc is None:
                continue
            p = _LinkParser()
            p.feed(doc)
            p.close()
            rows.extend((pid, i, h, t) for i, (h, t) in enumerate(p.links))
        yield _with_ids(rows, ["page", "link_idx", "href", "text"])


def extract_links(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """Every ``<a>`` of every page: (page, link_idx, href, text)."""
    src = df.select(F.col(id_col).cast("long").cast("string").alias(id_col), html_col)
    return src.mapInPandas(lambda it: _links(it, id_col, html_col), LINK_SCHEMA)
