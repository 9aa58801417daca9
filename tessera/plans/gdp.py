"""GDP extract-transform-load - table rows out of HTML pages, cleaned,
enriched with a region, thresholded, and averaged over the top N per region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.aggregates import topn_avg
from tessera.operators.filters import drop_sentinel, threshold
from tessera.operators.joins import lookup
from tessera.sources.files import parse_number
from tessera.sources.html import extract_html_tables, link_value_pairs, pick_table

HEADER_WORDS = ["Country", "IMF"]
SENTINELS = ["World"]


def extract_gdp(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                table_class: str | None = "wikitable") -> DataFrame:
    """(Country, GDP_USD_millions) from the first matching table of each page:
    first linked cell and the cell after it; 'World' and unparsable values dropped."""
    cells = extract_html_tables(pages, id_col, html_col)
    rows = link_value_pairs(pick_table(cells, HEADER_WORDS, table_class))
    rows = drop_sentinel(rows, "name", SENTINELS)
    cleaned = F.trim(F.regexp_replace(F.col("value_text"), "[,—]", ""))
    out = rows.select(F.col("name").alias("Country"), parse_number(cleaned).alias("GDP_USD_millions"))
    return out.filter(F.col("GDP_USD_millions").isNotNull())


def transform_gdp(raw: DataFrame, regions: DataFrame) -> DataFrame:
    """Region by country (lookup join, unmatched kept as 'not found'), billions
    with 2 decimals, sorted by GDP descending."""
    out = lookup(raw, regions, "Country", {"Region": "not found"})
    return (out.select("Country", "Region", F.round(F.col("GDP_USD_millions") / 1000, 2).alias("GDP_USD_billion"))
            .orderBy(F.col("GDP_USD_billion").desc()))


def gdp_above(gdp: DataFrame, billions: float = 100) -> DataFrame:
    """Countries at or above the threshold, largest first."""
    return threshold(gdp, "GDP_USD_billion", billions)


def region_topn_avg(gdp: DataFrame, n: int = 5, ties: str = "row") -> DataFrame:
    """Average GDP of the top n countries per region, 2 decimals.
    ``ties='row'`` takes exactly n (by country name on ties); ``'rank'`` keeps ties."""
    out = topn_avg(gdp, "Region", "GDP_USD_billion", n, ties, tie_break="Country" if ties == "row" else None,
                   name="avg_gdp_billion")
    return out.withColumn("avg_gdp_billion", F.round("avg_gdp_billion", 2))


def render_gdp_pages(nation: DataFrame) -> DataFrame:
    """Test pages rendered from table rows by expression, one page per row: a
    decoy table first (header without 'IMF'), then the GDP table with a header
    row, a 'World' total row, a short row, and the country row (linked name,
    value with thousands separators; key 13 gets the missing-value dash)."""
    name = F.col("n_name")
    gdp = (F.col("n_nationkey") + 1) * 1234567
    value = F.when(F.col("n_nationkey") == 13, F.lit("—")).otherwise(F.format_number(gdp.cast("double"), 0))
    html = F.concat(
        F.lit('<html><body><table class="wikitable"><tr><th>Country</th><th>Year</th></tr>'
              '<tr><td>1</td><td><a href="/x">Decoy</a></td><td>9</td></tr></table>'
              '<table class="wikitable sortable"><tr><th>Rank</th><th>Country/Territory</th><th>IMF</th>'
              '<th>WB</th></tr><tr><td>0</td><td><a href="/wiki/World">World</a></td><td>105,000,000</td>'
              '<td>1</td></tr><tr><td>short</td><td>row</td></tr><tr><td>'),
        F.col("n_nationkey").cast("string"), F.lit('</td><td><a href="/wiki/'), name, F.lit('">'), name,
        F.lit("</a></td><td> "), value, F.lit(" </td><td>0</td></tr></table></body></html>"))
    return nation.select(F.col("n_nationkey").cast("long").alias("page_id"), html.alias("html"))
