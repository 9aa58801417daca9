"""HTML sources (A12) and the GDP job."""

from pyspark.sql import functions as F

from tessera.catalog import load, query
from tessera.plans import gdp as P
from tessera.sources.html import extract_links

GDP_SQL = """
  SELECT n_name AS Country, r_name AS Region, round((n_nationkey + 1) * 1234567 / 1000, 2) AS GDP_USD_billion
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 13"""


def gdp(spark, sf):
    nation, region = load(spark, sf, "nation"), load(spark, sf, "region")
    regions = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("Country"), F.col("r_name").alias("Region"))
    return P.transform_gdp(P.extract_gdp(P.render_gdp_pages(nation)), regions)


@query("html_tables", GDP_SQL)
def q_html_tables(spark, sf):
    return gdp(spark, sf)


@query("gdp_threshold", f"SELECT * FROM ({GDP_SQL}) g WHERE GDP_USD_billion >= 20000 ORDER BY GDP_USD_billion DESC")
def q_gdp_threshold(spark, sf):
    return P.gdp_above(gdp(spark, sf), 20000)


@query("gdp_topn", f"""
  SELECT Region, round(avg(GDP_USD_billion), 2) AS avg_gdp_billion FROM (
    SELECT *, row_number() OVER (PARTITION BY Region ORDER BY GDP_USD_billion DESC, Country) AS r
    FROM ({GDP_SQL}) g) x WHERE r <= 3 GROUP BY Region""")
def q_gdp_topn(spark, sf):
    return P.region_topn_avg(gdp(spark, sf), 3, "row")


@query("gdp_topn_rank", f"""
  SELECT Region, round(avg(GDP_USD_billion), 2) AS avg_gdp_billion FROM (
    SELECT *, rank() OVER (PARTITION BY Region ORDER BY GDP_USD_billion DESC) AS r
    FROM ({GDP_SQL}) g) x WHERE r <= 3 GROUP BY Region""")
def q_gdp_topn_rank(spark, sf):
    return P.region_topn_avg(gdp(spark, sf), 3, "rank")


def _unescape(x):
    return (f"replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), "
            f"'&#39;', ''''), '&amp;', '&')")


@query("page_links", f"""
  SELECT page_id AS page, CAST(i - 1 AS INT) AS link_idx, {_unescape('hrefs[i]')} AS href,
         trim({_unescape('texts[i]')}) AS text
  FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs,
               regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS texts FROM pages) p,
       LATERAL (SELECT unnest(range(1, len(hrefs) + 1)) AS i) r""")
def q_page_links(spark, sf):
    return extract_links(load(spark, sf, "pages"), "page_id", "html")


@query("page_link_domains", """
  SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS host, count(*) AS pages,
         CAST(sum(len(regexp_extract_all(html, '<a href='))) AS BIGINT) AS links
  FROM pages GROUP BY 1""")
def q_page_link_domains(spark, sf):
    p = load(spark, sf, "pages")
    links = extract_links(p, "page_id", "html").groupBy(F.col("page").alias("page_id")).agg(
        F.count(F.lit(1)).alias("n"))
    per = p.select("page_id", F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("host")).join(
        links, "page_id", "left")
    return per.groupBy("host").agg(F.count(F.lit(1)).alias("pages"),
                                   F.coalesce(F.sum("n"), F.lit(0)).alias("links"))
