"""Registered queries: what is read out of pages and URLs."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioscan.functions.text import clean_license_text, digits_only, first_match
from folioscan.functions.urls import basename, item_code, trailing_number
from folioscan.operators.detail import detail_rows, map_attributes, to_wide, whole_tables, widen
from folioscan.operators.errors import unknown_attribute_rows
from folioscan.operators.first_writer import license_dimension as first_licenses
from folioscan.operators.links import (
    extract_links,
    frontier_errors,
    last_page as last_pages,
    link_errors,
    max_page as corpus_bound,
)
from folioscan.operators.page_parse import Selectors, parse_pages
from folioscan.plans.registry import query
from folioscan.plans.rendering import (
    CUSTOMER_PAGERS,
    PART_ITEMS,
    customer_author_pages,
    customer_list_pages,
    customer_pagers,
    part_pages,
    table,
)
from folioscan.sources.pages import list_frontier as frontier_of, read_pages, resolve_frontier, spread

# Where the archive's articles keep the fields.
ARTICLE = Selectors(list_container="nav", title="h1", license="footer", detail="article")


def _pages(spark, sf_dir):
    return read_pages(spark, f"{sf_dir}/pages.parquet")


def _archive(spark, sf_dir):
    return spread(_pages(spark, sf_dir))


@query("""
WITH nav AS (SELECT page_id, url, regexp_extract(html, '<nav>(.*?)</nav>', 1, 's') AS html FROM pages),
links AS (SELECT page_id, url, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS hrefs FROM nav),
one AS (SELECT page_id, url, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) AS i FROM links)
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos,
       regexp_extract(url, '^(https?://[^/]+)', 1)
         || replace(replace(href, '&quot;', '"'), '&amp;', '&') AS link
FROM one
""")
def page_links(spark, sf_dir):
    parsed = parse_pages(_archive(spark, sf_dir), ["links"], selectors=ARTICLE)
    host = F.regexp_extract("url", "^(https?://[^/]+)", 1)
    return extract_links(parsed, host).select("page_id", "pos", "link")


@query("""
WITH items AS (SELECT c_custkey, c_nationkey, unnest(range(1, c_custkey % 3 + 2)) AS n FROM customer)
SELECT c_custkey AS page_id, CAST(n - 1 AS INTEGER) AS pos,
       'https://catalogue.example/view.do?menuNo=200023&wrtSn=' || c_custkey || n AS link
FROM items WHERE c_nationkey <> 7
UNION ALL SELECT c_custkey, CAST(c_custkey % 3 + 1 AS INTEGER), NULL FROM customer WHERE c_nationkey = 8
""")
def list_links(spark, sf_dir):
    """The catalogue's own list pages, with the default selectors."""
    parsed = parse_pages(spread(customer_list_pages(spark, sf_dir)), ["links"])
    return extract_links(parsed, "https://catalogue.example").drop("href")


@query("""
SELECT c_custkey AS page_id, 'PAGE_URL_ERROR : '
  || CASE c_nationkey WHEN 7 THEN 'no usable link list' ELSE 'link without address' END
  || '/list.do?p=' || c_custkey AS line
FROM customer WHERE c_nationkey IN (7, 8)
""")
def page_errors(spark, sf_dir):
    return link_errors(parse_pages(spread(customer_list_pages(spark, sf_dir)), ["links"]))


@query("""
SELECT page_id,
       replace(replace(replace(regexp_extract(html, '<h1>(.*?)</h1>', 1, 's'), '&quot;', '"'), '&middot;', '·'),
               '&amp;', '&') AS title
FROM pages WHERE regexp_matches(html, '<h1>')
""")
def page_titles(spark, sf_dir):
    parsed = parse_pages(_archive(spark, sf_dir), ["title"], selectors=ARTICLE)
    return parsed.filter(F.col("title").isNotNull()).select("page_id", "title")


_FOOTER = """
footers AS (
  SELECT page_id,
         trim(regexp_replace(replace(replace(replace(replace(regexp_extract(html, '<footer>(.*?)</footer>', 1, 's'),
              '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&'), '[\\n\\r\\t]', '', 'g')) AS license_name
  FROM pages
)
"""


@query(f"WITH {_FOOTER} SELECT page_id, license_name FROM footers")
def license_lines(spark, sf_dir):
    parsed = parse_pages(_archive(spark, sf_dir), ["license"], selectors=ARTICLE)
    return parsed.select("page_id", clean_license_text(F.col("license_text")).alias("license_name"))


@query(f"""
WITH {_FOOTER},
named AS (SELECT page_id, license_name, trim(split_part(license_name, '·', 2)) AS license FROM footers)
SELECT license, min(page_id) AS page_id, arg_min(license_name, page_id) AS license_name
FROM named GROUP BY license
""")
def license_dimension(spark, sf_dir):
    lines = license_lines(spark, sf_dir)
    name = F.trim(F.element_at(F.split("license_name", "·"), 2))
    return first_licenses(lines.withColumn("license", name)).select("license", "page_id", "license_name")


@query("""
SELECT page_id, list_extract(string_split(url, '/'), -1) AS name FROM pages
""")
def url_basenames(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", basename(F.col("url")).alias("name"))


@query(f"WITH {CUSTOMER_PAGERS} SELECT page_id, last_page FROM pagers")
def last_page(spark, sf_dir):
    return last_pages(parse_pages(spread(customer_pagers(spark, sf_dir)), ["pager"]))


@query(f"WITH {CUSTOMER_PAGERS} SELECT max(last_page) AS max_page FROM pagers")
def max_page(spark, sf_dir):
    return corpus_bound(last_page(spark, sf_dir))


@query("""
SELECT n AS page, 'https://catalogue.example/list.do?pageIndex=' || n AS url
FROM (SELECT unnest(range(1, (SELECT max(page_id) + 2 FROM pages))) AS n)
""")
def list_frontier(spark, sf_dir):
    """The bound is known to the driver, as a page number read off the last pager would be."""
    stop = _pages(spark, sf_dir).agg(F.max("page_id")).first()[0]
    return frontier_of(spark, 1, stop + 1, "https://catalogue.example/list.do?pageIndex=")


@query("""
WITH wanted AS (
  SELECT url FROM pages UNION ALL SELECT url || '&gone=1' FROM pages
),
known AS (SELECT url, min(page_id) AS page_id FROM pages GROUP BY url)
SELECT w.url, k.page_id, CASE WHEN k.page_id IS NULL THEN 'miss' ELSE 'hit' END AS status
FROM wanted w LEFT JOIN known k ON w.url = k.url
""")
def frontier_resolution(spark, sf_dir):
    archive = _pages(spark, sf_dir)
    wanted = archive.select(F.explode(F.array("url", F.concat("url", F.lit("&gone=1")))).alias("url"))
    return resolve_frontier(wanted, archive)


@query("""
SELECT url || '&gone=1' AS url, 'PAGE_URL_ERROR : not archived/' || url || '&gone=1' AS line FROM pages
""")
def frontier_misses(spark, sf_dir):
    return frontier_errors(frontier_resolution(spark, sf_dir)).select("url", "line")


@query("""
SELECT page_id, coalesce(nullif(regexp_extract(url, '/[a-z]{2}/([0-9]{1,16})', 1), ''), 'error') AS code FROM pages
""")
def url_codes(spark, sf_dir):
    code = item_code(F.col("url"), key="/[a-z]{2}/", width=(1, 16))
    return _pages(spark, sf_dir).select("page_id", code.alias("code"))


_ITEM_URL = """
'/view.do?menuNo=200023&' || CASE WHEN o_orderstatus = 'F' THEN 'x' ELSE '' END || 'wrtSn='
  || CASE WHEN o_orderpriority LIKE '1%' THEN repeat(CAST(o_orderkey AS VARCHAR), 6)
          ELSE CAST(o_orderkey AS VARCHAR) END
"""


@query(f"""
SELECT o_orderkey,
       coalesce(nullif(regexp_extract({_ITEM_URL}, 'wrtSn=([0-9]{{4,16}})', 1), ''), 'error') AS code
FROM orders
""")
def item_codes(spark, sf_dir):
    key = F.col("o_orderkey").cast("string")
    url = F.concat(
        F.lit("/view.do?menuNo=200023&"),
        F.when(F.col("o_orderstatus") == "F", F.lit("x")).otherwise(F.lit("")),
        F.lit("wrtSn="),
        F.when(F.col("o_orderpriority").startswith("1"), F.repeat(key, F.lit(6))).otherwise(key),
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", item_code(url).alias("code"))


def _part_details(spark, sf_dir):
    return whole_tables(parse_pages(spread(part_pages(spark, sf_dir)), ["detail"]))


@query(f"""
WITH {PART_ITEMS}, whole AS (SELECT * FROM part_items WHERE complete),
lines AS (
  SELECT page_id, 0 AS place, 'UCI' AS title, 'uci' AS attribute, uci AS value FROM whole
  UNION ALL SELECT page_id, 1, '분류 (장르)', 'classification', classification FROM whole
  UNION ALL SELECT page_id, 2, '저작자', 'author', author FROM whole
  UNION ALL SELECT page_id, 3, '요약정보', 'summary_info', summary_info FROM whole
  UNION ALL SELECT page_id, 4, '원저작물크기', 'original_size', original_size FROM whole
  UNION ALL SELECT page_id, 5, '발행자', 'publisher', publisher FROM whole
  UNION ALL SELECT page_id, 6, '비고', NULL, 'x' FROM whole WHERE has_unknown
  UNION ALL SELECT page_id, 6 + CAST(has_unknown AS INTEGER), '저작 자', 'author', 'second' FROM whole
            WHERE has_repeated
)
SELECT page_id, CAST(place AS INTEGER) AS pos, title, attribute, value FROM lines
""")
def detail_long(spark, sf_dir):
    rows = map_attributes(detail_rows(_part_details(spark, sf_dir)))
    return rows.select("page_id", "pos", "title", "attribute", "value")


_WIDE = f"""
WITH {PART_ITEMS}
SELECT page_id, uci, author, classification, publisher, summary_info, original_size,
       CAST(NULL AS VARCHAR) AS icn, CAST(NULL AS VARCHAR) AS public_author,
       CAST(NULL AS VARCHAR) AS publicate_date, CAST(NULL AS VARCHAR) AS create_date,
       CAST(NULL AS VARCHAR) AS publicate_contry, CAST(NULL AS VARCHAR) AS original_text,
       CAST(NULL AS VARCHAR) AS relation_tag, CAST(NULL AS VARCHAR) AS publish_date,
       CAST(NULL AS VARCHAR) AS contributor, CAST(NULL AS VARCHAR) AS alternate_title,
       CAST(NULL AS VARCHAR) AS substitute, CAST(NULL AS VARCHAR) AS attribute,
       CAST(NULL AS VARCHAR) AS collect_type, CAST(NULL AS VARCHAR) AS collect_target,
       CAST(NULL AS VARCHAR) AS collect_url, CAST(NULL AS VARCHAR) AS main_language,
       CAST(NULL AS VARCHAR) AS original_type, CAST(NULL AS VARCHAR) AS original_date,
       CAST(NULL AS VARCHAR) AS original_collection, CAST(NULL AS VARCHAR) AS details, col_size
FROM part_items WHERE complete
"""


@query(_WIDE)
def detail_wide(spark, sf_dir):
    return widen(_part_details(spark, sf_dir))


@query(_WIDE)
def detail_wide_from_long(spark, sf_dir):
    return to_wide(map_attributes(detail_rows(_part_details(spark, sf_dir))))


@query(f"WITH {PART_ITEMS} SELECT page_id, col_size FROM part_items WHERE complete")
def col_size(spark, sf_dir):
    return detail_wide_from_long(spark, sf_dir).select("page_id", "col_size")


@query("""
SELECT c_custkey AS page_id,
       CASE WHEN c_custkey % 4 >= 1 THEN c_name || ',' ELSE '' END
         || CASE WHEN c_custkey % 4 >= 2 THEN c_mktsegment || ',' ELSE '' END
         || CASE WHEN c_custkey % 4 >= 3 THEN c_nationkey || ',' ELSE '' END AS author
FROM customer
""")
def authors(spark, sf_dir):
    parsed = parse_pages(spread(customer_author_pages(spark, sf_dir)), ["detail"])
    return widen(parsed).select("page_id", "author")


@query(f"""
WITH {PART_ITEMS}
SELECT page_id AS item_id, CAST(6 AS INTEGER) AS pos, '비고' AS title, page_id || ' : 알 수 없는 상세정보' AS line
FROM part_items WHERE complete AND has_unknown
""")
def unknown_attributes(spark, sf_dir):
    rows = map_attributes(detail_rows(_part_details(spark, sf_dir)))
    named = rows.withColumn("item_id", F.col("page_id").cast("string"))
    return unknown_attribute_rows(named, "item_id").withColumn("item_id", F.col("item_id").cast("bigint"))


@query("""
SELECT page_id, try_cast(regexp_extract(url, '([0-9]{1,10})$', 1) AS BIGINT) AS number,
       regexp_replace(url, '[^0-9]', '', 'g') AS digits,
       nullif(regexp_extract(url, 'page=([0-9]+)', 1), '') AS page
FROM pages
""")
def url_numbers(spark, sf_dir):
    url = F.col("url")
    return _pages(spark, sf_dir).select(
        "page_id",
        trailing_number(url).alias("number"),
        digits_only(url).alias("digits"),
        first_match(url, "page=([0-9]+)", 1).alias("page"),
    )
