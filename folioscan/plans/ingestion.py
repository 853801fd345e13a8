"""Registered queries: the item pass end to end, as a batch and as a stream."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscan.functions.payload import encode_base64
from folioscan.operators.errors import classify_outcome, status_summary as summarise
from folioscan.operators.page_parse import parse_pages
from folioscan.plans.crawl import crawl
from folioscan.plans.ingest import error_rows, first_writers, ingest_batch, item_rows, routed
from folioscan.plans.registry import query
from folioscan.plans.rendering import (
    LIST_TEMPLATE,
    PART_ITEMS,
    PART_SITE,
    crawl_archive,
    part_assets,
    part_image_assets,
    part_pages,
    table,
)
from folioscan.sources.logs import read_error_log, run_metadata
from folioscan.sources.pages import spread, stream_pages
from folioscan.sources.tables import ITEMS, LICENSES, read_table, reset_tables
from folioscan.sources.workspace import new_folder, written
from folioscan.streaming.ingest import ingest_stream as stream_items


def _staged(spark, sf_dir):
    """Parsed once and stored, as ``ingest_batch`` does: flags and errors read it several times."""
    return written(item_rows(parse_pages(spread(part_pages(spark, sf_dir)))), "stage")


@query(f"WITH {PART_ITEMS} SELECT page_id, _id, status FROM part_outcomes")
def item_outcomes(spark, sf_dir):
    flags = routed(_staged(spark, sf_dir))
    failed = F.col("failure").isNotNull()
    nothing = read_table(spark, new_folder(spark, "empty"), "items")
    writers = first_writers(flags.filter(F.col("complete") & ~failed), nothing, "_id", small=False)
    marked = flags.join(writers.select("page_id", F.lit(True).alias("first")), "page_id", "left")
    status = classify_outcome(F.col("complete"), failed, F.col("first").isNotNull())
    return marked.select("page_id", "_id", status.alias("status"))


@query(f"WITH {PART_ITEMS} SELECT status, count(*) AS items FROM part_outcomes GROUP BY status")
def status_summary(spark, sf_dir):
    return summarise(item_outcomes(spark, sf_dir))


@query(f"""
WITH {PART_ITEMS},
sides AS (
  SELECT page_id, _id, 'unknown_attribute' AS stage, '비고' AS message, '알 수 없는 상세정보' AS tail
  FROM part_items WHERE has_table AND has_unknown
  UNION ALL SELECT page_id, _id, 'duplicate_label', 'author', 'duplicate label author'
  FROM part_items WHERE complete AND has_repeated
  UNION ALL SELECT page_id, _id, 'item', 'image without address', 'image without address'
  FROM part_items WHERE complete AND failed
)
SELECT page_id, _id AS item_id, stage, message, _id || ' : ' || tail AS line FROM sides
""")
def catalogue_errors(spark, sf_dir):
    staged = _staged(spark, sf_dir)
    flags = routed(staged)
    return error_rows(staged, flags)


_ITEMS_SQL = f"""
WITH {PART_ITEMS}
SELECT page_id, i._id, filename, '../../img/origin/' || i._id || '.png' AS path, license, license_name,
       uci, author, classification, publisher, summary_info, original_size, col_size,
       {", ".join(
           f"CAST(NULL AS VARCHAR) AS {c}"
           for c in ITEMS.names[6:-1]
           if c not in ("uci", "author", "classification", "publisher", "summary_info", "original_size")
       )}
FROM part_items i JOIN part_outcomes o USING (page_id) WHERE status = 'inserted'
"""


@query(_ITEMS_SQL)
def ingest_items(spark, sf_dir):
    root = new_folder(spark, "catalogue")
    ingest_batch(part_pages(spark, sf_dir), 0, root)
    return read_table(spark, root, "items").select(*ITEMS.names)


@query(f"""
WITH {PART_ITEMS}
SELECT license, arg_min(license_name, page_id) AS license_name FROM part_items GROUP BY license
""")
def ingest_licenses(spark, sf_dir):
    root = new_folder(spark, "catalogue")
    ingest_batch(part_pages(spark, sf_dir), 0, root)
    return read_table(spark, root, "licenses").select(*LICENSES.names[:2])


@query(f"""
WITH {PART_ITEMS}
SELECT 'items' AS name, count_if(status = 'inserted')::BIGINT AS rows_before, 0::BIGINT AS rows_after FROM part_outcomes
UNION ALL SELECT 'outcomes', count(*), 0 FROM part_outcomes
UNION ALL SELECT 'licenses', count(DISTINCT license), 0 FROM part_items
""")
def reset_catalogue(spark, sf_dir):
    """A loaded catalogue is emptied; its tables stay readable."""
    root = new_folder(spark, "catalogue")
    ingest_batch(part_pages(spark, sf_dir), 0, root)
    names = ["items", "outcomes", "licenses"]
    before = [read_table(spark, root, name).count() for name in names]
    reset_tables(spark, root)
    after = [read_table(spark, root, name).agg(F.count("*").alias("rows_after")) for name in names]
    counted = [
        rows.select(F.lit(name).alias("name"), F.lit(n).cast("bigint").alias("rows_before"), "rows_after")
        for name, n, rows in zip(names, before, after)
    ]
    return reduce(DataFrame.unionByName, counted)


def _middle(pages):
    return pages.agg(F.expr("percentile_approx(page_id, 0.5)")).first()[0]


def _stream(spark, arrivals, root):
    """All files of a folder as a stream of its own, with a fresh checkpoint."""
    stream = stream_pages(spark, arrivals, files_per_batch=spark.sparkContext.defaultParallelism)
    stream_items(stream, root, new_folder(spark, "stream")).awaitTermination()


@query(_ITEMS_SQL)
def ingest_stream(spark, sf_dir):
    """The pages arrive as two sets of files, the earlier page ids first, in several micro-batches."""
    arrivals, root = new_folder(spark, "arrivals"), new_folder(spark, "catalogue")
    pages = spread(part_pages(spark, sf_dir))
    middle = _middle(pages)
    for arrival in (F.col("page_id") <= middle, F.col("page_id") > middle):
        pages.filter(arrival).write.mode("append").parquet(arrivals)
    _stream(spark, arrivals, root)
    return read_table(spark, root, "items").select(*ITEMS.names)


@query(_ITEMS_SQL)
def ingest_resume(spark, sf_dir):
    """A batch of the first half, a stream of the rest, and another stream of all pages, into one root."""
    rest, every, root = (new_folder(spark, label) for label in ("rest", "every", "catalogue"))
    pages = part_pages(spark, sf_dir)
    middle = _middle(pages)
    ingest_batch(pages.filter(F.col("page_id") <= middle), 0, root)
    pages.filter(F.col("page_id") > middle).write.parquet(rest)
    pages.write.parquet(every)
    _stream(spark, rest, root)
    _stream(spark, every, root)
    return read_table(spark, root, "items").select(*ITEMS.names)


# Images are archived for all parts but every seventh; every eleventh has an entry without bytes.
_IMAGE_SQL = f"""
WITH {PART_ITEMS},
shown AS (SELECT * FROM part_items WHERE complete AND NOT failed AND page_id % 7 <> 0 AND page_id % 11 <> 0)
SELECT _id, _id || '.png' AS filename, base64(encode(arg_min(filename, page_id))) AS hash FROM shown GROUP BY _id
"""


def _images(spark, root):
    return read_table(spark, root, "images").select("_id", "filename", encode_base64(F.col("hash_")).alias("hash"))


@query(_IMAGE_SQL)
def ingest_images(spark, sf_dir):
    """The image addresses of the pages lead to the archive; the first page of an id stores its image."""
    root = new_folder(spark, "catalogue")
    ingest_batch(part_pages(spark, sf_dir), 0, root, PART_SITE, part_assets(spark, sf_dir))
    return _images(spark, root)


@query(_IMAGE_SQL)
def ingest_encoded(spark, sf_dir):
    """The same with payloads stored as base64 text."""
    root, site = new_folder(spark, "catalogue"), replace(PART_SITE, encoding="base64")
    ingest_batch(part_pages(spark, sf_dir), 0, root, site, part_assets(spark, sf_dir))
    return read_table(spark, root, "images", "base64").select("_id", "filename", F.col("hash_").alias("hash"))


@query(_IMAGE_SQL)
def ingest_images_late(spark, sf_dir):
    """The first load has no archive; the images come with the second, though all items are stored."""
    root = new_folder(spark, "catalogue")
    ingest_batch(part_pages(spark, sf_dir), 0, root, PART_SITE)
    ingest_batch(part_pages(spark, sf_dir), 1, root, PART_SITE, part_assets(spark, sf_dir))
    return _images(spark, root)


@query(f"""
WITH {PART_ITEMS},
marked AS (SELECT *, page_id % 7 = 0 OR page_id % 11 = 0 AS lost FROM part_items WHERE complete),
firsts AS (SELECT _id, min(page_id) AS page_id FROM marked WHERE NOT failed AND NOT lost GROUP BY _id)
SELECT page_id, 'item' AS stage, _id || ' : ' || CASE WHEN failed THEN 'image without address' ELSE 'image not found' END AS line
FROM marked WHERE failed OR lost
UNION ALL SELECT m.page_id, 'image', m._id || ' : Origin image hash data save error'
FROM marked m LEFT JOIN firsts f ON m.page_id = f.page_id WHERE NOT failed AND NOT lost AND f.page_id IS NULL
""")
def ingest_asset_errors(spark, sf_dir):
    root = new_folder(spark, "catalogue")
    ingest_batch(part_pages(spark, sf_dir), 0, root, PART_SITE, part_assets(spark, sf_dir))
    errors = read_table(spark, root, "errors").filter(F.col("stage").isin("item", "image"))
    return errors.select("page_id", "stage", "line")


# With images that can be decoded but for every fifth; every seventh is missing. One name may be asked for twice.
_FILES = f"""
WITH {PART_ITEMS},
shown AS (SELECT * FROM part_items WHERE complete AND NOT failed AND page_id % 7 <> 0),
firsts AS (SELECT _id, min(page_id) AS page_id FROM shown GROUP BY _id),
"""


@query(f"""{_FILES}
made AS (SELECT _id, page_id FROM firsts WHERE page_id % 5 <> 0)
SELECT 'origin_files' AS name, _id || '.png' AS filename FROM firsts
UNION ALL SELECT 'thumbnail_files', _id || '.png' FROM made
UNION ALL SELECT 'thumbnails', _id || '.png' FROM made
UNION ALL SELECT DISTINCT 'license_files', license FROM part_items
UNION ALL SELECT 'errors', 'THUMBNAIL ERROR: ' || _id || '.png' FROM firsts WHERE page_id % 5 = 0
""")
def ingest_switches(spark, sf_dir):
    """One half of the pages with icons as files, then all of them with images and thumbnails as files, too."""
    root, pages, assets = new_folder(spark, "catalogue"), part_pages(spark, sf_dir), part_image_assets(spark, sf_dir)
    half, site = _middle(pages), replace(PART_SITE, encoding="base64", license_files=True)
    ingest_batch(pages.filter(F.col("page_id") <= half), 0, root, site, assets)
    ingest_batch(pages, 1, root, replace(site, origin_files=True, thumbnail_files=True), assets)
    names = ("origin_files", "thumbnail_files", "thumbnails", "license_files")
    found = [read_table(spark, root, name).select(F.lit(name).alias("name"), "filename") for name in names]
    errors = read_table(spark, root, "errors").filter("stage = 'thumbnail'")
    found.append(errors.select(F.lit("errors").alias("name"), F.col("line").alias("filename")))
    return reduce(DataFrame.unionByName, found)


_CRAWL = f"""
WITH {PART_ITEMS},
pages AS (SELECT *, CASE WHEN p_size = 50 THEN NULL ELSE 10000 + p_partkey - CASE WHEN p_partkey % 3 = 1 THEN 1 ELSE 0 END END
          AS number FROM part),
lists AS (SELECT c_custkey, c_nationkey FROM customer),
links AS (SELECT c_custkey, 10000 + c_custkey * 2 + n AS number FROM lists, (SELECT unnest([0, 1, 5]) AS n) WHERE c_nationkey <> 7),
hits AS (SELECT min(p_partkey) AS page_id FROM pages WHERE number IN (SELECT number FROM links) GROUP BY number)
"""


@query(f"""{_CRAWL}
SELECT page_id, _id, filename, CASE WHEN NOT complete THEN 'missing_structure' WHEN failed THEN 'error' ELSE 'inserted' END AS status
FROM part_items JOIN hits USING (page_id)
""")
def crawl_catalogue(spark, sf_dir):
    """List pages, their links, the archived pages behind them, and their items, as one plan."""
    root = _crawled(spark, sf_dir)
    outcomes = read_table(spark, root, "outcomes")
    names = parse_pages(spread(part_pages(spark, sf_dir)), ["title"], keys=["page_id"])
    return outcomes.join(names.withColumnRenamed("title", "filename"), "page_id").select("page_id", "_id", "filename", "status")


@query(f"""{_CRAWL}
SELECT 'PAGE_URL_ERROR : no usable link list/https://catalogue.example/list.do?p=' || c_custkey AS line
FROM lists WHERE c_nationkey = 7
UNION ALL SELECT 'PAGE_URL_ERROR : link without address/https://catalogue.example/list.do?p=' || c_custkey
FROM lists WHERE c_nationkey = 8
UNION ALL SELECT 'PAGE_URL_ERROR : not archived/https://catalogue.example/list.do?p=' || (n + i)
FROM (SELECT max(c_custkey) AS n FROM customer), (SELECT unnest([1, 2]) AS i)
UNION ALL SELECT DISTINCT 'PAGE_URL_ERROR : not archived/https://catalogue.example/view.do?menuNo=200023&wrtSn=' || number
FROM links WHERE number NOT IN (SELECT number FROM pages WHERE number IS NOT NULL)
""")
def crawl_errors(spark, sf_dir):
    """What the crawl could not read: list pages and item pages that are missing or of no use."""
    errors = read_table(spark, _crawled(spark, sf_dir), "errors")
    return errors.filter(F.col("stage") == "page").select("line")


@query("""
SELECT 'START_PAGE' AS key, '0' AS value FROM customer UNION SELECT 'END_PAGE', CAST(max(c_custkey) + 2 AS VARCHAR) FROM customer
UNION SELECT 'BASE_URL', 'https://catalogue.example' FROM customer
""")
def crawl_headers(spark, sf_dir):
    """The run's settings, as its log holds them, without its times and page range."""
    headers = run_metadata(read_error_log(spark, f"{_crawled(spark, sf_dir)}/log"))
    return headers.filter(F.col("key").rlike("^[A-Z]+_[A-Z_]+$"))


def _crawled(spark, sf_dir):
    root = new_folder(spark, "catalogue")
    last = table(spark, sf_dir, "customer").agg(F.max("c_custkey")).first()[0] or 0
    crawl(crawl_archive(spark, sf_dir), root, 0, last + 2, LIST_TEMPLATE, PART_SITE)
    return root


# Pagers: list pages end at a third of the customers, says the first; at half of them, says the page there.
_BOUNDED = """
n AS (SELECT max(c_custkey) AS n FROM customer),
reached AS (SELECT n // 3 + 1 + (n // 3 + 1) // 2 AS stop FROM n),
"""


@query(f"""{_CRAWL.rstrip()},
{_BOUNDED.rstrip().rstrip(",")},
seen AS (SELECT DISTINCT 10000 + c_custkey * 2 + i AS number FROM lists, reached, (SELECT unnest([0, 1, 5]) AS i)
         WHERE c_nationkey <> 7 AND c_custkey <= stop)
SELECT page_id, status FROM part_outcomes JOIN (
  SELECT min(p_partkey) AS page_id FROM pages WHERE number IN (SELECT number FROM seen) GROUP BY number) USING (page_id)
""")
def crawl_bounded(spark, sf_dir):
    """A crawl that is told no last page: the pager of the first page gives one, the pagers up to there a later one."""
    root = new_folder(spark, "catalogue")
    crawl(crawl_archive(spark, sf_dir, pagers=True), root, 0, None, LIST_TEMPLATE, PART_SITE)
    statuses = read_table(spark, root, "outcomes").select("page_id", "status")
    return statuses


@query(f"""{_CRAWL.rstrip()},
touched AS (SELECT * FROM part_items JOIN hits USING (page_id)),
late AS (SELECT *, page_id % 7 = 0 OR page_id % 11 = 0 AS lost FROM touched),
lines AS (
  SELECT _id AS item_id, _id || ' : 알 수 없는 상세정보' AS line FROM late WHERE has_table AND has_unknown
  UNION SELECT _id, _id || ' : duplicate label author' FROM late WHERE complete AND has_repeated
  UNION SELECT _id, _id || ' : image without address' FROM late WHERE complete AND failed
  UNION SELECT _id, _id || ' : image not found' FROM late WHERE complete AND NOT failed AND lost)
SELECT item_id, line, attempt::INTEGER AS attempt,
  CASE WHEN attempt = 2 AND line LIKE '% : image not found' THEN 'closed' ELSE 'open' END AS outcome
FROM lines, (SELECT unnest([1, 2]) AS attempt) WHERE item_id <> 'error'
""")
def crawl_retry(spark, sf_dir):
    """Some images are archived only for the second try, which closes the lines about them and no others."""
    root = new_folder(spark, "catalogue")
    last = table(spark, sf_dir, "customer").agg(F.max("c_custkey")).first()[0] or 0
    whole = part_image_assets(spark, sf_dir, missing=False)
    crawl(
        crawl_archive(spark, sf_dir), root, 0, last + 2, LIST_TEMPLATE, PART_SITE,
        part_assets(spark, sf_dir), retry=True, later_assets=whole,
    )
    return read_table(spark, root, "attempts").select("item_id", "line", "attempt", "outcome")
