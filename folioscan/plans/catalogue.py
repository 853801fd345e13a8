"""Registered queries: upserts, errors, paging, lookups and joins over catalogue tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioscan.functions.payload import encode_base64
from folioscan.functions.text import json_object, run_label
from folioscan.functions.urls import item_code
from folioscan.operators import paging, summary
from folioscan.operators.assets import materialise_missing as missing_assets
from folioscan.operators.errors import log_item_lines, retry_candidates, retry_pass as pages_to_retry
from folioscan.operators.first_writer import insert_if_absent as inserts
from folioscan.operators.joins import catalogue_audit, license_for_item
from folioscan.operators.lookup import (
    IMAGE_NAMES,
    LICENSE_IMAGE_NAMES,
    LICENSE_NAMES,
    THUMBNAIL_NAMES,
    lookup,
    lookup_json,
    non_empty_attributes,
    page_answer as answer_of_page,
    renamed,
    select_rename,
)
from folioscan.operators.page_parse import parse_pages
from folioscan.plans.ingest import error_rows, item_rows, routed
from folioscan.plans.registry import query
from folioscan.plans.rendering import EVENT_LOG, PART_ITEMS, event_log, part_pages, table
from folioscan.sources.logs import read_error_log, run_metadata as header_rows, write_error_log
from folioscan.sources.pages import spread
from folioscan.sources.workspace import new_folder, written


@query("""
WITH stored AS (SELECT d.text FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
fresh AS (SELECT * FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)),
firsts AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM fresh)
SELECT doc_id, lang, source, n_chars FROM firsts f
WHERE n = 1 AND NOT EXISTS (SELECT 1 FROM stored s WHERE s.text = f.text)
""")
def insert_if_absent(spark, sf_dir):
    """Documents without a label arrive at a store of the labelled ones; the text is the key.

    Texts are keyed by digest, where they are read; the other columns come back by id.
    """
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id")
    keyed = documents.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))
    stored = keyed.join(labels, "doc_id", "left_semi").select("digest")
    fresh = inserts(keyed.join(labels, "doc_id", "left_anti"), stored, ["digest"], ["doc_id"])
    return documents.select("doc_id", "lang", "source", "n_chars").join(fresh.select("doc_id"), "doc_id", "left_semi")


@query(f"""
WITH {EVENT_LOG}
SELECT event_id,
       CASE WHEN value LIKE '> Progress: %' THEN 'Progress' ELSE split_part(substr(value, 3), '=', 1) END AS key,
       CASE WHEN value LIKE '> Progress: %' THEN substr(value, 13) ELSE split_part(value, '=', 2) END AS value
FROM event_log WHERE value LIKE '>%'
""")
def run_metadata(spark, sf_dir):
    return header_rows(event_log(spark, sf_dir), keys=("event_id",))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d_%H%M%S') AS label FROM events")
def run_labels(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", run_label(F.col("ts")).alias("label"))


@query(f"""
WITH {EVENT_LOG} SELECT value FROM event_log WHERE value NOT LIKE '>%' AND regexp_matches(value, '^[0-9]')
""")
def error_log(spark, sf_dir):
    """Lines go to text files and come back; the ones that name an item stay."""
    path = new_folder(spark, "log")
    write_error_log(event_log(spark, sf_dir), path, "value")
    return log_item_lines(read_error_log(spark, path))


@query(f"""
WITH {EVENT_LOG},
ids AS (SELECT DISTINCT regexp_extract(value, '^[0-9]{{1,16}}') AS item_id FROM event_log
        WHERE value NOT LIKE '>%' AND regexp_matches(value, '^[0-9]'))
SELECT item_id, '/view.do?wrtSn=' || item_id || '&menuNo=200023' AS url FROM ids
""")
def retry_urls(spark, sf_dir):
    return retry_candidates(event_log(spark, sf_dir))


@query(f"""
WITH {PART_ITEMS},
logged AS (SELECT _id FROM part_items WHERE complete AND (failed OR has_unknown OR has_repeated)
           UNION SELECT _id FROM part_items WHERE has_table AND has_unknown)
SELECT page_id, _id, CASE WHEN complete THEN summary_info END AS summary_info FROM part_items
WHERE _id <> 'error' AND _id IN (SELECT _id FROM logged)
""")
def retry_pass(spark, sf_dir):
    """One pass over all items, then another over the ones its log names."""
    pages = part_pages(spark, sf_dir)
    staged = written(item_rows(parse_pages(spread(pages))), "stage")
    flags = routed(staged)
    errors = error_rows(staged, flags)
    again = pages_to_retry(errors, pages, item_code(F.col("url")), "line")
    rows = item_rows(parse_pages(spread(again)))
    shown = F.when(F.col("has_parts") & F.col("has_rows"), F.col("summary_info"))
    return rows.select("page_id", "_id", shown.alias("summary_info"))


@query("SELECT count(*) AS count FROM documents")
def data_count(spark, sf_dir):
    return summary.data_count(table(spark, sf_dir, "documents"))


@query("""
WITH t AS (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 9 OFFSET 18)
SELECT d.doc_id, d.source, d.text FROM t JOIN documents d ON d.doc_id = t.doc_id
""")
def page_slice(spark, sf_dir):
    payloads = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return paging.page_slice(payloads, "doc_id", 18, 9)


@query("""
WITH t AS (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 45 OFFSET 90)
SELECT d.doc_id AS id, base64(encode(d.text)) AS hash,
       CASE WHEN l.doc_id IS NOT NULL
            THEN CAST(to_json({'doc_id': l.doc_id, 'quality': l.quality, 'toxic': l.toxic}) AS VARCHAR) END AS info
FROM t JOIN documents d ON d.doc_id = t.doc_id LEFT JOIN labels l ON l.doc_id = d.doc_id
""")
def data_range(spark, sf_dir):
    payloads = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    joined = paging.data_range(payloads, labels, "doc_id", 90, 45)
    info = F.to_json("info", {"ignoreNullFields": "false"})
    return joined.select(
        F.col("doc_id").alias("id"), encode_base64(F.col("text").cast("binary")).alias("hash"), info.alias("info")
    )


@query("SELECT o_orderkey, o_custkey, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 12000")
def deep_slice(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return paging.slice_rows(orders, ["o_orderkey"], 12_000, 50)


@query("""
SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, l_orderkey, l_linenumber FROM lineitem
ORDER BY l_shipdate, l_orderkey, l_linenumber LIMIT 200 OFFSET 12345
""")
def deep_slice_ties(spark, sf_dir):
    """Many lines share a date; the other columns break the ties."""
    lines = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_orderkey", "l_linenumber")
    found = paging.slice_rows(lines, ["l_shipdate"], 12_345, 200)
    return found.select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"), "l_orderkey", "l_linenumber")


@query("""
SELECT quality, d.doc_id, source FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
ORDER BY quality NULLS FIRST, d.doc_id NULLS FIRST LIMIT 60 OFFSET 100
""")
def deep_slice_nulls(spark, sf_dir):
    """Most documents have no label, so the key is null; ranked as a deep slice at any offset."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "quality")
    rows = documents.select("doc_id", "source").join(labels, "doc_id", "left").select("quality", "doc_id", "source")
    return paging.slice_rows(rows, ["quality"], 100, 60, shallow=0)


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 9 OFFSET 27")
def catalogue_page(spark, sf_dir):
    return paging.page(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), ["c_custkey"], 4)


@query("SELECT doc_id, source FROM documents ORDER BY n_chars, doc_id LIMIT 1")
def first_row(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return paging.first_row(documents, ["n_chars", "doc_id"]).drop("n_chars")


@query("""
SELECT l_orderkey, l_linenumber,
       CAST((row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1) // 9 + 1 AS BIGINT) AS page,
       CAST((row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1) % 9 AS BIGINT) AS slot
FROM lineitem
""")
def page_table(spark, sf_dir):
    return paging.assign_pages(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT source, CAST(ceil(count(*) / 9.0) AS BIGINT) AS pages FROM documents GROUP BY source")
def page_count(spark, sf_dir):
    counted = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
    return counted.select("source", paging.page_count(F.col("n")).alias("pages"))


@query("""
WITH t AS (SELECT count(*) AS n, count(*) // 8 AS size FROM documents),
b AS (SELECT unnest(range(8)) AS batch)
SELECT batch, 1 + batch * size AS first_page, CASE WHEN batch = 7 THEN n - 7 * size ELSE size END AS pages FROM t, b
""")
def batch_manifest(spark, sf_dir):
    return summary.batch_manifest(spark, 1, table(spark, sf_dir, "documents").count(), 8)


@query("""
WITH t AS (SELECT count(*) AS n, count(*) // 8 AS size FROM documents),
b AS (SELECT unnest(range(8)) AS batch),
d AS (SELECT least(doc_id // size, 7) AS batch, count(*) AS done FROM labels, t GROUP BY 1),
m AS (SELECT batch, CASE WHEN batch = 7 THEN n - 7 * size ELSE size END AS pages FROM t, b)
SELECT m.batch, coalesce(done, 0) AS done, pages, round(100.0 * coalesce(done, 0) / pages, 3) AS percent
FROM m LEFT JOIN d ON m.batch = d.batch
""")
def progress(spark, sf_dir):
    """Labelled documents count as finished pages; pages are numbered from 1."""
    pages = table(spark, sf_dir, "documents").count()
    done = table(spark, sf_dir, "labels").select((F.col("doc_id") + 1).alias("page"))
    return summary.progress(done, "page", 1, pages, 8)


@query("""
WITH wanted AS (SELECT DISTINCT doc_id FROM labels UNION SELECT -1 - doc_id FROM labels)
SELECT w.doc_id, CASE WHEN d.doc_id IS NULL THEN '{}' ELSE CAST(to_json(
  {'doc_id': d.doc_id, 'lang': d.lang, 'source': d.source, 'n_chars': d.n_chars}) AS VARCHAR) END AS answer
FROM wanted w LEFT JOIN documents d ON w.doc_id = d.doc_id
""")
def item_lookup(spark, sf_dir):
    """Every labelled id and as many ids that do not exist."""
    ids = table(spark, sf_dir, "labels").select(F.explode(F.array("doc_id", -1 - F.col("doc_id"))).alias("doc_id"))
    return lookup_json(ids, table(spark, sf_dir, "documents"), "doc_id", ["doc_id", "lang", "source", "n_chars"])


@query("""
WITH wanted AS (SELECT DISTINCT doc_id FROM labels UNION SELECT -1 - doc_id FROM labels)
SELECT w.doc_id, CASE WHEN d.doc_id IS NULL THEN '{}' ELSE CAST(to_json(
  {'id': d.doc_id, 'filename': d.doc_id || '.png', 'hashimg': base64(encode(d.text))}) AS VARCHAR) END AS answer
FROM wanted w LEFT JOIN documents d ON w.doc_id = d.doc_id
""")
def image_lookup(spark, sf_dir):
    """Image answers for every labelled id and as many ids without an image."""
    ids = table(spark, sf_dir, "labels").select(F.explode(F.array("doc_id", -1 - F.col("doc_id"))).alias("doc_id"))
    images = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("doc_id").alias("_id"),
        F.concat(F.col("doc_id").cast("string"), F.lit(".png")).alias("filename"),
        F.col("text").cast("binary").alias("hash_"),
    )
    return lookup_json(ids, images, "doc_id", renamed(IMAGE_NAMES))


@query("""
WITH t AS (SELECT doc_id, source, n_chars FROM documents ORDER BY doc_id LIMIT 9 OFFSET 27)
SELECT CAST(to_json({'list': list({'doc_id': doc_id, 'source': source, 'n_chars': n_chars} ORDER BY doc_id)})
            AS VARCHAR) AS answer FROM t
""")
def page_answer(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return answer_of_page(documents, "doc_id", 27, 9)


@query("""SELECT '{"list":[]}' AS answer FROM (SELECT count(*) FROM documents)""")
def empty_page_answer(spark, sf_dir):
    """A request without a bound."""
    return answer_of_page(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id", None, 9)


@query("""
WITH t AS (SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 30 OFFSET 45)
SELECT CAST(to_json({'list': list({'doc_id': t.doc_id, 'source': source, 'info':
  CASE WHEN l.doc_id IS NOT NULL THEN {'doc_id': l.doc_id, 'quality': l.quality, 'toxic': l.toxic} END}
  ORDER BY t.doc_id)}) AS VARCHAR) AS answer
FROM t LEFT JOIN labels l ON l.doc_id = t.doc_id
""")
def page_answer_info(spark, sf_dir):
    """A page whose rows carry the row of another table."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    return answer_of_page(documents, "doc_id", 45, 30, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


def _asset_answers(spark, sf_dir, names):
    """Answers for every labelled id and as many ids that are not stored; texts are the payloads."""
    ids = table(spark, sf_dir, "labels").select(F.explode(F.array("doc_id", -1 - F.col("doc_id"))).alias("doc_id"))
    stored = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("doc_id").cast("string").alias("_id"),
        F.concat(F.col("doc_id").cast("string"), F.lit(".png")).alias("filename"),
        F.col("source").alias("license"),
        F.col("lang").alias("license_name"),
        F.col("text").cast("binary").alias("hash_"),
    )
    return lookup_json(ids, stored, "doc_id", renamed(names))


@query("""
WITH wanted AS (SELECT DISTINCT doc_id FROM labels UNION SELECT -1 - doc_id FROM labels)
SELECT w.doc_id, CASE WHEN d.doc_id IS NULL THEN '{}' ELSE CAST(to_json(
  {'id': CAST(d.doc_id AS VARCHAR), 'filename': d.doc_id || '.png', 'hashthumbnail': base64(encode(d.text))})
  AS VARCHAR) END AS answer
FROM wanted w LEFT JOIN documents d ON w.doc_id = d.doc_id
""")
def thumbnail_lookup(spark, sf_dir):
    return _asset_answers(spark, sf_dir, THUMBNAIL_NAMES)


@query("""
WITH wanted AS (SELECT DISTINCT doc_id FROM labels UNION SELECT -1 - doc_id FROM labels)
SELECT w.doc_id, CASE WHEN d.doc_id IS NULL THEN '{}' ELSE CAST(to_json(
  {'id': d.source, 'license_name': d.lang, 'hashlicense': base64(encode(d.text))}) AS VARCHAR) END AS answer
FROM wanted w LEFT JOIN documents d ON w.doc_id = d.doc_id
""")
def license_lookup(spark, sf_dir):
    return _asset_answers(spark, sf_dir, LICENSE_IMAGE_NAMES)


@query("""
SELECT c_custkey, c_mktsegment AS licensename, c_nationkey || '.png' AS filename FROM customer
""")
def license_answers(spark, sf_dir):
    items = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_mktsegment").alias("license_name"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit(".png")).alias("license"),
    )
    return select_rename(items, {"c_custkey": "c_custkey", **LICENSE_NAMES})


@query("SELECT p_partkey, p_name, p_brand FROM part WHERE p_partkey = 42 LIMIT 1")
def point_lookup(spark, sf_dir):
    return lookup(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand"), "p_partkey", 42)


@query("""
SELECT c_custkey, 'C_NAME' AS KEY, c_name AS value FROM customer WHERE c_name <> ''
UNION ALL SELECT c_custkey, 'C_NATIONKEY', CAST(c_nationkey AS VARCHAR) FROM customer WHERE c_nationkey <> 0
UNION ALL SELECT c_custkey, 'C_MKTSEGMENT', c_mktsegment FROM customer WHERE c_mktsegment <> ''
""")
def item_attributes(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return non_empty_attributes(customer, "c_custkey", ["c_name", "c_nationkey", "c_mktsegment"])


@query("""
SELECT CAST(doc_id AS VARCHAR) AS id, doc_id || '.png' AS filename, base64(encode(text)) AS hashimg FROM documents
""")
def image_answers(spark, sf_dir):
    name = F.col("doc_id").cast("string")
    images = table(spark, sf_dir, "documents").select(
        name.alias("_id"),
        F.concat(name, F.lit(".png")).alias("filename"),
        encode_base64(F.col("text").cast("binary")).alias("hash_"),
    )
    return select_rename(images, IMAGE_NAMES)


@query("""
SELECT o_orderkey, CAST(to_json({'o_orderkey': o_orderkey, 'status': o_orderstatus, 'info':
  {'customer': o_custkey, 'priority': o_orderpriority}}) AS VARCHAR) AS answer FROM orders
""")
def nested_json(spark, sf_dir):
    info = F.struct(F.col("o_custkey").alias("customer"), F.col("o_orderpriority").alias("priority"))
    answer = json_object("o_orderkey", F.col("o_orderstatus").alias("status"), info.alias("info"))
    return table(spark, sf_dir, "orders").select("o_orderkey", answer.alias("answer"))


def _licensed(spark, sf_dir):
    """Orders as items and customers as the licences they name; one segment's are not stored."""
    items = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("_id"), F.col("o_custkey").cast("string").alias("license")
    )
    licenses = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").cast("string").alias("license"),
        F.col("c_mktsegment").alias("license_name"),
        F.col("c_name").cast("binary").alias("hash_"),
    )
    return items, licenses


_LICENSED = """
SELECT CAST(o_orderkey AS VARCHAR) AS _id, CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS license_name,
       base64(encode(c_name)) AS hashlicense
FROM orders, customer WHERE o_custkey = c_custkey AND c_mktsegment <> 'BUILDING'
"""


@query(_LICENSED)
def license_join(spark, sf_dir):
    joined = license_for_item(*_licensed(spark, sf_dir))
    return joined.withColumn("hashlicense", encode_base64(F.col("hashlicense")))


@query(_LICENSED)
def license_join_split(spark, sf_dir):
    """The same join as it runs beyond the broadcast bound, with every repeated key split."""
    joined = license_for_item(*_licensed(spark, sf_dir), broadcast_rows=0, rows_per_split=5)
    return joined.withColumn("hashlicense", encode_base64(F.col("hashlicense")))


@query("""
WITH a AS (SELECT DISTINCT user_id AS _id FROM events), i AS (SELECT c_custkey * 2 AS _id FROM customer)
SELECT _id, 'asset_without_item' AS problem FROM a WHERE _id NOT IN (SELECT _id FROM i)
UNION ALL SELECT _id, 'item_without_asset' FROM i WHERE _id NOT IN (SELECT _id FROM a)
""")
def asset_audit(spark, sf_dir):
    assets = table(spark, sf_dir, "events").select(F.col("user_id").alias("_id"))
    items = table(spark, sf_dir, "customer").select((F.col("c_custkey") * 2).alias("_id"))
    return catalogue_audit(assets, items)


@query("""
WITH planned AS (
  SELECT o_orderkey AS page_id, o_custkey || '.png' AS filename,
         CASE o_orderstatus WHEN 'F' THEN 'origin' WHEN 'O' THEN 'thumbnail' ELSE 'license' END AS kind FROM orders
),
existing AS (SELECT 'origin' AS kind, c_custkey || '.png' AS filename FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT kind, filename, min(page_id) AS page_id FROM planned p
WHERE kind IN ('origin', 'thumbnail')
  AND NOT EXISTS (SELECT 1 FROM existing e WHERE e.kind = p.kind AND e.filename = p.filename)
GROUP BY kind, filename
""")
def materialise_missing(spark, sf_dir):
    status = F.col("o_orderstatus")
    kind = F.when(status == "F", "origin").when(status == "O", "thumbnail").otherwise("license")
    planned = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("page_id"),
        F.concat(F.col("o_custkey").cast("string"), F.lit(".png")).alias("filename"),
        kind.alias("kind"),
    )
    existing = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(
        F.lit("origin").alias("kind"), F.concat(F.col("c_custkey").cast("string"), F.lit(".png")).alias("filename")
    )
    return missing_assets(planned, existing, {"origin": True, "thumbnail": True, "license": False})
