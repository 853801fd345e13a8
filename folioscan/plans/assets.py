"""Registered queries: payload encodings, sizes, asset files and thumbnails."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from folioscan.functions.payload import data_uri as as_data_uri, decode_base64, encode_base64, fit_box
from folioscan.operators.assets import (
    decode_images,
    payload_sizes as sizes_of,
    roundtrip_check,
    size_profile as profile,
    thumbnail_errors as failed_thumbnails,
    thumbnail_job as make_thumbnails,
)
from folioscan.plans.registry import query
from folioscan.plans.ingest import thumbnail_stored
from folioscan.plans.rendering import document_images, flat_images, table
from folioscan.sources.assets import read_assets
from folioscan.sources.pages import spread
from folioscan.sources.tables import (
    ENCODED_IMAGES,
    encoded_assets,
    read_payloads,
    read_table,
    settle_manifest,
    write_assets,
    write_batch,
)
from folioscan.sources.workspace import new_folder, written


def _payloads(spark, sf_dir, *columns):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", *columns, F.col("text").cast("binary").alias("payload"))


@query("SELECT doc_id, base64(encode(text)) AS hash FROM documents")
def base64_payload(spark, sf_dir):
    return _payloads(spark, sf_dir).select("doc_id", encode_base64(F.col("payload")).alias("hash"))


@query("""
SELECT CAST(doc_id AS VARCHAR) AS _id, doc_id || '.png' AS filename, base64(encode(text)) AS hash_ FROM documents
""")
def asset_table(spark, sf_dir):
    """The image table in its base64 form, written and read back."""
    path = new_folder(spark, "assets")
    name = F.col("doc_id").cast("string")
    rows = _payloads(spark, sf_dir).select(
        name.alias("_id"), F.concat(name, F.lit(".png")).alias("filename"), F.col("payload").alias("hash_")
    )
    write_assets(rows, path, "base64")
    return spark.read.schema(ENCODED_IMAGES).parquet(path)


@query("SELECT doc_id, text FROM documents")
def base64_decoded(spark, sf_dir):
    back = decode_base64(encode_base64(F.col("payload"))).cast("string")
    return _payloads(spark, sf_dir).select("doc_id", back.alias("text"))


@query("SELECT doc_id, 'data:image/png;base64,' || base64(encode(text)) AS uri FROM documents")
def data_uri(spark, sf_dir):
    return _payloads(spark, sf_dir).select("doc_id", as_data_uri(encode_base64(F.col("payload"))).alias("uri"))


@query("""
SELECT e AS encoding, count(*) AS payloads, CAST(0 AS BIGINT) AS mismatches
FROM documents, (SELECT unnest(['base64', 'zlib', 'raw']) AS e) GROUP BY e
""")
def roundtrip(spark, sf_dir):
    payloads = spread(_payloads(spark, sf_dir), "doc_id")
    checks = [roundtrip_check(payloads, "doc_id", "payload", e) for e in ("base64", "zlib", "raw")]
    return reduce(lambda a, b: a.unionByName(b), checks)


@query("""
SELECT doc_id, CAST(octet_length(encode(text)) AS INTEGER) AS raw_size,
       CAST(4 * ((octet_length(encode(text)) + 2) // 3) AS INTEGER) AS base64_size,
       CAST(4 * ((octet_length(encode(text)) + 2) // 3) AS INTEGER) AS restored_size
FROM documents
""")
def payload_sizes(spark, sf_dir):
    return sizes_of(spread(_payloads(spark, sf_dir), "doc_id"), "payload").drop("compressed_size")


@query()
def size_profile(spark, sf_dir):
    """zlib sizes have no SQL form; the tests compare them with a plain loop."""
    return profile(spread(_payloads(spark, sf_dir, "source"), "doc_id"), "payload", ["source"])


@query("""
SELECT source, sum(octet_length(encode(text)) + 1)::BIGINT AS bytes FROM documents GROUP BY source
""")
def asset_files(spark, sf_dir):
    """Documents become files, a folder per source, and are read back as binary assets."""
    path = new_folder(spark, "files")
    documents = table(spark, sf_dir, "documents").select("source", "text")
    documents.write.partitionBy("source").option("maxRecordsPerFile", 2000).text(path)
    files = read_assets(spark, path, "*.txt")
    source = F.regexp_extract("path", "/source=([^/]+)/", 1)
    return files.groupBy(source.alias("source")).agg(F.sum(F.octet_length("payload")).alias("bytes"))


_WIDTH, _HEIGHT = "CAST(o_orderkey % 4000 + 1 AS DOUBLE)", "CAST(o_custkey % 3000 + 1 AS DOUBLE)"

# The thumbnail rule over columns ``w`` and ``h`` (doubles) of a relation ``sized``.
_FIT = """
ratio AS (SELECT *, w / h AS a FROM sized),
exact AS (SELECT *, 200 * a AS x, 200 / a AS y FROM ratio),
near AS (SELECT *,
  CASE WHEN abs(a - floor(x) / 200) <= abs(a - ceil(x) / 200) THEN floor(x) ELSE ceil(x) END AS nx,
  CASE WHEN floor(y) = 0 OR abs(a - 200 / floor(y)) <= abs(a - 200 / ceil(y)) THEN floor(y) ELSE ceil(y) END AS ny
  FROM exact),
fitted AS (SELECT *,
  CAST(CASE WHEN w <= 200 AND h <= 200 THEN w WHEN a <= 1 THEN greatest(nx, 1) ELSE 200 END AS INTEGER) AS width,
  CAST(CASE WHEN w <= 200 AND h <= 200 THEN h WHEN a <= 1 THEN 200 ELSE greatest(ny, 1) END AS INTEGER) AS height
  FROM near)
"""


@query(f"""
WITH sized AS (SELECT o_orderkey, {_WIDTH} AS w, {_HEIGHT} AS h FROM orders), {_FIT}
SELECT o_orderkey, width, height FROM fitted
""")
def thumbnail_dims(spark, sf_dir):
    size = fit_box(F.col("o_orderkey") % 4000 + 1, F.col("o_custkey") % 3000 + 1)
    return table(spark, sf_dir, "orders").select("o_orderkey", size.alias("size")).select("o_orderkey", "size.*")


@query(f"""
WITH bytes AS (SELECT doc_id, source, octet_length(encode(text)) AS n FROM documents),
sized AS (SELECT doc_id, source, CAST(greatest(least(n, 640), 1) AS DOUBLE) AS w,
                 ceil(n / CAST(greatest(least(n, 640), 1) AS DOUBLE)) AS h FROM bytes), {_FIT}
SELECT CAST(doc_id AS VARCHAR) AS _id, doc_id || '.png' AS filename, width, height, 'PNG' AS kind
FROM fitted WHERE source <> 'src7'
""")
def thumbnail_job(spark, sf_dir):
    made = make_thumbnails(spread(document_images(spark, sf_dir), "_id")).filter(F.col("hash_").isNotNull())
    kind = F.substring(F.col("hash_"), 2, 3).cast("string")
    return made.select("_id", "filename", "width", "height", kind.alias("kind"))


@query("""
SELECT CAST(doc_id AS VARCHAR) AS _id, 'THUMBNAIL ERROR: ' || doc_id || '.png' AS line
FROM documents WHERE source = 'src7'
""")
def thumbnail_errors(spark, sf_dir):
    return failed_thumbnails(make_thumbnails(spread(document_images(spark, sf_dir), "_id")))


# Thumbnails of the flat images that can be read: sizes and the digest of their pixels.
_FLAT = f"""
coloured AS (
  SELECT p_partkey, p_partkey % 500 + 1 AS width, p_size * 9 + 1 AS height,
         printf('%02X%02X%02X', p_partkey % 256, p_size, (p_partkey * 7) % 256) AS colour
  FROM part WHERE p_partkey % 5 <> 0),
sized AS (SELECT p_partkey, colour, CAST(width AS DOUBLE) AS w, CAST(height AS DOUBLE) AS h FROM coloured),
{_FIT}, flat AS (SELECT *, sha256(repeat(colour, width * height)) AS pixels FROM fitted)
"""


def _pixels(thumbnails):
    """Stored thumbnails, decoded again."""
    made = decode_images(thumbnails)
    return made.select("_id", "image.width", "image.height", F.sha2(F.hex("image.data").cast("binary"), 256).alias("pixels"))


@query(f"WITH {_FLAT} SELECT CAST(p_partkey AS VARCHAR) AS _id, width, height, pixels FROM flat")
def stored_thumbnails(spark, sf_dir):
    """Flat PNG images go into the catalogue; thumbnails come out of its images table and are decoded again."""
    root = new_folder(spark, "catalogue")
    write_batch(flat_images(spark, sf_dir), root, "images", 0, "test")
    thumbnail_stored(spark, 0, root)
    return _pixels(read_table(spark, root, "thumbnails"))


@query(f"""
WITH {_FLAT}
SELECT encoding, CAST(p_partkey AS VARCHAR) AS _id, width, height, pixels
FROM flat, (SELECT unnest(['base64', 'zlib']) AS encoding)
""")
def encoded_thumbnails(spark, sf_dir):
    """The same from catalogues that keep payloads as base64 text and as zlib bytes."""
    # Made once, read by both catalogues.
    images, found = written(flat_images(spark, sf_dir), "images"), []
    for encoding in ("base64", "zlib"):
        root = new_folder(spark, "catalogue")
        settle_manifest(spark, root, encoding)
        write_batch(encoded_assets(images, encoding), root, "images", 0, "test")
        thumbnail_stored(spark, 0, root)
        pixels = _pixels(read_payloads(spark, root, "thumbnails"))
        found.append(pixels.select(F.lit(encoding).alias("encoding"), "*"))
    return found[0].unionByName(found[1])
