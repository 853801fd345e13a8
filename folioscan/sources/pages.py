"""Page archives and the frontier of URLs to read from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscan.functions.urls import list_url
from folioscan.operators.first_writer import first_by_key
from folioscan.operators.joins import having_key, hot_key_join
from folioscan.sources.workspace import estimated_bytes

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

# Inputs estimated above this many bytes per core have splits enough of their own.
SPREAD_BYTES_PER_CORE = 64 << 20
# And no input above this many bytes is moved for that, however many cores there are.
SPREAD_BYTES = 4 << 30


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Archive of raw pages. The schema is given, so no inference job runs."""
    return spark.read.schema(PAGE_SCHEMA).parquet(path)


def stream_pages(spark: SparkSession, path: str, files_per_batch: int = 1000, name_glob: str = "*.parquet") -> DataFrame:
    """The archive as a stream of files."""
    return (
        spark.readStream.schema(PAGE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("pathGlobFilter", name_glob)
        .parquet(path)
    )


def spread(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Use idle cores for a small input before the parse; leave a large one as its scan splits it.

    Spark's size estimate decides, so nothing runs for the check. A small input is spread by hash of
    ``key``: a recomputed task sees the same rows. Beyond ``SPREAD_BYTES`` in all HTML is not moved.
    """
    cores = pages.sparkSession.sparkContext.defaultParallelism
    if estimated_bytes(pages) > min(cores * SPREAD_BYTES_PER_CORE, SPREAD_BYTES):
        return pages
    # Not by the bare key: after a join on it Spark would drop the step and merge the small partitions.
    return pages.repartition(cores, F.xxhash64(key))


def list_frontier(spark: SparkSession, start: int, stop: int, template: str) -> DataFrame:
    """``(page, url)`` for every list page of the closed range."""
    page = F.col("id")
    return spark.range(start, stop + 1).select(page.alias("page"), list_url(template, page).alias("url"))


def resolve_frontier(frontier: DataFrame, archive: DataFrame, key: str = "url", order: str = "page_id") -> DataFrame:
    """Frontier rows with the archived page (``order`` column) that serves them and a ``status``.

    The earliest copy of a page wins. Only the two narrow archive columns are joined; read the HTML
    of the hits afterwards with ``pages_of``. Archived copies of one URL fold before the shuffle, and
    a URL that a large part of the frontier names is split by the place of its rows, equal rows too.
    """
    known = first_by_key(archive.select(key, order), [key], [order])
    placed = frontier.withColumn("_place", F.monotonically_increasing_id())
    joined = hot_key_join(placed, known, key, ["_place"], "left").drop("_place")
    return joined.withColumn("status", F.when(F.col(order).isNull(), F.lit("miss")).otherwise(F.lit("hit")))


def pages_of(resolved: DataFrame, archive: DataFrame, order: str = "page_id") -> DataFrame:
    """Archive rows of the hits, one per page however often the frontier names it.

    Hits are counted: up to a bound they are broadcast, and the HTML stays where it is.
    """
    hits = resolved.filter(F.col("status") == "hit").select(order).distinct()
    return having_key(archive, hits, order)
