"""A packed store of image files: how stored bytes come before Spark's image source.

The source decodes files only. So each different payload becomes a file of its own, but not a folder: files
lie in folders by the first digits of their digest, about ``FILES_PER_FOLDER`` in each, and all that is listed
are these folders. Which file holds which digest is read back from the files. The store is scratch: it
is dropped when the decoded images were used.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscan.sources.workspace import dropped, new_folder, written

# Files of one folder, and the most digits of the digest that name a folder (65,536 folders).
FILES_PER_FOLDER, MOST_DIGITS = 1000, 4
# Files that one task writes, and files that one task decodes: their pixels lie in memory together.
FILES_WRITTEN, FILES_READ = 2000, 16
# PNG of 16-bit grey, with and without alpha, in the header's depth and colour: Spark keeps its low bytes.
_WIDE_GREY = ("1000", "1004")


@dataclass(frozen=True)
class PackedImages:
    """``digests``: a narrow row per row of the table, with the payload's digest, null where nothing can be read.

    ``images``: ``(place, image)``, each different payload decoded once. ``places``: ``(place, digest)``.
    """

    digests: DataFrame
    images: DataFrame
    places: DataFrame


def readable(payload: Column) -> Column:
    """Payloads that Spark may decode without changing pixels."""
    wide_grey = F.startswith(payload, F.lit(b"\x89PNG")) & F.hex(F.substring(payload, 25, 2)).isin(*_WIDE_GREY)
    return payload.isNotNull() & ~wide_grey


def folder_digits(files: int) -> int:
    """Hexadecimal digits that give about ``FILES_PER_FOLDER`` files a folder."""
    digits = 0
    while digits < MOST_DIGITS and files > FILES_PER_FOLDER * 16**digits:
        digits += 1
    return digits


def _place(path: Column) -> Column:
    """Folder and name of a file. File names repeat between folders."""
    return F.regexp_extract(path, "([^/]+/[^/]+)$", 1)


@contextmanager
def packed_images(images: DataFrame, payload: str = "hash_") -> Iterator[PackedImages]:
    """Decoded payloads of a table of image bytes, as long as the context lasts.

    Payloads are folded by digest before they shuffle, once, to the task that writes their folder; pixels never
    shuffle here. Bytes that are no image have no row among ``images``; null payloads, and PNG of 16-bit grey,
    have no digest.
    """
    spark = images.sparkSession
    data = F.col(payload)
    digest = F.when(readable(data), F.sha2(data, 256))
    others = [c for c in images.columns if c != payload]
    digests = written(images.select(*others, digest.alias("digest")), "image-digests")
    path = new_folder(spark, "image-files")
    try:
        n = digests.filter("digest is not null").agg(F.count_distinct("digest")).first()[0]
        digits = folder_digits(n)
        folder = F.substring("digest", 1, digits) if digits else F.lit("all")
        files = images.filter(readable(data)).groupBy(F.sha2(data, 256).alias("digest")).agg(F.first(payload).alias("payload"))
        # The text source writes bytes as they are; the line end after them is no part of the image.
        lines = files.select(folder.alias("folder"), F.col("payload").cast("string").alias("value"))
        tasks = max(spark.sparkContext.defaultParallelism, n // FILES_WRITTEN)
        text = lines.repartition(tasks, "folder").write.partitionBy("folder")
        text.option("compression", "none").option("maxRecordsPerFile", 1).text(path)
        found = spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True)
        found = found.option("ignoreCorruptFiles", True).load(path)
        # Spark packs files by bytes; here time and memory go by files.
        found = found.coalesce(max(4 * spark.sparkContext.defaultParallelism, n // FILES_READ))
        stored = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        stored = stored.coalesce(max(spark.sparkContext.defaultParallelism, n // FILES_WRITTEN))
        content = F.expr("substring(content, 1, octet_length(content) - 1)")
        places = stored.select(_place(F.col("path")).alias("place"), F.sha2(content, 256).alias("digest"))
        yield PackedImages(
            digests, found.select(_place(F.col("image.origin")).alias("place"), "image"), written(places, "image-places")
        )
    finally:
        dropped(spark, path)
