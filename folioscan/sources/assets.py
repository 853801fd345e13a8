"""Asset files: raw bytes and decoded images."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscan.functions.urls import basename


def read_assets(spark: SparkSession, path: str, name_glob: str = "*") -> DataFrame:
    """``(path, filename, length, payload)`` of the files below ``path``; lengths need no read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", name_glob)
    return files.load(path).select(
        "path", basename(F.col("path")).alias("filename"), "length", F.col("content").alias("payload")
    )


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """``(_id, filename, image)``, decoded on the executors; an invalid file has negative sizes."""
    name = basename(F.col("image.origin"))
    return spark.read.format("image").load(path).select(
        F.regexp_replace(name, r"\.[^.]*$", "").alias("_id"), name.alias("filename"), "image"
    )
