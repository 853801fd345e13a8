"""Catalogue tables as parquet, and their schemas."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscan.functions.attributes import COLUMNS
from folioscan.functions.payload import decode, encode
from folioscan.sources.manifest import drop_manifest, read_manifest, settled_encoding, write_manifest
from folioscan.sources.workspace import dropped

_s, _b, _l, _i = T.StringType(), T.BinaryType(), T.LongType(), T.IntegerType()


def _schema(**columns) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


ITEMS = _schema(
    page_id=_l, _id=_s, filename=_s, path=_s, license=_s, license_name=_s, **dict.fromkeys(COLUMNS, _s), col_size=_i
)
IMAGES = _schema(_id=_s, filename=_s, hash_=_b)
LICENSES = _schema(license=_s, license_name=_s, hash_=_b)
ENCODED_IMAGES = _schema(_id=_s, filename=_s, hash_=_s)
ENCODED_LICENSES = _schema(license=_s, license_name=_s, hash_=_s)
FILES = _schema(filename=_s, payload=_b)
ERRORS = _schema(page_id=_l, item_id=_s, stage=_s, message=_s, line=_s)
ATTEMPTS = _schema(item_id=_s, line=_s, attempt=_i, outcome=_s)
OUTCOMES = _schema(page_id=_l, _id=_s, status=_s)

# Table name -> schema. One folder each below the catalogue's root.
TABLES = {
    "items": ITEMS,
    "images": IMAGES,
    "thumbnails": IMAGES,
    "licenses": LICENSES,
    "errors": ERRORS,
    "outcomes": OUTCOMES,
    "attempts": ATTEMPTS,
    # Assets as files, raw whatever the catalogue's encoding: those that an item pass was told to materialise.
    "origin_files": FILES,
    "thumbnail_files": FILES,
    "license_files": FILES,
}

# The same for tables whose payloads are stored as base64 text.
ENCODED = {"images": ENCODED_IMAGES, "thumbnails": ENCODED_IMAGES, "licenses": ENCODED_LICENSES}

# Who wrote a row: a run (a stream, or the batch loads) and its batch. Folders are named by both.
RUN, BATCH = "run", "batch_id"
_WRITER = [T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType())]


def write_items(items: DataFrame, path: str, mode: str = "append") -> None:
    items.write.mode(mode).parquet(path)


def encoded_assets(assets: DataFrame, encoding: str, payload: str = "hash_") -> DataFrame:
    """The asset table with its payload as ``base64`` text, ``zlib`` bytes or ``raw`` bytes."""
    return assets.withColumn(payload, encode(assets[payload], encoding))


def write_assets(assets: DataFrame, path: str, encoding: str = "raw", mode: str = "append") -> None:
    encoded_assets(assets, encoding).write.mode(mode).parquet(path)


def table_schema(name: str, encoding: str) -> T.StructType:
    return ENCODED[name] if encoding == "base64" and name in ENCODED else TABLES[name]


def settle_manifest(spark: SparkSession, root: str, encoding: str | None = None) -> str:
    """The catalogue's encoding, which its first batch settles: later ones may not name another."""
    if read_manifest(spark, root) is None:
        encoding = encoding or "raw"
        write_manifest(spark, root, encoding, {name: table_schema(name, encoding) for name in TABLES})
    return settled_encoding(spark, root, encoding)


def read_table(spark: SparkSession, root: str, name: str, encoding: str | None = None) -> DataFrame:
    """A catalogue table with the run and batch that wrote each row; empty when nothing is stored.

    Payloads are of the type that the catalogue's manifest says; the ``encoding`` of one without is raw unless named.
    """
    if name in ENCODED and encoding is None:
        encoding = settled_encoding(spark, root)
    schema = T.StructType([*table_schema(name, encoding or "raw").fields, *_WRITER])
    try:
        return spark.read.schema(schema).parquet(f"{root}/{name}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_batch(spark: SparkSession, root: str, name: str, batch_id: int, run: str) -> DataFrame:
    """What one batch wrote to a table without payloads. No other folder is listed."""
    return spark.read.schema(TABLES[name]).parquet(f"{root}/{name}/{RUN}={run}/{BATCH}={batch_id}")


def written_by(run: str, batch_id: int) -> Column:
    """Rows of one batch."""
    return (F.col(RUN) == run) & (F.col(BATCH) == batch_id)


def write_batch(rows: DataFrame, root: str, name: str, batch_id: int, run: str) -> None:
    """Write one batch's part of a table. Writing it again replaces it and no other run's or batch's rows."""
    columns = [f.name for f in TABLES[name].fields]
    rows.select(*columns).write.mode("overwrite").parquet(f"{root}/{name}/{RUN}={run}/{BATCH}={batch_id}")


def write_together(tables: dict[str, DataFrame], root: str, batch_id: int, run: str) -> None:
    """Write one batch's part of several tables as concurrent jobs.

    The tables share their inputs and no order, and the last tasks of one job leave cores for the
    next. The first failure is raised after all jobs have ended.
    """
    spark = next(iter(tables.values())).sparkSession
    write = inheritable_thread_target(spark)(write_batch)
    with ThreadPoolExecutor(len(tables)) as pool:
        jobs = [pool.submit(write, rows, root, name, batch_id, run) for name, rows in tables.items()]
    for job in jobs:
        job.result()


def read_payloads(spark: SparkSession, root: str, name: str, payload: str = "hash_") -> DataFrame:
    """``read_table`` with the payloads as raw bytes, whatever they are stored as."""
    encoding = settled_encoding(spark, root)
    return read_table(spark, root, name, encoding).withColumn(payload, decode(F.col(payload), encoding))


def reset_tables(spark: SparkSession, root: str, names=tuple(TABLES)) -> None:
    """Empty the tables; they stay readable. A catalogue that is emptied whole may get another encoding."""
    if set(TABLES) <= set(names):
        drop_manifest(spark, root)
    for name in names:
        dropped(spark, f"{root}/_keys/{name}")
        schema = T.StructType([*TABLES[name].fields, *_WRITER])
        spark.createDataFrame([], schema).write.mode("overwrite").partitionBy(RUN, BATCH).parquet(f"{root}/{name}")
