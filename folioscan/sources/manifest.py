"""The catalogue's manifest: how payloads are encoded and which columns the tables have, written once.

One small JSON file beside the tables. Its name begins with an underscore, so table readers pass it over.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from folioscan.sources.workspace import dropped

MANIFEST = "_catalogue.json"
ENCODINGS = ("raw", "base64", "zlib")


def _file(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{MANIFEST}")
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def read_manifest(spark: SparkSession, root: str) -> dict | None:
    """``{"encoding", "tables": {name: schema}}`` of the catalogue below ``root``; null when it has none."""
    path, files = _file(spark, root)
    if not files.exists(path):
        return None
    stream = files.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_manifest(spark: SparkSession, root: str, encoding: str, tables: dict[str, T.StructType]) -> None:
    whole = {"encoding": encoding, "tables": {name: schema.jsonValue() for name, schema in tables.items()}}
    path, files = _file(spark, root)
    stream = files.create(path, True)
    try:
        stream.write(bytearray(json.dumps(whole, indent=1).encode()))
    finally:
        stream.close()


def drop_manifest(spark: SparkSession, root: str) -> None:
    dropped(spark, f"{root}/{MANIFEST}")


def settled_encoding(spark: SparkSession, root: str, encoding: str | None = None) -> str:
    """The encoding of the catalogue's payloads. Naming another one than it is stored in is an error.

    A catalogue without a manifest has what the caller names, raw bytes if nothing.
    """
    if encoding is not None and encoding not in ENCODINGS:
        raise ValueError(f"unknown encoding {encoding!r}")
    known = read_manifest(spark, root)
    if known is None:
        return encoding or "raw"
    if encoding not in (None, known["encoding"]):
        raise ValueError(f"payloads of {root} are stored as {known['encoding']}, not as {encoding}")
    return known["encoding"]
