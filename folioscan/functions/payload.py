"""Binary payloads: base64, zlib, data URIs and thumbnail sizes."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The box a thumbnail fits in and the prefix of an inline image.
THUMBNAIL_BOX = (200, 200)
DATA_URI_PREFIX = "data:image/png;base64,"


def encode_base64(payload: Column) -> Column:
    """Base64 on one line. Spark's own output has CRLF after every 76 characters.

    A byte-wise replace: ``translate`` would look every character up, which costs more than encoding.
    """
    return F.replace(F.base64(payload), F.lit("\r\n"), F.lit(""))


def decode_base64(text: Column) -> Column:
    return F.unbase64(text)


def _each(payload: pa.Array, change: Callable[[pa.Buffer], bytes]) -> pa.Array:
    """Binary values, changed one by one into one buffer: no second copy of a batch on either side; null stays null."""
    data, ends, valid = bytearray(), np.zeros(len(payload) + 1, np.int64), np.zeros(len(payload), bool)
    for at, value in enumerate(payload):
        if value.is_valid:
            valid[at] = True
            data += change(value.as_buffer())
        ends[at + 1] = len(data)
    parts = [np.packbits(valid, bitorder="little"), ends, data]
    return pa.Array.from_buffers(pa.large_binary(), len(payload), [pa.py_buffer(part) for part in parts])


@F.arrow_udf(T.BinaryType())
def compress(payload: pa.Array) -> pa.Array:
    """zlib; Spark has no native expression for it, so Arrow batches, which Spark bounds in bytes, go through Python."""
    return _each(payload, zlib.compress)


@F.arrow_udf(T.BinaryType())
def decompress(payload: pa.Array) -> pa.Array:
    return _each(payload, zlib.decompress)


def encode(payload: Column, encoding: str) -> Column:
    """``base64`` gives text; ``zlib`` and ``raw`` give bytes."""
    if encoding == "base64":
        return encode_base64(payload)
    if encoding == "zlib":
        return compress(encode_base64(payload).cast("binary"))
    if encoding == "raw":
        return payload
    raise ValueError(f"unknown encoding {encoding!r}")


def decode(stored: Column, encoding: str) -> Column:
    if encoding == "base64":
        return decode_base64(stored)
    if encoding == "zlib":
        return decode_base64(decompress(stored).cast("string"))
    if encoding == "raw":
        return stored
    raise ValueError(f"unknown encoding {encoding!r}")


def data_uri(base64_text: Column) -> Column:
    return F.concat(F.lit(DATA_URI_PREFIX), base64_text)


def _closest(exact: Column, error) -> Column:
    """The whole number next to ``exact`` with the smaller aspect error, at least 1."""
    low, high = F.floor(exact), F.ceil(exact)
    return F.greatest(F.when(error(low) <= error(high), low).otherwise(high), F.lit(1))


def fit_box(width: Column, height: Column, box: tuple[int, int] = THUMBNAIL_BOX) -> Column:
    """``struct(width, height)`` of a thumbnail: aspect kept, never enlarged, at least 1 pixel.

    One side takes the box; the other is whichever neighbour of the exact value keeps the aspect
    ratio closest.
    """
    box_w, box_h = F.lit(box[0]), F.lit(box[1])
    aspect = width / height

    def width_error(n):
        return F.abs(aspect - n / box_h)

    def height_error(n):
        return F.when(n == 0, F.lit(0.0)).otherwise(F.abs(aspect - box_w / F.greatest(n, F.lit(1))))

    fits = (width <= box_w) & (height <= box_h)
    by_height = F.lit(box[0] / box[1]) >= aspect
    new_w = F.when(fits, width).when(by_height, _closest(box_h * aspect, width_error)).otherwise(box_w)
    new_h = F.when(fits, height).when(by_height, box_h).otherwise(_closest(box_w / aspect, height_error))
    return F.struct(new_w.cast("int").alias("width"), new_h.cast("int").alias("height"))
