"""Asset jobs: what is missing, thumbnails, round trips and size profiles."""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from folioscan.functions.payload import THUMBNAIL_BOX, compress, decode, decompress, encode, encode_base64, fit_box
from folioscan.functions.png import png_pixels, png_samples, png_size
from folioscan.operators.errors import thumbnail_error_line
from folioscan.operators.first_writer import insert_if_absent
from folioscan.operators.joins import hot_key_join, not_broadcast
from folioscan.sources.images import packed_images, readable
from folioscan.sources.workspace import new_folder, written


def materialise_missing(
    planned: DataFrame, existing: DataFrame, kinds: dict[str, bool], name: str = "filename", order: str = "page_id"
) -> DataFrame:
    """Planned assets to write: of an enabled kind, with a name that does not exist yet.

    ``planned`` lists ``(kind, name, order, ..)`` without payloads; fetch those for the result only.
    Of several plans for one name the first writes it.
    """
    enabled = [kind for kind, on in kinds.items() if on]
    wanted = planned.filter(F.col("kind").isin(enabled))
    return insert_if_absent(wanted, existing, ["kind", name], [order])


# Spark's image modes (OpenCV codes, 8 bits per channel) and their channel counts.
IMAGE_CHANNELS = {0: 1, 16: 3, 24: 4}
IMAGE_MODES = {channels: mode for mode, channels in IMAGE_CHANNELS.items()}
RGB_MODE = 16


def _sums(lines: np.ndarray, size: int, most: int = 0) -> tuple[np.ndarray, int]:
    """``size`` rows, each the weighted sum of the rows it covers, and the sum of its weights, which are whole numbers.

    All new rows at once, by the first row that each covers, by the second and so on. Rows are floats or whole numbers
    up to ``most``, whose sums are as narrow as they can be.
    """
    shared = math.gcd(len(lines), size)
    length, unit = len(lines) // shared, size // shared
    kind = float if lines.dtype.kind == "f" else np.min_scalar_type(most * length)
    start = np.arange(size) * length
    first, out = start // unit, None
    for i in range(-(-length // unit) + 1):
        row = first + i
        part = np.minimum((row + 1) * unit, start + length) - np.maximum(row * unit, start)
        if (part > 0).any():
            weights = np.maximum(part, 0).astype(kind)[:, None]
            added = np.multiply(lines.take(np.minimum(row, len(lines) - 1), 0), weights, dtype=kind)
            out = added if out is None else np.add(out, added, out=out)
    return out, length


def _shrink(pixels: np.ndarray, size: int, axis: int) -> np.ndarray:
    """Area average along one axis."""
    if size == pixels.shape[axis]:
        return pixels
    front = np.moveaxis(pixels.astype(float), axis, 0)
    sums, weight = _sums(front.reshape(len(front), -1), size)
    return np.moveaxis((sums / weight).reshape(size, *front.shape[1:]), 0, axis)


def _png(rgb: np.ndarray) -> bytes:
    """An 8-bit RGB image as an unfiltered PNG."""

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    height, width, _ = rgb.shape
    rows = np.concatenate([np.zeros((height, 1), np.uint8), rgb.reshape(height, width * 3)], axis=1)
    header = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    body = zlib.compress(rows.tobytes())
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", body) + chunk(b"IEND", b"")


# Rows of one shared image that one task may get, and different images that one task decodes.
ROWS_PER_IMAGE, IMAGES_PER_TASK = 20_000, 500
# Bytes of images or thumbnails that a task hands over at once: a batch for each costs more than a small image.
BYTES_AT_ONCE = 4 << 20
_IMAGE = "struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>"


def _different(images: DataFrame, payload: str) -> tuple[DataFrame, DataFrame, int]:
    """``(digests, payloads, n)``: a narrow, stored row per row, and each of ``n`` different payloads that can be read, once.

    ``payloads`` has ``digest, payload`` and ``size``, what the header of a plain PNG names.
    """
    data = F.col(payload)
    rows = images.select("_id", "filename", payload)
    digests = written(rows.select("_id", "filename", F.when(readable(data), F.sha2(data, 256)).alias("digest")), "image-digests")
    folded = rows.filter(readable(data)).groupBy(F.sha2(data, 256).alias("digest")).agg(F.first(payload).alias("payload"))
    n = digests.agg(F.count_distinct("digest")).first()[0]
    return digests, folded.withColumn("size", png_size(F.col("payload"))), n


def _dealt(payloads: DataFrame, n: int, *by: str) -> DataFrame:
    """Payloads spread by number: time goes by pixels, and few bytes may hold many."""
    return payloads.repartition(max(4 * payloads.sparkSession.sparkContext.defaultParallelism, n // IMAGES_PER_TASK), *by)


def _owners(digests: DataFrame) -> DataFrame:
    """``(digest, split, rows)``: the rows that share a payload, ``ROWS_PER_IMAGE`` of them or about that many in one list."""
    some = digests.filter("digest is not null")
    counts = some.groupBy("digest").agg(F.count("*").alias("n")).filter(F.col("n") > ROWS_PER_IMAGE)
    hot = counts.select("digest", F.ceil(F.col("n") / F.lit(ROWS_PER_IMAGE)).cast("bigint").alias("splits"))
    cut = some.join(F.broadcast(hot), "digest", "left")
    split = F.pmod(F.monotonically_increasing_id(), F.coalesce("splits", F.lit(1).cast("bigint"))).alias("split")
    row = F.struct("_id", "filename")
    return cut.select("digest", split, row.alias("row")).groupBy("digest", "split").agg(F.collect_list("row").alias("rows"))


def _left_over(made: DataFrame) -> DataFrame | None:
    """Payloads that were not decoded in their task, as a table of images; null if there are none."""
    rest = made.filter("rest is not null").select(
        F.col("digest").alias("_id"), F.lit(None).cast("string").alias("filename"), F.col("rest").alias("hash_")
    )
    return None if rest.isEmpty() else rest


def decode_images(images: DataFrame, payload: str = "hash_") -> DataFrame:
    """``(_id, filename, image)`` of stored image bytes, as ``thumbnail_job`` takes them, stored.

    Plain PNG is decoded in the task that has its bytes. Other images Spark decodes from files only; see
    ``packed_images``. Read are PNG, JPEG, GIF, BMP and what else Java reads. Bytes that cannot be read keep their row
    with a null image. The rows that share a payload travel with it as a list, so its pixels are written once for each
    list and shuffle nowhere; for thumbnails alone ``stored_thumbnails`` moves less.
    """
    digests, payloads, n = _different(images, payload)
    owned = _dealt(payloads.join(not_broadcast(_owners(digests)), "digest"), n, "digest", "split")
    schema = T.StructType.fromDDL(f"digest string, image {_IMAGE}, rest binary").add(owned.schema["rows"])
    arrow_schema = to_arrow_schema(schema)

    def decode_plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, held, decoded, rest, payloads = 0, 0, [], [], batch.column("payload")
            for at, size in enumerate(batch.column("size").to_pylist()):
                data = payloads[at].as_py()
                pixels = size and png_pixels(data, **size)
                image = None
                if pixels is not None:
                    height, width, channels = pixels.shape
                    image = {
                        "origin": "", "height": height, "width": width, "nChannels": channels,
                        "mode": IMAGE_MODES[channels], "data": pixels.tobytes(),
                    }
                decoded.append(image)
                rest.append(data if image is None else None)
                held += len(data) if image is None else len(image["data"])
                if held > BYTES_AT_ONCE or at + 1 == batch.num_rows:
                    made = {"digest": _part(batch, "digest", low, at), "image": decoded, "rest": rest, "rows": _part(batch, "rows", low, at)}
                    yield _batch(made, arrow_schema)
                    low, held, decoded, rest = at + 1, 0, [], []

    made = written(owned.select("digest", "rows", "payload", "size").mapInArrow(decode_plain, schema), "plain-images")
    row = F.explode("rows").alias("row")
    found = made.filter("rest is null").select(row, "image").select("row.*", "image")
    unread = digests.filter("digest is null").select("_id", "filename")
    rest = _left_over(made)
    if rest is not None:
        with packed_images(rest) as packed:
            decoded = written(packed.images.join(packed.places, "place").select("digest", "image"), "decoded")
        others = made.filter("rest is not null").select(row, "digest").select("row.*", "digest")
        found = found.unionByName(hot_key_join(others, decoded, "digest", ["_id"], "left", ROWS_PER_IMAGE).drop("digest"))
    return found.unionByName(unread.withColumn("image", F.lit(None).cast(_IMAGE)))


def _part(batch: pa.RecordBatch, column: str, low: int, last: int) -> pa.Array:
    return batch.column(column).slice(low, last + 1 - low)


def _batch(columns: dict[str, list | pa.Array], schema: pa.Schema) -> pa.RecordBatch:
    """Columns, some of them as they came, by the names of a schema."""
    arrays = [columns[f.name] for f in schema]
    return pa.RecordBatch.from_arrays(
        [a.cast(f.type) if isinstance(a, pa.Array) else pa.array(a, f.type) for a, f in zip(arrays, schema)], schema=schema
    )


def stored_thumbnails(images: DataFrame, payload: str = "hash_", box: tuple[int, int] = THUMBNAIL_BOX) -> DataFrame:
    """``thumbnail_job`` over stored image bytes (``_id, filename, payload``): each different payload is decoded and shrunk once.

    Plain PNG is shrunk in the task that has its bytes, so its pixels move nowhere; other images go through
    ``packed_images``. Neither payloads nor pixels meet the rows that share them; thumbnails do, by digest, a shared
    one split.
    """
    digests, payloads, n = _different(images, payload)
    sized = _dealt(payloads, n, "digest").withColumn("to", fit_box(F.col("size.width"), F.col("size.height"), box))
    schema = "digest string, width int, height int, hash_ binary, rest binary"
    arrow_schema = to_arrow_schema(T.StructType.fromDDL(schema))

    def shrink_plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, held, out, payloads = 0, 0, {name: [] for name in ("width", "height", "hash_", "rest")}, batch.column("payload")
            for at, (size, to) in enumerate(zip(batch.column("size").to_pylist(), batch.column("to").to_pylist())):
                data = payloads[at].as_py()
                samples = size and png_samples(data, **size)
                made = {"rest": data} if samples is None else {"hash_": _shrunk(samples, to["height"], to["width"], (0, 1, 2)), **to}
                for name, values in out.items():
                    values.append(made.get(name))
                held += len(data if samples is None else made["hash_"])
                if held > BYTES_AT_ONCE or at + 1 == batch.num_rows:
                    yield _batch({"digest": _part(batch, "digest", low, at), **out}, arrow_schema)
                    low, held, out = at + 1, 0, {name: [] for name in out}

    made = written(sized.mapInArrow(shrink_plain, schema), "plain-thumbnails")
    by_digest, rest = made.filter("rest is null").drop("rest"), _left_over(made)
    if rest is not None:
        with packed_images(rest) as packed:
            named = packed.images.select(F.col("place").alias("_id"), F.lit(None).cast("string").alias("filename"), "image")
            filed = written(thumbnail_job(named, box).withColumnRenamed("_id", "place").drop("filename"), "shrunk")
            by_digest = by_digest.unionByName(filed.join(packed.places, "place").drop("place"))
    joined = hot_key_join(digests, by_digest, "digest", ["_id"], "left", ROWS_PER_IMAGE)
    return joined.select(*_THUMBNAIL.names)


def _shrunk(pixels: np.ndarray, to_height: int, to_width: int, order: tuple[int, ...] = (2, 1, 0)) -> bytes:
    """Pixels, grey or BGR(A) unless ``order`` names the places of red, green and blue, to the PNG of an RGB thumbnail.

    Area averages of whole numbers: sums are exact, and rounded once.
    """
    height, width, channels = pixels.shape
    order, small, weight = (0,) * 3 if channels == 1 else order, pixels, 1
    if to_height != height:
        small, weight = _sums(small.reshape(height, -1), to_height, 255)
        small = small.reshape(to_height, width, channels)
    if to_width != width:
        # By column, the channels apart.
        columns = np.empty((width, 3, to_height), small.dtype)
        for i, channel in enumerate(order):
            columns[:, i] = small[:, :, channel].T
        small, across = _sums(columns.reshape(width, -1), to_width, 255 * weight)
        weight *= across
        small = small.reshape(to_width, 3, to_height).transpose(2, 0, 1)
    else:
        small = small[:, :, order]
    if weight > 1:
        small = np.rint(small / weight).astype(np.uint8)
    return _png(np.ascontiguousarray(small))


def _thumbnail(data: bytes, height: int, width: int, mode: int, to_height: int, to_width: int) -> bytes:
    return _shrunk(np.frombuffer(data, np.uint8).reshape(height, width, IMAGE_CHANNELS[mode]), to_height, to_width)


_THUMBNAIL = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("hash_", T.BinaryType()),
    ]
)


def thumbnail_job(images: DataFrame, box: tuple[int, int] = THUMBNAIL_BOX) -> DataFrame:
    """``(_id, filename, width, height, hash_)``: the RGB thumbnail of every image as PNG bytes.

    ``images`` has ``_id``, ``filename`` and Spark's image struct, decoded by the executors. Sizes
    are a native expression; only the pixel work is Python. An image that cannot be used keeps its
    row with null size and payload (see ``thumbnail_errors``). No shuffle.
    """
    image, sized = F.col("image"), F.col("size")
    usable = (
        (image["width"] > 0)
        & (image["height"] > 0)
        & image["mode"].isin(list(IMAGE_CHANNELS))
        & (F.octet_length(image["data"]) == image["width"] * image["height"] * image["nChannels"])
    )
    size = F.when(usable, fit_box(image["width"], image["height"], box))
    narrow = images.select("_id", "filename", "image", size.alias("size")).select(
        "_id",
        "filename",
        sized["width"].alias("width"),
        sized["height"].alias("height"),
        image["height"].alias("from_height"),
        image["width"].alias("from_width"),
        image["mode"].alias("mode"),
        F.when(usable, image["data"]).alias("data"),
    )
    arrow_schema = to_arrow_schema(_THUMBNAIL)

    def resize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                # One image at a time: pixels are large, thumbnails are not.
                row = batch.slice(at, 1).to_pylist()[0]
                small = None
                if row["data"] is not None:
                    small = _thumbnail(
                        row["data"], row["from_height"], row["from_width"], row["mode"], row["height"], row["width"]
                    )
                out = {"hash_": small, **{k: row[k] for k in ("_id", "filename", "width", "height")}}
                yield pa.RecordBatch.from_pylist([out], schema=arrow_schema)

    return narrow.mapInArrow(resize, _THUMBNAIL)


def thumbnail_errors(thumbnails: DataFrame) -> DataFrame:
    failed = thumbnails.filter(F.col("hash_").isNull())
    return failed.select("_id", thumbnail_error_line(F.col("filename")).alias("line"))


def thumbnail_rows(thumbnails: DataFrame) -> DataFrame:
    return thumbnails.filter(F.col("hash_").isNotNull()).select("_id", "filename", "hash_")


def roundtrip_check(payloads: DataFrame, key: str, payload: str, encoding: str) -> DataFrame:
    """``(encoding, payloads, mismatches)`` after encode, store, read and decode.

    Digests and lengths are compared, so the join that finds lost rows moves a few bytes per payload
    and never the payloads.
    """
    spark = payloads.sparkSession
    path = new_folder(spark, f"roundtrip-{encoding}")
    payloads.select(key, encode(F.col(payload), encoding).alias("stored")).write.parquet(path)
    back = decode(F.col("stored"), encoding)

    def digest(value):
        return F.struct(F.sha2(value, 256), F.octet_length(value))

    sent = payloads.select(key, digest(F.col(payload)).alias("sent"))
    read = spark.read.parquet(path).select(key, back.alias("back")).select(key, digest(F.col("back")).alias("read"))
    both = sent.join(read, key, "full")
    return both.agg(
        F.lit(encoding).alias("encoding"),
        F.count("*").alias("payloads"),
        F.count_if(~F.col("sent").eqNullSafe(F.col("read"))).alias("mismatches"),
    )


def payload_sizes(payloads: DataFrame, payload: str) -> DataFrame:
    """Adds ``raw_size``, ``base64_size``, ``compressed_size`` and ``restored_size``."""
    encoded = payloads.withColumn("encoded", encode_base64(F.col(payload)))
    packed = encoded.withColumn("packed", compress(F.col("encoded").cast("binary")))
    return packed.select(
        *[c for c in payloads.columns if c != payload],
        F.octet_length(payload).alias("raw_size"),
        F.length("encoded").alias("base64_size"),
        F.octet_length("packed").alias("compressed_size"),
        F.octet_length(decompress(F.col("packed"))).alias("restored_size"),
    )


def size_profile(payloads: DataFrame, payload: str, by: list[str]) -> DataFrame:
    """Total sizes per group; partial sums leave each task before the shuffle."""
    sizes = ["raw_size", "base64_size", "compressed_size", "restored_size"]
    return (
        payload_sizes(payloads.select(*by, payload), payload)
        .groupBy(*by)
        .agg(F.count("*").alias("payloads"), *[F.sum(s).cast("bigint").alias(s) for s in sizes])
    )
