"""Semi and anti joins by bitmaps of whole numbers: wide rows stay where they are, however many keys there are.

Keys that agree in all but their low 15 bits are one bucket. A bucket with many keys is a bitmap of 4 KB, one
with few a list of their low bits. Buckets are broadcast; when all of them are more than ``BITMAP_BYTES``, the
wide rows are read in passes, each over a range of keys with the buckets of that range. A range is a filter that
reaches the scan, so rows stored in key order are read once all the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscan.sources.workspace import checkpointed

# Low bits of a key within its bucket, as Spark's bitmaps have them; keys up to which a bucket is a list.
BUCKET_BITS, LISTED_KEYS = 15, 500
# Bytes of the buckets that one pass broadcasts (the driver holds them a few times over), and of a bucket's row beside its keys.
BITMAP_BYTES, ROW_BYTES = 32 << 20, 64


def whole_number(rows: DataFrame, key: str) -> bool:
    return isinstance(rows.schema[key].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))


def _bucket(key: Column) -> Column:
    return F.shiftright(key.cast("bigint"), BUCKET_BITS)


def _place(key: Column) -> Column:
    return key.cast("bigint").bitwiseAND(F.lit((1 << BUCKET_BITS) - 1).cast("bigint"))


def bitmaps(keys: DataFrame, key: str) -> DataFrame:
    """``(bucket, listed, bits, size)`` of distinct keys, stored; null keys belong nowhere."""
    some = keys.filter(F.col(key).isNotNull()).select(_bucket(F.col(key)).alias("bucket"), _place(F.col(key)).alias("place"))
    # A bucket has no more than 32,768 different keys.
    folded = some.groupBy("bucket").agg(
        F.collect_set(F.col("place").cast("smallint")).alias("listed"), F.bitmap_construct_agg("place").alias("bits")
    )
    few = F.size("listed") <= LISTED_KEYS
    return checkpointed(
        folded.select(
            "bucket",
            F.when(few, F.col("listed")).alias("listed"),
            F.when(~few, F.col("bits")).alias("bits"),
            (F.when(few, 2 * F.size("listed")).otherwise(F.octet_length("bits")) + ROW_BYTES).cast("bigint").alias("size"),
        )
    )


def _holds(place: Column) -> Column:
    """Whether a bucket, as ``with_keys`` names its columns, holds a key's low bits."""
    byte = F.substring("_bits", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))
    bit = F.call_function("shiftright", F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(place, F.lit(8)).cast("int"))
    return F.coalesce(F.array_contains("_listed", place.cast("smallint")), F.pmod(bit, F.lit(2)) == 1)


def with_keys(rows: DataFrame, keys: DataFrame, key: str, inside: bool = True) -> DataFrame:
    """Rows whose ``key`` (a whole number) is among ``keys``, or is not, without a shuffle of the rows.

    Rows with a null key are in no set.
    """
    buckets = bitmaps(keys, key)
    size = buckets.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    how, out = "left_semi" if inside else "left_anti", None
    for low, high in _passes(buckets, size):
        of_pass, some = rows, buckets
        if low is not None:
            of_pass, some = of_pass.filter(F.col(key) > (low << BUCKET_BITS) - 1), some.filter(F.col("bucket") >= low)
        if high is not None:
            below = F.col(key) <= (high << BUCKET_BITS) - 1
            of_pass = of_pass.filter(below | F.col(key).isNull() if low is None else below)
            some = some.filter(F.col("bucket") < high)
        # Counted: about BITMAP_BYTES.
        some = some.select(*[F.col(c).alias(f"_{c}") for c in ("bucket", "listed", "bits")])
        match = (_bucket(F.col(key)) == F.col("_bucket")) & _holds(_place(F.col(key)))
        part = of_pass.join(F.broadcast(some), match, how)
        out = part if out is None else out.unionByName(part)
    return out


def _passes(buckets: DataFrame, size: int) -> list[tuple[int | None, int | None]]:
    """Ranges of buckets, open at both ends of the whole, with about ``BITMAP_BYTES`` each."""
    n = -(-size // BITMAP_BYTES)
    if n <= 1:
        return [(None, None)]
    cuts = buckets.agg(F.percentile_approx("bucket", [i / n for i in range(1, n)], 100 * n)).first()[0]
    cuts = sorted({cut + 1 for cut in cuts})
    return list(zip([None, *cuts], [*cuts, None]))
