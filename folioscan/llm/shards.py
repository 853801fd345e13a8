"""Token ids in training order: fixed-stride shards behind a keyed permutation.

Texts become sequences of a fixed number of token ids. Sequences are numbered by document id, text and
piece, whatever files and tasks the texts come from, and a keyed Feistel permutation with cycle-walking gives each its slot in the training order, without a sort of
the corpus and without a table of the order: the slot of any number, and back, follows from the key. Slots
are cut into shards by range; a shard is one file of records of equal size, in slot order, so a reader can
go on at any slot.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscan.llm.words import mixed
from folioscan.sources.workspace import checkpointed, new_folder

# Token ids of a sequence, sequences of a shard (16 MB with two bytes an id), and the key of the order.
STRIDE, SHARD_SEQUENCES, KEY = 1024, 8192, 20240917
ROUNDS = 6
# Characters that are encoded at once; longer texts are cut before white space.
PIECE_CHARS = 1_000_000
# Texts, and characters of texts, whose records are made at a time.
TEXTS_AT_ONCE, CHARS_AT_ONCE = 256, 1_000_000
# Documents of a range that are numbered in one task, and documents whose numbers are broadcast at most.
RANGE_ROWS, BROADCAST_ROWS = 1_000_000, 500_000


def permuted(numbers: np.ndarray, total: int, key: int, inverse: bool = False) -> np.ndarray:
    """A permutation of ``0 .. total - 1`` chosen by ``key``, applied to some of these numbers.

    A Feistel network permutes the next power of four; numbers that leave the range walk on along their
    cycle until they are back in it, which takes less than four steps on average.
    """
    half = np.uint64(max((max(total - 1, 1).bit_length() + 1) // 2, 1))
    mask = (np.uint64(1) << half) - np.uint64(1)
    salts = mixed(np.arange(1, ROUNDS + 1, dtype=np.uint64) + np.uint64(key % 2**64))
    out = numbers.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> half, out[walking] & mask
        for salt in salts[::-1] if inverse else salts:
            if inverse:
                left, right = right ^ (mixed(left + salt) & mask), left
            else:
                left, right = right, left ^ (mixed(right + salt) & mask)
        out[walking] = (left << half) | right
        walking = walking[out[walking] >= np.uint64(total)]
    return out.astype(np.int64)


def load_encoding(path: str, pattern: str):
    """The encoding of a rank file, and the id after its last, which ends a document."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return encoding, max(ranks.values()) + 1


def encode(encoding, text: str) -> list[int]:
    """Ids of a whole text."""
    if len(text) <= PIECE_CHARS:
        return encoding.encode_ordinary(text)
    ids, low, blank = [], 0, re.compile(r"(?<=\S)\s")
    while low < len(text):
        found = blank.search(text, low + PIECE_CHARS)
        high = found.start() if found else len(text)
        ids += encoding.encode_ordinary(text[low:high])
        low = high
    return ids


def token_sequences(documents: DataFrame, doc_id: str, text: str, tokenizer: str, pattern: str, stride: int) -> DataFrame:
    """``(doc_id, digest, part, row, piece, pieces, n_tokens, record)``: all sequences of all texts.

    A text's ids and an end id fill records of ``stride`` little-endian numbers, the last one padded with
    end ids that ``n_tokens`` leaves out. ``digest`` is a hash of the text; ``part`` and ``row`` tell the
    rows of the table apart, and nothing else follows from them.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = documents.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(body).alias("digest"),
        F.spark_partition_id().alias("part"), body.alias("text"),
    )
    names = ["row", "piece", "pieces", "n_tokens", "record"]
    kinds = [T.LongType(), T.IntegerType(), T.IntegerType(), T.IntegerType(), T.BinaryType()]
    schema = T.StructType([*rows.schema.fields[:3], *[T.StructField(n, k) for n, k in zip(names, kinds)]])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, end = load_encoding(tokenizer, pattern)
        kind = np.dtype("<u2" if end < 2**16 else "<u4")
        width, before = stride * kind.itemsize, 0
        for batch in batches:
            for part in _portions(batch):
                rows, pieces, counts, records = [], [], [], []
                for i, body in enumerate(part.column(3).to_pylist()):
                    ids = np.array([*encode(encoding, body), end], dtype=kind)
                    n = -(-len(ids) // stride)
                    data = np.concatenate((ids, np.full(n * stride - len(ids), end, kind))).tobytes()
                    records += [data[at : at + width] for at in range(0, len(data), width)]
                    counts += [stride] * (n - 1) + [len(ids) - (n - 1) * stride]
                    rows += [i] * n
                    pieces += range(n)
                take = np.array(rows, np.int64)
                columns = [
                    *[column.take(pa.array(take)) for column in part.columns[:3]],
                    pa.array(take + before),
                    pa.array(pieces, pa.int32()),
                    pa.array(np.bincount(take, minlength=part.num_rows)[take].astype(np.int32)),
                    pa.array(counts, pa.int32()),
                    pa.array(records, pa.binary()),
                ]
                yield pa.record_batch(columns, names=schema.names)
                before += part.num_rows

    return rows.mapInArrow(cut, schema)


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in runs of bounded numbers of texts and characters; a longer text is a run of its own."""
    ends = np.cumsum(pc.binary_length(batch.column(3)).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < batch.num_rows:
        limit = (ends[low - 1] if low else 0) + CHARS_AT_ONCE
        high = min(max(int(np.searchsorted(ends, limit, side="right")), low + 1), low + TEXTS_AT_ONCE)
        yield batch.slice(low, high - low)
        low = high


def first_numbers(stored: DataFrame) -> tuple[DataFrame, int, int]:
    """``(at_part, at_row, first)``, the number of each row's first sequence, with the rows and the sequences.

    Rows are ordered by id (null first) and digest of the text, so the number of a sequence does not depend
    on how the table is split; rows equal in both are the same sequences. Only narrow rows move: they are
    range-sorted, summed up range by range, and one sum per range comes to the driver.
    """
    spark = stored.sparkSession
    order = ["doc_id", "digest", "part", "row"]
    heads = stored.filter("piece = 0").select(*order, "pieces")
    n = heads.count()
    ranges = heads.repartitionByRange(max(-(-n // RANGE_ROWS), 1), *order).withColumn("range", F.spark_partition_id())
    ranges = checkpointed(ranges)
    sums = ranges.groupBy("range").agg(F.sum("pieces").alias("n")).orderBy("range").collect()
    ends = np.cumsum([row["n"] for row in sums]).tolist()
    # As an Arrow table: rows of Python objects would start a second set of Python workers on the executors.
    before = pa.array([end - row["n"] for row, end in zip(sums, ends)], pa.int64())
    offsets = spark.createDataFrame(pa.table({"range": pa.array([row["range"] for row in sums], pa.int32()), "before": before}))
    running = F.sum("pieces").over(Window.partitionBy("range").orderBy(*order)) - F.col("pieces")
    # One row per range, so its size is bounded by the number of documents over ``RANGE_ROWS``.
    numbered = ranges.withColumn("inside", running).join(F.broadcast(offsets), "range")
    first = (F.col("before") + F.col("inside")).alias("first")
    return numbered.select(F.col("part").alias("at_part"), F.col("row").alias("at_row"), first), n, ends[-1] if ends else 0


def write_shards(
    documents: DataFrame, path: str, tokenizer: str, pattern: str, doc_id: str = "doc_id", text: str = "text",
    stride: int = STRIDE, shard_sequences: int = SHARD_SEQUENCES, key: int = KEY,
) -> DataFrame:
    """Write all sequences to ``path`` in training order; gives the stored table.

    Columns: ``slot`` (dense from 0), ``doc_id, piece, n_tokens, record`` and ``shard``, by which the
    folders are named. The same rows and key give the same table, however they are split into files and
    tasks. Records are staged once in the shared folder, and shuffle once, by shard; beyond half a million
    documents once more, to meet their numbers. A null or empty text is one sequence with the end id only.
    Repeated rows are sequences of their own. Null ids stay null, and come first; other columns are left
    out. An empty table writes an empty one.
    """
    spark = documents.sparkSession
    staged = new_folder(spark, "sequences")
    cut = token_sequences(documents, doc_id, text, tokenizer, pattern, stride)
    cut.write.option("compression", "zstd").parquet(staged)
    stored = spark.read.schema(cut.schema).parquet(staged)
    first, n, total = first_numbers(stored)

    @F.pandas_udf("long")
    def slot_of(numbers: pd.Series) -> pd.Series:
        return pd.Series(permuted(numbers.to_numpy(), total, key))

    same = (F.col("part") == F.col("at_part")) & (F.col("row") == F.col("at_row"))
    numbered = stored.join(F.broadcast(first) if n <= BROADCAST_ROWS else first, same)
    slots = numbered.withColumn("slot", slot_of(F.col("first") + F.col("piece")))
    shards = slots.withColumn("shard", F.expr(f"slot div {int(shard_sequences)}"))
    ordered = shards.select("slot", "doc_id", "piece", "n_tokens", "record", "shard")
    # A shard's size is known, so its number needs no sampled ranges.
    ordered = ordered.repartition(max(-(-total // shard_sequences), 1), "shard")
    ordered = ordered.sortWithinPartitions("shard", "slot")
    ordered.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    return read_shards(spark, path, ordered.schema)


def read_shards(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_slots(shards: DataFrame, start: int, stop: int, shard_sequences: int = SHARD_SEQUENCES) -> DataFrame:
    """Sequences of the slots ``start .. stop - 1`` in order: reads only the shards that hold them."""
    inside = F.col("shard").between(start // shard_sequences, max(stop - 1, 0) // shard_sequences)
    return shards.filter(inside & (F.col("slot") >= start) & (F.col("slot") < stop)).orderBy("slot")


def token_ids(record: bytes, n_tokens: int, stride: int = STRIDE) -> list[int]:
    """The ids of one record."""
    return np.frombuffer(record, f"<u{len(record) // stride}")[:n_tokens].tolist()


def shard_digest(shards: DataFrame, shard_sequences: int = SHARD_SEQUENCES) -> DataFrame:
    """Where every sequence lies, with the hash of its stored record."""
    return shards.select(
        "doc_id",
        "piece",
        "slot",
        F.col("shard").cast("bigint").alias("shard"),
        F.pmod("slot", F.lit(shard_sequences)).cast("bigint").alias("row_in_shard"),
        "n_tokens",
        F.sha2("record", 256).alias("record_sha256"),
    )
