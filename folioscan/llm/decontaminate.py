"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short and documents long, so Jaccard similarity says nothing; what counts is the share
of an item's shingles that a document holds. Items are partitioned by their number of shingles, and
each is sketched by its ``k`` smallest shingle hashes (bottom-k MinHash). ``k`` belongs to the
partition: it is one more than the shingles that an item of the partition's largest size may miss, so a
document that holds enough of an item holds one of its sketch values at least, however long it is.
Candidates found this way are verified by exact shingle containment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from folioscan.llm.names import filtered_in_arrow
from folioscan.llm.words import WordReader, distinct_per_row, plain_words, sliced

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
# Item hashes that one pass over the documents carries to the tasks: 32 MB of values.
HASHES_PER_PASS = 4_000_000

_ITEM = T.StructType(
    [T.StructField("size", T.IntegerType()), T.StructField("hashes", T.ArrayType(T.LongType()))]
)


def sketch_size(shingles: int, containment: float) -> int:
    """Sketch values for an item: partitions hold the sizes from a power of two up to the next."""
    largest = (1 << int(shingles).bit_length()) - 1
    return min(shingles, int(np.floor((1 - containment) * largest + 1e-9)) + 1)


def item_shingles(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``(item_id, size, hashes)``: the distinct shingles of every item that has words.

    ``size`` is the words per shingle: five, or all words of a shorter item.
    """
    chosen = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    schema = T.StructType([chosen.schema["item_id"], *_ITEM.fields])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = WordReader(plain_words())
        for batch in batches:
            ids, sizes, hashes = [], [], []
            names = batch.column(0).to_pylist()
            for low, high, words in reader.read(batch.column(1)):
                value, row = words.shingles(SHINGLE_WORDS)
                value, row, _ = distinct_per_row(value, row)
                counts = np.diff(words.first)
                for i in np.flatnonzero(counts):
                    ids.append(names[low + i])
                    sizes.append(min(SHINGLE_WORDS, int(counts[i])))
                    hashes.append(value[row == i].astype(np.int64))
            yield pa.record_batch(
                [
                    pa.array(ids, batch.schema.field(0).type),
                    pa.array(sizes, pa.int32()),
                    pa.array(hashes, pa.list_(pa.int64())),
                ],
                names=schema.names,
            )

    return chosen.mapInArrow(cut, schema)


class ItemIndex:
    """Sketches and shingles of some items ``(item_id, size, sorted hashes)``, ready for searches."""

    def __init__(self, items: list[tuple], containment: float):
        self.containment = containment
        self.ids = [item_id for item_id, _, _ in items]
        self.shingles = [hashes for _, _, hashes in items]
        self.by_size = {}
        for size in sorted({size for _, size, _ in items}):
            chosen = [i for i, item in enumerate(items) if item[1] == size]
            lowest = [
                self.shingles[i][: sketch_size(len(self.shingles[i]), containment)] for i in chosen
            ]
            value, owner = np.concatenate(lowest), np.repeat(chosen, [len(x) for x in lowest])
            order = np.argsort(value, kind="stable")
            self.by_size[size] = value[order], owner[order]

    def search(self, words) -> Iterator[tuple[int, int, int]]:
        """``(row, item, shared shingles)`` of every row that holds enough of an item."""
        for size, (sketch, owner) in self.by_size.items():
            value, row = words.shingles(size)
            at = np.searchsorted(sketch, value)
            hit = sketch[np.minimum(at, len(sketch) - 1)] == value
            last = np.searchsorted(sketch, value[hit], "right")
            pairs = {
                (int(r), int(item))
                for r, low, high in zip(row[hit], at[hit], last)
                for item in owner[low:high]
            }
            bounds = np.searchsorted(row, np.arange(len(words.first)))
            for r, item in sorted(pairs):
                mine = self.shingles[item]
                shared = int(np.isin(mine, value[bounds[r] : bounds[r + 1]]).sum())
                if shared >= self.containment * len(mine) - 1e-9:
                    yield r, item, shared


def item_blocks(items: DataFrame, hashes_per_pass: int) -> Iterator[list[tuple]]:
    """Items in blocks of bounded size, streamed through the driver."""
    block, held = [], 0
    for item_id, size, hashes in items.toLocalIterator():
        if block and held + len(hashes) > hashes_per_pass:
            yield block
            block, held = [], 0
        block.append((item_id, size, np.sort(np.array(hashes, np.int64).astype(np.uint64))))
        held += len(hashes)
    if block:
        yield block


def find_items(
    documents: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    containment: float = CONTAINMENT,
    hashes_per_pass: int = HASHES_PER_PASS,
) -> DataFrame:
    """``(doc_id, item_id, n_item, n_shared, containment)`` for every document that holds an item.

    Narrow: documents never shuffle. Items are the stated query set and go to the tasks in blocks of
    at most ``hashes_per_pass`` shingle hashes, one pass over the documents for each block.
    Null or empty texts hold nothing; items without words are found nowhere. A repeated row or item
    gives a repeated row. Null ids are kept as they are. No items: no rows.
    """
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    cut = item_shingles(items, item_id, item_text)
    schema = T.StructType(
        [rows.schema["doc_id"], cut.schema["item_id"]]
        + [T.StructField(name, T.LongType()) for name in ("n_item", "n_shared")]
        + [T.StructField("containment", T.DoubleType())]
    )
    item_type = to_arrow_type(cut.schema["item_id"].dataType)
    found = None
    for block in item_blocks(cut, hashes_per_pass):
        held = documents.sparkSession.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            reader, index = WordReader(plain_words()), ItemIndex(held.value, containment)
            for batch in sliced(batches):
                at, item, shared = [], [], []
                for low, _, words in reader.read(batch.column(1)):
                    for r, i, n in index.search(words):
                        at.append(low + r)
                        item.append(i)
                        shared.append(n)
                size = [len(index.shingles[i]) for i in item]
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array(at, pa.int64())),
                        pa.array([index.ids[i] for i in item], item_type),
                        pa.array(size, pa.int64()),
                        pa.array(shared, pa.int64()),
                        pa.array([n / m for n, m in zip(shared, size)], pa.float64()),
                    ],
                    names=schema.names,
                )

        part = rows.mapInArrow(search, schema)
        found = part if found is None else found.unionByName(part)
    return documents.sparkSession.createDataFrame([], schema) if found is None else found


def drop_contaminated(
    documents: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    containment: float = CONTAINMENT,
    hashes_per_pass: int = HASHES_PER_PASS,
) -> DataFrame:
    """The documents, with all their columns, that hold none of the items; see ``find_items``."""
    kept = documents
    at = documents.columns.index(text)
    for block in item_blocks(item_shingles(items, item_id, item_text), hashes_per_pass):
        held = documents.sparkSession.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            reader, index = WordReader(plain_words()), ItemIndex(held.value, containment)
            for batch in sliced(batches):
                keep = np.ones(batch.num_rows, dtype=bool)
                for low, _, words in reader.read(batch.column(at)):
                    for r, _, _ in index.search(words):
                        keep[low + r] = False
                yield batch.filter(pa.array(keep))

        kept = filtered_in_arrow(kept, clean)
    return kept
