"""N-gram Jaccard join with Bayesian candidate pruning.

Texts with the same set of five-word shingles are one class. Classes that share a band of MinHash values
are brought into one candidate group (no pair is written down for that). Inside a group MinHash values
are compared a few at a time; after each few, pairs drop out whose posterior probability of reaching the
threshold is below the tolerance. What is left is verified by exact intersections. Large groups are cut
into blocks, and a task compares two blocks, so no task holds more than a bounded number of texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscan.llm.components import components
from folioscan.llm.names import free_names, quoted
from folioscan.llm.words import WordReader, distinct_per_row, mixed, per_row, plain_words, sliced
from folioscan.operators.joins import hot_key_join
from folioscan.sources.workspace import checkpointed, written

SHINGLE_WORDS = 5
THRESHOLD = 0.8
# Bands of MinHash values: a pair at the threshold shares none with probability (1 - 0.8**5)**24 < 1e-4.
BANDS, BAND_VALUES = 24, 5
# MinHash values compared at a time in a group, and in all; posterior below which a pair is dropped.
STEP_VALUES, SIGNATURE_VALUES = 16, 64
TOLERANCE = 1e-6
# Classes and shingles of one block; a task holds two blocks.
BLOCK_CLASSES, BLOCK_SHINGLES = 256, 400_000
# Rows of ids that are broadcast at most.
BROADCAST_IDS = 500_000


def multipliers(count: int, seed: int) -> np.ndarray:
    """Odd factors, one for each MinHash value."""
    return np.random.default_rng(seed).integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """By step: the fewest equal values with which a pair may still reach the threshold.

    With a uniform prior and ``m`` of ``n`` values equal, the posterior probability of a similarity of at
    least ``t`` is that of at most ``m`` successes in ``n + 1`` trials of probability ``t``.
    """
    bounds = []
    for n in range(STEP_VALUES, SIGNATURE_VALUES + 1, STEP_VALUES):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        bounds.append(m)
    return bounds


def _fixed_binary(words: np.ndarray) -> pa.Array:
    """Rows of 64-bit values as binary values."""
    width = words.shape[1] * 8
    offsets = np.arange(len(words) + 1, dtype=np.int32) * width
    data = pa.py_buffer(np.ascontiguousarray(words).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(offsets.tobytes()), data])


def row_key(documents: DataFrame, columns: list[str]):
    """A hash that tells rows of one id apart. Maps, which have no hash, count as their JSON."""
    kinds = {c: documents.schema[c].dataType.simpleString() for c in columns}
    values = [(F.to_json(F.struct(F.col(q).alias("m"))) if "map<" in kinds[c] else F.col(q)) for c, q in zip(columns, quoted(columns))]
    return F.xxhash64(*values)


def sketches(documents: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``(keys.., class, n, bands)``: a hash of the shingle set, its size, and one hash per band."""
    rows = documents.select(*keys, text)
    schema = T.StructType(
        rows.schema.fields[:-1]
        + [
            T.StructField("class", T.BinaryType()),
            T.StructField("n", T.LongType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, factors = WordReader(plain_words()), multipliers(BANDS * BAND_VALUES, 11)
        top = np.uint64(2**64 - 1)
        for batch in sliced(batches):
            sets, sizes, bands = [], [], []
            for low, high, words in reader.read(batch.column(len(keys))):
                value, row = words.shingles(SHINGLE_WORDS)
                value, row, _ = distinct_per_row(value, row)
                bounds = np.searchsorted(row, np.arange(high - low + 1))
                sizes.append(np.diff(bounds))
                halves = [per_row(mixed(value ^ np.uint64(salt)), bounds, np.add, np.uint64(0)) for salt in (1, 2)]
                sets.append(np.stack(halves, axis=1))
                found = np.zeros((high - low, BANDS), dtype=np.uint64)
                for i, factor in enumerate(factors):
                    least = per_row(value * factor, bounds, np.minimum, top)
                    found[:, i // BAND_VALUES] = mixed(found[:, i // BAND_VALUES] + least + np.uint64(i))
                bands.append(found)
            n = batch.num_rows
            flat = (np.concatenate(bands) if bands else np.zeros((0, BANDS), np.uint64)).astype(np.int64)
            ends = pa.array(np.arange(n + 1, dtype=np.int32) * BANDS)
            columns = [
                _fixed_binary(np.concatenate(sets) if sets else np.zeros((0, 2), np.uint64)),
                pa.array(np.concatenate(sizes) if sizes else [], pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(flat.ravel())),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=schema.names)

    return rows.mapInArrow(sketch, schema)


def _shingle_sets(texts: DataFrame) -> DataFrame:
    """``(class, label, blocks, shingles)`` from ``(class, label, blocks, text)``."""
    schema = "class binary, label binary, blocks bigint, shingles binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = WordReader(plain_words())
        for batch in sliced(batches):
            for low, high, words in reader.read(batch.column(3)):
                value, row = words.shingles(SHINGLE_WORDS)
                value, row, _ = distinct_per_row(value, row)
                bounds = np.searchsorted(row, np.arange(high - low + 1)) * 8
                data = value.tobytes()
                sets = pa.array([data[a:b] for a, b in zip(bounds, bounds[1:])], pa.binary())
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], sets], names=["class", "label", "blocks", "shingles"]
                )

    return texts.select("class", "label", "blocks", "text").mapInArrow(cut, schema)


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 matrices over the shared shingles."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    column = np.cumsum(shared) - 1
    keep = shared[code]
    owner, column = owner[keep], column[code][keep]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(sets), len(sets)), dtype=np.float64)
    width = 4096
    for start in range(0, int(shared.sum()), width):
        low, high = np.searchsorted(column, [start, start + width])
        dense = np.zeros((len(sets), width), dtype=np.float32)
        dense[owner[low:high], column[low:high] - start] = 1
        total += dense @ dense.T
    return total


def linked_pairs(sets: list[np.ndarray], side: np.ndarray | None, threshold: float, bounds: list[int]) -> np.ndarray:
    """A symmetric matrix of the pairs that reach the threshold; with ``side``, only pairs of different sides."""
    size = np.array([len(s) for s in sets])
    ends = np.concatenate(([0], np.cumsum(size)))
    values = np.concatenate(sets)
    alive = ~np.eye(len(sets), dtype=bool)
    if side is not None:
        alive &= side[:, None] != side[None, :]
    if not alive.any():
        return alive
    matches = np.zeros(alive.shape, dtype=np.int16)
    for i, factor in enumerate(multipliers(SIGNATURE_VALUES, 13)):
        least = np.minimum.reduceat(values * factor, ends[:-1])
        matches += least[:, None] == least[None, :]
        if (i + 1) % STEP_VALUES == 0:
            alive &= matches >= bounds[i // STEP_VALUES]
            if not alive.any():
                return alive
    left = np.flatnonzero(alive.any(axis=1))
    shared = _intersections([sets[i] for i in left])
    union = size[left][:, None] + size[left][None, :] - shared
    alive[np.ix_(left, left)] &= shared >= threshold * union - 1e-9
    return alive


def _verified(groups: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """``(class, links, root)``: by pair of blocks, the links of a class and the smallest class it reaches."""
    bounds = least_matches(threshold, tolerance)

    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("class").sort_values("class")
        sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
        # Two blocks by the task's key: either may be empty, and pairs inside one belong to its own task.
        low, high = rows["low"].iloc[0], rows["high"].iloc[0]
        side = (rows["block"] != low).to_numpy() if low != high else None
        link = linked_pairs(sets, side, threshold, bounds)
        root = np.arange(len(sets))
        while True:
            near = np.where(link, root[None, :], len(sets)).min(axis=1, initial=len(sets))
            lower = np.minimum(root, near)
            if (lower == root).all():
                break
            root = lower
        n = link.sum(axis=1)
        kept = n > 0
        names = rows["class"].to_numpy()
        return pd.DataFrame({"class": names[kept], "links": n[kept].astype(np.int64), "root": names[root[kept]]})

    return groups.groupBy("label", "low", "high").applyInPandas(verify, "class binary, links bigint, root binary")


def jaccard_classes(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
    threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
) -> tuple[DataFrame, DataFrame]:
    """``(members, classes)`` of all documents, both stored.

    ``members``: ``doc_id, row_key, class``, one per row. ``classes``, one per different shingle set:
    ``class``, ``rep`` (the first of its rows: ``missing, doc_id, row_key, times``), ``n_copies``,
    ``n_links`` (other classes at or above the threshold), ``group`` (the smallest class it is linked to,
    directly or through others).
    """
    columns = documents.columns
    rows = documents.select(
        F.col(doc_id).alias("doc_id"), row_key(documents, columns).alias("row_key"), F.col(text).alias("text")
    )
    sketched = written(sketches(rows, ["doc_id", "row_key"]), "sketches")
    same = sketched.groupBy("class", "doc_id", "row_key").agg(
        F.count("*").alias("times"), F.first("n").alias("n"), F.first("bands").alias("bands")
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row_key", "times", "n", "bands"))
    classes = written(same.groupBy("class").agg(first.alias("rep"), F.sum("times").alias("n_copies")), "classes")

    entries = classes.filter("rep.n > 0").select("class", F.explode("rep.bands").alias("band"))
    buckets = entries.groupBy("band").agg(F.min("class").alias("leader"), F.count("*").alias("n"))
    shared = buckets.filter("n > 1").drop("n")
    stars = entries.join(shared, "band").select(F.col("class").alias("a"), F.col("leader").alias("b"))
    coarse = checkpointed(components(stars.filter("a != b").distinct()))

    sized = classes.select("class", "rep.doc_id", "rep.row_key", "rep.times", F.col("rep.n").alias("n"))
    inside = coarse.select(F.col("node").alias("class"), "label").join(sized, "class")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_CLASSES), F.ceil(F.sum("n") / BLOCK_SHINGLES))
    # Only large groups have more than one block, so a hot label meets a short list.
    large = checkpointed(inside.groupBy("label").agg(blocks.cast("bigint").alias("blocks")).filter("blocks > 1"))
    large = F.broadcast(large) if large.count() <= BROADCAST_IDS else large
    wanted = checkpointed(inside.drop("n").join(large, "label", "left").fillna({"blocks": 1}))
    texts = _class_texts(rows, wanted)
    placed = _shingle_sets(texts).withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    paired = placed.withColumn("other", other).withColumns(
        {"low": F.least("block", "other"), "high": F.greatest("block", "other")}
    )
    verified = written(_verified(paired.drop("blocks", "other"), threshold, tolerance), "links")

    links = verified.groupBy("class").agg(F.sum("links").alias("n_links"))
    joined = components(verified.select(F.col("class").alias("a"), F.col("root").alias("b")))
    known = links.join(joined.withColumnRenamed("node", "class"), "class")
    full = classes.join(known, "class", "left").select(
        "class",
        F.struct("rep.missing", "rep.doc_id", "rep.row_key", "rep.times").alias("rep"),
        "n_copies",
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        F.coalesce("label", "class").alias("group"),
    )
    return sketched.select("doc_id", "row_key", "class"), checkpointed(full)


def _class_texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wanted rows with their texts, one for each class, also where rows are equal in id and text.

    Equal rows are folded in the tasks that read them, before they move.
    """
    single = _with_ids(rows, wanted.filter("times = 1"))
    if wanted.filter("times > 1").isEmpty():
        return single
    return single.unionByName(_with_ids(rows, wanted.filter("times > 1")).dropDuplicates(["class"]))


def _with_ids(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Texts of the wanted rows; ids are broadcast when they are few, else both sides shuffle."""
    side = wanted.withColumnsRenamed({"doc_id": "wanted_id", "row_key": "wanted_key"})
    side = F.broadcast(side) if wanted.count() <= BROADCAST_IDS else side
    same = (F.col("row_key") == F.col("wanted_key")) & F.col("doc_id").eqNullSafe(F.col("wanted_id"))
    return rows.join(side, same).drop("wanted_id", "wanted_key")


def jaccard_join(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
    threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
) -> DataFrame:
    """``(doc_id, class_id, copy_id, n_links, n_copies)``, one row per document.

    ``copy_id`` is the smallest id of the rows with the same shingles, ``n_links`` the number of other
    classes of copies with a Jaccard similarity of ``threshold`` or more, ``class_id`` the smallest id of
    all rows that links connect. Texts of fewer than five words are one shingle; texts without words, null
    texts among them, are copies of each other. Repeated rows are copies. Null ids are members, and name a
    class only if no other id does. Other columns do not matter. An empty table gives no rows.
    """
    members, classes = jaccard_classes(documents.select(doc_id, text), doc_id, text, threshold, tolerance)
    named = classes.groupBy("group").agg(F.min("rep.doc_id").alias("class_id"))
    known = classes.join(named, "group").select(
        "class", "class_id", F.col("rep.doc_id").alias("copy_id"), "n_links", "n_copies"
    )
    joined = hot_key_join(members, known, "class", ["row_key"])
    return joined.select("doc_id", "class_id", "copy_id", "n_links", "n_copies")


def keep_first(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
    threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
) -> DataFrame:
    """One document, with all its columns, of each group that copies and links connect: the smallest id.

    Rows without an id stay only where a group has no other; one of equal rows stays.
    """
    members, classes = jaccard_classes(documents, doc_id, text, threshold, tolerance)
    kept = classes.groupBy("group").agg(F.min("rep").alias("rep")).select("rep.*")
    kept = checkpointed(kept.select("doc_id", "row_key", "times"))
    counts = kept.agg(F.count("*").alias("kept"), F.count_if(F.col("times") > 1).alias("repeated")).first()
    names = free_names(documents, ["row_key", "kept_id", "kept_key"])
    keyed = documents.withColumn(names["row_key"], row_key(documents, documents.columns))
    same = (F.col(names["row_key"]) == F.col(names["kept_key"])) & F.col(doc_id).eqNullSafe(F.col(names["kept_id"]))

    def matching(ids: DataFrame, n: int, how: str) -> DataFrame:
        side = ids.select(F.col("doc_id").alias(names["kept_id"]), F.col("row_key").alias(names["kept_key"]))
        return keyed.join(F.broadcast(side) if n <= BROADCAST_IDS else side, same, how)

    if not counts["repeated"]:
        dropped = members.select("doc_id", "row_key").distinct().join(
            kept.select(F.col("doc_id").alias("k"), F.col("row_key").alias("r")),
            (F.col("row_key") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("k")),
            "left_anti",
        )
        dropped = checkpointed(dropped)
        n = dropped.count()
        if n < counts["kept"]:
            return matching(dropped, n, "left_anti").select(*quoted(documents.columns))
        return matching(kept, counts["kept"], "left_semi").select(*quoted(documents.columns))
    single = matching(kept.filter("times = 1"), counts["kept"], "left_semi")
    equal = matching(kept.filter("times > 1"), counts["repeated"], "left_semi")
    return single.unionByName(equal.dropDuplicates([names["row_key"], doc_id])).select(*quoted(documents.columns))
