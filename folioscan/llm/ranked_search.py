"""Ranked lexical search by NRA: impact-sorted lists, read in order, with score intervals per document.

A first pass keeps, per document, its length and the query terms it holds. Document frequencies and lengths
then give every posting its impact, and postings become lists sorted by impact, one set of lists per shard
of a few thousand documents. A shard is searched for every item by sequential reads from the heads of its
lists (no random access): what was read bounds a document's score from below, the last impacts read bound
it from above. Reading goes on until no document outside the best can reach them, ties included, and the
scores of all that may be among them are final. A task carries its best from shard to shard, so most later
shards end after their first reads. The best of all tasks are ranked at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from folioscan.llm.words import WordReader, plain_words, sliced
from folioscan.sources.workspace import written

TOP = 10
# Documents of a shard, postings of a list's first read, and item terms that go to the tasks at once.
SHARD_DOCUMENTS, FIRST_READ, TERMS_PER_PASS = 4096, 64, 2_000_000
# The smoothing of the impact, in thousandths, and the share of the length in it, in hundredths.
SCALE, SMOOTHING, LENGTH_SHARE = 1_000_000_000, 8, 90
# Marks the row that gives a document's id, among the rows of its postings.
_DOCUMENT = -1


def item_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[tuple[list, list[np.ndarray]]]:
    """``(ids, term hashes)`` of the items, a bounded number of terms at a time."""
    reader, ids, terms, held = WordReader(plain_words()), [], [], 0
    for row in items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).toLocalIterator():
        for _, _, words in reader.read(pa.array([row["text"]], pa.string())):
            found = np.unique(words.hash)
            if len(found):
                ids.append(row["item_id"])
                terms.append(found)
                held += len(found)
        if held >= TERMS_PER_PASS:
            yield ids, terms
            ids, terms, held = [], [], 0
    if ids:
        yield ids, terms


def query_postings(documents: DataFrame, wanted: np.ndarray, doc_id: str, text: str) -> DataFrame:
    """``(part, place, doc_id, n, terms, tfs)``, a row per document: its length and its ``wanted`` terms.

    ``wanted`` are sorted hashes; a term is its place among them. ``part`` and ``place`` number the documents.
    """
    rows = documents.select(
        F.spark_partition_id().alias("part"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text")
    )
    numbers = [
        T.StructField("n", T.LongType()),
        T.StructField("terms", T.ArrayType(T.IntegerType())),
        T.StructField("tfs", T.ArrayType(T.LongType())),
    ]
    head = [rows.schema["part"], T.StructField("place", T.LongType()), rows.schema["doc_id"]]
    schema = T.StructType([*head, *numbers])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, place = WordReader(plain_words()), 0
        for batch in sliced(batches):
            n, held, terms, tfs = [], [], [], []
            for low, high, words in reader.read(batch.column(2)):
                n.append(np.diff(words.first))
                at = np.minimum(np.searchsorted(wanted, words.hash), len(wanted) - 1)
                hit = wanted[at] == words.hash
                key, tf = np.unique(words.row[hit] * len(wanted) + at[hit], return_counts=True)
                held.append(np.bincount(key // len(wanted), minlength=high - low))
                terms.append(key % len(wanted))
                tfs.append(tf)
            offsets = pa.array(np.concatenate(([0], np.cumsum(np.concatenate(held)))), pa.int32())
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(values), kind))
                for values, kind in ((terms, pa.int32()), (tfs, pa.int64()))
            ]
            places = pa.array(np.arange(place, place + batch.num_rows))
            place += batch.num_rows
            lengths = pa.array(np.concatenate(n), pa.int64())
            yield pa.record_batch([batch.column(0), places, batch.column(1), lengths, *lists], names=schema.names)

    return rows.mapInArrow(count, schema)


def impact_lists(postings: DataFrame, shard_documents: int) -> DataFrame:
    """``(part, shard, term, impact, slot, doc_id)``: every shard's lists, each sorted by falling impact.

    Rows of term ``-1`` come first and name the documents of a shard. Shards follow from the numbers of
    the documents, so none grows with a source, an id or a term.
    """
    n_docs, total = postings.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_docs, total = F.lit(n_docs).cast("bigint"), F.lit(max(total, 1)).cast("bigint")
    held = postings.filter(F.size("terms") > 0).withColumn("shard", F.expr(f"place div {int(shard_documents)}"))
    frequency = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    ratio = (2 * n_docs + 2).cast("double") / (2 * F.col("df") + 1).cast("double")
    # One row per term of the block of items at most, which TERMS_PER_PASS bounds.
    weights = F.broadcast(frequency.select("term", F.floor(1000 * F.log(ratio)).cast("bigint").alias("weight")))
    document = F.struct(F.lit(_DOCUMENT).alias("terms"), F.lit(0).cast("bigint").alias("tfs"))
    rows = held.select(
        "part",
        "shard",
        F.pmod("place", F.lit(shard_documents)).cast("int").alias("slot"),
        "doc_id",
        "n",
        F.explode(F.concat(F.array(document), F.arrays_zip("terms", "tfs"))).alias("posting"),
    ).select("part", "shard", "slot", "doc_id", "n", F.col("posting.terms").alias("term"), F.col("posting.tfs").alias("tf"))
    length = F.call_function("div", LENGTH_SHARE * F.col("n") * n_docs, total) + (100 - LENGTH_SHARE)
    tf = F.col("tf")
    share = F.call_function("div", SCALE * tf, 1000 * tf + SMOOTHING * length)
    named = F.col("term") == _DOCUMENT
    lists = rows.join(weights, "term", "left").select(
        "part",
        "shard",
        "term",
        F.when(named, F.lit(0).cast("bigint")).otherwise(F.col("weight") * share).alias("impact"),
        "slot",
        F.when(named, F.col("doc_id")).alias("doc_id"),
    )
    dealt = lists.repartition("part", "shard")
    return dealt.sortWithinPartitions("part", "shard", "term", F.desc("impact"), "slot")


def resolve(
    impact: np.ndarray, slot: np.ndarray, begin: np.ndarray, end: np.ndarray, size: int, carried: np.ndarray, top: int = TOP
) -> tuple[np.ndarray, np.ndarray, int]:
    """``(slots, scores, read)``: the documents of a shard that may be among the ``top``, with final scores.

    ``begin`` and ``end`` are the lists of the item's terms in ``impact`` and ``slot``, ``carried`` scores
    found elsewhere. Documents that tie with the last of the best are all there. ``read`` postings were read.
    """
    length = end - begin
    depth = np.zeros_like(length)
    bound = impact[begin]
    need = np.ones(len(begin), dtype=bool)
    floor = np.sort(carried)[-top] if len(carried) >= top else 1
    if bound.sum() < max(floor, 1):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    while True:
        depth = np.where(need, np.minimum(length, np.maximum(2 * depth, FIRST_READ)), depth)
        owner = np.repeat(np.arange(len(begin)), depth)
        at = np.arange(len(owner)) + np.repeat(begin - (np.cumsum(depth) - depth), depth)
        docs = slot[at]
        # What no list has shown yet is at most the last impact read of each unfinished list.
        bound = np.where(depth < length, impact[begin + depth - 1], 0)
        lower, met = np.zeros(size, np.int64), np.zeros(size, np.int64)
        np.add.at(lower, docs, impact[at])
        np.add.at(met, docs, bound[owner])
        upper, unseen = lower + bound.sum() - met, bound.sum()
        known = np.concatenate((carried, lower[lower > 0]))
        limit = max(int(np.partition(known, -top)[-top]) if len(known) >= top else 1, 1)
        alive = (lower > 0) & (upper >= limit)
        open_ = alive & (upper > lower)
        if unseen < limit and not open_.any():
            slots = np.flatnonzero(alive)
            return slots, lower[slots], len(owner)
        need = depth < length
        if unseen < limit:
            # Only lists that still say something about an open document.
            need &= np.bincount(owner[open_[docs]], minlength=len(begin)) < open_.sum()


def _better(best: list[tuple[int, object]], found: list[tuple[int, object]]) -> list[tuple[int, object]]:
    order = lambda hit: (-hit[0], hit[1] is None, hit[1] if hit[1] is not None else 0)
    return sorted(best + found, key=order)[:TOP]


def search_lists(lists: DataFrame, terms: list[np.ndarray]) -> DataFrame:
    """``(item, doc_id, score)``: every task's best documents of every item; ``terms`` are those of the items."""
    schema = T.StructType(
        [T.StructField("item", T.IntegerType()), lists.schema["doc_id"], T.StructField("score", T.LongType())]
    )

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """The rows of one shard after the other."""
        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            part, shard = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((np.diff(part) != 0) | (np.diff(shard) != 0)) + 1
            for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
                piece = batch.slice(low, high - low)
                if held and (held[-1].column(0)[0], held[-1].column(1)[0]) != (piece.column(0)[0], piece.column(1)[0]):
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(piece)
        if held:
            yield pa.Table.from_batches(held)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in terms]
        id_type = None
        for table in shards(batches):
            term, impact = table.column("term").to_numpy(), table.column("impact").to_numpy()
            slot, ids = table.column("slot").to_numpy().astype(np.int64), table.column("doc_id")
            id_type = ids.type
            n = int(np.searchsorted(term, _DOCUMENT, "right"))
            ids = ids.slice(0, n).combine_chunks()
            by_id = np.empty(n, np.int64)
            by_id[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(n)
            local = np.zeros(int(slot.max()) + 1, np.int64)
            local[slot[:n]] = np.arange(n)
            slot = local[slot]
            for item, wanted in enumerate(terms):
                begin, end = np.searchsorted(term, wanted, "left"), np.searchsorted(term, wanted, "right")
                begin, end = begin[end > begin], end[end > begin]
                if not len(begin):
                    continue
                carried = np.array([score for score, _ in best[item]], np.int64)
                slots, scores, _ = resolve(impact, slot, begin, end, n, carried)
                first = np.lexsort((by_id[slots], -scores))[:TOP]
                found = [(int(scores[i]), ids[int(slots[i])].as_py()) for i in first]
                best[item] = _better(best[item], found)
        hits = [(item, doc, score) for item, of_item in enumerate(best) for score, doc in of_item]
        if hits:
            columns = list(zip(*hits))
            yield pa.record_batch(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], id_type), pa.array(columns[2], pa.int64())],
                names=schema.names,
            )

    return lists.mapInArrow(search, schema)


def search(
    documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    shard_documents: int = SHARD_DOCUMENTS,
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``TOP`` documents of every item, ties by ascending ``doc_id``.

    Terms are told apart by 64-bit hashes, the same for items and documents. Null and empty texts have no
    terms: such a document is never found, such an item finds nothing. Every row is a document and every
    item row an item, repeated rows and ids too; null ids come last among ties. Other columns are left out.
    Empty tables give no rows. Items pass the driver in blocks of ``TERMS_PER_PASS`` terms, each of which
    reads the documents once; documents and their postings never do.
    """
    spark = documents.sparkSession
    kind = items.select(F.col(item_id).alias("item_id")).schema["item_id"].dataType
    found = []
    for ids, terms in item_blocks(items, item_id, text):
        wanted = np.unique(np.concatenate(terms))
        postings = written(query_postings(documents, wanted, doc_id, text), "postings")
        lists = impact_lists(postings, shard_documents)
        hits = search_lists(lists, [np.searchsorted(wanted, of_item) for of_item in terms])
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)
        schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", kind)])
        names = spark.createDataFrame(list(enumerate(ids)), schema)
        found.append(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not found:
        nothing = documents.select(F.col(doc_id).alias("doc_id")).limit(0)
        return nothing.select(
            F.lit(None).cast(kind).alias("item_id"), F.lit(0).alias("rank"), "doc_id", F.lit(0).cast("bigint").alias("score")
        )
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
