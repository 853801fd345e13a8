"""Substring dedup: words covered by long passages that also start elsewhere.

A window is ``size`` consecutive words. Its anchor is the smallest of the hashes of its short word runs,
so equal windows have equal anchors at equal places, and neighbouring windows share one. The windows of
one anchor occurrence form a context. Contexts of one anchor are the reference shard for each other:

1. Anchors and context hashes of all documents are counted. A context that occurs twice is repeated as
   a whole; an anchor with different contexts needs their words.
2. The words of those contexts go to the task of their anchor. There a suffix automaton of the shard
   tells for every place how often the last ``size`` words occur (matching statistics with counts).
3. Windows found this way are joined to their documents, and the maximal spans they cover go.

Automata are dealt out by anchor instead of broadcast whole: a shard's automaton matters only to the
documents that hold its anchors, and streaming every document past every shard would cost the square of
the corpus.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscan.llm.words import Words, WordReader, mixed, sliced, space_words
from folioscan.operators.joins import hot_key_join
from folioscan.sources.workspace import checkpointed, written

WINDOW_WORDS = 35
# Words of the runs among which a window's anchor is chosen.
ANCHOR_WORDS = 8
# Contexts of one anchor that form a shard; beyond it every window goes to a shard of its own words.
SHARD_CONTEXTS = 1000
# Words of one automaton: small shards share one.
SHARD_WORDS = 50_000


def run_hashes(words: Words, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each place on, across texts where a text ends."""
    padded = np.concatenate((words.hash, np.zeros(size, np.uint64)))
    total, factor = np.zeros(len(words.hash), np.uint64), 1
    for step in range(size):
        total += padded[step : step + len(total)] * np.uint64(factor)
        factor = factor * 0x9E3779B97F4A7C15 % 2**64
    return mixed(total)


def anchors(words: Words, size: int = WINDOW_WORDS) -> tuple[np.ndarray, ...]:
    """``(row, key, context, start, count)`` of every anchor occurrence.

    ``start`` is the first window's place in its text and ``count`` the number of windows that share the
    occurrence; ``context`` is a hash of all their words.
    """
    n = len(words.hash)
    last = words.first[words.row + 1]
    at = np.arange(n)
    valid = at + size <= last
    if not valid.any():
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    run = min(ANCHOR_WORDS, size)
    grams = run_hashes(words, run)
    choices = size - run + 1
    best, where, width = grams, at, 1
    while width < choices:
        step = min(width, choices - width)
        other = np.minimum(at + step, n - 1)
        lower = best[other] < best
        best, where = np.where(lower, best[other], best), np.where(lower, where[other], where)
        width += step
    windows = np.flatnonzero(valid)
    chosen, row = where[windows], words.row[windows]
    new = np.ones(len(windows), dtype=bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1])
    heads = np.flatnonzero(new)
    count = np.diff(np.append(heads, len(windows)))
    begin = windows[heads]
    every = run_hashes(words, size)
    # First and last window and the place of the anchor tell a context: its windows overlap in all words.
    context = mixed(every[begin] + mixed(every[begin + count - 1]) * np.uint64(3) + count.astype(np.uint64))
    context = mixed(context + (chosen[heads] - begin).astype(np.uint64))
    return row[heads], grams[chosen[heads]], context, begin - words.first[row[heads]], count


def mark_anchors(documents: DataFrame, keys: list[str], size: int, text: str = "text") -> DataFrame:
    """The key columns, ``n_words``, ``words_sha`` (of the words, joined) and the document's anchors."""
    rows = documents.select(*keys, text)
    lists = [("key", T.LongType()), ("context", T.LongType()), ("start", T.IntegerType()), ("count", T.IntegerType())]
    schema = T.StructType(
        rows.schema.fields[:-1]
        + [T.StructField("n_words", T.LongType()), T.StructField("words_sha", T.StringType())]
        + [T.StructField(f"{name}s", T.ArrayType(kind)) for name, kind in lists]
    )
    kinds = [np.int64, np.int64, np.int32, np.int32]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = WordReader(space_words())
        for batch in sliced(batches):
            for low, high, words in reader.read(batch.column(len(keys))):
                part = batch.slice(low, high - low)
                shas = [_sha(text) for text in part.column(len(keys)).cast(pa.binary()).to_pylist()]
                row, *values = anchors(words, size)
                ends = pa.array(np.searchsorted(row, np.arange(high - low + 1)).astype(np.int32))
                columns = [
                    pa.ListArray.from_arrays(ends, pa.array(v.astype(kind))) for v, kind in zip(values, kinds)
                ]
                n_words = pa.array(np.diff(words.first).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], n_words, pa.array(shas), *columns], names=schema.names
                )

    return rows.mapInArrow(mark, schema)


def _sha(text: bytes | None) -> str:
    return hashlib.sha256(b" ".join((text or b"").split())).hexdigest()


class SuffixAutomaton:
    """Automaton of several word sequences; ``counts`` tells how often the words up to a place occur."""

    def __init__(self):
        self.length, self.link, self.follow, self.times = [0], [-1], [{}], [0]

    def add(self, symbols: list) -> list[int]:
        """Add a sequence; gives its state at every place."""
        length, link, follow, times = self.length, self.link, self.follow, self.times
        last, states = 0, []
        for symbol in symbols:
            known = follow[last].get(symbol)
            if known is not None and length[known] == length[last] + 1:
                last = known
                times[last] += 1
                states.append(last)
                continue
            if known is None:
                state = len(length)
                length.append(length[last] + 1)
                link.append(0)
                follow.append({})
                times.append(1)
                at = last
                while at >= 0 and symbol not in follow[at]:
                    follow[at][symbol] = state
                    at = link[at]
                if at >= 0:
                    link[state] = self._split(at, follow[at][symbol], symbol)
                last = state
            else:
                last = self._split(last, known, symbol)
                times[last] += 1
            states.append(last)
        return states

    def _split(self, at: int, known: int, symbol) -> int:
        """The state of ``at`` followed by ``symbol``, cut off from longer words if need be."""
        length, link, follow = self.length, self.link, self.follow
        if length[known] == length[at] + 1:
            return known
        clone = len(length)
        length.append(length[at] + 1)
        link.append(link[known])
        follow.append(dict(follow[known]))
        self.times.append(0)
        while at >= 0 and follow[at].get(symbol) == known:
            follow[at][symbol] = clone
            at = link[at]
        link[known] = clone
        return clone

    def close(self) -> None:
        """Add up occurrences along the links; to be called once, after all sequences."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.times[self.link[state]] += self.times[state]

    def repeated(self, states: list[int], size: int) -> list[int]:
        """First places of the runs of ``size`` symbols that occur twice or more, among a sequence's states."""
        found = []
        length, link = self.length, self.link
        for end in range(size - 1, len(states)):
            state = states[end]
            while length[link[state]] >= size:
                state = link[state]
            if self.times[state] > 1:
                found.append(end - size + 1)
        return found


def _edge_contexts(touched: DataFrame, size: int) -> DataFrame:
    """``(key, context, text_id, start, words)`` of the contexts whose words are needed.

    Those of an anchor with too many contexts are cut into windows, each a shard by its own hash.
    """
    schema = "key long, context long, text_id long, start int, words binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "context", "text_id", "start", "words"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        for part in sliced(batches, 32):
            out = []
            for row in part.to_pylist():
                edges = [place for place in row["places"] if place["edge"]]
                words = row["text"].encode().split() if edges else []
                for place in edges:
                    start, count = place["start"], place["count"]
                    if place["wide"]:
                        for at in range(start, start + count):
                            window = b" ".join(words[at : at + size])
                            key = int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), signed=True)
                            out.append((key, 0, row["text_id"], at, window))
                    else:
                        run = b" ".join(words[start : start + count + size - 1])
                        out.append((place["key"], place["context"], row["text_id"], start, run))
            if out:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return touched.select("text_id", "text", "places").mapInArrow(cut, schema)


def _shard_windows(contexts: DataFrame, size: int) -> DataFrame:
    """``(key, context, repeated)``: places of repeated windows in every context, from its shard's automaton.

    Contexts come sorted by key; whole shards are gathered until an automaton is large enough.
    """

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(shard: list) -> pa.RecordBatch:
            automaton, states = SuffixAutomaton(), []
            for _, _, words, _ in shard:
                states.append(automaton.add(words))
            automaton.close()
            found = [
                list(range(len(s) - size + 1)) if whole else automaton.repeated(s, size)
                for s, (_, _, _, whole) in zip(states, shard)
            ]
            return pa.record_batch(
                [
                    pa.array([x[0] for x in shard], pa.int64()),
                    pa.array([x[1] for x in shard], pa.int64()),
                    pa.array(found, pa.list_(pa.int32())),
                ],
                names=["key", "context", "repeated"],
            )

        shard, held, key = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if row[0] != key and held > SHARD_WORDS:
                    yield solve(shard)
                    shard, held = [], 0
                key, words = row[0], row[2].split()
                shard.append((row[0], row[1], words, row[3]))
                held += len(words)
        if shard:
            yield solve(shard)

    ordered = contexts.select("key", "context", "words", "whole").repartition("key").sortWithinPartitions("key", "context")
    return ordered.mapInArrow(match, "key long, context long, repeated array<int>")


def _kept_words(touched: DataFrame, size: int) -> DataFrame:
    """``(text_id, n_removed, kept_sha)`` from ``(text_id, text, spans)``; spans are window starts and counts."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 32):
            removed, shas = [], []
            for text, spans in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                words = (text or b"").split()
                covered = np.zeros(len(words) + 1, dtype=np.int32)
                for span in spans:
                    covered[span["start"]] += 1
                    covered[span["start"] + span["count"] + size - 1] -= 1
                gone = np.cumsum(covered[:-1]) > 0
                removed.append(int(gone.sum()))
                kept = [word for word, out in zip(words, gone) if not out]
                shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.record_batch(
                [batch.column(0), pa.array(removed, pa.int64()), pa.array(shas, pa.string())],
                names=["text_id", "n_removed", "kept_sha"],
            )

    return touched.select("text_id", "text", "spans").mapInArrow(remove, "text_id long, n_removed long, kept_sha string")


def remove_repeats(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WINDOW_WORDS,
    shard_contexts: int = SHARD_CONTEXTS,
) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)``, one row per document.

    Removed is every word that a window covers whose words also start anywhere else, in the same document
    or another; windows are judged on the input. Texts with the same words are copies: all their words go
    if they fill a window. Repeated rows are copies, too. A null or empty text has no words; texts shorter
    than a window keep all. Null ids stay null. No rows give no rows.
    """
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("row_key", F.xxhash64("doc_id", "text"))
    marked = written(mark_anchors(rows, ["doc_id", "row_key"], size), "anchors")
    marked = marked.withColumn("text_id", F.xxhash64("words_sha"))
    same = marked.groupBy("text_id", "words_sha").agg(
        F.count("*").alias("copies"),
        F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row_key")).alias("rep"),
    )
    texts = written(same, "texts")

    places = marked.select("text_id", F.explode(F.arrays_zip("keys", "contexts", "starts", "counts")).alias("p"))
    places = places.select("text_id", F.col("p.keys").alias("key"), F.col("p.contexts").alias("context"),
                           F.col("p.starts").alias("start"), F.col("p.counts").alias("count"))
    differs = lambda c: F.min(c) != F.max(c)
    shards = places.groupBy("key").agg(
        differs("context").alias("edge"),
        (differs("text_id") | differs("start")).alias("many"),
        (F.count("*") > shard_contexts).alias("wide"),
    )
    # Stored, so that the joins below are of two shuffles, which Spark can split at a hot anchor.
    shards = checkpointed(shards.filter("many").select("key", "edge", (F.col("edge") & F.col("wide")).alias("wide")))
    near = written(places.join(shards, "key"), "suspects")
    whole = (differs("text_id") | differs("start")).alias("whole")
    contexts = checkpointed(near.groupBy("key", "context").agg(whole, F.min("text_id").alias("first_id")))
    hits = near.join(contexts, ["key", "context"]).filter("whole or edge")
    # Of a context that is repeated as a whole, one text is enough for its shard.
    hits = hits.withColumn("edge", F.col("edge") & (~F.col("whole") | (F.col("text_id") == F.col("first_id"))))
    by_text = hits.groupBy("text_id").agg(
        F.collect_set(F.struct("start", "count", "key", "context", "whole", "edge", "wide")).alias("places")
    )
    wanted = by_text.join(texts.select("text_id", "rep.doc_id", "rep.row_key", "copies"), "text_id")
    wanted = wanted.withColumnsRenamed({"doc_id": "wanted_id", "row_key": "wanted_key"})
    match = (F.col("row_key") == F.col("wanted_key")) & F.col("doc_id").eqNullSafe(F.col("wanted_id"))
    touched = rows.join(wanted, match).select("text_id", "text", "places", "copies")
    touched = written(touched, "touched")

    edges = written(_edge_contexts(touched, size), "contexts")
    once = edges.groupBy("key", "context").agg(
        F.first("words").alias("words"), (differs("text_id") | differs("start")).alias("whole")
    )
    solved = _shard_windows(once, size)
    solved = checkpointed(solved.filter(F.size("repeated") > 0))
    windows = edges.select("key", "context", "text_id", "start").join(solved, ["key", "context"])
    offset = F.explode("repeated").alias("offset")
    windows = windows.select("text_id", "start", offset)
    found = windows.groupBy("text_id").agg(
        F.collect_set(F.struct((F.col("start") + F.col("offset")).alias("start"), F.lit(1).alias("count"))).alias("windows")
    )
    whole = F.transform(
        F.filter("places", lambda p: p["whole"]), lambda p: F.struct(p["start"].alias("start"), p["count"].alias("count"))
    )
    single = touched.filter("copies = 1").select("text_id", "text", whole.alias("whole"))
    spanned = single.join(found, "text_id", "left").select(
        "text_id", "text", F.concat("whole", F.coalesce("windows", F.array().cast("array<struct<start:int,count:int>>"))).alias("spans")
    )
    changed = written(_kept_words(spanned.filter(F.size("spans") > 0), size), "kept")

    info = texts.select("text_id", "words_sha", "copies").join(changed, "text_id", "left")
    info = info.filter("copies > 1 or kept_sha is not null").drop("words_sha")
    narrow = marked.select("doc_id", "row_key", "text_id", "n_words", "words_sha")
    joined = hot_key_join(narrow, info, "text_id", ["row_key"], "left")
    copied = (F.col("copies") > 1) & (F.col("n_words") >= size)
    empty = hashlib.sha256(b"").hexdigest()
    return joined.select(
        "doc_id",
        "n_words",
        F.when(copied, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("bigint"))).alias("n_removed"),
        F.when(copied, F.lit(empty)).otherwise(F.coalesce("kept_sha", "words_sha")).alias("kept_sha256"),
    )
