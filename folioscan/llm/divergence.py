"""How the sources of a language differ in their words, by hash-consed segment trees.

Every source's counts of a language's frequent terms are the leaves of a binary tree over term ids. Subtrees
with the same counts are one node, so the many stretches of rare terms that a source does not have, or has
once, exist once. Two sources are compared by walking both trees together: a pair of nodes that is met again
is not priced again but counted. Term ids are cut into ranges and sources into blocks, and a task holds the
trees of two blocks of sources over one range. What it returns are sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from folioscan.llm.words import WordReader, sliced
from folioscan.sources.workspace import written

# A language keeps the terms of so many of its documents; so many terms of a source are reported.
LEAST_DOCUMENTS, TOP_TERMS = 30, 50
# Parts of a whole, and what is added to every count.
WHOLE, ADDED = 1_000_000_000, 5
# Term ids of one range, sources of one block, pairs of sources that a task walks at once.
RANGE_TERMS, BLOCK_SOURCES, PAIRS_AT_ONCE = 2048, 64, 256
# Distinct (group, term) entries that a task of the first pass holds, and rows of a batch it gives.
ENTRIES_HELD, ROWS_GIVEN = 400_000, 50_000
_ABSENT = -1


def letter_words() -> np.ndarray:
    """Words are runs of letters and non-ASCII characters; ASCII case is folded."""
    table = np.zeros(256, dtype=np.uint16)
    folded = _folded()
    for byte in range(256):
        if byte >= 0x80 or chr(byte).isalpha():
            table[byte] = int(folded[byte]) + 1
    return table


def _folded() -> np.ndarray:
    """Bytes with A to Z in lower case."""
    return np.array([ord(chr(b).lower()) if b < 0x80 else b for b in range(256)], dtype=np.uint8)


class TermCounts:
    """Counts of a task: ``(group, term)`` with occurrences and documents, and the terms' texts."""

    def __init__(self):
        self.folded = _folded()
        self.entries: list[tuple] = []
        self.hashes: list[np.ndarray] = []
        self.texts: list[pa.Array] = []
        self.size = 0

    def add(self, words, group: np.ndarray) -> None:
        """Terms of some documents; ``group`` by row."""
        order = np.lexsort((words.hash, words.row))
        value, row = words.hash[order], words.row[order]
        at = np.flatnonzero(np.concatenate(([True], (np.diff(value) != 0) | (np.diff(row) != 0))))
        times = np.diff(np.append(at, len(value)))
        self.entries.append((group[row[at]], value[at], times, np.ones(len(at), np.int64)))
        self.size += len(at)
        shown, first = np.unique(value[at], return_index=True)
        self.hashes.append(shown)
        self.texts.append(self._texts(words, order[at[first]]))

    def _texts(self, words, at: np.ndarray) -> pa.Array:
        size = words.end[at] - words.start[at]
        offsets = np.concatenate(([0], np.cumsum(size)))
        source = np.arange(offsets[-1]) + np.repeat(words.start[at] - offsets[:-1], size)
        data = self.folded[words.data[source]]
        return pa.Array.from_buffers(
            pa.large_string(), len(at), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
        )

    def fold(self) -> None:
        """Add up entries of one group and term; keep each text once."""
        if not self.entries:
            return
        group, value, times, docs = (np.concatenate(c) for c in zip(*self.entries))
        order = np.lexsort((group, value))
        group, value = group[order], value[order]
        at = np.flatnonzero(np.concatenate(([True], (np.diff(value) != 0) | (np.diff(group) != 0))))
        sums = [np.add.reduceat(c[order], at) for c in (times, docs)]
        self.entries = [(group[at], value[at], *sums)]
        self.size = len(at)
        shown, first = np.unique(np.concatenate(self.hashes), return_index=True)
        self.hashes, self.texts = [shown], [pa.concat_arrays(self.texts).take(pa.array(first))]

    def drain(self) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
        """``(groups, terms, occurrences, documents)``, and forget them."""
        self.fold()
        for group, value, times, docs in self.entries:
            for low in range(0, len(group), ROWS_GIVEN):
                part = slice(low, low + ROWS_GIVEN)
                texts = self.texts[0].take(pa.array(np.searchsorted(self.hashes[0], value[part])))
                yield group[part], texts.cast(pa.string()), times[part], docs[part]
        self.entries, self.hashes, self.texts, self.size = [], [], [], 0


_COUNTS = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("term", T.StringType()),
        T.StructField("times", T.LongType()),
        T.StructField("docs", T.LongType()),
    ]
)


def partial_counts(documents: DataFrame) -> DataFrame:
    """``(lang, source, term, times, docs)`` of each task, from ``(lang, source, text)``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, counts, codes = WordReader(letter_words()), TermCounts(), {}

        def given() -> Iterator[pa.RecordBatch]:
            names = list(codes)
            langs, sources = (pa.array([n[i] for n in names], pa.string()) for i in (0, 1))
            for group, terms, times, docs in counts.drain():
                of = pa.array(group)
                yield pa.record_batch([langs.take(of), sources.take(of), terms, pa.array(times), pa.array(docs)], names=_COUNTS.names)

        for batch in sliced(batches):
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            group = np.array([codes.setdefault(key, len(codes)) for key in keys], np.int64)
            for low, high, words in reader.read(batch.column(2)):
                if len(words.start):
                    counts.add(words, group[low:high])
            if counts.size > 2 * ENTRIES_HELD:
                counts.fold()
                if counts.size > ENTRIES_HELD:
                    yield from given()
        yield from given()

    return documents.mapInArrow(count, _COUNTS)


def kept_counts(partial: DataFrame, least: int) -> DataFrame:
    """``(lang, source, term, times, lang_times, first)`` of kept terms.

    One shuffle by language and term serves both the sums per source and those per language. ``first``
    marks one row of each term.
    """
    term = Window.partitionBy("lang", "term")
    dealt = partial.repartition("lang", "term")
    summed = dealt.groupBy("lang", "term", "source").agg(F.sum("times").alias("times"), F.sum("docs").alias("docs"))
    named = summed.select(
        "lang",
        "source",
        "term",
        "times",
        F.sum("times").over(term).alias("lang_times"),
        F.sum("docs").over(term).alias("lang_docs"),
        (F.row_number().over(term.orderBy("source")) == 1).alias("first"),
    )
    return written(named.filter(F.col("lang_docs") >= least).drop("lang_docs"), "term-counts")


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(WHOLE * (count + ADDED) / total)``, exact for totals below 2 ** 48; absent terms have none.

    The product would leave 64 bits, so the division goes in two steps. ``total`` holds ``ADDED`` per term.
    """
    first, second = 31_250, 32_000
    total = np.maximum(total, 1)
    whole, rest = np.divmod((np.maximum(counts, 0) + ADDED) * first, total)
    return np.where(counts == _ABSENT, 0, 1 + whole * second + rest * second // total)


class Forest:
    """Hash-consed trees over the rows of a count matrix, whose width is a power of two.

    ``levels[k]`` gives the two children of every node of level ``k + 1``; nodes of level 0 are counts.
    """

    def __init__(self, counts: np.ndarray):
        self.values, ids = np.unique(counts, return_inverse=True)
        ids = ids.reshape(counts.shape)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.empty = [np.isin(self.values, (0, _ABSENT))]
        nodes = len(self.values)
        while ids.shape[1] > 1:
            pairs, at = np.unique(ids[:, ::2] * nodes + ids[:, 1::2], return_inverse=True)
            self.levels.append((pairs // nodes, pairs % nodes))
            below = self.empty[-1]
            self.empty.append(below[pairs // nodes] & below[pairs % nodes])
            ids, nodes = at.reshape(len(ids), -1), len(pairs)
        self.roots = ids[:, 0]

    def leaf_pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(pair, count, count, times)``: what the leaves of tree ``left[i]`` and tree ``right[i]`` hold.

        Both trees are walked from their roots. Equal pairs of nodes go on as one, with how often they were met.
        """
        pair, a, b = np.arange(len(left)), self.roots[left], self.roots[right]
        times = np.ones(len(left), np.int64)
        for low, high in reversed(self.levels):
            nodes = int(max(low.max(), high.max())) + 1
            key = np.concatenate([(pair * nodes + child[a]) * nodes + child[b] for child in (low, high)])
            key, at = np.unique(key, return_inverse=True)
            met = np.zeros(len(key), np.int64)
            np.add.at(met, at, np.concatenate((times, times)))
            pair, a, b, times = key // (nodes * nodes), key // nodes % nodes, key % nodes, met
        return pair, self.values[a], self.values[b], times

    def leaves(self, tree: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(i, place, count, count)`` where tree ``tree[i]`` holds anything; empty subtrees are not entered."""
        which, a, b, place = np.arange(len(tree)), self.roots[tree], self.roots[other], np.zeros(len(tree), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            low, high = self.levels[level]
            which, place = np.concatenate((which, which)), np.concatenate((2 * place, 2 * place + 1))
            a, b = np.concatenate((low[a], high[a])), np.concatenate((low[b], high[b]))
            keep = ~self.empty[level][a]
            which, a, b, place = which[keep], a[keep], b[keep], place[keep]
        keep = ~self.empty[0][a]
        return which[keep], place[keep], self.values[a[keep]], self.values[b[keep]]


_PRICED = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("part", T.StringType()),
        T.StructField("item", T.StringType()),
        T.StructField("value", T.LongType()),
    ]
)


def price_range(key: tuple, table: pa.Table, top: int = TOP_TERMS) -> pa.Table:
    """Differences of two blocks of sources over one range of terms.

    ``table`` has a row without a term for every source of the blocks, with its sums, and their counts.
    """
    lang, _, low, high = (value.as_py() for value in key)
    heads = table.filter(pc.is_null(table.column("term"))).sort_by("number")
    number, total = heads.column("number").to_numpy(), heads.column("total").to_numpy()
    names = heads.column("source").combine_chunks()
    n_terms, lang_total = heads.column("n_terms")[0].as_py(), heads.column("lang_total")[0].as_py()
    table = table.filter(pc.is_valid(table.column("term")))
    terms = table.group_by("term").aggregate([("lang_times", "max")])
    # Frequent terms first, so that what sources seldom have lies together. Terms that neither block has come last.
    terms = terms.sort_by([("lang_times_max", "descending"), ("term", "ascending")])
    texts, of_lang = terms.column("term").combine_chunks(), terms.column("lang_times_max").to_numpy()
    width = 1 << max(n_terms - 1, 0).bit_length()
    counts = np.zeros((len(number) + 1, width), np.int64)
    counts[:, n_terms:] = _ABSENT
    place = pc.index_in(table.column("term").combine_chunks(), texts).to_numpy()
    counts[np.searchsorted(number, table.column("number").to_numpy()), place] = table.column("times").to_numpy()
    counts[-1, : len(of_lang)] = of_lang
    forest, out = Forest(counts), []

    def give(sources: pa.Array, part: str, items: pa.Array, values: np.ndarray) -> None:
        n = len(values)
        columns = [pa.array([lang] * n, pa.string()), sources, pa.array([part] * n, pa.string()), items, pa.array(values)]
        out.append(pa.table(columns, names=_PRICED.names))

    block = number // BLOCK_SOURCES
    left, right = np.meshgrid(np.flatnonzero(block == low), np.flatnonzero(block == high), indexing="ij")
    left, right = left.ravel(), right.ravel()
    if low == high:
        left, right = left[left < right], right[left < right]
    for at in range(0, len(left), PAIRS_AT_ONCE):
        one, two = left[at : at + PAIRS_AT_ONCE], right[at : at + PAIRS_AT_ONCE]
        pair, a, b, times = forest.leaf_pairs(one, two)
        price = np.abs(shares(a, total[one[pair]]) - shares(b, total[two[pair]])) * times
        sums = np.zeros(len(one), np.int64)
        np.add.at(sums, pair, price)
        first, second = names.take(pa.array(one)), names.take(pa.array(two))
        give(first, "pair", second, sums)
        give(second, "pair", first, sums)
    if low == high:
        every = np.arange(len(number))
        which, place, a, b = forest.leaves(every, np.full(len(number), len(number)))
        more = shares(a, total[which]) - shares(b, np.int64(lang_total))
        which, place, more = (c[more > 0] for c in (which, place, more))
        order = np.lexsort((_ranks(texts)[place], -more, which))
        which, place, more = (c[order] for c in (which, place, more))
        nth = np.arange(len(which)) - np.searchsorted(which, which, "left")
        which, place, more = (c[nth < top] for c in (which, place, more))
        give(names.take(pa.array(which)), "term", texts.take(pa.array(place)), more)
    return pa.concat_tables(out) if out else pa.Table.from_batches([], schema=_arrow_priced())


def _arrow_priced() -> pa.Schema:
    return pa.schema([(f.name, pa.int64() if f.name == "value" else pa.string()) for f in _PRICED])


def _ranks(texts: pa.Array) -> np.ndarray:
    """By text: its place in UTF-8 order."""
    out = np.empty(len(texts), np.int64)
    out[pc.sort_indices(texts.cast(pa.binary())).to_numpy()] = np.arange(len(texts))
    return out


def _ranges(n_terms: Column) -> Column:
    """Ranges that a language's terms are cut into."""
    return F.greatest(F.ceil(n_terms / F.lit(RANGE_TERMS)).cast("int"), F.lit(1))


def differences(
    documents: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how far sources of a language lie apart, and by what terms.

    Part ``pair`` has every other source of the language with the sum of the differences of their shares,
    part ``term`` the ``top`` terms whose share is above the language's. Null text, language and source
    read as empty. A group without terms has the share of an unseen term for all; a language without kept
    terms has pairs of value 0. Repeated rows count each. Other columns are left out; an empty table gives
    no rows. Nothing comes to the driver. A task holds two blocks of sources over one range of terms, and
    sources of one language are numbered, and ranked for each source, as narrow rows.
    """
    blank = F.lit("")
    rows = documents.select(
        F.coalesce(F.col(lang), blank).alias("lang"), F.coalesce(F.col(source), blank).alias("source"), F.col(text).alias("text")
    )
    named = kept_counts(partial_counts(rows), least)
    sums = named.groupBy("lang", "source").agg(F.sum("times").alias("sum"))
    no_terms = F.lit(0).cast("bigint")
    of_group = rows.select("lang", "source").distinct().join(sums, ["lang", "source"], "left")
    of_group = of_group.withColumn("sum", F.coalesce("sum", no_terms))
    of_group = of_group.withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    terms = named.groupBy("lang").agg(F.count_if("first").alias("lang_terms"))
    of_lang = of_group.groupBy("lang").agg(F.sum("sum").alias("lang_sum"), F.count("*").alias("sources"))
    of_lang = of_lang.join(terms, "lang", "left").withColumn("lang_terms", F.coalesce("lang_terms", no_terms))
    added = ADDED * F.col("lang_terms")
    groups = written(
        of_group.join(of_lang, "lang").select(
            "lang",
            "source",
            "number",
            (F.col("sum") + added).alias("total"),
            (F.col("lang_sum") + added).alias("lang_total"),
            _ranges(F.col("lang_terms")).alias("ranges"),
            F.ceil(F.col("sources") / F.lit(BLOCK_SOURCES)).cast("int").alias("blocks"),
        ),
        "groups",
    )
    langs = groups.select("lang", "ranges").distinct()
    at = F.pmod(F.xxhash64("term"), F.col("ranges").cast("bigint")).cast("int").alias("range")
    sizes = named.filter("first").join(langs, "lang").select("lang", at).groupBy("lang", "range").agg(F.count("*").alias("n_terms"))
    whole = groups.withColumn("range", F.explode(F.sequence(F.lit(0), F.col("ranges") - 1)))
    heads = whole.join(sizes, ["lang", "range"], "left").withColumn("n_terms", F.coalesce("n_terms", F.lit(0).cast("bigint")))
    no = lambda kind, name: F.lit(None).cast(kind).alias(name)
    shared = ["lang", "range", "number", "blocks"]
    heads = heads.select(
        *shared, "source", "total", "lang_total", "n_terms", no("string", "term"), no("bigint", "times"), no("bigint", "lang_times")
    )
    entries = named.join(groups, ["lang", "source"]).select(
        "lang", at, "number", "blocks", no("string", "source"), no("bigint", "total"), no("bigint", "lang_total"), no("bigint", "n_terms"),
        "term", "times", "lang_times",
    )
    # A source takes part in the comparisons of its block with every block of the language, its own among them.
    block = F.expr(f"number div {BLOCK_SOURCES}").cast("int")
    both = heads.unionByName(entries).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = both.select(
        "*", F.least(block, "other").alias("low"), F.greatest(block, "other").alias("high")
    ).drop("other", "blocks")

    def price(key: tuple, table: pa.Table) -> pa.Table:
        return price_range(key, table, top)

    priced = dealt.groupBy("lang", "range", "low", "high").applyInArrow(price, _PRICED)
    summed = priced.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = summed.withColumn("rank", F.row_number().over(order))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= top))
