"""Token counts by rank-synchronous array merging.

Words of many texts that have not been met before are held as one ragged array of symbols. Every round
each word merges all places of its own lowest-rank pair at once, until no word has a pair left that
merges. What remains of a word is its number of tokens, which is kept for the next texts.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from folioscan.llm.words import sliced

# Characters of a text that are cut at a time, and units (what stands between blanks) that a task remembers.
PIECE_CHARS = 200_000
KNOWN_UNITS = 400_000
# Units of texts that wait for the counts of new ones among them.
UNITS_AT_ONCE = 300_000
# Letters and numbers of newer Unicode versions than the tokenizers library reads (16), which
# takes them as other characters; hexadecimal, in ranges.
LATER = """
    558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7
    10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff
    18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96
    1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479
    3d000-3fc3f
"""
_LATER = "".join("-".join(f"\\U{int(code, 16):08x}" for code in part.split("-")) for part in LATER.split())
# The word pattern of the vocabulary file's pre-tokenizer, with those characters among the others.
WORD = r"(?V1)'s|'t|'re|'ve|'m|'ll|'d|[\p{L}--[later]]+|[\p{N}--[later]]|[[^\s\p{L}\p{N}]||[later]]+"
WORD = WORD.replace("later", _LATER)
# Lower case of letters where Python's own differs, by context or by Unicode version.
LOWER = {"\u03a3": "\u03c3", "\ua7cb": "\u0264", "\ua7dc": "\u019b"}
LIMIT = 2048


def byte_characters() -> list[str]:
    """The character that stands for each byte in vocabulary files of byte-level BPE."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


class Merges:
    """Symbols and merges of a vocabulary file, as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model = whole["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        names = byte_characters()
        self.inner = np.array([vocab[c] for c in names], dtype=np.int64)
        self.final = np.array([vocab[c + end] for c in names], dtype=np.int64)
        self.base = max(vocab.values()) + 1
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        keys = np.array([vocab[a] * self.base + vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.special = [token["content"] for token in whole["added_tokens"] if not token["normalized"]]

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Symbols that are left of every word (none is empty)."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        symbol = self.inner[data]
        ends = np.cumsum(lengths)
        symbol[ends - 1] = self.final[data[ends - 1]]
        left, owner = lengths.copy(), np.arange(len(words))
        none = len(self.merged)
        while len(owner):
            size = left[owner]
            word = np.repeat(np.arange(len(owner)), size)
            start = np.cumsum(size) - size
            rank = np.full(len(symbol), none, dtype=np.int64)
            key = symbol[:-1] * self.base + symbol[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = (self.keys[at] == key) & (word[:-1] == word[1:])
            rank[:-1][known] = self.ranks[at[known]]
            lowest = np.minimum.reduceat(rank, start)
            hit = (rank == lowest[word]) & (rank < none)
            # In a run of hits (one symbol again and again) every other one merges, from the left.
            place = np.arange(len(hit))
            run = place - np.maximum.accumulate(np.where(hit, -1, place))
            hit &= run % 2 == 1
            symbol = np.where(hit, self.merged[np.minimum(rank, none - 1)], symbol)
            keep = np.ones(len(hit), dtype=bool)
            keep[1:] = ~hit[:-1]
            left[owner] -= np.add.reduceat(hit.astype(np.int64), start)
            going = lowest < none
            keep &= going[word]
            symbol, owner = symbol[keep], owner[going]
        return left


class TokenCounter:
    """Counts the tokens of texts; remembers what stands between blanks."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.known: dict[str, int] = {}
        self.word = regex.compile(WORD)
        self.special = re.compile("|".join(re.escape(s) for s in self.merges.special)) if self.merges.special else None

    def _units(self, text: str) -> Iterator[list[str]]:
        """A text without special tokens, normalised and cut at blanks and line ends, piece by piece."""
        low = 0
        while low < len(text):
            high = text.find(" ", low + PIECE_CHARS)
            high = len(text) if high < 0 else high
            piece = text[low:high]
            if not piece.isascii():
                piece = unicodedata.normalize("NFC", piece)
                for upper, lower in LOWER.items():
                    piece = piece.replace(upper, lower)
            yield piece.lower().replace("\n", " ").split(" ")
            low = high

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of every text. Words that are new to the texts are merged together."""
        totals, waiting, held = [0] * len(texts), [], 0
        for i, text in enumerate(texts):
            parts = [text or ""]
            if self.special and text and self.special.search(text):
                parts = self.special.split(text)
                totals[i] += len(parts) - 1
            for part in parts:
                for units in self._units(part):
                    waiting.append((i, units))
                    held += len(units)
                    if held > UNITS_AT_ONCE:
                        self._settle(waiting, totals)
                        waiting, held = [], 0
        self._settle(waiting, totals)
        return totals

    def _settle(self, waiting: list[tuple[int, list[str]]], totals: list[int]) -> None:
        known = self.known
        if len(known) > KNOWN_UNITS:
            known.clear()
        fresh = list(set().union(*(units for _, units in waiting)).difference(known))
        if fresh:
            cut = [self.word.findall(unit) for unit in fresh]
            words = list(set().union(*cut))
            count = dict(zip(words, self.merges.counts([w.encode() for w in words]).tolist())) if words else {}
            known.update((unit, sum(map(count.__getitem__, found))) for unit, found in zip(fresh, cut))
        for i, units in waiting:
            totals[i] += sum(map(known.__getitem__, units))


def count_tokens(
    documents: DataFrame, tokenizer: str, keys: list[str], text: str = "text", limit: int = LIMIT
) -> DataFrame:
    """``(keys.., n_bytes, n_tokens, over_limit)``, one row per document.

    ``tokenizer`` is the path of a vocabulary file that every executor can read. Tokens are those of the
    whole text, without added begin or end; a special token's string inside a text is that one token. A
    null or empty text has none. Repeated rows count each. Nothing shuffles; a task holds one batch of
    texts and the counts of a bounded number of units.
    """
    rows = documents.select(*keys, text)
    schema = T.StructType(
        rows.schema.fields[:-1]
        + [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
        + [T.StructField("over_limit", T.BooleanType())]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(tokenizer)
        for batch in sliced(batches):
            texts = batch.column(len(keys))
            n_tokens = pa.array(counter.count(texts.to_pylist()), pa.int64())
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            columns = [*batch.columns[:-1], n_bytes, n_tokens, pc.greater(n_tokens, limit)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(count, schema)
