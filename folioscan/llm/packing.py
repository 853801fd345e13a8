"""Documents packed into sequences by bulk-synchronous best fit.

Pieces of documents are sorted by range of their length and ranked. Sequences with room are gaps, sorted by
room. Sizes are whole numbers up to the length of a sequence, so pieces of one length, and gaps of one room,
are a run of interchangeable rows, and there are never more runs than sizes. A superstep takes the pieces of
one length, longest first: a sweep over the gaps finds their successors, the smallest gaps that hold them, for
the whole run at once; pieces that want the same gaps are told apart by rank; gaps shrink; the next length
follows. The sweeps see runs only, whatever the number of documents. The matches they leave, intervals of
ranks and of sequences, go to the tasks, and every task looks the place of its own pieces up.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscan.llm.token_counts import byte_characters
from folioscan.operators.paging import with_rank
from folioscan.sources.workspace import written

# Tokens of a sequence, and the id that ends a document.
ROOM, END = 2048, 0
# Characters that are encoded at once; longer texts are cut before white space.
PIECE_CHARS = 1_000_000
# Rows of a batch, and pieces that one task ranks.
ROWS_AT_ONCE, PIECES_PER_TASK = 256, 4_000_000
# The word pattern of the vocabulary file's pre-tokenizer.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Ids of texts as the vocabulary file's own library gives them, without added tokens.

    Merges of the file are ranked by id, so a faster library that takes ranks gives the same ids.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        byte_of = {name: byte for byte, name in enumerate(byte_characters())}
        vocab, merges = whole["model"]["vocab"], whole["model"]["merges"]
        special = {token["content"]: token["id"] for token in whole["added_tokens"]}
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in merges]
        rising = [vocab[a + b] for a, b in pairs]
        if rising != sorted(rising):
            raise ValueError(f"{path}: ids of merged tokens do not rise with the rank of their merge")
        ranks = {bytes(byte_of[c] for c in name): i for name, i in vocab.items() if name not in special}
        self.encoding = tiktoken.Encoding("ranks", pat_str=WORD, mergeable_ranks=ranks, special_tokens=special)
        self.special = set(special)
        self.blank = re.compile(r"(?<=\S)\s")

    def ids(self, text: str) -> np.ndarray:
        """Ids of a whole text; a special token's string in it is that token."""
        parts, low = [], 0
        while low < len(text):
            found = self.blank.search(text, low + PIECE_CHARS) if len(text) - low > PIECE_CHARS else None
            high = found.start() if found else len(text)
            parts.append(np.asarray(self.encoding.encode_to_numpy(text[low:high], allowed_special=self.special), np.uint32))
            low = high
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def piece_starts(length: int, room: int) -> list[int]:
    """Where the pieces of a document begin; only the first may be shorter than ``room``."""
    first = (length - 1) % room + 1
    return [0, *range(first, length, room)]


def token_pieces(
    documents: DataFrame, tokenizer: str, doc_id: str, text: str, room: int = ROOM, records: bool = False
) -> DataFrame:
    """``(row, doc_id, piece, start, length, ids_crc32[, record])``: every document with its end id, cut to pieces.

    ``row`` numbers the documents. ``record`` holds the ids as little-endian numbers of four bytes.
    """
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text")
    )
    long = T.LongType()
    fields = [("piece", T.IntegerType()), ("start", long), ("length", long), ("ids_crc32", long)]
    fields += [("record", T.BinaryType())] if records else []
    schema = T.StructType([rows.schema["row"], rows.schema["doc_id"], *[T.StructField(n, k) for n, k in fields]])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(low, ROWS_AT_ONCE)
                row, piece, start, length, sums, data = [], [], [], [], [], []
                for i, body in enumerate(part.column(2)):
                    ids = np.append(encoder.ids(body.as_py() or ""), np.uint32(END)).astype("<u4")
                    starts = piece_starts(len(ids), room)
                    for n, (begin, end) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                        record = ids[begin:end].tobytes()
                        row.append(i)
                        piece.append(n)
                        start.append(begin)
                        length.append(end - begin)
                        sums.append(zlib.crc32(record))
                        if records:
                            data.append(record)
                take = pa.array(row, pa.int64())
                columns = [
                    part.column(0).take(take),
                    part.column(1).take(take),
                    pa.array(piece, pa.int32()),
                    *[pa.array(values, pa.int64()) for values in (start, length, sums)],
                    *([pa.array(data, pa.binary())] if records else []),
                ]
                yield pa.record_batch(columns, names=schema.names)

    return rows.mapInArrow(cut, schema)


@dataclass
class Gaps:
    """Sequences by the room they have left, as intervals of sequence numbers."""

    rooms: list[int] = field(default_factory=list)
    runs: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    opened: int = 0

    def put(self, room: int, first: int, count: int) -> None:
        if room <= 0 or count <= 0:
            return
        if room not in self.runs:
            insort(self.rooms, room)
            self.runs[room] = []
        self.runs[room].append((first, count))

    def take(self, least: int) -> tuple[int, int, int] | None:
        """``(room, first, count)`` of the smallest gaps that hold ``least``."""
        at = bisect_left(self.rooms, least)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        first, count = self.runs[room].pop()
        if not self.runs[room]:
            del self.runs[room]
            self.rooms.pop(at)
        return room, first, count

    def open(self, room: int, count: int) -> tuple[int, int, int]:
        self.opened += count
        return room, self.opened - count, count


def best_fit(counts: dict[int, int], room: int) -> tuple[np.ndarray, int]:
    """``(matches, sequences)`` for so many pieces of each length.

    A match is ``(rank, length, sequence, each, offset)``: pieces from that rank on, in falling order of
    length, go to consecutive sequences, ``each`` to one, from that offset on, up to the next match.
    """
    gaps, matches, rank = Gaps(), [], 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            gap = gaps.take(length)
            if gap is None:
                gap = gaps.open(room, -(-left // (room // length)))
            have, first, count = gap
            # Of all gaps that hold the piece this is the smallest, and what it leaves is smaller still.
            each = min(have // length, left)
            full = min(count, left // each)
            matches.append((rank, length, first, each, room - have))
            gaps.put(have - each * length, first, full)
            gaps.put(have, first + full, count - full)
            rank += full * each
            left -= full * each
    return np.array(matches, np.int64).reshape(-1, 5), gaps.opened


def place_pieces(pieces: DataFrame, room: int = ROOM) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to stored pieces (``row, doc_id, piece, start, length, ids_crc32``).

    Ranks follow length, id, piece and digest, so places do not depend on how the input was split; only
    repeated rows are interchangeable. The driver gets the number of pieces of each length.
    """
    spark = pieces.sparkSession
    counts = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    matches, _ = best_fit(counts, room)
    total = sum(counts.values())
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PIECES_PER_TASK))
    columns = pieces.columns
    falling = pieces.withColumn("shortness", -F.col("length"))
    order = ["shortness", "doc_id", "piece", "ids_crc32", "start"]
    ranked = with_rank(falling, order, tasks, carry=["length", "row"])
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rank = batch.column(batch.num_columns - 1).to_numpy()
            first, length, sequence, each, offset = matches[np.searchsorted(matches[:, 0], rank, "right") - 1].T
            nth = rank - first
            places = [pa.array(sequence + nth // each), pa.array(offset + nth % each * length)]
            yield pa.record_batch([*batch.columns[:-1], *places], names=schema.names)

    return ranked.select(*columns, "rank").mapInArrow(look_up, schema)


def pack(
    documents: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", room: int = ROOM
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``, one row per piece.

    Null and empty texts are documents of one id, the end. Documents above ``room`` ids are cut, the
    rest stay whole. Repeated rows are packed each, null ids stay null, other columns are left out, and an
    empty table gives no rows. Sequences have no gaps inside and at most ``room`` ids.
    """
    return place_pieces(written(token_pieces(documents, tokenizer, doc_id, text, room), "pieces"), room).drop("row")


def packed_sequences(
    documents: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", room: int = ROOM
) -> DataFrame:
    """``(sequence_id, n_tokens, record)``: the packed sequences with their ids, four bytes each.

    Ids are made once and stored. Their places come back by the number of the row, and records shuffle once, by
    sequence, of which none is longer than ``room``.
    """
    made = written(token_pieces(documents, tokenizer, doc_id, text, room, records=True), "records")
    placed = place_pieces(made.drop("record"), room).select("row", "piece", "sequence_id", "offset", "length")
    parts = made.select("row", "piece", "record").join(placed, ["row", "piece"])
    grouped = parts.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("offset", "record"))).alias("parts")
    )
    joined = F.unhex(F.array_join(F.transform("parts", lambda part: F.hex(part["record"])), ""))
    return grouped.select("sequence_id", "n_tokens", joined.alias("record"))
