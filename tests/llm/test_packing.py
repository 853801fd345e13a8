"""Packing against a plain best fit, the library's ids, and the rules of the result."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import zlib
from tokenizers import Tokenizer

from folioscan.llm import packing
from .tables import SMALL

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_best_fit(lengths, room):
    gaps = []
    for length in sorted(lengths, reverse=True):
        fitting = [g for g in gaps if g >= length]
        gap = min(fitting, default=room)
        if fitting:
            gaps.remove(gap)
        gaps.append(gap - length)
    return sorted(gaps)


def spread_out(counts, room):
    """Every piece's ``(length, sequence, offset)`` by the matches."""
    matches, n = packing.best_fit(counts, room)
    lengths = [length for length in sorted(counts, reverse=True) for _ in range(counts[length])]
    out = []
    for rank, length in enumerate(lengths):
        first, of, sequence, each, offset = matches[np.searchsorted(matches[:, 0], rank, "right") - 1]
        assert of == length
        out.append((length, int(sequence + (rank - first) // each), int(offset + (rank - first) % each * length)))
    return out, n


@pytest.mark.parametrize("seed", range(30))
def test_matches_are_best_fit(seed):
    rng = np.random.default_rng(seed)
    room = int(rng.integers(1, 80))
    lengths = rng.integers(1, room + 1, rng.integers(0, 300)).tolist() + [1] * int(rng.integers(0, 100))
    placed, n = spread_out(Counter(lengths), room)
    used = {}
    for length, sequence, offset in sorted(placed, key=lambda p: (p[1], p[2])):
        assert used.get(sequence, 0) == offset
        used[sequence] = offset + length
    assert sorted(used) == list(range(n))
    assert sorted(room - u for u in used.values()) == plain_best_fit(lengths, room)


def check_rules(rows, room):
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values(), default=0) <= room
    return ends


def expected_pieces(rows, room):
    library, out = Tokenizer.from_file(PATH), []
    for doc_id, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % room or min(room, len(ids))
        starts = [0, *range(first, len(ids), room)]
        for n, (begin, end) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            out.append((doc_id, n, begin, end - begin, zlib.crc32(ids[begin:end].tobytes())))
    return sorted(map(repr, out))


@pytest.mark.parametrize("room", [1, 16, 2048])
def test_awkward_rows(spark, awkward, nothing, room):
    special = [(20, "a <|endoftext|> inside <|endoftext|>"), (21, "<|endoftext|>"), (22, "  two  blanks \n\n")]
    documents = awkward.select("doc_id", "text").unionByName(spark.createDataFrame(special, "doc_id long, text string"))
    if room == 1:
        documents = documents.filter("length(text) < 1000")
    rows = packing.pack(documents, PATH, room=room).collect()
    got = sorted(repr((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows)
    assert got == expected_pieces([tuple(r) for r in documents.collect()], room)
    ends = check_rules(rows, room)
    assert sorted(room - e for e in ends.values()) == plain_best_fit([r.length for r in rows], room)
    assert packing.pack(nothing, PATH, room=room).count() == 0


def test_places_do_not_depend_on_the_split(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    places = [
        sorted(map(tuple, packing.pack(documents.repartition(n), PATH).collect())) for n in (1, 5)
    ]
    assert places[0] == places[1]
    total = sum(row[3] for row in places[0])
    assert len({row[5] for row in places[0]}) <= -(-total // 2048) + 2


def test_sequences_hold_their_ids(spark, awkward):
    rows = packing.pack(awkward, PATH, room=64).collect()
    whole = {r.sequence_id: r for r in packing.packed_sequences(awkward, PATH, room=64).collect()}
    assert {s: r.n_tokens for s, r in whole.items()} == check_rules(rows, 64)
    by_place = lambda r: whole[r.sequence_id].record[4 * r.offset : 4 * (r.offset + r.length)]
    assert sorted(zlib.crc32(by_place(r)) for r in rows) == sorted(r.ids_crc32 for r in rows)


def test_cut_texts_have_the_same_ids(monkeypatch):
    encoder = packing.Encoder(PATH)
    text = "some words,  and\n\n more é中 <|endoftext|> 123 " * 50
    whole = encoder.ids(text).tolist()
    assert whole == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(packing, "PIECE_CHARS", 20)
    assert encoder.ids(text).tolist() == whole
