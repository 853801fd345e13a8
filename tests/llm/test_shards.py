import public_tokenizers
import numpy as np
import pytest

from folioscan.llm import shards
from folioscan.sources.workspace import new_folder

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("total", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation(total):
    numbers = np.arange(total)
    slots = shards.permuted(numbers, total, 7)
    assert sorted(slots.tolist()) == numbers.tolist()
    assert (shards.permuted(slots, total, 7, inverse=True) == numbers).all()
    if total > 100:
        assert (shards.permuted(numbers, total, 8) != slots).any()
        assert abs(np.corrcoef(numbers, slots)[0, 1]) < 0.2


def written(spark, rows, **options):
    return shards.write_shards(rows, new_folder(spark, "test"), PATH, public_tokenizers.PATTERN, **options)


def test_round_trip_and_resume(spark, awkward):
    stored = written(spark, awkward, stride=16, shard_sequences=50)
    rows = stored.orderBy("slot").collect()
    assert [r.slot for r in rows] == list(range(len(rows)))
    assert all(r.shard == r.slot // 50 and len(r.record) == 32 for r in rows)
    encoding, end = shards.load_encoding(PATH, public_tokenizers.PATTERN)
    whole = {}
    for r in sorted(rows, key=lambda r: r.piece):
        whole.setdefault(r.doc_id, []).append(shards.token_ids(r.record, r.n_tokens, 16))
    once = {r.doc_id: r.text for r in awkward.collect() if r.doc_id not in (None, 11)}
    for doc_id, text in once.items():
        ids = sum(whole[doc_id], [])
        assert ids[-1] == end and encoding.decode(ids[:-1]) == (text or "")
    resumed = shards.read_slots(stored, 33, 120, 50).collect()
    assert [r.record for r in resumed] == [r.record for r in rows[33:120]]
    again = written(spark, awkward, stride=16, shard_sequences=50)
    assert [r.record for r in again.orderBy("slot").collect()] == [r.record for r in rows]
    digest = shards.shard_digest(stored, 50).collect()
    assert len(digest) == len(rows) and all(d.row_in_shard == d.slot % 50 for d in digest)


def stored_bytes(table):
    return [(r.slot, r.doc_id, r.piece, r.n_tokens, bytes(r.record)) for r in table.orderBy("slot").collect()]


def test_order_does_not_follow_the_split(spark, awkward, monkeypatch):
    """Other partitions, another order of rows, several ranges and a join without broadcast: the same shards."""
    want = stored_bytes(written(spark, awkward.coalesce(1), stride=16, shard_sequences=50))
    for rows in (awkward.repartition(5), awkward.repartition(3, "text").union(awkward.limit(0))):
        assert stored_bytes(written(spark, rows, stride=16, shard_sequences=50)) == want
    for name, value in (("RANGE_ROWS", 7), ("BROADCAST_ROWS", 0), ("TEXTS_AT_ONCE", 2), ("CHARS_AT_ONCE", 40)):
        monkeypatch.setattr(shards, name, value)
    assert stored_bytes(written(spark, awkward.repartition(4), stride=16, shard_sequences=50)) == want


def test_offsets_start_no_python_workers(spark, awkward, monkeypatch):
    """Rows of Python objects would be unpickled by workers of their own beside those that encode."""

    def parallelize(*_):
        raise AssertionError("rows of Python objects")

    monkeypatch.setattr(spark.sparkContext, "parallelize", parallelize)
    monkeypatch.setattr(shards, "RANGE_ROWS", 7)
    stored = written(spark, awkward, stride=16, shard_sequences=50)
    assert [r.slot for r in stored.orderBy("slot").collect()] == list(range(stored.count()))


def test_empty_table(spark, nothing):
    assert written(spark, nothing).count() == 0


def test_pieces_of_long_texts(monkeypatch):
    encoding, _ = shards.load_encoding(PATH, public_tokenizers.PATTERN)
    text = "some words,  and\n\n more é中 " * 400
    whole = encoding.encode_ordinary(text)
    monkeypatch.setattr(shards, "PIECE_CHARS", 100)
    assert shards.encode(encoding, text) == whole
