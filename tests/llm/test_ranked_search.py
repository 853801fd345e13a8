"""Ranked search against SQL on awkward tables, and its reads against plain scores."""

import duckdb
import numpy as np
import pytest
from check import normal

from folioscan.llm import ranked_search
from folioscan.llm.queries import OP11_SQL


def by_sql(documents, items):
    con = duckdb.connect()
    columns = [c for c in ("doc_id", "text") if c in documents.columns]
    con.register("documents", documents.select(*columns).toArrow())
    con.register("benchmark", items.toArrow())
    return normal(con.execute(OP11_SQL).fetchall(), ["item_id", "rank", "doc_id", "score"])


ITEMS = [
    (1, "alpha beta nothing"),
    (1, "WORD1 and2 and3 one"),
    (2, None),
    (3, " .. "),
    (None, "row of words"),
    (4, "row row row of words, repeated"),
    (5, "CAFÉ café 中文"),
    (6, "absent"),
]


@pytest.mark.parametrize("shard", [1, 3, 4096])
def test_awkward_rows(spark, awkward, nothing, shard):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = ranked_search.search(awkward, items, shard_documents=shard)
    assert got.count() > 10
    assert normal([tuple(r) for r in got.collect()], got.columns) == by_sql(awkward, items)
    assert ranked_search.search(nothing, items).count() == 0
    none = ranked_search.search(awkward, items.limit(0))
    assert none.count() == 0 and none.schema.names == got.schema.names


def test_ties_and_hot_groups(spark):
    """Hundreds of copies tie; the smallest ids win, whatever the order of the rows."""
    rows = [(i, "same words here" if i % 3 else f"other words {i}") for i in range(600, 0, -1)]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([(7, "same here"), (8, "words")], "item_id long, text string")
    got = ranked_search.search(documents, items, shard_documents=50)
    assert normal([tuple(r) for r in got.collect()], got.columns) == by_sql(documents, items)
    assert [r.doc_id for r in got.filter("item_id = 7").orderBy("rank").collect()] == [1, 2, 4, 5, 7, 8, 10, 11, 13, 14]


def test_blocks_of_items(spark, awkward, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    whole = ranked_search.search(awkward, items).collect()
    monkeypatch.setattr(ranked_search, "TERMS_PER_PASS", 3)
    assert sorted(map(repr, ranked_search.search(awkward, items).collect())) == sorted(map(repr, whole))


def lists_of(rng, size, n_terms):
    impact, slot, begin, end = [], [], [], []
    for _ in range(n_terms):
        docs = rng.permutation(size)[: rng.integers(1, size + 1)]
        values = np.sort(rng.integers(0, 50, len(docs)) ** 3)[::-1]
        begin.append(len(impact))
        impact += values.tolist()
        slot += docs.tolist()
        end.append(len(impact))
    return (np.array(c, np.int64) for c in (impact, slot, begin, end))


@pytest.mark.parametrize("seed", range(40))
def test_resolved_scores(seed, monkeypatch):
    monkeypatch.setattr(ranked_search, "FIRST_READ", 2)
    rng = np.random.default_rng(seed)
    size = int(rng.integers(1, 400))
    impact, slot, begin, end = lists_of(rng, size, int(rng.integers(1, 6)))
    carried = np.sort(rng.integers(1, 200_000, rng.integers(0, 11)))
    slots, scores, _ = ranked_search.resolve(impact, slot, begin, end, size, carried)
    whole = np.zeros(size, np.int64)
    np.add.at(whole, slot, impact)
    assert (whole[slots] == scores).all()
    known = np.sort(np.concatenate((carried, whole[whole > 0])))[::-1]
    limit = known[9] if len(known) >= 10 else 1
    assert set(np.flatnonzero(whole >= max(limit, 1))) <= set(slots.tolist())


def test_reads_stop_early():
    """One document leads by far: most of the lists stays unread."""
    size = 10_000
    impact = np.concatenate([np.r_[10_000, np.sort(np.arange(1, size))[::-1] // 10] for _ in range(3)]).astype(np.int64)
    slot = np.tile(np.arange(size), 3)
    begin = np.arange(3) * size
    slots, scores, read = ranked_search.resolve(impact, slot, begin, begin + size, size, np.zeros(0, np.int64), top=1)
    assert slots.tolist() == [0] and scores.tolist() == [30_000] and read <= 3 * ranked_search.FIRST_READ
    assert ranked_search.resolve(impact, slot, begin, begin + size, size, np.array([40_000]), top=1)[2] == 0
