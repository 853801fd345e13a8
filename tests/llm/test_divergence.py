"""Source divergence against SQL on awkward tables, and shared trees against plain sums."""

import duckdb
import numpy as np
import pytest
from check import normal

from folioscan.llm import divergence
from folioscan.llm.queries import OP12_SQL

NAMES = ["lang", "source", "part", "item", "value", "rank"]


def by_sql(documents, least, top=50):
    con = duckdb.connect()
    con.register("documents", documents.select("text", "lang", "source").toArrow())
    sql = OP12_SQL.replace(">= 30", f">= {least}").replace("<= 50", f"<= {top}")
    return normal(con.execute(sql).fetchall(), NAMES)


def rows_of(found):
    assert found.columns == NAMES
    return normal([tuple(r) for r in found.collect()], NAMES)


@pytest.mark.parametrize("least", [1, 2, 30])
def test_awkward_rows(spark, awkward, nothing, least):
    assert rows_of(divergence.differences(awkward, least=least)) == by_sql(awkward, least)
    assert divergence.differences(nothing, least=least).count() == 0


def documents_of(spark, n=400, sources=9):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}é" for k in rng.zipf(1.3, 40) % 300]
        rows.append((" ".join(words), "en" if i % 5 else None, f"s{rng.integers(sources) ** 2 // sources}" if i % 7 else None))
    return spark.createDataFrame(rows, "text string, lang string, source string")


def test_blocks_and_ranges(spark, monkeypatch):
    """Few terms a range, few sources a block and few pairs at once give the same rows."""
    documents = documents_of(spark)
    expected = by_sql(documents, 3, 5)
    assert len(expected) > 100
    assert rows_of(divergence.differences(documents, least=3, top=5)) == expected
    monkeypatch.setattr(divergence, "RANGE_TERMS", 16)
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", 2)
    monkeypatch.setattr(divergence, "PAIRS_AT_ONCE", 3)
    assert rows_of(divergence.differences(documents, least=3, top=5)) == expected


def test_counts_are_given_in_parts(spark, monkeypatch):
    documents = documents_of(spark).repartition(3)
    expected = by_sql(documents, 3)
    monkeypatch.setattr(divergence, "ENTRIES_HELD", 20)
    monkeypatch.setattr(divergence, "ROWS_GIVEN", 7)
    assert rows_of(divergence.differences(documents, least=3)) == expected


@pytest.mark.parametrize("seed", range(20))
def test_forest(seed):
    rng = np.random.default_rng(seed)
    trees, width = int(rng.integers(2, 9)), 1 << int(rng.integers(0, 7))
    counts = rng.integers(0, 3, (trees, width)) * (rng.random((trees, width)) < 0.3)
    counts[:, width - width // 4 :] = -1
    forest = divergence.Forest(counts)
    left, right = (a.ravel() for a in np.meshgrid(np.arange(trees), np.arange(trees)))
    pair, a, b, times = forest.leaf_pairs(left, right)
    sums = np.zeros(len(left), np.int64)
    np.add.at(sums, pair, np.abs(a - b) ** 3 * times)
    assert sums.tolist() == [int((np.abs(counts[i] - counts[j]) ** 3).sum()) for i, j in zip(left, right)]
    which, place, a, b = forest.leaves(left, right)
    plain = {(k, p) for k, i in enumerate(left) for p in np.flatnonzero(counts[i] > 0)}
    assert {(k, p) for k, p in zip(which.tolist(), place.tolist())} == plain and len(which) == len(plain)
    assert all(x == counts[left[k], p] and y == counts[right[k], p] for k, p, x, y in zip(which, place, a, b))


def test_equal_subtrees_are_one_node():
    counts = np.zeros((50, 1024), np.int64)
    counts[np.arange(50), np.arange(50)] = 1
    forest = divergence.Forest(counts)
    # Beside the path from each single leaf there is one empty node a level.
    assert sum(len(low) for low, _ in forest.levels) < 50 * 10
    assert len(forest.leaf_pairs(np.arange(49), np.arange(1, 50))[0]) <= 49 * 3


def test_exact_shares():
    rng = np.random.default_rng(5)
    total = rng.integers(1, 2**47, 2000)
    counts = (rng.random(2000) * total).astype(np.int64)
    plain = [1 + 10**9 * (int(c) + 5) // int(t) for c, t in zip(counts, total)]
    assert divergence.shares(counts, total).tolist() == plain
    assert divergence.shares(np.array([-1]), np.array([9])).tolist() == [0]
