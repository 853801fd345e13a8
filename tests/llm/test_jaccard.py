import random

import numpy as np
import pytest

from .brute import jaccard as similarity
from .brute import shingles
from .tables import SMALL
from folioscan.llm import jaccard
from folioscan.llm.components import components


def brute(rows, least=0.8):
    """``(doc_id, class_id, copy_id, n_links, n_copies)`` by comparing all pairs."""
    sets = {}
    for i, t in rows:
        sets.setdefault(frozenset(shingles(t)), []).append(i)
    keys = list(sets)
    links = {k: [o for o in keys if o != k and k and o and similarity(k, o) >= least - 1e-12] for k in keys}
    out, first = [], lambda ids: min((i for i in ids if i is not None), default=None)
    for k in keys:
        seen, todo = {k}, [k]
        while todo:
            for o in links[todo.pop()]:
                if o not in seen:
                    seen.add(o)
                    todo.append(o)
        group = first(i for s in seen for i in sets[s])
        out += [(i, group, first(sets[k]), len(links[k]), len(sets[k])) for i in sets[k]]
    return sorted(out, key=str)


def joined(table, **options):
    return sorted((tuple(r) for r in jaccard.jaccard_join(table, **options).collect()), key=str)


def near_copies(seed, groups, copies, words):
    random.seed(seed)
    word = lambda: "".join(random.choice("abcdefghij") for _ in range(4))
    rows = []
    for _ in range(groups):
        text = [word() for _ in range(words)]
        for _ in range(copies):
            mine = list(text)
            for _ in range(random.choice([0, 1, 1, 2, 4])):
                mine[random.randrange(len(mine))] = word()
            rows.append((len(rows), " ".join(mine)))
    random.shuffle(rows)
    return rows


def test_tables_equal_brute_force(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert joined(table) == brute([(r.doc_id, r.text) for r in table.collect()])


def test_near_copies_equal_brute_force(spark, monkeypatch):
    rows = near_copies(1, 12, 15, 120)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert max(r[3] for r in want) > 5 and joined(table) == want
    monkeypatch.setattr(jaccard, "BLOCK_CLASSES", 4)
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", 1)
    assert joined(table) == want


def test_empty_blocks_count_no_link_twice(spark, monkeypatch):
    rows = near_copies(7, 10, 3, 120)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 40)
    got = joined(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute(rows) and max(r[3] for r in got) == 2


@pytest.mark.parametrize("least", [1, 500_000])
def test_equal_rows_make_one_set(spark, monkeypatch, least):
    """Rows equal in id and text, null ids among them, reach the comparison once."""
    (_, one), (_, two) = near_copies(9, 1, 2, 80)[:2]
    rows = [(None, one)] * 3_000 + [(5, two)] * 40 + [(6, two), (7, "other words than those of all others")]
    seen = []
    cut = jaccard._shingle_sets
    monkeypatch.setattr(jaccard, "_shingle_sets", lambda texts: seen.append(texts.count()) or cut(texts))
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", least)
    got = joined(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute(rows) and seen == [2]


def test_awkward_rows(awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert joined(awkward) == brute(rows)
    kept = jaccard.keep_first(awkward)
    assert kept.schema == awkward.schema
    want = sorted({r[1] for r in brute(rows)}, key=str)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == want
    assert joined(nothing) == [] and jaccard.keep_first(nothing).count() == 0


@pytest.mark.parametrize("repeat", [False, True])
def test_one_document_of_each_group_stays(spark, repeat):
    rows = near_copies(4, 8, 6, 80)
    rows += rows[:5] if repeat else []
    kept = jaccard.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == sorted({r[1] for r in brute(rows)})


def test_pruning_bounds():
    bounds = jaccard.least_matches(0.8, 1e-6)
    assert bounds == sorted(bounds) and 0 < bounds[0] and bounds[-1] < 0.8 * 64
    assert np.all(np.array(jaccard.least_matches(0.8, 1e-3)) >= bounds)


def test_components(spark):
    random.seed(6)
    for n, m in ((1, 0), (60, 40), (200, 120), (30, 100)):
        edges = [(random.randrange(n), random.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(1000, 1040)]
        parent = {}
        find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
        for a, b in edges:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
        table = spark.createDataFrame(edges + [(None, 1)], "a long, b long")
        got = {r.node: r.label for r in components(table).collect()}
        assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert components(table.limit(0)).count() == 0
