import hashlib
import random
import re
from collections import Counter

import pytest

from folioscan.llm import substrings


def brute(rows, size):
    cut = [(i, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for i, t in rows]
    times = Counter(tuple(w[k : k + size]) for _, w in cut for k in range(len(w) - size + 1))
    out = []
    for i, w in cut:
        gone = set()
        for k in range(len(w) - size + 1):
            if times[tuple(w[k : k + size])] > 1:
                gone.update(range(k, k + size))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def removed(table, **options):
    return sorted((tuple(r) for r in substrings.remove_repeats(table, **options).collect()), key=str)


def passages(seed, letters, size):
    random.seed(seed)
    word = lambda: "".join(random.choice(letters) for _ in range(2))
    shared = [[word() for _ in range(random.randint(size - 2, 4 * size))] for _ in range(6)]
    rows = []
    for i in range(70):
        words = [word() for _ in range(random.choice([0, 3, size - 1, size, 90]))]
        for _ in range(random.randint(0, 3)):
            passage, at = random.choice(shared), random.randint(0, len(words))
            words[at:at] = passage[random.randint(0, 3) :]
        rows.append((i, random.choice([" ", "\n", " \t"]).join(words)))
    return rows + [rows[0], (70, rows[1][1]), (None, rows[2][1]), (71, None), (72, "")]


@pytest.mark.parametrize(("seed", "letters", "size"), [(1, "abcdefgh", 35), (2, "ab", 10), (3, "abc", 6), (4, "a", 12)])
def test_random_passages_equal_brute_force(spark, seed, letters, size):
    rows = passages(seed, letters, size)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows, size)
    assert removed(table, size=size) == want
    assert removed(table, size=size, shard_contexts=1) == want


def test_awkward_rows(awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert removed(awkward) == brute(rows, 35)
    assert removed(nothing) == []


def test_automaton_counts_runs():
    random.seed(8)
    for _ in range(150):
        texts = [[random.choice("ab") for _ in range(random.randint(0, 14))] for _ in range(random.randint(1, 5))]
        size = random.randint(1, 4)
        automaton = substrings.SuffixAutomaton()
        states = [automaton.add(t) for t in texts]
        automaton.close()
        times = Counter(tuple(t[k : k + size]) for t in texts for k in range(len(t) - size + 1))
        for text, found in zip(texts, states):
            want = [k for k in range(len(text) - size + 1) if times[tuple(text[k : k + size])] > 1]
            assert automaton.repeated(found, size) == want
