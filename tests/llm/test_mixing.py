import hashlib
import random
import re

from pyspark.sql import functions as F

from folioscan.llm import mixing

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, weights=(5, 2, 1), most=3):
    """Targets by plain water filling, takes by a sort of places."""
    sized = [(i, len(WORDS.findall(t or "")), s) for i, t, s in rows]
    sources = sorted({s for *_, s in sized}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(n for _, n, x in sized if x == s) for s in sources}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sources)}
    cut = set()
    while True:
        left = sum(weight[s] for s in sources if s not in cut)
        share = (sum(total.values()) - sum(most * total[s] for s in cut)) / left if left else 0
        more = {s for s in sources if s not in cut and weight[s] * share > most * total[s]}
        if not more:
            break
        cut |= more
    target = {s: min(weight[s] * share, most * total[s]) if s not in cut else float(most * total[s]) for s in sources}
    place = lambda i: int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16)
    times = {}
    for s in sources:
        whole = int(target[s] // total[s]) if total[s] else 0
        rest = target[s] - whole * total[s]
        groups = {}
        for i, n, x in sized:
            if x == s:
                groups[place(i)] = groups.get(place(i), 0) + n
        upto = 0
        for p in sorted(groups):
            below, upto = upto, upto + groups[p]
            more = upto <= rest or (below <= rest and 2 * (rest - below) >= groups[p])
            times[s, p] = whole + more
    return sorted(((i, n, total[s], round(target[s], 6), n * times[s, place(i)]) for i, n, s in sized), key=str)


def mixed(table):
    rows = mixing.mix(table).collect()
    return sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in rows), key=str)


def test_random_sources_equal_brute_force(spark):
    random.seed(2)
    for sizes in ([400, 3, 20, 80, 1], [1, 1], [50], [5, 300, 2, 2, 2, 200, 1]):
        rows = []
        for k, n in enumerate(sizes):
            source = None if k == 4 else f"s{k}é"
            for _ in range(n):
                rows.append((len(rows), "w " * random.choice([0, 1, 5, 30, 400]), source))
        table = spark.createDataFrame(rows, "doc_id long, text string, source string")
        got = mixed(table)
        assert got == brute(rows)
        total = {}
        for _, n, size, target, taken in got:
            assert taken <= 3 * n
            total.setdefault((size, target), []).append(taken)
        assert all(abs(sum(taken) - target) <= 400 for (_, target), taken in total.items())
        repeated = mixing.mixed_documents(table).groupBy("doc_id").count().collect()
        times = {i: taken // n for i, n, _, _, taken in got if n}
        assert {r["doc_id"]: r["count"] for r in repeated if r["doc_id"] in times} == {i: t for i, t in times.items() if t}


def test_awkward_rows(awkward, nothing):
    rows = [(r.doc_id, r.text, r.source) for r in awkward.collect()]
    # Rows of one id share a place, so their takes are compared together.
    assert mixed(awkward) == brute(rows)
    out = mixing.mixed_documents(awkward)
    assert out.schema == awkward.schema and out.count() > 0
    assert mixed(nothing) == [] and mixing.mixed_documents(nothing).count() == 0
    assert mixed(awkward.withColumn("text", F.lit(None).cast("string")))[0][-1] == 0
