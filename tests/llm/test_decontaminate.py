import random

from pyspark.sql import functions as F

from .brute import shingles
from .tables import SMALL
from folioscan.llm import decontaminate


def brute(documents, items, least=0.8):
    out = []
    cut = [(i, shingles(t)) for i, t in items]
    for doc_id, text in documents:
        for item_id, mine in cut:
            if mine:
                shared = len(mine & shingles(text, len(next(iter(mine)))))
                if shared >= least * len(mine) - 1e-9:
                    out.append((doc_id, item_id, len(mine), shared))
    return sorted(out, key=str)


def found(documents, items, **options):
    rows = decontaminate.find_items(documents, items, **options).collect()
    return sorted(((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in rows), key=str)


def test_tables_equal_brute_force(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert want and found(documents, items) == want
    assert found(documents, items, hashes_per_pass=100) == want
    kept = decontaminate.drop_contaminated(documents, items, hashes_per_pass=300)
    assert kept.columns == documents.columns
    ids = {r.doc_id for r in documents.collect()} - {d for d, *_ in want}
    assert {r.doc_id for r in kept.collect()} == ids


def test_partial_items_in_long_documents(spark):
    random.seed(5)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(5))
    items = [(i, " ".join(word() for _ in range(random.choice([1, 2, 4, 5, 6, 12, 40, 90])))) for i in range(60)]
    items += [(60, items[0][1]), (61, None), (62, ""), (None, items[1][1]), (63, "?!")]
    documents = []
    for i in range(80):
        words = [word() for _ in range(random.choice([0, 3, 50, 3000]))]
        for _ in range(random.randint(0, 3)):
            cut = (random.choice(items[:60])[1]).upper().split()
            if len(cut) > 10 and random.random() < 0.7:
                cut[random.randrange(len(cut))] = "changed"
            at = random.randint(0, len(words))
            words[at:at] = [w + "," for w in cut]
        documents.append((i, " ".join(words)))
    documents += [(None, items[2][1]), (81, None), (82, ""), documents[0]]
    d = spark.createDataFrame(documents, "doc_id long, text string")
    t = spark.createDataFrame(items, "item_id long, text string")
    for least in (0.8, 0.5, 1.0):
        assert found(d, t, containment=least) == brute(documents, items, least)


def test_awkward_rows(awkward, nothing, spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta"), (2, None)], "item_id long, text string")
    assert {r[0] for r in found(awkward, items)} == {1, 2}
    kept = decontaminate.drop_contaminated(awkward, items)
    assert kept.schema == awkward.schema and kept.count() == awkward.count() - 2
    assert found(awkward, items.limit(0)) == [] == found(nothing, items)
    assert decontaminate.drop_contaminated(awkward, items.limit(0)).count() == awkward.count()
    renamed = items.select(F.col("item_id").alias("i"), F.col("text").alias("t"))
    assert len(found(awkward, renamed, item_id="i", item_text="t")) == 2
