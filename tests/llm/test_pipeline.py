"""Each stage against brute force on its own input."""


import corpus_pipeline
from .tables import SMALL
from folioscan.llm import quality
from .test_decontaminate import brute as leaks
from .test_jaccard import brute as groups
from .test_mixing import brute as mix


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    texts = lambda table: [(r.doc_id, r.text) for r in table.collect()]

    good = stages["quality"](spark, docs, SMALL).cache()
    model = quality.fit(quality.labelled(quality.document_statistics(docs, ["doc_id"]), labels))
    scored = quality.score_statistics(quality.document_statistics(docs, ["doc_id"]), model, ["doc_id"])
    assert good.columns == columns and 0 < good.count() < docs.count()
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in scored.collect() if r.score >= 0.3}

    single = stages["near duplicates"](spark, good, SMALL).cache()
    assert single.columns == columns
    assert sorted(i for i, _ in texts(single)) == sorted({g[1] for g in groups(texts(good))})

    clean = stages["decontamination"](spark, single, SMALL).cache()
    assert clean.columns == columns
    held = {i for i, *_ in leaks(texts(single), items)}
    assert {i for i, _ in texts(clean)} == {i for i, _ in texts(single)} - held

    mixed = stages["mixing"](spark, clean, SMALL).cache()
    assert mixed.columns == columns
    taken = {i: (n, t) for i, n, _, _, t in mix([(r.doc_id, r.text, r.source) for r in clean.collect()])}
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert all(counts.get(i, 0) * n == t for i, (n, t) in taken.items())

    stored = stages["tokens"](spark, mixed, SMALL).collect()
    assert sorted(r.slot for r in stored) == list(range(len(stored)))
    firsts = {}
    for r in stored:
        firsts[r.doc_id] = firsts.get(r.doc_id, 0) + (r.piece == 0)
    assert firsts == counts
    assert corpus_pipeline.run(spark, SMALL).count() == len(stored)


def test_awkward_rows(spark, awkward, nothing):
    for docs in (awkward, nothing):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            if name != "tokens":
                assert out.schema == docs.schema
                docs = out
        assert (out.count() > 0) == (docs.count() > 0)


