import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .tables import SMALL
from folioscan.llm import quality
from folioscan.llm.queries import op4_quality

MIDDLE = "/root/testdata/sf0.01"


def test_contract_and_held_out_accuracy(spark):
    rows = op4_quality(spark, MIDDLE).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(judged) > 50 and np.mean([p == y for p, y in judged]) > 0.97


def test_held_out_labels_are_never_read(spark):
    documents, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    stats = quality.document_statistics(documents, ["doc_id"])
    a, b = (quality.fit(quality.labelled(stats, table)) for table in (labels, flipped))
    assert (a.mean == b.mean).all() and (a.whiten == b.whiten).all()


def test_fit_equals_plain_discriminant(spark):
    documents, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    known = quality.labelled(quality.document_statistics(documents, ["doc_id"]), labels)
    model = quality.fit(known)
    rows = known.collect()
    x, y = np.array([r.stats for r in rows]), np.array([r.label for r in rows])
    cov = [np.cov(x[y == k].T, bias=True) for k in (0, 1)]
    n = np.array([(y == k).sum() for k in (0, 1)])
    pooled = np.maximum(((cov[0] * n[0] + cov[1] * n[1]) / n.sum()).diagonal(), quality.VARIANCE_FLOOR)
    logs = []
    for k in (0, 1):
        s = 0.9 * cov[k] + 0.1 * np.diag(pooled) + 1e-3 * quality.VARIANCE_FLOOR * np.eye(len(pooled))
        d = x - x[y == k].mean(axis=0)
        far = np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d)
        logs.append(np.log((n[k] + 1) / (n.sum() + 2)) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * far)
    want = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))
    assert np.allclose(model.score(x), want, atol=1e-6)


def test_order_of_rows_does_not_matter(spark):
    documents, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    known = quality.labelled(quality.document_statistics(documents, ["doc_id"]), labels)
    a, b = (quality.fit(known.repartition(n)) for n in (1, 7))
    assert (a.mean == b.mean).all() and (a.whiten == b.whiten).all() and (a.constant == b.constant).all()


def test_awkward_rows(awkward, nothing, spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (6, 1), (None, 1), (99, 0)], "doc_id long, quality int")
    for known in (labels, labels.filter("quality = 1"), labels.limit(0)):
        model = quality.fit(quality.labelled(quality.document_statistics(awkward, ["doc_id"]), known))
        scored = quality.score_statistics(quality.document_statistics(awkward, ["doc_id"]), model, ["doc_id"])
        scores = [r.score for r in scored.collect()]
        assert len(scores) == awkward.count() and all(0 <= s <= 1 for s in scores)
        kept = quality.keep_good(awkward, model)
        assert kept.schema == awkward.schema and kept.count() == sum(s >= quality.KEEP for s in scores)
        assert quality.keep_good(nothing, model).count() == 0


def test_an_empty_text_is_a_row_of_zeros():
    rows = pa.RecordBatch.from_arrays([pa.array([None, "", "a b"], pa.string())], names=["text"])
    ((_, table),) = quality._measured(iter([rows]), 0)
    assert (table[:2] == 0).all() and table[2].any() and np.isfinite(table).all()


def test_no_task_measures_and_adds_up(spark, monkeypatch):
    """Two Python workers in one task would be twice the memory: statistics are stored between, also with broadcast labels."""
    documents, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    known = quality.labelled(quality.document_statistics(documents, ["doc_id"]), F.broadcast(labels))
    inputs, kind = [], type(documents)
    plain = kind.mapInArrow

    def seen(rows, *args, **kwargs):
        inputs.append(rows._jdf.queryExecution().executedPlan().toString())
        return plain(rows, *args, **kwargs)

    monkeypatch.setattr(kind, "mapInArrow", seen)
    quality.fit(known)
    assert len(inputs) == 1 and "MapInArrow" not in inputs[0]
