"""The compacted key index against a plain set of keys."""

import random

from pyspark.sql import functions as F

from folioscan.plans.ingest import ItemOptions, ingest_batch
from folioscan.sources import key_index
from folioscan.sources.key_index import KeyIndex
from folioscan.sources.tables import read_table, reset_tables
from folioscan.sources.workspace import new_folder


def write(spark, root, run, n, keys):
    rows = spark.createDataFrame([(k, "x") for k in keys], "_id string, filename string").coalesce(1)
    index = KeyIndex(spark, root, "items", "_id")
    index.rewritten(run, n)
    rows.write.mode("overwrite").parquet(f"{root}/items/run={run}/batch_id={n}")
    index.compact()


def keys_of(rows):
    return sorted((r[0] for r in rows.distinct().collect()), key=str)


def test_index_equals_the_table(spark, monkeypatch):
    monkeypatch.setattr(key_index, "FAN", 2)
    monkeypatch.setattr(key_index, "PART_KEYS", 3)
    monkeypatch.setattr(key_index, "SMALL_KEYS", 0)
    root, rng, held = new_folder(spark, "t"), random.Random(2), {}
    for n in range(7):
        batch = (rng.choice(["a", "b"]), rng.randrange(6))
        held[batch] = [f"k{rng.randrange(60)}" for _ in range(rng.randrange(8))] + [None] * (n == 4)
        write(spark, root, *batch, held[batch])
        index = KeyIndex(spark, root, "items", "_id")
        assert len(index.young()) < 2
        asked = [f"k{i}" for i in range(0, 70, 3)] + [None]
        wanted = spark.createDataFrame([(k,) for k in asked], "_id string")
        for own in (batch, ("other", 0)):
            stored = {k for b, keys in held.items() if b != own for k in keys}
            assert keys_of(index.stored(None, *own)) == sorted(stored, key=str)
            found = set(keys_of(index.stored(wanted, *own)))
            assert found <= stored and found & set(asked) == stored & set(asked)


def test_only_matching_parts_are_opened(spark, monkeypatch):
    monkeypatch.setattr(key_index, "FAN", 2)
    monkeypatch.setattr(key_index, "PART_KEYS", 100)
    root = new_folder(spark, "t")
    write(spark, root, "a", 0, [f"k{i}" for i in range(0, 5000, 2)])
    write(spark, root, "a", 1, [f"k{i}" for i in range(1, 5000, 2)])
    index = KeyIndex(spark, root, "items", "_id")
    (segment,) = index.segments
    assert (segment.parts, segment.rows, index.young()) == (64, 5000, [])
    part = lambda keys: {r[0] for r in spark.createDataFrame([(k,) for k in keys], "_id string").select(index._part(64)).collect()}
    known = spark.createDataFrame([("k7",), ("k8",)], "_id string")
    rows = index.stored(known, "b", 0)
    files = {r[0].split("/part=")[1].split("/")[0] for r in rows.select(F.input_file_name()).distinct().collect()}
    assert files == {str(p) for p in part(["k7", "k8"])} and len(files) <= 2
    assert "PartitionFilters: [part#" in rows._jdf.queryExecution().toString()
    # Keys that are new open nothing, but for the filter's false positives.
    fresh = spark.createDataFrame([(f"new{i}",) for i in range(20)], "_id string")
    assert len(index.matching_parts(fresh)[segment.name]) <= 3
    every = [f"k{i}" for i in range(0, 5000, 50)]
    found = index.matching_parts(spark.createDataFrame([(k,) for k in every], "_id string"))
    assert set(found[segment.name]) == part(every)


def test_sizes_grow_geometrically(spark, monkeypatch):
    monkeypatch.setattr(key_index, "FAN", 1)
    monkeypatch.setattr(key_index, "SMALL_KEYS", 0)
    sizes = []

    def kept(self, keys, rows, covers):
        return key_index.Segment(str(len(sizes)), rows, 1, 1, covers)

    monkeypatch.setattr(KeyIndex, "_write", kept)
    monkeypatch.setattr(KeyIndex, "_segment_keys", lambda self, segment, parts=None: self._young_keys([]))
    root = new_folder(spark, "t")
    for n, size in enumerate([100, 10, 10, 3, 1]):
        write(spark, root, "a", n, [f"k{i}" for i in range(size)])
        sizes.append(sorted(s.rows for s in KeyIndex(spark, root, "items", "_id").segments))
    assert sizes == [[100], [10, 100], [20, 100], [3, 20, 100], [1, 3, 20, 100]]


def test_many_batches(spark, monkeypatch):
    """Batches with old and new ids store each id once, replays and a reset included."""
    monkeypatch.setattr(key_index, "FAN", 2)
    root = new_folder(spark, "t")
    html = '<h3 class="tit_txt3">t</h3><div class="imgD"><img src="/1.png"></div><div class="copyD"><img src="/l/by.png">CC</div><table class="tb_bbs"><tr><th>UCI</th><td>u</td></tr></table>'
    rows = [(10 * b + n, f"http://h/v.do?wrtSn={1000 + b + n}", html) for b in range(5) for n in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    options = ItemOptions(base_url="http://h")
    for b in (0, 1, 2, 1, 3, 0, 4):
        ingest_batch(pages.filter(F.col("page_id").between(10 * b, 10 * b + 9)), b, root, options)
    items = read_table(spark, root, "items")
    assert sorted(r["_id"] for r in items.collect()) == [str(1000 + i) for i in range(8)]
    assert read_table(spark, root, "licenses").count() == 1
    assert KeyIndex(spark, root, "items", "_id").segments
    reset_tables(spark, root)
    assert not KeyIndex(spark, root, "items", "_id").segments
    ingest_batch(pages.filter("page_id < 10"), 0, root, options)
    assert read_table(spark, root, "items").count() == 4
