"""Bitmap joins against plain sets, and the plans they are for."""

import random

import pytest
from pyspark.sql import functions as F

from folioscan.operators import bitmap, joins
from folioscan.operators.errors import retry_pass
from folioscan.functions.urls import item_code
from folioscan.sources.pages import pages_of
from folioscan.sources.workspace import new_folder


@pytest.mark.parametrize("listed", [0, 3, 500])
@pytest.mark.parametrize("size", [1 << 28, 300])
def test_semi_and_anti_equal_sets(spark, monkeypatch, listed, size):
    monkeypatch.setattr(bitmap, "LISTED_KEYS", listed)
    monkeypatch.setattr(bitmap, "BITMAP_BYTES", size)
    rng = random.Random(listed)
    edges = [0, -1, 1, 32767, 32768, -32768, -32769, 65535, 2**63 - 1, -(2**63), 7, 8, 15]
    ids = edges + [rng.randrange(-100_000, 100_000) for _ in range(500)] + [rng.randrange(2**62) for _ in range(50)] + [None]
    rows = spark.createDataFrame([(i, f"v{n}") for n, i in enumerate(ids)], "id long, v string")
    for chosen in (edges, rng.sample(ids[:-1], 200), []):
        keys = spark.createDataFrame([(i,) for i in {*chosen}] + [(None,)], "id long")
        got = {r["v"] for r in bitmap.with_keys(rows, keys, "id").collect()}
        assert got == {f"v{n}" for n, i in enumerate(ids) if i in {*chosen}}
        rest = {r["v"] for r in bitmap.with_keys(rows, keys, "id", inside=False).collect()}
        assert rest == {f"v{n}" for n, i in enumerate(ids) if i not in {*chosen}}


@pytest.mark.parametrize("size", [1 << 28, 100])
def test_html_is_never_exchanged(spark, monkeypatch, size):
    """With no keys broadcast and no automatic broadcast the pages still stay where they are."""
    monkeypatch.setattr(joins, "BROADCAST_KEYS", 0)
    monkeypatch.setattr(bitmap, "BITMAP_BYTES", size)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        path = new_folder(spark, "pages")
        url = F.concat(F.lit("http://h/v.do?wrtSn="), (F.col("id") + 1000).cast("string"))
        spark.range(200_000).select((F.col("id") * 7).alias("page_id"), url.alias("url"), F.lit("<p>").alias("html")).write.parquet(path)
        archive = spark.read.parquet(path)
        hits = archive.filter("page_id % 3 = 0").select("page_id", F.lit("hit").alias("status"))
        lines = spark.createDataFrame([("1005 : x",), ("1006 : x",), ("9 : x",)], "value string")
        kept = joins.keep_marked(archive, archive.select("page_id"), "page_id", F.col("page_id") % 3 == 0)
        retried = retry_pass(lines, archive, item_code(F.col("url")))
        for found, n in ((pages_of(hits, archive), 66_667), (retried, 2), (kept, 66_667)):
            assert found.count() == n
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert "html" in plan and "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_uncounted_sides_are_not_broadcast(spark):
    """Short rows in small files look small to Spark, however many they are: it may not broadcast what nobody counted."""
    from folioscan.operators.first_writer import absent, insert_if_absent
    from folioscan.plans.crawl import attempts
    from folioscan.plans.ingest import error_rows, routed

    path = new_folder(spark, "few")
    some = spark.range(100).select("id", F.col("id").cast("string").alias("name"), F.lit("7 : x").alias("line"))
    some.write.parquet(path)
    rows = spark.read.parquet(path)
    staged = rows.selectExpr(
        "id AS page_id", "name AS _id", "name AS license", "name AS hero_url", "name AS license_url", "true AS has_parts",
        "true AS has_rows", "array('x') AS unknown_titles", "array('y') AS repeated_attributes",
    )
    assets = rows.filter("id < 50").select(F.col("name").alias("url"), F.col("line").cast("binary").alias("payload"))
    plain = [
        (insert_if_absent(rows, rows, ["name"], ["id"]), 0),
        (absent(rows.filter("id < 60"), rows.filter("id > 9"), ["name"]), 10),
        (attempts(rows, rows), 2),
        (joins.having_key(rows, rows.select("name").filter("id < 30"), "name", 0), 30),
        (error_rows(staged, routed(staged)), 200),
    ]
    for found, n in plain:
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan and found.count() == n
    # Here the list of hot keys is broadcast, and rows that were counted.
    for found, n in ((joins.hot_key_join(rows, rows.select("name"), "name", ["id"]), 100), (routed(staged, assets), 100)):
        assert "SortMergeJoin" in found._jdf.queryExecution().executedPlan().toString() and found.count() == n


def test_keys_and_bitmaps_fit_a_small_driver():
    """A key that is broadcast takes some 64 bytes: its row, and places of a table that doubles."""
    assert joins.BROADCAST_KEYS * 64 <= 64 << 20 and bitmap.BITMAP_BYTES <= 64 << 20
