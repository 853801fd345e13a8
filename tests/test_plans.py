"""What the physical plans must and must not contain."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import folioscan.sources.pages as page_source
from folioscan.operators.detail import detail_rows, map_attributes, to_wide, widen
from folioscan.operators.first_writer import insert_if_absent
from folioscan.operators.joins import dimension_join
from folioscan.operators.lookup import lookup
from folioscan.operators.page_parse import parse_pages
from folioscan.operators.paging import page_slice, slice_rows, with_rank
from folioscan.plans.ingest import item_rows
from folioscan.sources.pages import read_pages, spread


@pytest.fixture(autouse=True)
def whole_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def pages(spark):
    return read_pages(spark, f"{SMALL}/pages.parquet")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_parse_and_item_rows_do_not_shuffle(pages):
    text = plan(item_rows(parse_pages(pages)))
    assert "Exchange" not in text and text.count("MapInArrow") == 1


def test_only_needed_page_columns_are_read(pages):
    text = plan(parse_pages(pages, ["links"], keys=["page_id"]))
    assert "ReadSchema: struct<page_id:bigint,html:string>" in text


def test_only_small_inputs_are_spread(pages, monkeypatch):
    assert "REPARTITION_BY_NUM" in plan(spread(pages))
    by_key = pages.repartition(pages.sparkSession.sparkContext.defaultParallelism, "page_id")
    assert "hashpartitioning(xxhash64(page_id" in plan(spread(by_key))
    monkeypatch.setattr(page_source, "SPREAD_BYTES_PER_CORE", 1)
    assert "Exchange" not in plan(spread(pages))


def test_wide_columns_are_generated_code(pages):
    text = plan(widen(parse_pages(pages, ["detail"])))
    assert "Exchange" not in text and "HashAggregate" not in text
    assert text.startswith("*("), text[:200]


def test_long_form_shuffles_once_after_a_partial_aggregate(pages, no_broadcast):
    text = plan(to_wide(map_attributes(detail_rows(parse_pages(pages, ["detail"])))))
    assert text.count("Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" in text and "partial_min_by" in text


def test_insert_shuffles_each_side_once(spark, no_broadcast):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").select("source", "doc_id", "lang")
    text = plan(insert_if_absent(documents, documents.select("source"), ["source"], ["doc_id"]))
    assert text.count("Exchange") == 2 and "partial_min" in text


def test_small_insert_does_not_shuffle_the_store(spark, no_broadcast):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    text = plan(insert_if_absent(documents.select("source", "doc_id"), documents, ["source"], ["doc_id"], small=True))
    assert "BroadcastHashJoin" in text and "LeftSemi" in text


def test_lookup_reaches_the_scan(spark):
    text = plan(lookup(spark.read.parquet(f"{SMALL}/part.parquet").select("p_partkey", "p_name"), "p_partkey", 42))
    assert "EqualTo(p_partkey,42)" in text and "ReadSchema: struct<p_partkey:bigint,p_name:string>" in text


def test_slices(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert "TakeOrderedAndProject(limit=27, offset=18" in plan(slice_rows(documents, ["doc_id"], 18, 9))
    text = plan(page_slice(documents.select("doc_id", "text"), "doc_id", 18, 9))
    assert "GreaterThanOrEqual(doc_id,18)" in text and "LessThanOrEqual(doc_id,26)" in text
    assert "BroadcastHashJoin" in text


def test_rank_has_no_global_window(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    text = plan(with_rank(orders, ["o_orderkey"]))
    rows_side = text.split("BroadcastExchange")[0]
    assert "Window" not in rows_side and "SinglePartition" not in rows_side
    assert text.count("SinglePartition") == 1  # one row per partition


def test_dimension_bound_is_checked(spark, no_broadcast):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet").select("o_orderkey", F.col("o_custkey").alias("k"))
    customer = spark.read.parquet(f"{SMALL}/customer.parquet").select(F.col("c_custkey").alias("k"), "c_name")
    assert "SortMergeJoin" not in plan(dimension_join(orders, customer, "k", ["o_orderkey"]))
    beyond = plan(dimension_join(orders, customer, "k", ["o_orderkey"], broadcast_rows=100))
    assert "SortMergeJoin [k" in beyond and "split" in beyond


def test_wide_columns_are_picked_where_they_lie(spark, pages, no_broadcast):
    """HTML and payloads do not shuffle for a small set of keys."""
    from folioscan.operators.errors import retry_pass
    from folioscan.operators.lookup import lookup_json
    from folioscan.plans.ingest import with_payload
    from folioscan.sources.pages import pages_of, resolve_frontier

    urls = pages.select("url")
    resolved = resolve_frontier(urls, pages)
    lines = spark.createDataFrame([("12 : x",)], "value string")
    archive = pages.select(F.col("url"), F.col("html").cast("binary").alias("payload"))
    items = pages.select("page_id", "url").limit(5)
    answers = lookup_json(pages.select("page_id").limit(5), pages, "page_id", ["url"])
    for df, wide in (
        (pages_of(resolved, pages), "html"),
        (retry_pass(lines, pages, F.col("page_id").cast("string")), "html"),
        (with_payload(items, archive, "url"), "payload"),
    ):
        assert not [line for line in plan(df).splitlines() if "Exchange hashpartitioning" in line and wide in line]
        assert "BroadcastHashJoin" in plan(df)
    assert "BroadcastHashJoin" in plan(answers)


def test_text_is_no_shuffle_key(spark, no_broadcast):
    from folioscan.plans import load
    from folioscan.plans.registry import QUERIES

    load()
    shuffles = [line for line in plan(QUERIES["insert_if_absent"](spark, SMALL)).splitlines() if "Exchange hash" in line]
    assert shuffles and not [line for line in shuffles if "text" in line]


def test_a_wide_dimension_is_not_broadcast(spark, no_broadcast, monkeypatch):
    import folioscan.operators.joins as joins

    orders = spark.read.parquet(f"{SMALL}/orders.parquet").select("o_orderkey", F.col("o_custkey").alias("k"))
    customer = spark.read.parquet(f"{SMALL}/customer.parquet").select(F.col("c_custkey").alias("k"), F.col("c_name").cast("binary").alias("b"))
    assert "SortMergeJoin" not in plan(dimension_join(orders, customer, "k", ["o_orderkey"], payload="b"))
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 100)
    assert "SortMergeJoin" in plan(dimension_join(orders, customer, "k", ["o_orderkey"], payload="b"))


def test_images_are_made_by_all_cores(spark, tmp_path):
    """Few bytes of the part table make many of pixels: its file's splits do not bound the tasks."""
    from folioscan.plans.rendering import flat_images

    rows = spark.createDataFrame([(i, i % 50 + 1) for i in range(1, 21)], "p_partkey long, p_size int")
    rows.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    images = flat_images(spark, str(tmp_path))
    assert images.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert {r["_id"] for r in images.collect()} == {str(i) for i in range(1, 21)}


def test_crawled_pages_are_rendered_by_all_cores(spark, tmp_path):
    """A crawl renders its archive whenever it reads it: the splits of the tables' files do not bound the tasks."""
    from folioscan.plans.rendering import crawl_archive, part_pages

    kinds = "p_partkey long, p_name string, p_brand string, p_type string, p_size int"
    part = spark.createDataFrame([(i, f"name {i}", "b", "t", i % 50 + 1) for i in range(1, 21)], kinds)
    part.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    customer = spark.createDataFrame([(i, i % 25) for i in range(1, 21)], "c_custkey long, c_nationkey int")
    customer.coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    archive = crawl_archive(spark, str(tmp_path))
    assert archive.rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism
    assert archive.count() == 40
    items = archive.filter("page_id < 1000000000000")
    assert sorted(items.collect()) == sorted(part_pages(spark, str(tmp_path)).collect())
