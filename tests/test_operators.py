from functools import partial

import pytest
from pyspark.sql import functions as F

from folioscan.functions.urls import item_code
from folioscan.operators import paging, summary
from folioscan.operators.assets import materialise_missing
from folioscan.operators.detail import detail_rows, map_attributes, to_wide, whole_tables, widen
from folioscan.operators.errors import log_item_lines, retry_candidates, retry_pass
from folioscan.operators.first_writer import first_by_key, insert_if_absent, license_dimension
from folioscan.operators.joins import catalogue_audit, dimension_join, enrich_with_info, hot_key_join, keep_marked
from folioscan.operators.lookup import lookup, lookup_json, non_empty_attributes
from folioscan.operators.page_parse import parse_pages
from folioscan.sources.logs import header_line, read_error_log, run_metadata, write_error_log
from folioscan.sources.pages import list_frontier, pages_of, resolve_frontier
from folioscan.sources.workspace import new_folder


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def detail_page(*table_rows):
    return '<table class="tb_bbs">' + "".join(f"<tr>{r}</tr>" for r in table_rows) + "</table>"


def pages(spark, *html):
    return spark.createDataFrame([(i, f"u{i}", h) for i, h in enumerate(html)], "page_id long, url string, html string")


def test_long_and_array_path_agree(spark):
    html = [
        detail_page("<th>UCI</th><td> 1 </td>", "<th>zzz</th><td>2</td>", "<th>UCI</th><td>3</td>"),
        detail_page("<th>저작자</th><td>by <a>A</a><a>B</a></td>", "<th>발행\t자</th><td>x</td>"),
        detail_page("<th>저작자</th><td>by nobody</td>", "<th>저작 자</th><td>plain</td>", "<th>ICN</th><td></td>"),
        detail_page("<td>no label</td>"),
        detail_page("<th>UCI</th>"),
        detail_page("<th>zzz</th>", "<th>UCI</th><td>5</td>"),
        "<p>no table",
        detail_page(),
    ]
    parsed = parse_pages(pages(spark, *html), ["detail"])
    wide = widen(parsed).select("page_id", "uci", "author", "icn", "publisher", "col_size")
    assert rows(wide, "page_id") == [
        (0, "1", None, None, None, 1),
        (1, None, "A,B,", None, None, 1),
        (2, None, "", "", None, 2),
        (5, "5", None, None, None, 1),
        (7, None, None, None, None, 0),
    ]
    long = to_wide(map_attributes(detail_rows(whole_tables(parsed))))
    # A page without rows has nothing in the long form.
    assert rows(long, "page_id") == [r for r in rows(widen(parsed), "page_id") if r[0] != 7]


def test_first_by_key(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, None), (None, 5, "z"), (None, 4, "w")], "k string, o int, v string")
    assert rows(first_by_key(df, ["k"], ["o"]), F.col("k").asc_nulls_first()) == [(None, 4, "w"), ("a", 1, "y"), ("b", 2, None)]
    stored = spark.createDataFrame([("b",), (None,)], "k string")
    for small in (False, True):
        assert rows(insert_if_absent(df, stored, ["k"], ["o"], small)) == [("a", 1, "y")]


def test_insert_is_idempotent_and_complete(spark):
    new = spark.range(2000).select((F.col("id") % 7).alias("k"), F.col("id").alias("o"))
    none = spark.createDataFrame([], "k long")
    first = insert_if_absent(new, none, ["k"], ["o"])
    assert rows(first) == [(k, k) for k in range(7)]
    assert insert_if_absent(new, first, ["k"], ["o"]).count() == 0


def test_license_dimension(spark):
    df = spark.createDataFrame([(2, "l", "b"), (1, "l", "a"), (3, None, "c")], "page_id int, license string, license_name string")
    assert rows(license_dimension(df)) == [(1, "l", "a")]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_join_equals_plain_join(spark, how):
    """A third of the facts has one key, another part none at all."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(
        (F.col("id") % 50).cast("string")
    )
    facts = spark.range(3000).select("id", key.alias("k"))
    other = spark.range(40).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("v"))
    other = other.union(spark.sql("select 'hot', -1L"))
    want = rows(facts.join(other, "k", how).select("id", "k", "v"), "id")
    split = hot_key_join(facts, other, "k", ["id"], how, rows_per_split=100).select("id", "k", "v")
    assert rows(split, "id") == want
    assert rows(dimension_join(facts, other, "k", ["id"], how).select("id", "k", "v"), "id") == want


def test_hot_key_is_spread(spark):
    facts = spark.range(4000).select("id", F.lit("hot").alias("k"))
    other = spark.createDataFrame([("hot", 1)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = hot_key_join(facts, other, "k", ["id"], rows_per_split=250)
        used = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in used) == 4000
    assert len(used) > 3 and max(r["count"] for r in used) < 2000


@pytest.mark.parametrize("limit", [100, 30, 0])
def test_keep_marked(spark, limit):
    """Few kept, few dropped, or many of both: the same rows."""
    wide = spark.range(100).withColumn("v", F.col("id") * 2)
    for kept in (F.col("id") % 10 == 0, F.col("id") % 10 != 0, F.col("id") % 2 == 0):
        assert rows(keep_marked(wide, spark.range(100), "id", kept, limit)) == rows(wide.filter(kept))


def test_enrich_and_audit(spark):
    assets = spark.createDataFrame([("1", b"a"), ("2", b"b")], "_id string, hash_ binary")
    items = spark.createDataFrame([("2", "t"), ("3", "u")], "_id string, filename string")
    assert [r["info"] for r in enrich_with_info(assets, items, "_id").orderBy("_id").collect()] == [None, ("2", "t")]
    assert rows(catalogue_audit(assets, items)) == [("1", "asset_without_item"), ("3", "item_without_asset")]


def test_lookup(spark):
    table = spark.createDataFrame([("01", "a", 0), ("2", "", 5)], "_id string, filename string, col_size int")
    assert rows(lookup(table, "_id", "01")) == [("01", "a", 0)]
    assert lookup(table, "_id", "1").count() == 0
    wanted = spark.createDataFrame([("2",), ("9",), ("2",)], "_id string")
    assert rows(lookup_json(wanted, table, "_id", ["_id", "col_size"])) == [("2", '{"_id":"2","col_size":5}'), ("9", "{}")]
    zero_text = table.withColumn("filename", F.when(F.col("_id") == "2", "0").otherwise(F.col("filename")))
    assert rows(non_empty_attributes(zero_text, "_id", ["filename", "col_size"])) == [
        ("01", "FILENAME", "a"), ("2", "COL_SIZE", "5"), ("2", "FILENAME", "0"),
    ]


def test_log_lines_and_retry(spark):
    lines = ["> Run at", "123 : x", "PAGE_URL_ERROR : x", "error : x", "", "1234567890123456 : y", "123 : again", " 7 : x"]
    log = spark.createDataFrame([(x,) for x in lines], "value string")
    assert log_item_lines(log).count() == 3
    assert rows(retry_candidates(log)) == [
        ("123", "/view.do?wrtSn=123&menuNo=200023"),
        ("1234567890123456", "/view.do?wrtSn=1234567890123456&menuNo=200023"),
    ]
    archive = spark.createDataFrame(
        [(1, "v?wrtSn=1230"), (2, "v?wrtSn=1234567890123456"), (3, "v"), (4, "v?wrtSn=1234567890123456")],
        "page_id int, url string",
    )
    assert [r[0] for r in rows(retry_pass(log, archive, item_code(F.col("url"))))] == [2, 4]


def test_log_round_trip_and_metadata(spark):
    header = spark.range(1).select(header_line(F.lit("PROCESS_COUNT"), F.lit("8")).alias("line"))
    more = ["> Run at: 2024-01-31_235959", "> SLEEP: 10 Pages, 1 sec", ">-- CONFIG --<", "12 : x", "> Progress: 1 ~ 9 page(s)", ""]
    lines = header.union(spark.createDataFrame([(x,) for x in more], "line string"))
    path = new_folder(spark, "log")
    write_error_log(lines, path)
    back = read_error_log(spark, path)
    assert back.count() == 7
    assert rows(run_metadata(back)) == [
        ("PROCESS_COUNT", "8"), ("Progress", "1 ~ 9 page(s)"), ("Run at", "2024-01-31_235959"), ("SLEEP", "10 Pages, 1 sec"),
    ]


def test_frontier(spark):
    assert rows(list_frontier(spark, 1, 3, "l?p=")) == [(1, "l?p=1"), (2, "l?p=2"), (3, "l?p=3")]
    archive = spark.createDataFrame([(5, "l?p=1", "b"), (4, "l?p=1", "a"), (6, "l?p=3", "c")], "page_id long, url string, html string")
    resolved = resolve_frontier(list_frontier(spark, 1, 3, "l?p="), archive)
    assert rows(resolved.select("page", "page_id", "status")) == [(1, 4, "hit"), (2, None, "miss"), (3, 6, "hit")]
    assert [r[0] for r in rows(pages_of(resolved, archive))] == [4, 6]


def test_page_counts(spark):
    df = spark.createDataFrame([(0,), (8,), (9,), (10,)], "n int").select("n", paging.page_count(F.col("n")).alias("p"))
    assert rows(df) == [(0, 0), (8, 1), (9, 1), (10, 2)]


def test_batches(spark):
    assert [r[2] for r in rows(summary.batch_manifest(spark, 1, 1003, 8))] == [125] * 7 + [128]
    assert [r[2] for r in rows(summary.batch_manifest(spark, 1, 3, 8))] == [0] * 7 + [3]
    for pages, batches in ((1003, 8), (3, 8), (16, 8)):
        done = spark.range(1, pages + 1).withColumnRenamed("id", "page")
        report = rows(summary.progress(done, "page", 1, pages, batches))
        assert [r[1] for r in report] == [r[2] for r in report]
        assert all(r[3] == 100.0 for r in report)


def test_slices(spark, monkeypatch):
    df = spark.range(500).select((499 - F.col("id")).alias("k"), F.col("id").alias("v")).repartition(7)
    want = [(k, 499 - k) for k in range(500)]
    for start, count in ((0, 9), (18, 9), (495, 9), (600, 9)):
        assert rows(paging.slice_rows(df, ["k"], start, count)) == want[start : start + count]
        assert rows(paging.page_slice(df, "k", start, count)) == want[start : start + count]
    assert rows(paging.page(df, ["k"], 3)) == want[18:27]
    items = spark.range(0, 500, 2).select(F.col("id").alias("k"), F.lit("i").alias("t"))
    got = paging.data_range(df, items, "k", 18, 3).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(18, 481, (18, "i")), (19, 480, None), (20, 479, (20, "i"))]
    assert paging.data_range(df, items, "k", 18, None).count() == 0
    assert paging.slice_rows(df, ["k"], None, 9).count() == 0
    assert paging.page_slice(df, "k", 0, None).count() == 0
    monkeypatch.setattr(paging, "SHALLOW_ROWS", 10)
    assert rows(paging.slice_rows(df, ["k"], 18, 9)) == want[18:27]
    assert rows(paging.page_slice(df, "k", 18, 9)) == want[18:27]


def test_rank_with_hot_first_column(spark):
    """One value of the first order column holds most rows; the second column splits them."""
    df = spark.range(3000).select(F.when(F.col("id") < 2500, 1).otherwise(F.col("id")).alias("a"), F.col("id").alias("b"))
    ranked = rows(paging.with_rank(df.repartition(5), ["a", "b"], partitions=6))
    assert [r[2] for r in ranked] == list(range(3000))
    placed = rows(paging.assign_pages(df, ["a", "b"]))
    assert [(r[2], r[3]) for r in placed] == [(i // 9 + 1, i % 9) for i in range(3000)]


def test_rank_tasks_follow_the_rows(spark, monkeypatch):
    """More tasks for more rows, which are counted: the estimate of a join is far too large."""
    seen = []
    monkeypatch.setattr(paging, "checkpointed", lambda df: seen.append(df.rdd.getNumPartitions()) or df)
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(paging, "RANK_BYTES_PER_TASK", 800)
    monkeypatch.setattr(paging, "RANK_ROWS_PER_TASK", 100)
    paging.with_rank(spark.range(2000), ["id"])
    few = spark.createDataFrame([(i,) for i in range(90)], "id long")
    paging.with_rank(few.rdd.toDF(), ["id"])
    paging.with_rank(few.join(few.withColumnRenamed("id", "other"), F.col("id") == F.col("other") + 1, "left"), ["id"])
    assert seen == [20, configured, configured]


def test_materialise_missing(spark):
    planned = spark.createDataFrame(
        [(1, "origin", "a"), (2, "origin", "a"), (3, "origin", "b"), (4, "license", "a"), (5, "thumbnail", "b")],
        "page_id int, kind string, filename string",
    )
    existing = spark.createDataFrame([("origin", "b")], "kind string, filename string")
    got = materialise_missing(planned, existing, {"origin": True, "thumbnail": True, "license": False})
    assert rows(got) == [(1, "origin", "a"), (5, "thumbnail", "b")]


def test_one_slice_rule_for_every_offset(spark):
    """Repeated and null keys: shallow and deep slices agree, in order."""
    values = [(None if i % 3 == 0 else i // 10, i % 7, str(i)) for i in range(300)]
    df = spark.createDataFrame(values, "k int, a int, b string").repartition(4)
    order = sorted(values, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    for start, count in ((0, 300), (0, 9), (95, 9), (99, 3), (150, 40), (295, 9), (400, 5)):
        for shallow in (0, 10_000):
            got = [tuple(r) for r in paging.slice_rows(df, ["k"], start, count, shallow).collect()]
            assert got == order[start : start + count]


def test_page_slice_holds_a_null_key(spark):
    df = spark.createDataFrame([(None, "n"), (1, "a"), (2, "b")], "k int, v string")
    assert [r.v for r in paging.page_slice(df, "k", 0, 2).collect()] == ["n", "a"]


def test_one_answer_per_key(spark):
    table = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k int, v string")
    wanted = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    assert rows(lookup_json(wanted, table, "k", ["v"])) == [(1, '{"v":"a"}'), (3, "{}")]


def test_a_hot_url_is_split_though_its_rows_are_equal(spark, monkeypatch):
    import folioscan.sources.pages as pages

    monkeypatch.setattr(pages, "hot_key_join", partial(hot_key_join, rows_per_split=10))
    frontier = spark.createDataFrame([("u",)] * 500 + [("v",), (None,)] + [(None,)] * 30, "url string")
    archive = spark.createDataFrame([(7, "u"), (3, "u")], "page_id long, url string")
    resolved = resolve_frontier(frontier, archive)
    counts = {(r["url"], r["page_id"], r["status"]): r["count"] for r in resolved.groupBy("url", "page_id", "status").count().collect()}
    assert counts == {("u", 3, "hit"): 500, ("v", None, "miss"): 1, (None, None, "miss"): 31}


def test_work_folder_must_be_shared_on_a_cluster():
    from types import SimpleNamespace

    from folioscan.sources.workspace import workspace

    def session(master, folder=""):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda f: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: folder), sparkContext=context)

    assert workspace(session("spark://host:1", "hdfs://shared")) == "hdfs://shared"
    for master in ("local", "local[4]", "local[*]"):
        assert "folioscan-" in workspace(session(master))
    for master in ("spark://host:1", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="checkpoint"):
            workspace(session(master))
