from dataclasses import replace

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from folioscan.operators.joins import keep_marked
from folioscan.operators.assets import _png
from folioscan.plans.ingest import ItemOptions, ingest_batch, reingest, thumbnail_batch, thumbnail_stored
from folioscan.plans.rendering import part_pages
from folioscan.sources.pages import stream_pages
from folioscan.sources.manifest import read_manifest
from folioscan.sources.tables import ITEMS, TABLES, read_payloads, read_table, reset_tables, write_assets, write_items
from folioscan.sources.workspace import new_folder, written
from folioscan.streaming.ingest import ingest_stream

HOST = "http://h"
OPTIONS = ItemOptions(base_url=HOST)


def item(hero="/1.png", title="t", icon="/l/by.png", license=" CC \n", detail="<tr><th>UCI</th><td>u</td></tr>"):
    parts = [
        f'<div class="imgD"><img src="{hero}"></div>' if hero else '<div class="imgD"><img></div>' if hero == "" else "",
        f'<h3 class="tit_txt3">{title}</h3>' if title is not None else "",
        f'<div class="copyD"><img src="{icon}">{license}</div>' if icon is not None else "",
        f'<table class="tb_bbs">{detail}</table>' if detail is not None else "",
    ]
    return "".join(parts)


PAGES = [
    (1, "/v?wrtSn=1001", item(title=' "first" ')),
    (2, "/v?wrtSn=1001", item(title="again", icon="/l/nc.png")),  # duplicate id, new licence
    (3, "/v?wrtSn=1003", item(hero="")),  # image without address
    (4, "/v?wrtSn=1004", item(title=None)),  # silent
    (5, "/v?wrtSn=1005", item(detail=None, icon="/l/sa.png")),  # silent, licence stored
    (6, "/v?wrtSn=1006", item(detail="<tr><th>zzz</th></tr><tr><th>UCI</th><td>6</td></tr>")),  # unknown label
    (7, "/v?wrtSn=1007", item(detail="<tr><th>zzz</th></tr><tr><th>UCI</th></tr><tr><th>yyy</th></tr>")),  # broken row
    (8, "/v?wrtSn=1008", item(detail="<tr><th>UCI</th><td>a</td></tr><tr><th>U CI</th><td>b</td></tr>")),  # repeated
    (9, "/v", item()),  # no code
    (10, "/v?x", item(title="second without code")),
    (11, "/v?wrtSn=1011", item(hero="/gone.png")),
    (12, "/v?wrtSn=1012", item(icon="/l/gone.png", detail=None)),
    (13, "/v?wrtSn=1013", item(icon="")),
]
STATUS = {
    1: "inserted", 2: "duplicate", 3: "error", 4: "missing_structure", 5: "missing_structure", 6: "inserted",
    7: "missing_structure", 8: "inserted", 9: "inserted", 10: "duplicate", 11: "error", 12: "error", 13: "error",
}
ASSETS = [
    (HOST + "/1.png", b"one"), (HOST + "/1.png", b"two"), (HOST + "/l/by.png", b"by"), (HOST + "/l/nc.png", b"nc"),
    (HOST + "/l/sa.png", b"sa"), (HOST, b"root"),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string")


@pytest.fixture
def assets(spark):
    return spark.createDataFrame(ASSETS, "url string, payload binary")


def rows(df, *columns):
    return sorted(tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in df.select(*columns).collect())


def snapshot(spark, root, names=("items", "images", "licenses", "errors", "outcomes")):
    return {n: sorted(map(repr, rows(read_table(spark, root, n), *[f.name for f in TABLES[n].fields]))) for n in names}


def test_batch_with_assets(spark, pages, assets):
    root = new_folder(spark, "t")
    ingest_batch(pages, 0, root, OPTIONS, assets)
    want = {**STATUS, 13: "inserted"}  # its licence address is the bare host, which is archived
    assert rows(read_table(spark, root, "outcomes"), "page_id", "status") == sorted(want.items())
    items = read_table(spark, root, "items")
    assert rows(items, "page_id", "_id", "filename", "license", "license_name", "uci", "col_size") == [
        (1, "1001", ' "first" ', "by.png", "CC", "u", 1),
        (6, "1006", "t", "by.png", "CC", "6", 1),
        (8, "1008", "t", "by.png", "CC", "a", 1),
        (9, "error", "t", "by.png", "CC", "u", 1),
        (13, "1013", "t", "", "CC", "u", 1),
    ]
    assert rows(items, "path")[0] == ("../../img/origin/1001.png",)
    assert rows(read_table(spark, root, "licenses"), "license", "hash_") == [
        ("", b"root"), ("by.png", b"by"), ("nc.png", b"nc"), ("sa.png", b"sa"),
    ]
    assert rows(read_table(spark, root, "images"), "_id", "filename", "hash_") == [
        (i, f"{i}.png", b"one") for i in ("1001", "1006", "1008", "1013", "error")
    ]
    assert rows(read_table(spark, root, "errors"), "page_id", "stage", "line") == [
        (2, "image", "1001 : Origin image hash data save error"),
        (3, "item", "1003 : image without address"),
        (6, "unknown_attribute", "1006 : 알 수 없는 상세정보"),
        (7, "unknown_attribute", "1007 : 알 수 없는 상세정보"),
        (8, "duplicate_label", "1008 : duplicate label uci"),
        (10, "image", "error : Origin image hash data save error"),
        (11, "item", "1011 : image not found"),
        (12, "item", "1012 : licence icon not found"),
        (12, "license", "LICENSE IMAGE ERROR: gone.png"),
    ]


def test_second_batch_and_replay(spark, pages, assets):
    root = new_folder(spark, "t")
    ingest_batch(pages, 0, root, OPTIONS, assets)
    ingest_batch(pages.withColumn("page_id", F.col("page_id") + 100), 1, root, OPTIONS, assets)
    once = snapshot(spark, root)
    assert read_table(spark, root, "items").count() == 5
    assert rows(read_table(spark, root, "outcomes").filter("page_id = 101"), "status") == [("duplicate",)]
    for batch_id, shift in ((1, 100), (0, 0)):
        ingest_batch(pages.withColumn("page_id", F.col("page_id") + shift), batch_id, root, OPTIONS, assets)
        assert snapshot(spark, root) == once


def test_large_and_small_batches_agree(spark, pages, assets, monkeypatch):
    import folioscan.plans.ingest as plan

    one, two = new_folder(spark, "t"), new_folder(spark, "t")
    for root in (one, two):
        for batch_id, part in enumerate((pages.filter("page_id <= 6"), pages.filter("page_id > 6"))):
            ingest_batch(part, batch_id, root, OPTIONS, assets)
        monkeypatch.setattr(plan, "BROADCAST_ROWS", -1)
        monkeypatch.setattr(plan, "PAYLOADS_PER_SPLIT", 1)
        monkeypatch.setattr(plan, "keep_marked", lambda *a: keep_marked(*a, limit=-1))
    assert snapshot(spark, one) == snapshot(spark, two)


def test_stream_equals_batch(spark, pages, assets):
    batch, stream, arrivals = new_folder(spark, "b"), new_folder(spark, "s"), new_folder(spark, "a")
    ingest_batch(pages, 0, batch, OPTIONS, assets)
    for low, high in ((0, 4), (4, 9), (9, 99)):
        part = pages.filter((F.col("page_id") > low) & (F.col("page_id") <= high))
        part.coalesce(1).write.mode("append").parquet(arrivals)
    checkpoint = new_folder(spark, "c")
    query = ingest_stream(stream_pages(spark, arrivals, 1), stream, checkpoint, OPTIONS, assets)
    query.awaitTermination()
    assert snapshot(spark, stream) == snapshot(spark, batch)
    assert read_table(spark, stream, "outcomes").select("run", "batch_id").distinct().count() == 3
    # Nothing new: another run adds nothing.
    ingest_stream(stream_pages(spark, arrivals, 1), stream, checkpoint, OPTIONS, assets).awaitTermination()
    assert snapshot(spark, stream) == snapshot(spark, batch)


def test_retry_pass_inserts_what_failed(spark, pages, assets):
    root = new_folder(spark, "t")
    ingest_batch(pages, 0, root, OPTIONS, assets)
    lines = read_table(spark, root, "errors").select(F.col("line").alias("value"))
    late = assets.union(spark.createDataFrame([(HOST + "/gone.png", b"late")], assets.schema))
    reingest(lines, pages, 1, root, OPTIONS, late)
    again = read_table(spark, root, "outcomes").filter("batch_id = 1")
    assert rows(again, "page_id", "status") == [
        (1, "duplicate"), (2, "duplicate"), (3, "error"), (6, "duplicate"), (7, "missing_structure"),
        (8, "duplicate"), (11, "inserted"), (12, "error"),
    ]
    assert rows(read_table(spark, root, "items").filter("batch_id = 1"), "_id") == [("1011",)]


def test_reset(spark, pages):
    root = new_folder(spark, "t")
    assert read_table(spark, root, "items").count() == 0
    ingest_batch(pages, 0, root, OPTIONS)
    first = snapshot(spark, root, ("items", "licenses", "errors", "outcomes"))
    reset_tables(spark, root)
    assert all(read_table(spark, root, name).count() == 0 for name in TABLES)
    ingest_batch(pages, 0, root, OPTIONS)
    assert snapshot(spark, root, ("items", "licenses", "errors", "outcomes")) == first


def test_code_can_be_replaced(spark, pages):
    root = new_folder(spark, "t")
    ingest_batch(pages, 0, root, replace(OPTIONS, code=F.col("page_id").cast("string")))
    # No asset archive, so nothing is lost; every page with all its parts has an id of its own.
    assert [r[0] for r in rows(read_table(spark, root, "items"), "page_id")] == [1, 2, 6, 8, 9, 10, 11, 13]


def test_write_modes(spark, assets):
    path = new_folder(spark, "t")
    items = read_table(spark, path, "items").select(*ITEMS.names)
    write_items(items, f"{path}/items", "overwrite")
    write_items(items, f"{path}/items")
    assert spark.read.parquet(f"{path}/items").count() == 0
    write_assets(assets.withColumnRenamed("payload", "hash_"), f"{path}/encoded", "base64")
    assert rows(spark.read.parquet(f"{path}/encoded"), "hash_")[0] == ("Ynk=",)


def test_every_part_is_accounted_for(spark):
    """Pages in, outcomes out: none lost, none twice."""
    root = new_folder(spark, "t")
    pages = part_pages(spark, SMALL)
    ingest_batch(pages, 0, root)
    outcomes = read_table(spark, root, "outcomes")
    assert outcomes.count() == outcomes.select("page_id").distinct().count() == pages.count()
    items = read_table(spark, root, "items")
    assert items.count() == items.select("_id").distinct().count()


def test_streams_and_batches_share_a_root(spark, pages, assets):
    """No writer replaces another's rows, and each counts what the others stored."""
    whole, root, arrivals = new_folder(spark, "w"), new_folder(spark, "s"), new_folder(spark, "a")
    ingest_batch(pages, 0, whole, OPTIONS, assets)
    ingest_batch(pages.filter("page_id <= 6"), 0, root, OPTIONS, assets)
    pages.coalesce(1).write.parquet(arrivals)
    for _ in range(2):
        stream = stream_pages(spark, arrivals, 1)
        ingest_stream(stream, root, new_folder(spark, "c"), OPTIONS, assets).awaitTermination()
    assert read_table(spark, root, "outcomes").select("run").distinct().count() == 3
    names = ("items", "images", "licenses")
    assert snapshot(spark, root, names) == snapshot(spark, whole, names)


def test_images_have_first_writers_of_their_own(spark, pages, assets):
    root, once = new_folder(spark, "t"), new_folder(spark, "o")
    ingest_batch(pages, 0, once, OPTIONS, assets)
    ingest_batch(pages, 0, root, OPTIONS)
    assert read_table(spark, root, "images").count() == 0
    ingest_batch(pages, 1, root, OPTIONS, assets)
    assert snapshot(spark, root, ("images",)) == snapshot(spark, once, ("images",))
    errors = read_table(spark, root, "errors").filter("stage = 'image'")
    assert rows(errors, "page_id") == [(2,), (10,)]
    # Items are emptied and loaded again: images are stored already, so none is stored twice.
    reset_tables(spark, root, ("items",))
    ingest_batch(pages, 2, root, OPTIONS, assets)
    assert snapshot(spark, root, ("images",)) == snapshot(spark, once, ("images",))


def test_an_asset_without_bytes_is_lost(spark, pages, assets):
    root = new_folder(spark, "t")
    bare = assets.withColumn("payload", F.when(~F.col("url").endswith("/1.png"), F.col("payload")))
    ingest_batch(pages.filter("page_id = 1"), 0, root, OPTIONS, bare)
    assert rows(read_table(spark, root, "errors"), "page_id", "line") == [(1, "1001 : image not found")]
    assert read_table(spark, root, "images").count() == 0 == read_table(spark, root, "items").count()


def test_one_error_table(spark, pages):
    root = new_folder(spark, "t")
    image = F.struct(
        F.lit("").alias("origin"), F.lit(1).alias("height"), F.lit(1).alias("width"), F.lit(1).alias("nChannels"),
        F.lit(0).alias("mode"), F.lit(b"").alias("data"),
    )
    images = spark.range(1).select(F.lit("7").alias("_id"), F.lit("7.png").alias("filename"), image.alias("image"))
    ingest_batch(pages, 0, root, OPTIONS)
    before = read_table(spark, root, "errors").count()
    thumbnail_batch(images, 0, root)
    errors = read_table(spark, root, "errors")
    assert errors.count() == before + 1
    assert rows(errors.filter("stage = 'thumbnail'"), "item_id", "line") == [("7", "THUMBNAIL ERROR: 7.png")]


def png(value):
    return _png(np.full((3, 2, 3), value, np.uint8))


@pytest.fixture(scope="module")
def shown(spark):
    """Pages with images that can be decoded, but for the third; the first and the fourth share an id."""
    pages = [(n, f"http://h/v.do?wrtSn={i}", item(hero=f"/{n}.png")) for n, i in ((1, 1001), (2, 1002), (3, 1003), (4, 1001))]
    held = [(f"http://h/{n}.png", png(n) if n != 3 else b"no image") for n in (1, 2, 3, 4)] + [("http://h/l/by.png", b"icon")]
    return (
        spark.createDataFrame(pages, "page_id long, url string, html string"),
        written(spark.createDataFrame(held, "url string, payload binary"), "held"),
    )


@pytest.mark.parametrize("encoding", ["raw", "base64", "zlib"])
def test_thumbnails_follow_the_encoding(spark, shown, encoding):
    pages, held = shown
    root = new_folder(spark, "t")
    ingest_batch(pages, 0, root, ItemOptions(base_url="http://h", encoding=encoding), held)
    thumbnail_stored(spark, 0, root)
    got = {r["_id"]: bytes(r["hash_"]) for r in read_payloads(spark, root, "thumbnails").collect()}
    assert got == {"1001": png(1), "1002": png(2)}
    errors = read_table(spark, root, "errors").filter("stage = 'thumbnail'")
    assert rows(errors, "item_id", "line") == [("1003", "THUMBNAIL ERROR: 1003.png")]
    kind = dict(read_table(spark, root, "thumbnails").dtypes)["hash_"]
    assert kind == ("string" if encoding == "base64" else "binary")
    assert read_manifest(spark, root)["encoding"] == encoding
    # Later batches follow the manifest, and may not change it.
    ingest_batch(pages, 1, root, ItemOptions(base_url="http://h"), held)
    other = "raw" if encoding != "raw" else "zlib"
    with pytest.raises(ValueError, match="stored as"):
        ingest_batch(pages, 2, root, ItemOptions(base_url="http://h", encoding=other), held)
    reset_tables(spark, root)
    assert read_manifest(spark, root) is None and read_table(spark, root, "thumbnails").count() == 0


def files_of(spark, root, name):
    return {r["filename"]: bytes(r["payload"]) for r in read_table(spark, root, name).collect()}


def test_switches(spark, shown):
    pages, held = shown
    root = new_folder(spark, "t")
    site = ItemOptions(base_url="http://h", encoding="base64")
    first = pages.filter("page_id <= 2")
    ingest_batch(first, 0, root, site, held)
    ingest_batch(first, 1, root, replace(site, thumbnail_files=True), held)
    names = ("origin_files", "thumbnail_files", "license_files", "thumbnails")
    assert all(read_table(spark, root, name).count() == 0 for name in names)
    ingest_batch(first, 2, root, replace(site, license_files=True), held)
    assert files_of(spark, root, "license_files") == {"by.png": b"icon"}
    # Images now become files, whoever stored them first, and bring their thumbnails with them.
    ingest_batch(first, 3, root, replace(site, origin_files=True, license_files=True), held)
    assert files_of(spark, root, "origin_files") == {"1001.png": png(1), "1002.png": png(2)}
    assert rows(read_table(spark, root, "thumbnails"), "_id", "batch_id") == [("1001", 3), ("1002", 3)]
    assert read_table(spark, root, "license_files").count() == 1
    assert read_table(spark, root, "thumbnail_files").count() == 0
    # What exists is left alone; thumbnail files are made of the images that are there.
    every = replace(site, origin_files=True, thumbnail_files=True, license_files=True)
    for _ in ("written", "replayed"):
        ingest_batch(pages, 4, root, every, held)
        assert files_of(spark, root, "origin_files") == {"1001.png": png(1), "1002.png": png(2), "1003.png": b"no image"}
        assert files_of(spark, root, "thumbnail_files") == {"1001.png": png(1), "1002.png": png(2)}
        assert rows(read_table(spark, root, "thumbnails"), "_id", "batch_id") == [("1001", 3), ("1002", 3)]
        errors = read_table(spark, root, "errors").filter("stage = 'thumbnail'")
        assert rows(errors, "item_id", "batch_id") == [("1003", 4)]
    ingest_batch(pages, 5, root, every, held)
    assert read_table(spark, root, "origin_files").count() == 3
    assert read_table(spark, root, "thumbnail_files").count() == 2
