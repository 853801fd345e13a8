import struct
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from folioscan.functions.payload import encode_base64
from png_reader import _decoded

from folioscan.operators.assets import _png, _shrink, roundtrip_check, size_profile, thumbnail_errors, thumbnail_job
from folioscan.plans.ingest import thumbnail_batch
from folioscan.sources.assets import read_assets, read_images
from folioscan.sources.tables import read_table
from folioscan.sources.workspace import new_folder


@pytest.fixture(scope="module")
def image_files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("images")
    rng = np.random.default_rng(5)
    for name, shape in {"wide": (300, 400), "tiny": (10, 20), "line": (1, 1000)}.items():
        (folder / f"{name}.png").write_bytes(_png(rng.integers(0, 256, (*shape, 3), dtype=np.uint8)))
    flat = np.zeros((500, 250, 3), np.uint8)
    flat[:, :, 0], flat[:, :, 2] = 200, 50
    (folder / "flat.png").write_bytes(_png(flat))
    (folder / "broken.png").write_bytes(b"not an image")
    return folder


def test_thumbnails(spark, image_files):
    made = {r["_id"]: r for r in thumbnail_job(read_images(spark, str(image_files))).collect()}
    sizes = {name: (r["width"], r["height"]) for name, r in made.items()}
    assert sizes == {
        "wide": (200, 150), "tiny": (20, 10), "line": (200, 1), "flat": (100, 200), "broken": (None, None)
    }
    assert bytes(made["tiny"]["hash_"]) == (image_files / "tiny.png").read_bytes()
    assert made["broken"]["hash_"] is None


def test_thumbnail_pixels_are_rgb(spark, image_files, tmp_path):
    """A flat colour survives resizing, and a PNG reader sees the size and channel order."""
    row = thumbnail_job(read_images(spark, str(image_files))).filter("_id = 'flat'").first()
    (tmp_path / "again.png").write_bytes(bytes(row["hash_"]))
    image = spark.read.format("image").load(str(tmp_path)).first()["image"]
    assert (image["width"], image["height"], image["nChannels"]) == (100, 200, 3)
    assert set(zip(*[iter(bytes(image["data"]))] * 3)) == {(50, 0, 200)}  # blue, green, red


def test_thumbnail_batch(spark, image_files):
    root = new_folder(spark, "t")
    images = read_images(spark, str(image_files))
    thumbnail_batch(images, 0, root)
    thumbnail_batch(images, 1, root)
    stored = read_table(spark, root, "thumbnails")
    assert sorted((r["_id"], r["batch_id"]) for r in stored.collect()) == [(n, 0) for n in ("flat", "line", "tiny", "wide")]
    lines = read_table(spark, root, "errors").filter("batch_id = 0 and stage = 'thumbnail'")
    assert [tuple(r) for r in lines.select("item_id", "line").collect()] == [("broken", "THUMBNAIL ERROR: broken.png")]


def test_grey_and_alpha_images(spark):
    grey, alpha = bytes([10, 20, 30, 40]), bytes([1, 2, 3, 255] * 4)
    rows = [
        ("g", "g.png", ("", 2, 2, 1, 0, grey)),
        ("a", "a.png", ("", 2, 2, 4, 24, alpha)),
        ("short", "s.png", ("", 2, 2, 3, 16, b"123")),
        ("mode", "m.png", ("", 2, 2, 1, 5, grey)),
    ]
    image = "struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>"
    df = spark.createDataFrame(rows, f"_id string, filename string, image {image}")
    made = {r["_id"]: r["hash_"] for r in thumbnail_job(df).collect()}
    assert bytes(made["g"]) == _png(np.repeat(np.array([[10, 20], [30, 40]], np.uint8)[:, :, None], 3, axis=2))
    assert bytes(made["a"]) == _png(np.full((2, 2, 3), [3, 2, 1], np.uint8))
    assert made["short"] is None and made["mode"] is None
    assert thumbnail_errors(thumbnail_job(df)).count() == 2


def test_shrink_is_the_area_average():
    rng = np.random.default_rng(3)
    pixels = rng.integers(0, 256, (7, 5, 3)).astype(float)
    fine = np.repeat(pixels, 3, axis=0)  # 7 rows to 3: each new row covers 7 of 21 thirds
    want = np.stack([fine[7 * i : 7 * i + 7].mean(axis=0) for i in range(3)])
    assert np.allclose(_shrink(pixels, 3, 0), want)
    assert np.allclose(_shrink(_shrink(pixels, 2, 0), 2, 1).mean(), pixels.mean())


def test_read_assets(spark, image_files):
    got = {r["filename"]: bytes(r["payload"]) for r in read_assets(spark, str(image_files), "*.png").collect()}
    assert got == {p.name: p.read_bytes() for p in Path(image_files).glob("*.png")}


def test_size_profile_equals_loop(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    payloads = documents.select("source", F.col("text").cast("binary").alias("payload"))
    want = {}
    for source, text in documents.select("source", "text").collect():
        import base64

        raw = text.encode()
        encoded = base64.b64encode(raw)
        sizes = Counter(payloads=1, raw=len(raw), base64=len(encoded), packed=len(zlib.compress(encoded)), back=len(encoded))
        want.setdefault(source, Counter()).update(sizes)
    got = {r["source"]: tuple(r)[1:] for r in size_profile(payloads, "payload", ["source"]).collect()}
    assert got == {s: (c["payloads"], c["raw"], c["base64"], c["packed"], c["back"]) for s, c in want.items()}


def test_roundtrip_counts_mismatches(spark, monkeypatch):
    import folioscan.operators.assets as assets

    payloads = spark.createDataFrame([(i, bytes(range(i))) for i in (0, 1, 57, 58, 200)], "id int, payload binary")
    for encoding in ("base64", "zlib", "raw"):
        assert tuple(roundtrip_check(payloads, "id", "payload", encoding).first()) == (encoding, 5, 0)
    monkeypatch.setattr(assets, "decode", lambda stored, encoding: F.substring(stored, 1, 10))
    assert roundtrip_check(payloads, "id", "payload", "raw").first()["mismatches"] == 3


def test_null_payload(spark):
    df = spark.createDataFrame([(1, None)], "id int, payload binary")
    assert df.select(encode_base64(F.col("payload"))).first()[0] is None
    assert roundtrip_check(df, "id", "payload", "zlib").first()["mismatches"] == 0


def test_png_filters_and_broken_files():
    rng = np.random.default_rng(4)
    for colour, step in ((0, 1), (2, 3), (6, 4)):
        pixels = rng.integers(0, 256, (7, 5, step), dtype=np.uint8)
        flat, rows = pixels.reshape(7, -1).astype(int), b""
        for y in range(7):
            up = flat[y - 1] if y else np.zeros_like(flat[0])
            left = np.concatenate((np.zeros(step, int), flat[y][:-step]))
            corner = np.concatenate((np.zeros(step, int), up[:-step]))
            guess = left + up - corner
            order = np.stack([abs(guess - left), abs(guess - up), abs(guess - corner)])
            paeth = np.choose(order.argmin(axis=0), [left, up, corner])
            base = [0, left, up, (left + up) // 2, paeth][y % 5]
            rows += bytes([y % 5]) + ((flat[y] - base) % 256).astype(np.uint8).tobytes()

        def chunk(kind, body):
            return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

        header = chunk(b"IHDR", struct.pack(">IIBBBBB", 5, 7, 8, colour, 0, 0, 0))
        data = b"\x89PNG\r\n\x1a\n" + header + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")
        image = _decoded(data)
        got = np.frombuffer(image["data"], np.uint8).reshape(7, 5, step)
        assert (got == (pixels if step == 1 else pixels[:, :, [2, 1, 0, *range(3, step)]])).all()
        assert _decoded(data[:45]) is None
    assert _decoded(None) is None and _decoded(b"") is None and _decoded(b"\x89PNG") is None


def _png_of(header, rows, *chunks):
    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    body = [chunk(b"IHDR", struct.pack(">IIBBBBB", *header)), *[chunk(*c) for c in chunks]]
    return b"\x89PNG\r\n\x1a\n" + b"".join(body) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


@pytest.mark.parametrize("per_folder", [1000, 1])
def test_stored_images_of_any_kind(spark, monkeypatch, per_folder):
    """Palette, 16 bits, grey and alpha, interlaced, GIF: what Spark's image source reads becomes pixels."""
    from folioscan.operators import assets
    from folioscan.sources import images

    monkeypatch.setattr(images, "FILES_PER_FOLDER", per_folder)
    gif = bytes.fromhex("47494638396101000100800000c80032ffffff2c00000000010001000002024401003b")
    rgb = _png_of((1, 1, 8, 2, 0, 0, 0), b"\0\xc8\0\x32")
    stored = {
        "palette": _png_of((1, 1, 8, 3, 0, 0, 0), b"\0\0", (b"PLTE", b"\xc8\0\x32")),
        "deep": _png_of((1, 1, 16, 2, 0, 0, 0), b"\0\xc8\xc8\0\0\x32\x32"),
        "interlaced": _png_of((1, 1, 8, 2, 0, 0, 1), b"\0\xc8\0\x32"),
        "gif": gif,
        "rgb": rgb,
        "grey alpha": _png_of((1, 1, 8, 4, 0, 0, 0), b"\0\x64\xff"),
        "grey 16": _png_of((1, 1, 16, 0, 0, 0, 0), b"\0\x64\x01"),
        "cut": rgb[:45],
        "text": b"no image",
        "empty": b"",
        "null": None,
    }
    rows = [*stored.items(), ("rgb", rgb), (None, rgb)]
    table = spark.createDataFrame([(k, f"{k}.x", v) for k, v in rows], "_id string, filename string, hash_ binary")
    made = thumbnail_job(assets.decode_images(table)).collect()
    assert sorted(map(repr, made)) == sorted(map(repr, assets.stored_thumbnails(table).collect()))
    assert Counter(r["_id"] for r in made) == Counter(k for k, _ in rows)
    got = {r["_id"]: r["hash_"] and bytes(r["hash_"]) for r in made}
    red, grey = (_png(np.array([[c]], np.uint8)) for c in ((200, 0, 50), (100, 100, 100)))
    want = dict.fromkeys(["palette", "deep", "interlaced", "gif", "rgb", None], red) | {"grey alpha": grey}
    assert got == dict.fromkeys(stored) | want


def test_packed_store_has_folders_by_digest(spark, monkeypatch):
    """A file for each different payload, few folders, and nothing left behind."""
    from folioscan.sources import images
    from folioscan.sources.workspace import workspace

    monkeypatch.setattr(images, "FILES_PER_FOLDER", 10)
    assert [images.folder_digits(n) for n in (0, 10, 11, 160, 161, 10**9)] == [0, 0, 1, 1, 2, images.MOST_DIGITS]
    payloads = [_png(np.full((1, 1, 3), i % 90, np.uint8)) for i in range(300)]
    table = spark.createDataFrame([(str(i), "x", p) for i, p in enumerate(payloads)], "_id string, filename string, hash_ binary")
    scratch = Path(workspace(spark)) / "folioscan"
    with images.packed_images(table) as packed:
        (folder,) = scratch.glob("image-files-*")
        assert len(list(folder.glob("folder=*"))) <= 16
        assert len(list(folder.glob("folder=*/part-*"))) == 90 == packed.images.count() == packed.places.count()
        digests = {r["digest"] for r in packed.places.collect()}
        assert digests == {r["digest"] for r in packed.digests.collect()} and packed.digests.count() == 300
    assert not list(scratch.glob("image-files-*"))


def test_plain_png_decodes_in_its_task():
    """Every filter and channel count, as the plain reader has them; files that are odd in any way are left alone."""
    from folioscan.functions.png import png_pixels

    rng = np.random.default_rng(6)
    for colour, step in ((0, 1), (2, 3), (6, 4)):
        for kinds in ([0] * 6, [1] * 6, [2] * 6, [2, 1, 2, 2, 0, 2], [4, 3, 2, 1, 0, 4], [3] * 6):
            rows = np.concatenate([np.array(kinds, np.uint8)[:, None], rng.integers(0, 256, (6, 9 * step), dtype=np.uint8)], axis=1)
            data = _png_of((9, 6, 8, colour, 0, 0, 0), rows.tobytes(), (b"gAMA", b"\0\0\xb1\x8f"))
            assert png_pixels(data, 9, 6, step).tobytes() == _decoded(data)["data"]
    plain = _png_of((1, 1, 8, 2, 0, 0, 0), b"\0\xc8\0\x32")
    assert png_pixels(plain, 1, 1, 3).tolist() == [[[50, 0, 200]]]
    odd = [
        plain[:-1], plain[:45], plain + b"x", plain[:-20] + b"\0" + plain[-19:],
        _png_of((1, 1, 8, 2, 0, 0, 0), b"\5\xc8\0\x32"), _png_of((1, 1, 8, 2, 0, 0, 0), b"\0\xc8\0"),
        _png_of((1, 1, 8, 2, 0, 0, 0), b"\0\xc8\0\x32\0"), _png_of((1, 1, 8, 2, 0, 0, 0), b"\0\xc8\0\x32", (b"tRNS", b"\0" * 6)),
    ]
    assert [png_pixels(x, 1, 1, 3) for x in odd] == [None] * len(odd)


def test_plain_png_becomes_no_file(spark, monkeypatch):
    """Only other images go through files; both kinds give what the file store alone gives."""
    from folioscan.operators import assets

    rng = np.random.default_rng(7)
    plain = [_png(rng.integers(0, 256, (300, 7, 3), dtype=np.uint8)) for _ in range(5)]
    plain.append(_png_of((3, 2, 8, 6, 0, 0, 0), b"\4" + bytes(range(12)) + b"\3" + bytes(range(9, 21))))
    plain.append(_png_of((3, 2, 8, 0, 0, 0, 0), b"\1abc\2def"))
    other = [_png_of((1, 1, 8, 3, 0, 0, 0), b"\0\0", (b"PLTE", b"\xc8\0\x32")), plain[0][:-3], b"no image"]
    rows = [(str(i), "x", p) for i, p in enumerate([*plain, *other, plain[0]])]
    table = spark.createDataFrame(rows, "_id string, filename string, hash_ binary")
    filed, whole = [], assets.packed_images
    monkeypatch.setattr(assets, "packed_images", lambda t, *a: filed.append(t.count()) or whole(t, *a))

    def images():
        return {r["_id"]: r["image"] and (*r["image"][1:5], bytes(r["image"]["data"])) for r in assets.decode_images(table).collect()}

    pixels, thumbnails = images(), sorted(map(repr, assets.stored_thumbnails(table).collect()))
    assert filed == [len(other)] * 2
    monkeypatch.setattr(assets, "png_size", lambda payload: F.lit(None).cast("struct<width:int,height:int,channels:int>"))
    assert images() == pixels and sorted(map(repr, assets.stored_thumbnails(table).collect())) == thumbnails
    assert filed[2:] == [len(rows) - 1] * 2 and [k for k, v in pixels.items() if v is None] in (["9"], ["8", "9"])


def test_zlib_takes_no_second_copy_of_a_batch():
    import tracemalloc

    import pyarrow as pa

    from folioscan.functions.payload import compress, decompress

    raw = [None, b"", *[np.random.default_rng(i).bytes(50_000) for i in range(200)], None]
    packed = compress.func(pa.array(raw, pa.binary()).slice(1))
    assert packed.to_pylist() == [x if x is None else zlib.compress(x) for x in raw[1:]]
    packed = packed.cast(pa.binary())
    tracemalloc.start()
    back = decompress.func(packed)
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert back.to_pylist() == raw[1:]
    assert held < 1.5 * 200 * 50_000


def test_shared_pixels_are_not_exchanged(spark, monkeypatch):
    """Rows travel with their payload as lists of bounded length, so no plan moves decoded pixels."""
    from folioscan.operators import assets

    monkeypatch.setattr(assets, "ROWS_PER_IMAGE", 10)
    monkeypatch.setattr(assets, "BYTES_AT_ONCE", 30, raising=False)
    payloads = [_png(np.full((2, 3, 3), i, np.uint8)) for i in range(4)]
    rows = [(None if i % 7 == 0 else str(i % 30), f"{i}.png", payloads[i % 4 if i < 20 else 0]) for i in range(95)]
    table = spark.createDataFrame([*rows, ("x", "x", b"no image"), ("n", "n", None)], "_id string, filename string, hash_ binary")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        decoded = assets.decode_images(table.filter("filename <> 'x'"))
        assert "Exchange" not in decoded._jdf.queryExecution().executedPlan().toString()
        got = Counter((r["_id"], r["filename"], r["image"] and bytes(r["image"]["data"])) for r in decoded.collect())
        pixels = {p: bytes([i]) * 18 for i, p in enumerate(payloads)}
        want = Counter((i, name, pixels[p]) for i, name, p in rows)
        assert got == want + Counter([("n", "n", None)])
        both = Counter((r["_id"], r["filename"], r["image"] and bytes(r["image"]["data"])) for r in assets.decode_images(table).collect())
        assert both == got + Counter([("x", "x", None)])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_shrunk_is_the_rounded_area_average():
    """Sums are exact and rounded once, so a half always goes to the even neighbour."""
    from fractions import Fraction

    from folioscan.operators.assets import _shrunk

    def covered(length, size):
        """Parts of each old row in each new one."""
        step = Fraction(length, size)
        return [[max(Fraction(0), min(step * (i + 1), j + 1) - max(step * i, j)) for j in range(length)] for i in range(size)]

    rng = np.random.default_rng(5)
    for height, width, to_height, to_width in ((16, 8, 10, 5), (7, 8, 7, 5), (8, 5, 3, 5), (3, 4, 3, 4)):
        for channels in (1, 3, 4):
            pixels = rng.integers(0, 256, (height, width, channels), dtype=np.uint8)
            down, across, area = covered(height, to_height), covered(width, to_width), Fraction(height * width, to_height * to_width)
            want = np.zeros((to_height, to_width, 3), np.uint8)
            for y in range(to_height):
                for x in range(to_width):
                    for c in range(3):
                        plane = pixels[:, :, 0 if channels == 1 else 2 - c].tolist()
                        total = sum(a * b * plane[j][i] for j, a in enumerate(down[y]) if a for i, b in enumerate(across[x]) if b)
                        want[y, x, c] = round(total / area)
            assert _shrunk(pixels, to_height, to_width) == _png(want)


def test_images_of_both_encodings_are_made_once(spark, monkeypatch, tmp_path):
    from folioscan.plans import assets as plan

    made, whole = [], plan.encoded_assets
    monkeypatch.setattr(plan, "encoded_assets", lambda images, e: made.append(images) or whole(images, e))
    spark.createDataFrame([(k, k % 50 + 1) for k in range(1, 9)], "p_partkey long, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    rows = plan.encoded_thumbnails(spark, str(tmp_path)).collect()
    assert Counter((r["encoding"], r["_id"]) for r in rows) == Counter((e, str(k)) for e in ("base64", "zlib") for k in range(1, 9) if k % 5)
    assert not any("png(" in images._jdf.queryExecution().optimizedPlan().toString() for images in made)


def test_thumbnails_are_not_broadcast_to_their_rows(spark):
    """Only the list of payloads that very many rows share is: thumbnails grow with the images, however small Spark takes them for."""
    from folioscan.operators import assets

    payloads = [_png(np.full((2, 3, 3), i, np.uint8)) for i in range(4)]
    table = spark.createDataFrame([(str(i), f"{i}.png", payloads[i % 4]) for i in range(12)], "_id string, filename string, hash_ binary")
    made = assets.stored_thumbnails(table)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") == 2
    assert Counter((r["_id"], bytes(r["hash_"])) for r in made.collect()) == Counter((str(i), payloads[i % 4]) for i in range(12))
