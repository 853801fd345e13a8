"""Catalogue pages rendered from the given tables.

The archive at hand holds articles: no pagers, images or detail tables. These plans render such pages
from table rows, natively and one page per row, so that the item operators run at the size of the
tables and their results can be stated in SQL over the source columns.
"""

from __future__ import annotations

import struct
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscan.plans.ingest import ItemOptions
from folioscan.sources.pages import spread
from folioscan.sources.workspace import written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def markup(text: Column) -> Column:
    """Text as HTML."""
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def anchors(names: Column) -> Column:
    return F.concat_ws("", F.transform(names, lambda n: F.concat(F.lit('<a href="#">'), markup(n), F.lit("</a>"))))


def detail_row(label: str, cell: Column | str) -> Column:
    cell = F.lit(cell) if isinstance(cell, str) else cell
    return F.concat(F.lit(f"<tr><th>{label}</th><td>"), cell, F.lit("</td></tr>\n"))


def item_page(title: Column, hero: Column, icon: Column, license: Column, detail: Column) -> Column:
    return F.concat(
        F.lit('<html><body><p>unclosed<br><h3 class="sub tit_txt3">'),
        markup(title),
        F.lit('</h3><div class="imgD"><!-- <img src="/no.png"> -->'),
        hero,
        F.lit('</div><div class="copyD">'),
        F.concat(F.lit('<img alt="" src="'), icon, F.lit('"><script>"</div>"</script>')),
        markup(license),
        F.lit("</div>"),
        detail,
        F.lit("</body></html>"),
    )


def part_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An item page per part, the awkward kinds included; see ``PART_ITEMS`` for what it holds."""
    return _item_pages(table(spark, sf_dir, "part"))


def _item_pages(part: DataFrame) -> DataFrame:
    key, size, kind, brand = F.col("p_partkey"), F.col("p_size"), F.col("p_type"), F.col("p_brand")
    number = F.lit(10000) + key - F.when(key % 3 == 1, F.lit(1)).otherwise(F.lit(0))
    url = F.concat(
        F.lit("https://catalogue.example/view.do?menuNo=200023"),
        F.when(size == 50, F.lit("")).otherwise(F.concat(F.lit("&wrtSn="), number.cast("string"))),
    )
    hero = F.when(size % 10 == 9, F.lit('<img alt="x">')).otherwise(
        F.concat(F.lit('<img src="/wrt/'), key.cast("string"), F.lit('.png">'))
    )
    rows = F.concat(
        detail_row("UCI", key.cast("string")),
        detail_row("분류 (장르)", kind),
        detail_row("저작자", anchors(F.array(brand, kind))),
        detail_row("요약정보", F.concat(F.lit(' \t "'), F.col("p_name"), F.lit('"\n '))),
        detail_row("원저작물크기", size.cast("string")),
        detail_row("발행자", markup(F.concat(brand, F.lit(" & co")))),
        F.when(size > 25, detail_row("비고", "x")).otherwise(F.lit("")),
        F.when(size % 5 == 0, detail_row("저작 자", "second")).otherwise(F.lit("")),
        F.when(size % 10 == 8, F.lit("<tr><th>공표국가</th></tr>")).otherwise(F.lit("")),
    )
    detail = F.when(size % 10 == 7, F.lit("<p>no table")).otherwise(
        F.concat(F.lit('<table class="tb_bbs wide"><tbody>'), rows, F.lit("</tbody></table>"))
    )
    icon = F.concat(F.lit("/img/license/"), F.lower(kind), F.lit(".png"))
    license = F.concat(F.lit("\n  CC "), kind, F.lit(" \t"))
    return part.select(
        key.alias("page_id"), url.alias("url"), item_page(F.col("p_name"), hero, icon, license, detail).alias("html")
    )


# The site of these pages.
HOST = "https://catalogue.example"
PART_SITE = ItemOptions(base_url=HOST)
LIST_TEMPLATE = f"{HOST}/list.do?p="


def part_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An asset archive for ``part_pages``, stored: images of part names, and all licence icons.

    Every seventh image is missing, and every eleventh has no bytes.
    """
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    images = part.filter(key % 7 != 0).select(
        F.concat(F.lit(f"{HOST}/wrt/"), key.cast("string"), F.lit(".png")).alias("url"),
        F.when(key % 11 != 0, F.col("p_name").cast("binary")).alias("payload"),
    )
    icons = part.select(
        F.concat(F.lit(f"{HOST}/img/license/"), F.lower("p_type"), F.lit(".png")).alias("url"),
        F.col("p_type").cast("binary").alias("payload"),
    )
    return written(images.unionByName(icons.distinct()), "archive")


def crawl_archive(spark: SparkSession, sf_dir: str, pagers: bool = False) -> DataFrame:
    """``part_pages`` and a list page per customer that links to three of them, if they exist.

    List pages of nation 7 hold an item without a link, those of nation 8 a link without address. With ``pagers``
    the first says that lists end at a third of the customers, and the page there that they end at half of them.
    """
    # A crawl reads its archive many times, and renders it each time: rows of the tables are spread before, so that
    # this does not run on as many tasks as the files have splits.
    customer = spread(table(spark, sf_dir, "customer"), "c_custkey")
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    items = F.transform(
        F.array(F.lit(0), F.lit(1), F.lit(5)),
        lambda n: F.concat(
            F.lit('<li><a href="/view.do?menuNo=200023&amp;wrtSn='),
            (F.lit(10000) + key * 2 + n).cast("string"),
            F.lit('">x</a></li>'),
        ),
    )
    odd = F.when(nation == 7, F.lit("<li>no link</li>")).when(nation == 8, F.lit("<li><a>no address</a>")).otherwise("")
    html = F.concat(F.lit('<ul id="wrtList">'), F.concat_ws("", items), odd, F.lit("</ul>"))
    if pagers:
        third = (customer.agg(F.max("c_custkey")).first()[0] or 0) // 3 + 1
        end = F.when(key >= third, F.lit(third + third // 2)).otherwise(F.lit(third))
        html = F.concat(html, F.lit('<span class="end"><a href="?pageIndex='), end.cast("string"), F.lit('">end</a></span>'))
    lists = customer.select(
        (key + 1_000_000_000_000).alias("page_id"),
        F.concat(F.lit(LIST_TEMPLATE), key.cast("string")).alias("url"),
        html.alias("html"),
    )
    return lists.unionByName(_item_pages(spread(table(spark, sf_dir, "part"), "p_partkey")))


# The same pages, stated over the source columns.
PART_ITEMS = """
part_items AS (
  SELECT p_partkey AS page_id,
         CASE WHEN p_size = 50 THEN 'error'
              ELSE CAST(10000 + p_partkey - CASE WHEN p_partkey % 3 = 1 THEN 1 ELSE 0 END AS VARCHAR) END AS _id,
         p_name AS filename,
         lower(p_type) || '.png' AS license,
         'CC ' || p_type AS license_name,
         CAST(p_partkey AS VARCHAR) AS uci,
         p_type AS classification,
         p_brand || ',' || p_type || ',' AS author,
         p_name AS summary_info,
         CAST(p_size AS VARCHAR) AS original_size,
         p_brand || ' & co' AS publisher,
         CAST(6 AS INTEGER) AS col_size,
         p_size > 25 AS has_unknown,
         p_size % 5 = 0 AS has_repeated,
         p_size % 10 <> 7 AS has_table,
         p_size % 10 NOT IN (7, 8) AS complete,
         p_size % 10 = 9 AS failed
  FROM part
),
part_outcomes AS (
  SELECT page_id, _id,
         CASE WHEN NOT complete THEN 'missing_structure'
              WHEN failed THEN 'error'
              WHEN page_id = min(CASE WHEN complete AND NOT failed THEN page_id END) OVER (PARTITION BY _id)
                THEN 'inserted'
              ELSE 'duplicate' END AS status
  FROM part_items
)
"""


def customer_pagers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list page with a pager per customer; the last page number grows with the table."""
    customer = table(spark, sf_dir, "customer")
    digits = F.concat(F.col("c_custkey").cast("string"), F.repeat(F.lit("0"), F.col("c_nationkey") % 3))
    number = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("none")).otherwise(
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("9876543"), F.lpad(digits, 10, "0"))).otherwise(digits)
    )
    html = F.concat(
        F.lit('<div><a href="?pageIndex=1">1</a><a class="endless" href="?p=7">x</a><span class="btn end"><b><a href="'),
        F.lit("list.do?wrtTy=4&amp;pageIndex="),
        number,
        F.lit('">end</a></b><a href="?p=5">y</a></span><a class="end" href="?p=8">z</a></div>'),
    )
    return customer.select(
        F.col("c_custkey").alias("page_id"), F.lit("list.do").alias("url"), html.alias("html")
    )


CUSTOMER_PAGERS = """
pagers AS (
  SELECT c_custkey AS page_id,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL
              WHEN c_mktsegment = 'BUILDING'
                THEN CAST(lpad(CAST(c_custkey AS VARCHAR) || repeat('0', c_nationkey % 3), 10, '0') AS BIGINT)
              ELSE CAST(CAST(c_custkey AS VARCHAR) || repeat('0', c_nationkey % 3) AS BIGINT) END AS last_page
  FROM customer
)
"""


def customer_author_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An item page per customer whose author cell has 0 to 3 links."""
    customer = table(spark, sf_dir, "customer")
    names = F.slice(
        F.array("c_name", F.col("c_mktsegment"), F.col("c_nationkey").cast("string")),
        F.lit(1),
        (F.col("c_custkey") % 4).cast("int"),
    )
    html = F.concat(
        F.lit('<table class="tb_bbs">'), detail_row("저작자", F.concat(F.lit("by "), anchors(names))), F.lit("</table>")
    )
    return customer.select(F.col("c_custkey").alias("page_id"), F.lit("").alias("url"), html.alias("html"))


def customer_list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list page per customer with 1 to 3 links; some have an item or a link that cannot be used."""
    customer = table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    count = (F.col("c_custkey") % 3 + 1).cast("int")
    items = F.transform(
        F.sequence(F.lit(1), count),
        lambda n: F.concat(
            F.lit('<li><p><a href="/view.do?menuNo=200023&amp;wrtSn='), key, n.cast("string"), F.lit('"><img></a><a href="x">')
        ),
    )
    nation = F.col("c_nationkey")
    odd = F.when(nation == 7, F.lit("<li>no link</li>")).when(nation == 8, F.lit("<li><a>no address</a>")).otherwise("")
    html = F.concat(F.lit('<li><a href="menu"></a></li><ul id="wrtList">'), F.concat_ws("</li>", items), odd, F.lit("</ul>"))
    return customer.select(
        F.col("c_custkey").alias("page_id"), F.concat(F.lit("list.do?p="), key).alias("url"), html.alias("html")
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run log with one line per event: headers, item errors, page errors and sentinel lines."""
    events = table(spark, sf_dir, "events")
    user = F.col("user_id").cast("string")
    line = (
        F.when(F.col("event_type") == "view", F.concat(F.lit("> "), F.upper("event_type"), F.lit("_COUNT="), user))
        .when(F.col("event_type") == "click", F.concat(F.lit("PAGE_URL_ERROR : timed out/"), user))
        .when(F.col("event_id") % 7 == 0, F.concat(F.lit("error : "), user))
        .when(F.col("event_id") % 7 == 1, F.concat(F.lit("> Progress: 1 ~ "), user, F.lit(" page(s)")))
        .when(F.col("event_id") % 7 == 2, F.lit(""))
        .otherwise(F.concat((F.col("user_id") + 1234567890120000).cast("string"), F.lit(" : "), F.col("event_type")))
    )
    return events.select("event_id", line.alias("value"))


EVENT_LOG = """
event_log AS (
  SELECT event_id,
         CASE WHEN event_type = 'view' THEN '> ' || upper(event_type) || '_COUNT=' || user_id
              WHEN event_type = 'click' THEN 'PAGE_URL_ERROR : timed out/' || user_id
              WHEN event_id % 7 = 0 THEN 'error : ' || user_id
              WHEN event_id % 7 = 1 THEN '> Progress: 1 ~ ' || user_id || ' page(s)'
              WHEN event_id % 7 = 2 THEN ''
              ELSE CAST(user_id + 1234567890120000 AS VARCHAR) || ' : ' || event_type END AS value
  FROM events
)
"""


def document_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes as a grey image, 1 to 640 pixels wide, in Spark's image struct.

    Documents of the source ``src7`` lose their last byte, as a broken file would.
    """
    data = F.col("text").cast("binary")
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", data.alias("bytes"))
    sized = documents.withColumn("width", F.greatest(F.least(F.octet_length("bytes"), F.lit(640)), F.lit(1)))
    high = sized.withColumn("height", F.ceil(F.octet_length("bytes") / F.col("width")).cast("int"))
    area = F.col("width") * F.col("height") - F.when(F.col("source") == "src7", F.lit(1)).otherwise(F.lit(0))
    image = F.struct(
        F.lit("").alias("origin"),
        "height",
        "width",
        F.lit(1).alias("nChannels"),
        F.lit(0).alias("mode"),
        F.rpad(F.col("bytes"), area, F.lit(b"\x00")).alias("data"),
    )
    name = F.col("doc_id").cast("string")
    return high.select(name.alias("_id"), F.concat(name, F.lit(".png")).alias("filename"), image.alias("image"))


def flat_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image rows of parts: PNG files of one colour each; every fifth holds bytes that are no image.

    Blue, green and red are key % 256, the size and key * 7 % 256.
    """
    # Few bytes of the table make many of pixels: spread before, over all cores.
    part = spread(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_partkey")

    @F.pandas_udf("binary")
    def png(keys: pd.Series, sizes: pd.Series) -> pd.Series:
        def one(key: int, size: int) -> bytes:
            if key % 5 == 0:
                return b"no image"
            return flat_png(key % 500 + 1, size * 9 + 1, (key * 7 % 256, size, key % 256))

        return pd.Series([one(key, size) for key, size in zip(keys, sizes)])

    name = F.col("p_partkey").cast("string")
    payload = png("p_partkey", "p_size")
    return part.select(name.alias("_id"), F.concat(name, F.lit(".png")).alias("filename"), payload.alias("hash_"))


def part_image_assets(spark: SparkSession, sf_dir: str, missing: bool = True) -> DataFrame:
    """The asset archive of ``part_pages`` with ``flat_images`` for images, stored; every seventh may be missing."""
    images = flat_images(spark, sf_dir)
    if missing:
        images = images.filter(F.col("_id").cast("bigint") % 7 != 0)
    heroes = images.select(F.concat(F.lit(f"{HOST}/wrt/"), "_id", F.lit(".png")).alias("url"), F.col("hash_").alias("payload"))
    icons = table(spark, sf_dir, "part").select(
        F.concat(F.lit(f"{HOST}/img/license/"), F.lower("p_type"), F.lit(".png")).alias("url"),
        F.col("p_type").cast("binary").alias("payload"),
    )
    return written(heroes.unionByName(icons.distinct()), "archive")


def flat_png(width: int, height: int, rgb: tuple[int, int, int]) -> bytes:
    """A PNG of one colour; its rows use the plain and the upward filter."""

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    rows = b"\0" + bytes(rgb) * width + (b"\2" + bytes(3 * width)) * (height - 1)
    header = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")
