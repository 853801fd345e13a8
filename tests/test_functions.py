from datetime import datetime

import pytest
from pyspark.sql import functions as F

from folioscan.functions import payload, text, urls
from folioscan.functions.attributes import ATTRIBUTES, attribute_of, detail_value


def test_strip_removes_what_python_strips(values):
    spaces = [chr(c) for c in range(0x10000) if chr(c).isspace()]
    words = [f"{s}a{s}b{s}{s}" for s in spaces] + ["​ x ​", ""]
    assert values(text.strip, words) == [w.strip() for w in words]
    assert sorted(text.STRIP_CODE_POINTS) == [ord(s) for s in spaces]


def test_clean_value_strips_before_deleting(values):
    assert values(text.clean_value, ["  a\tb\n", '" x "', "  y\r\n", None]) == ["ab", " x ", "y", None]


def test_clean_license_text_deletes_before_stripping(values):
    assert values(text.clean_license_text, ["\n  CC BY \t", ' "a" \n b']) == ["CC BY", '"a"  b']


def test_scalars(values):
    assert values(text.normalise_label, [" a b\t"]) == ["ab\t"]
    assert values(text.digits_only, ["wrtSn=12a3"]) == ["123"]
    assert values(text.to_integer, ["12", "", "x"]) == [12, None, None]
    assert values(lambda c: text.first_match(c, "([0-9]+)x", 1), ["12x", "12"]) == ["12", None]
    assert values(text.key_label, ["col_size"]) == ["COL_SIZE"]
    assert values(text.round3, [1.23456], "double") == [1.235]
    assert values(text.join_authors, [["A", "B"], []], "array<string>") == ["A,B,", ""]
    assert values(text.run_label, [datetime(2024, 1, 31, 23, 59, 58)], "timestamp") == ["2024-01-31_235958"]


def test_item_code(values):
    cases = {
        "/v?wrtSn=1234": "1234",
        "/v?wrtSn=12345678901234567890": "1234567890123456",
        "/v?wrtSn=123": "error",
        "/v": "error",
        "xwrtSn=5555&wrtSn=6666": "5555",
        "wrtSn=1&wrtSn=7777": "7777",
        "wrtSn=１２３４５": "error",
        "wrtSn=0012": "0012",
    }
    assert values(urls.item_code, list(cases)) == list(cases.values())


def test_url_pieces(values):
    hrefs = ["?pageIndex=13579", "?p=987654321098", "?p=x", None]
    assert values(urls.trailing_number, hrefs) == [13579, 7654321098, None, None]
    assert values(urls.basename, ["/a/b.png?x=1", "c.png", "/d/"]) == ["b.png?x=1", "c.png", ""]
    assert values(lambda c: urls.absolute_url("http://h", c), ["/a", None]) == ["http://h/a", None]
    assert values(urls.asset_path, ["7"]) == ["../../img/origin/7.png"]
    assert values(urls.item_url, ["0042"]) == ["/view.do?wrtSn=0042&menuNo=200023"]
    assert values(lambda c: urls.list_url("l?p=", c), [3], "int") == ["l?p=3"]


def test_attributes(values):
    assert len(ATTRIBUTES) == len(set(ATTRIBUTES.values())) == 26
    labels = ["UCI", "분류 (장르)", "발행\t자", "저작 자", "zzz", None]
    assert values(attribute_of, labels) == ["uci", "classification", None, "author", None, None]
    assert values(attribute_of, list(ATTRIBUTES)) == list(ATTRIBUTES.values())


def test_author_cell(spark):
    rows = [("저작자", "x", ["A", "B"]), ("저작자", "x", []), ("저작 자", " plain ", ["A"])]
    df = spark.createDataFrame(rows, "t string, v string, l array<string>")
    got = [r[0] for r in df.select(detail_value(F.col("t"), F.col("v"), F.col("l"))).collect()]
    assert got == ["A,B,", "", "plain"]


@pytest.mark.parametrize("encoding", ["base64", "zlib", "raw"])
def test_encode_decode(values, encoding):
    data = [bytes(i % 251 for i in range(n)) for n in (0, 1, 57, 58, 200)]
    back = values(lambda c: payload.decode(payload.encode(c, encoding), encoding), data, "binary")
    assert [bytes(b) for b in back] == data


def test_base64_has_no_line_breaks(values):
    (encoded,) = values(payload.encode_base64, [b"x" * 200], "binary")
    assert len(encoded) == 268 and "\n" not in encoded and "\r" not in encoded
    assert values(payload.data_uri, ["QQ=="]) == ["data:image/png;base64,QQ=="]


def test_fit_box(spark):
    cases = {
        (400, 300): (200, 150), (300, 400): (150, 200), (20, 10): (20, 10), (1000, 1): (200, 1),
        (1, 1000): (1, 200), (200, 200): (200, 200), (201, 200): (200, 199), (640, 480): (200, 150),
        (272, 92): (200, 68), (3000, 22): (200, 2),  # 3000:22 is nearer to 200:2 than to 200:1
    }
    df = spark.createDataFrame([(i, *k) for i, k in enumerate(cases)], "i int, w int, h int")
    got = df.orderBy("i").select(payload.fit_box(F.col("w"), F.col("h")).alias("s")).select("s.*").collect()
    assert [tuple(r) for r in got] == list(cases.values())
