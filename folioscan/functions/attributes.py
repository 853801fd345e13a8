"""The closed set of detail labels and the item columns they fill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscan.functions.text import clean_value, join_authors, normalise_label

# Detail label -> item column. Column spellings are part of the stored schema.
ATTRIBUTES = {
    "UCI": "uci",
    "ICN": "icn",
    "저작자": "author",
    "공동저작자": "public_author",
    "공표일자(년도)": "publicate_date",
    "창작일자(년도)": "create_date",
    "공표국가": "publicate_contry",
    "분류(장르)": "classification",
    "원문제공": "original_text",
    "요약정보": "summary_info",
    "관련태그": "relation_tag",
    "발행일자": "publish_date",
    "발행자": "publisher",
    "기여자": "contributor",
    "저작물명대체제목": "alternate_title",
    "저작물파일유형": "substitute",
    "저작물속성": "attribute",
    "수집연계유형": "collect_type",
    "수집연계대상명": "collect_target",
    "수집연계URL": "collect_url",
    "주언어": "main_language",
    "원저작물유형": "original_type",
    "원저작물창작일": "original_date",
    "원저작물크기": "original_size",
    "원저작물소장처": "original_collection",
    "추가사항": "details",
}
COLUMNS = list(ATTRIBUTES.values())

# Fixed value: the one label whose cell is read as a list of links.
AUTHOR_LABEL = "저작자"

# Fixed value: the message logged for a label outside the set.
UNKNOWN_LABEL = "알 수 없는 상세정보"


def dictionary(spark: SparkSession) -> DataFrame:
    """The label dictionary as a table of 26 rows."""
    schema = T.StructType([T.StructField("label", T.StringType()), T.StructField("attribute", T.StringType())])
    return spark.createDataFrame(list(ATTRIBUTES.items()), schema)


def attribute_of(title: Column) -> Column:
    """Item column of a raw label, null when the label is unknown. No join, no shuffle."""
    entries = ", ".join(f"'{label}', '{name}'" for label, name in ATTRIBUTES.items())
    return F.try_element_at(F.expr(f"map({entries})"), normalise_label(title))


def detail_value(title: Column, value: Column, links: Column) -> Column:
    """Cleaned cell text; for the author label, exactly as written, the joined link texts."""
    return clean_value(F.when(title == AUTHOR_LABEL, join_authors(links)).otherwise(value))
