"""Run logs: error lines and run headers, as text and as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscan.functions.text import first_match

# The header forms of a run log.
SETTING = r"^> ([A-Z_]+)=(.*)$"
NAMED = r"^> ([A-Za-z ]+): (.*)$"
SECONDS = r"^([0-9]+(?:\.[0-9]+)?) sec$"


def write_error_log(errors: DataFrame, path: str, line: str = "line") -> None:
    """Append the error lines as text files."""
    errors.select(F.col(line).alias("value")).write.mode("append").text(path)


def write_run_log(headers: list[str], errors: DataFrame, path: str, run: str, batch_id: int, line: str = "line") -> None:
    """The log of one run and batch: its headers and its error lines, in a folder that the same run and batch replaces."""
    spark = errors.sparkSession
    first = spark.createDataFrame([(h,) for h in headers], "value string").coalesce(1)
    lines = first.unionByName(errors.select(F.col(line).alias("value")))
    lines.write.mode("overwrite").text(f"{path}/run={run}/batch_id={batch_id}")


def read_error_log(spark: SparkSession, path: str) -> DataFrame:
    """Log lines as ``value``, of all runs and batches below ``path``."""
    return spark.read.text(path).select("value")


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """``(run, batch_id, value)``: log lines with the run that wrote them."""
    return spark.read.schema("value string, run string, batch_id long").text(path).select("run", "batch_id", "value")


def run_durations(lines: DataFrame, column: str = "value", keys: tuple[str, ...] = ("run", "batch_id")) -> DataFrame:
    """``(keys.., name, seconds)`` of the header lines that hold a time."""
    value = F.col("value")
    named = run_metadata(lines, column, keys).filter(value.rlike(SECONDS))
    return named.select(*keys, F.col("key").alias("name"), F.regexp_extract(value, SECONDS, 1).cast("double").alias("seconds"))


def header_line(key, value):
    """``> KEY=VALUE``."""
    return F.format_string("> %s=%s", key, value)


def setting_line(key: str, value: object) -> str:
    return f"> {key}={value}"


def named_line(name: str, value: object) -> str:
    """``> Name: value``."""
    return f"> {name}: {value}"


def run_metadata(lines: DataFrame, column: str = "value", keys: tuple[str, ...] = ()) -> DataFrame:
    """``(keys.., key, value)`` of the header lines: ``> KEY=VALUE`` and ``> Name: value``."""
    text = F.col(column)
    key = F.coalesce(first_match(text, SETTING, 1), first_match(text, NAMED, 1))
    value = F.coalesce(first_match(text, SETTING, 2), first_match(text, NAMED, 2))
    parsed = lines.select(*keys, key.alias("key"), value.alias("value"))
    return parsed.filter(F.col("key").isNotNull())
