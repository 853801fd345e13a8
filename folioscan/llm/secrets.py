"""Secret scan with corpus-wide ownership frequency.

Credential-shaped spans come out of every text with built-in expressions. A candidate's hash is then
looked at over the whole corpus: how many repositories and how many owners hold it. A value that many
owners hold is a copied example; one that only one owner holds and that looks random may be live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscan.operators.joins import hot_key_join
from folioscan.sources.workspace import written

# The kinds in order, their patterns, the group that holds the value, its least length.
KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
# Values that this many owners hold are examples.
EXAMPLE_OWNERS = 3
# Values at least this long, with letters and digits and enough different characters, look live.
LIVE_LENGTH, LIVE_DISTINCT = 16, 8
PLACEHOLDER = r"(?i)example|sample|dummy|change_?me|placeholder|your[_-]|xxxx|0000|1234567"
_BLOCK = 256


def running_sum(values: Column) -> Column:
    """Inclusive sums of an array, in blocks, so that long arrays do not cost their square."""
    none = F.array().cast("array<bigint>")
    add = lambda acc, x: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + x))
    last = F.greatest(F.floor((F.size(values) - 1) / F.lit(_BLOCK)), F.lit(0)).cast("int")
    cut = lambda b: F.aggregate(F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)), none, add)
    blocks = F.transform(F.sequence(F.lit(0), last), cut)
    ends = F.aggregate(
        F.transform(blocks, lambda b: F.coalesce(F.try_element_at(b, F.lit(-1)), F.lit(0).cast("bigint"))), none, add
    )
    shifted = lambda b, i: F.transform(b, lambda x: x + F.when(i > 0, F.get(ends, i - 1)).otherwise(0))
    return F.flatten(F.transform(blocks, shifted))


def live_looking(value: Column) -> Column:
    """Long, mixed and not a placeholder."""
    distinct = F.size(F.array_distinct(F.split(value, "")))
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    return (F.length(value) >= LIVE_LENGTH) & mixed & (distinct >= LIVE_DISTINCT) & ~value.rlike(PLACEHOLDER)


def _with_spans(rows: DataFrame) -> DataFrame:
    """``spans``: start, end (code points), kind number, value start, hash and look of every finding."""
    parts = []
    for number, (kind, pattern, group, least) in enumerate(KINDS):
        found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        rows = rows.withColumn(f"{kind}_found", found)
        some = F.size(f"{kind}_found") > 0
        value = F.regexp_extract_all("text", F.lit(pattern), F.lit(group)) if group else F.col(f"{kind}_found")
        rows = rows.withColumns(
            {
                f"{kind}_value": F.when(some, value),
                f"{kind}_gap": F.when(some, F.split("text", pattern, -1)),
            }
        )
        steps = F.zip_with(
            F.slice(f"{kind}_gap", 1, F.size(f"{kind}_found")),
            f"{kind}_found",
            lambda gap, match: (F.length(gap) + F.length(match)).cast("bigint"),
        )
        rows = rows.withColumn(f"{kind}_end", F.when(some, running_sum(steps)))
        parts.append(F.when(some, _spans(kind, number, least)).otherwise(F.array().cast(_SPAN)))
    described = F.transform(
        F.concat(*parts),
        lambda s: F.struct(
            s["start"],
            s["end"],
            s["kind"],
            (s["end"] - F.length(s["value"])).alias("value_start"),
            F.unhex(F.sha2(s["value"].cast("binary"), 256)).alias("hash"),
            live_looking(s["value"]).alias("looks_live"),
        ),
    )
    return rows.withColumn("spans", described)


def _spans(kind: str, number: int, least: int) -> Column:
    """The matches of a kind whose value is long enough, with their places."""

    def span(match: Column, i: Column) -> Column:
        end = F.get(f"{kind}_end", i)
        return F.struct(
            (end - F.length(match)).alias("start"),
            end.alias("end"),
            F.lit(number).alias("kind"),
            F.get(f"{kind}_value", i).alias("value"),
        )

    return F.filter(F.transform(f"{kind}_found", span), lambda s: F.length(s["value"]) >= least)


_SPAN = "array<struct<start:bigint,end:bigint,kind:int,value:string>>"


def find_secrets(documents: DataFrame, keys: list[str], owner: Column, repository: Column, text: str = "text") -> DataFrame:
    """One row per document: its keys and ``findings``, sorted by start, then kind.

    A finding has ``start, end, kind`` (number in ``KINDS``), ``value_start``, ``owners``,
    ``repositories`` and ``verdict``: ``example`` for values of ``EXAMPLE_OWNERS`` owners or more,
    ``live`` for values of one owner that look live, else null. Secrets themselves are not carried on,
    only their SHA-256. A null text is empty; null owners are one owner, null repositories one
    repository. Repeated rows are rows of their own, though of the same owner. No rows: no rows.
    """
    chosen = documents.select(
        *[F.col(k).alias(f"key_{i}") for i, k in enumerate(keys)],
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
    )
    names = [f"key_{i}" for i in range(len(keys))]
    narrow = _with_spans(chosen).select(*names, "owner", "repository", "spans")
    found = written(narrow.withColumn("row", F.monotonically_increasing_id()), "secrets")
    spans = found.select("row", *names, "owner", "repository", F.explode_outer("spans").alias("span"))
    spans = spans.withColumn("hash", F.col("span.hash"))
    # Distinct first: a hash that every copy of an example holds becomes one row per repository and task.
    places = spans.filter(F.col("hash").isNotNull()).groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    by_owner = places.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    spread = by_owner.groupBy("hash").agg(
        F.count("*").alias("owners"), F.sum("repositories").alias("repositories")
    )
    facts = spans.drop("owner", "repository").withColumn("start", F.col("span.start"))
    joined = hot_key_join(facts, spread, "hash", ["row", "start"], "left")
    verdict = F.when(F.col("owners") >= EXAMPLE_OWNERS, "example").when(
        (F.col("owners") == 1) & F.col("span.looks_live"), "live"
    )
    finding = F.when(
        F.col("span").isNotNull(),
        F.struct(
            F.col("span.start").alias("start"),
            F.col("span.end").alias("end"),
            F.col("span.kind").alias("kind"),
            F.col("span.value_start").alias("value_start"),
            "owners",
            "repositories",
            verdict.alias("verdict"),
        ),
    )
    by_row = joined.groupBy("row", *names).agg(F.sort_array(F.collect_list(finding)).alias("findings"))
    return by_row.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], "findings")


def _joined(spans: Column) -> Column:
    texts = F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(texts, ",")


def span_digest(found: DataFrame, keys: list[str]) -> DataFrame:
    """Counts by kind, the hash of the base spans, and all spans as text.

    Beside the base spans, a value with a verdict is a span of kind ``live`` or ``example``.
    """
    kind_names = F.array(*[F.lit(kind) for kind, *_ in KINDS])
    base = F.transform("findings", lambda f: F.struct(f["start"], f["kind"], f["end"], F.get(kind_names, f["kind"]).alias("name")))
    judged = F.filter("findings", lambda f: f["verdict"].isNotNull())
    added = F.transform(
        judged,
        lambda f: F.struct(
            f["value_start"].alias("start"),
            (F.lit(len(KINDS)) + (f["verdict"] == "example").cast("int")).alias("kind"),
            f["end"],
            f["verdict"].alias("name"),
        ),
    )
    count = lambda test: F.size(F.filter("findings", test)).cast("bigint")
    of_kind = lambda n: count(lambda f: f["kind"] == n)
    return found.select(
        *keys,
        *[of_kind(n).alias(f"n_{kind}") for n, (kind, *_) in enumerate(KINDS)],
        F.sha2(_joined(F.array_sort(base)).cast("binary"), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat(base, added))).alias("spans"),
        count(lambda f: f["verdict"] == "live").alias("n_live"),
        count(lambda f: f["verdict"] == "example").alias("n_example"),
    )
