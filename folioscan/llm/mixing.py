"""Mixing sources to target weights with hash-threshold histograms.

Every document has a fixed place in [0, 2**60), a hash of its id. The part of a source that the mix
takes is everything below a threshold place, found without sorting: tokens are summed by source and
hash bucket, the bucket that crosses the budget is cut again, level by level, until it is one place.
Targets above a source's size nest: whole repeats first, the threshold decides who gets one more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioscan.llm.names import free_names, quoted
from folioscan.operators.joins import dimension_join
from folioscan.operators.paging import with_rank
from folioscan.sources.workspace import checkpointed, written

# Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
# A source is taken at most this often.
MOST_REPEATS = 3
# Bits of a place, and bits that one level of buckets decides.
PLACE_BITS, LEVEL_BITS = 60, 12


def word_count(text: Column) -> Column:
    """Runs without ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def place(doc_id: Column) -> Column:
    """The first 60 bits of the id's MD5; rows with one id share a place."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, PLACE_BITS // 4), 16, 10).cast("bigint")


def source_key(source: Column) -> Column:
    """A key that is never null, so that rows without a source join like others."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def source_targets(sized: DataFrame, weights=WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """``(source_key, source_size, target)`` by source; ``sized`` has ``source_key`` and ``size``.

    All sizes are shared by weight; a target above ``most`` times its source is cut, and what it loses
    is shared again. Sources stay distributed: each round brings one row of sums to the driver.
    """
    totals = sized.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    ordered = totals.withColumn("missing", F.col("source_key") == "")
    ranked = with_rank(ordered, ["missing", "source_key", "source_size"])
    turn = F.pmod("rank", F.lit(len(weights))).cast("int")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), turn)
    sources = checkpointed(ranked.select("source_key", "source_size", weight.cast("bigint").alias("weight")))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    share, cut = 0.0, None
    while True:
        limit = F.col("source_size") * most
        above = F.lit(False) if cut is None else F.col("weight") * F.lit(share) > limit
        sums = sources.agg(
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0)).alias("given"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("weight"),
            F.count_if(above).alias("cut"),
        ).first()
        if sums["cut"] == cut or not sums["weight"]:
            break
        share, cut = (total - sums["given"]) / sums["weight"], sums["cut"]
    target = F.least(F.col("weight") * F.lit(float(share)), (limit).cast("double"))
    return sources.select("source_key", "source_size", target.alias("target"))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``(source_key, source_size, target, repeats, threshold)`` by source.

    ``sized`` has ``source_key``, ``size`` and ``place``. A document is taken ``repeats`` times, and
    once more when its place is below ``threshold``. Each level reads only the rows of the bucket that
    crosses the budget; a source has at most ``2 ** LEVEL_BITS`` rows in any window.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    budgets = targets.withColumn("repeats", whole.cast("bigint"))
    rest = F.col("target") - F.col("repeats") * F.col("source_size")
    edge = budgets.select("source_key", rest.alias("rest"), F.lit(0).cast("bigint").alias("prefix"))
    rows = sized.select("source_key", "size", "place")
    for shift in range(PLACE_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        upper = F.shiftright("place", shift + LEVEL_BITS).alias("prefix")
        inside = rows.withColumn("prefix", upper).withColumn("bucket", F.shiftright("place", shift))
        if shift < PLACE_BITS - LEVEL_BITS:
            inside = inside.join(edge.select("source_key", "prefix"), ["source_key", "prefix"], "left_semi")
        sums = inside.groupBy("source_key", "bucket").agg(F.sum("size").alias("size"))
        order = Window.partitionBy("source_key").orderBy("bucket")
        running = sums.withColumn("upto", F.sum("size").over(order))
        below = F.col("upto") - F.col("size")
        crossing = (
            running.join(edge.select("source_key", "rest"), "source_key")
            .filter((below <= F.col("rest")) & (F.col("rest") < F.col("upto")))
            .select("source_key", (F.col("rest") - below).alias("rest"), F.col("bucket").alias("prefix"), "size")
        )
        edge = checkpointed(crossing)
    nearer = F.col("prefix") + F.when(F.col("rest") * 2 >= F.col("size"), 1).otherwise(0)
    ends = edge.select("source_key", nearer.cast("bigint").alias("threshold"))
    limit = F.coalesce("threshold", F.lit(0).cast("bigint"))
    return budgets.join(ends, "source_key", "left").withColumn("threshold", limit)


def _planned(sized: DataFrame, weights, most: int) -> DataFrame:
    return checkpointed(thresholds(sized, source_targets(sized, weights, most)))


def _times() -> Column:
    return F.col("repeats") + (F.col("place") < F.col("threshold")).cast("bigint")


def _sized(documents: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    return documents.select(
        F.col(doc_id).alias("doc_id"),
        word_count(F.col(text)).alias("size"),
        source_key(F.col(source)).alias("source_key"),
        place(F.col(doc_id)).alias("place"),
    )


def mix(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights=WEIGHTS, most: int = MOST_REPEATS,
) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``, one row per document.

    Sizes are words; a null text has none, and a document without words adds none however often it is
    taken. A null source is a source of its own, the last. Rows with one id (null included) are taken
    alike, so equal rows share their fate. Other columns are ignored. An empty table gives no rows.
    """
    sized = written(_sized(documents, doc_id, text, source), "mix")
    plan = _planned(sized, weights, most)
    joined = dimension_join(sized, plan, "source_key", ["place"])
    taken = (F.col("size") * _times()).alias("taken")
    return joined.select("doc_id", "size", "source_size", "target", taken)


def mixed_documents(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights=WEIGHTS, most: int = MOST_REPEATS,
) -> DataFrame:
    """The documents themselves, with their columns, each as often as the mix takes it.

    Thresholds are joined to the texts where they lie; what ``mix`` says of null texts, sources and
    repeated ids holds here too.
    """
    sized = written(_sized(documents, doc_id, text, source), "mix")
    plan = _planned(sized, weights, most).select("source_key", "repeats", "threshold")
    names = free_names(documents, ["source_key", "place", "repeats", "threshold"])
    keyed = documents.withColumns(
        {names["source_key"]: source_key(F.col(source)), names["place"]: place(F.col(doc_id))}
    )
    plan = plan.select(*[F.col(c).alias(names[c]) for c in plan.columns])
    joined = dimension_join(keyed, plan, names["source_key"], [names["place"]])
    below = F.col(names["place"]) < F.col(names["threshold"])
    times = (F.col(names["repeats"]) + below.cast("bigint")).cast("int")
    taken = joined.filter(times > 0).withColumn(names["place"], F.explode(F.array_repeat(F.lit(1), times)))
    return taken.select(*quoted(documents.columns))
