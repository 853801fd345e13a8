"""Which keys a growing table holds, without reading the table: a compacted index.

Each batch adds a folder to a table, and asking all folders for a few keys costs more with every batch. So
the keys of ``FAN`` batches are written once more, narrow, as a segment, together with the segments that are
no more than twice as large: sizes grow geometrically, so a key is rewritten a logarithmic number of times. What a
batch meets is a bounded number of young folders and a few segments, each of which is cut into parts by the
keys' hash and has a Bloom filter per part. Parts that no key of the batch falls into are not opened, parts
whose filter knows none of its keys neither.

A batch that is written again is void in the segment that holds it and counts as a young folder from then on.
One writer at a time, as for the catalogue itself.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscan.sources.workspace import checkpointed, dropped

# Young folders that are merged; most parts of a segment, a power of two; filter bits for each key.
FAN, PARTS, BITS_PER_KEY = 8, 64, 16
# Keys of one part of a small segment, and keys up to which segments are always merged.
PART_KEYS, SMALL_KEYS = 50_000, 1_000_000
# Bits of one filter row, as Spark's bitmaps have them, and the bits that a key sets.
BITMAP_BITS, PROBES = 32_768, 2
STATE = "_state.json"

Batch = tuple[str, int]


@dataclass
class Segment:
    """Keys of the batches it ``covers``; its rows of ``void`` batches count no more. ``bits``: length of a part's filter."""

    name: str
    rows: int
    parts: int
    bits: int
    covers: set[Batch]
    void: set[Batch] = field(default_factory=set)


def _by_run(batches: set[Batch]) -> dict[str, list[int]]:
    out: dict[str, list[int]] = {}
    for run, n in sorted(batches):
        out.setdefault(run, []).append(n)
    return out


def _batches(by_run: dict[str, list[int]]) -> set[Batch]:
    return {(run, n) for run, numbers in by_run.items() for n in numbers}


class KeyIndex:
    """The index of one table's ``key`` below the catalogue's root."""

    def __init__(self, spark: SparkSession, root: str, table: str, key: str):
        self.spark, self.table, self.key = spark, f"{root}/{table}", key
        self.folder = f"{root}/_keys/{table}"
        self.segments: list[Segment] = []
        self._load()

    # Folders and the state file.

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _load(self) -> None:
        path, files = self._path(f"{self.folder}/{STATE}")
        if not files.exists(path):
            return
        stream = files.open(path)
        try:
            state = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        self.segments = [
            Segment(s["name"], s["rows"], s["parts"], s["bits"], _batches(s["covers"]), _batches(s["void"])) for s in state
        ]

    def _save(self) -> None:
        """The state replaces the old one by a rename: readers see one or the other."""
        state = [
            {"name": s.name, "rows": s.rows, "parts": s.parts, "bits": s.bits, "covers": _by_run(s.covers), "void": _by_run(s.void)}
            for s in self.segments
        ]
        path, files = self._path(f"{self.folder}/{STATE}")
        fresh, _ = self._path(f"{self.folder}/{STATE}.{uuid.uuid4().hex}")
        stream = files.create(fresh, True)
        try:
            stream.write(bytearray(json.dumps(state).encode()))
        finally:
            stream.close()
        files.delete(path, False)
        files.rename(fresh, path)

    def batches(self) -> list[Batch]:
        """All batches of the table, by the names of its folders."""
        path, files = self._path(self.table)
        if not files.exists(path):
            return []
        found = []
        for run in files.listStatus(path):
            name = run.getPath().getName()
            if name.startswith("run="):
                for batch in files.listStatus(run.getPath()):
                    number = batch.getPath().getName()
                    if number.startswith("batch_id="):
                        found.append((name[4:], int(number[9:])))
        return sorted(found)

    def young(self) -> list[Batch]:
        """Batches that no segment speaks for."""
        covered = {batch for segment in self.segments for batch in segment.covers}
        return [batch for batch in self.batches() if batch not in covered]

    # Rows.

    def _schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(self.key, T.StringType()), T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())]
        )

    def _young_keys(self, batches: list[Batch]) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], self._schema())
        paths = [f"{self.table}/run={run}/batch_id={n}" for run, n in batches]
        return self.spark.read.schema(self._schema()).option("basePath", self.table).parquet(*paths)

    def _hash(self) -> Column:
        return F.xxhash64(self.key)

    def _part(self, parts: int) -> Column:
        return F.pmod(self._hash(), F.lit(parts)).cast("int")

    def _probes(self, bits: int) -> Column:
        """The bits of a key in its part's filter."""
        places = [F.pmod(F.xxhash64(self.key, F.lit(n)), F.lit(bits)) for n in range(PROBES)]
        return F.array(*places)

    def _segment_keys(self, segment: Segment, parts: list[int] | None = None) -> DataFrame:
        schema = T.StructType([*self._schema().fields, T.StructField("part", T.IntegerType())])
        rows = self.spark.read.schema(schema).parquet(f"{self.folder}/{segment.name}/keys")
        if parts is not None:
            rows = rows.filter(F.col("part").isin(parts))
        return self._without(rows, segment.void).drop("part")

    def _without(self, rows: DataFrame, batches: set[Batch]) -> DataFrame:
        for run, n in sorted(batches):
            rows = rows.filter(~((F.col("run") == run) & (F.col("batch_id") == n)))
        return rows

    def _filters(self, segment: Segment, parts: list[int]) -> DataFrame:
        schema = "bucket long, bits binary, part int"
        rows = self.spark.read.schema(schema).parquet(f"{self.folder}/{segment.name}/filters")
        return rows.filter(F.col("part").isin(parts))

    def matching_parts(self, keys: DataFrame) -> dict[str, list[int]]:
        """By segment the parts that may hold any of ``keys`` (few): all bits of a key are set in the part's filter."""
        held = keys.select(F.pmod(self._hash(), F.lit(PARTS)).alias("part")).distinct().collect()
        wanted = {row["part"] for row in held}
        found = []
        for segment in self.segments if wanted else []:
            parts = sorted({part % segment.parts for part in wanted})
            probes = keys.select(self.key, self._part(segment.parts).alias("part"), F.explode(self._probes(segment.bits)).alias("probe"))
            placed = probes.select(
                self.key, "part", F.expr(f"probe div {BITMAP_BITS}").alias("bucket"), F.pmod("probe", F.lit(BITMAP_BITS)).alias("bit")
            ).distinct()
            byte = F.conv(F.hex(F.expr("substring(bits, cast(bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
            known = byte.bitwiseAND(F.expr("shiftleft(1, cast(bit % 8 as int))")) != 0
            joined = self._filters(segment, parts).join(F.broadcast(placed), ["part", "bucket"])
            # Both bits of a key may be one.
            hits = joined.groupBy(self.key, "part").agg(F.count_if(known).alias("n"))
            asked = placed.groupBy(self.key, "part").agg(F.count("*").alias("asked"))
            both = hits.join(F.broadcast(asked), hits[self.key].eqNullSafe(asked[self.key]) & (hits["part"] == asked["part"]))
            found.append(both.filter(F.col("n") == F.col("asked")).select(F.lit(segment.name).alias("name"), hits["part"]).distinct())
        out: dict[str, list[int]] = {segment.name: [] for segment in self.segments}
        if found:
            rows = found[0]
            for more in found[1:]:
                rows = rows.unionByName(more)
            for row in rows.collect():
                out[row["name"]].append(row["part"])
        return {name: sorted(parts) for name, parts in out.items()}

    def stored(self, keys: DataFrame | None, run: str, batch_id: int) -> DataFrame:
        """``(key)`` of what other batches wrote. With ``keys`` (few) at least those of them that are stored.

        Keys are counted by the caller: they go to every task that reads a filter.
        """
        own = (run, batch_id)
        out = self._young_keys([batch for batch in self.young() if batch != own]).select(self.key)
        matching = None
        if keys is not None and self.segments:
            matching = self.matching_parts(checkpointed(keys.select(self.key).distinct()))
        for segment in self.segments:
            parts = None if matching is None else matching[segment.name]
            if parts is None or parts:
                rows = self._without(self._segment_keys(segment, parts), {own} & segment.covers)
                out = out.unionByName(rows.select(self.key))
        return out

    # Upkeep.

    def rewritten(self, run: str, batch_id: int) -> None:
        """A batch is written again: segments no longer speak for it."""
        batch = (run, batch_id)
        for segment in self.segments:
            if batch in segment.covers:
                segment.covers.remove(batch)
                segment.void.add(batch)
                self._save()

    def _write(self, keys: DataFrame, rows: int, covers: set[Batch]) -> Segment:
        """A new segment. Its files are there before the state names it, so a lost run leaves only litter."""
        parts = 1
        while parts < PARTS and rows > PART_KEYS * parts:
            parts *= 2
        bits = BITMAP_BITS
        # Parts are even up to chance.
        while bits < rows // parts * BITS_PER_KEY:
            bits *= 2
        segment = Segment(f"segment-{uuid.uuid4().hex}", rows, parts, bits, covers)
        path = f"{self.folder}/{segment.name}"
        dealt = keys.withColumn("part", self._part(parts)).repartition(parts, "part")
        dealt.sortWithinPartitions("part", self.key).write.partitionBy("part").parquet(f"{path}/keys")
        stored = self.spark.read.schema(T.StructType([*self._schema().fields, T.StructField("part", T.IntegerType())]))
        probes = stored.parquet(f"{path}/keys").select("part", F.explode(self._probes(bits)).alias("probe"))
        filters = probes.groupBy("part", F.expr(f"probe div {BITMAP_BITS}").alias("bucket")).agg(
            F.bitmap_construct_agg(F.pmod("probe", F.lit(BITMAP_BITS))).alias("bits")
        )
        # Sorted by bucket, so that a reader's row groups hold neighbours.
        filters = filters.repartition(parts, "part").sortWithinPartitions("part", "bucket")
        filters.write.partitionBy("part").parquet(f"{path}/filters")
        return segment

    def compact(self) -> None:
        """Merge young folders, when there are ``FAN``, and the segments that are not much larger, into one segment."""
        young = self.young()
        if len(young) < FAN:
            return
        keys, covers, merged = self._young_keys(young), set(young), []
        rows = keys.count()
        for segment in sorted(self.segments, key=lambda s: s.rows):
            if segment.rows <= max(2 * rows, SMALL_KEYS):
                keys = keys.unionByName(self._segment_keys(segment))
                covers |= segment.covers
                rows += segment.rows
                merged.append(segment)
        made = self._write(keys, rows, covers)
        self.segments = [s for s in self.segments if s not in merged] + [made]
        self._save()
        dropped(self.spark, *[f"{self.folder}/{segment.name}" for segment in merged])
