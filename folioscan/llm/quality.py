"""Quality classifier: a regularised quadratic discriminant over document statistics.

Each class is a Gaussian over transformed statistics of a text, its covariance shrunk towards a common
diagonal. The Cholesky factors of both covariances are computed once; a score is the difference of the
two log densities (squared Mahalanobis distances and log determinants) and of the log priors, as a
probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscan.llm.names import filtered_in_arrow
from folioscan.llm.words import Words, WordReader, per_row, repeats_per_row, sliced, space_words
from folioscan.sources.workspace import checkpointed

# Share of the pooled diagonal in each class covariance, and a floor for its variances.
SHRINKAGE = 0.1
VARIANCE_FLOOR = 1e-3
# Documents of at least this probability of label 1 are kept.
KEEP = 0.3
# Statistics are rounded to this step, so that sums of them and of their products are exact and a
# fitted model does not depend on the order in which tasks end.
STEP = 2.0**-10

STATISTICS = (
    "bytes", "words", "word_length", "long_words", "upper", "digits", "marks", "signs", "ends",
    "wide", "lines", "distinct_words", "top_word", "repeated_runs", "adjacent", "late_upper",
)


def _classes() -> dict[str, np.ndarray]:
    """By name: the bytes that count."""
    marks, signs = set(b".,;:!?'\"-()"), set(b"#$%&*|@+=/\\<>[]{}^_~`")
    tests = {
        "upper": lambda b: 65 <= b <= 90,
        "digits": lambda b: 48 <= b <= 57,
        "marks": lambda b: b in marks,
        "signs": lambda b: b in signs,
        "wide": lambda b: b >= 0xC0,
        "lines": lambda b: b == 10,
    }
    return {name: np.array([test(b) for b in range(256)], np.float64) for name, test in tests.items()}


def statistics(words: Words, classes: dict[str, np.ndarray], bounds: np.ndarray) -> np.ndarray:
    """One row of transformed statistics per text; an empty text is a row of zeros."""
    n_bytes = np.diff(bounds).astype(np.float64)
    n_words = np.diff(words.first).astype(np.float64)
    texts, counts = np.maximum(n_bytes, 1), np.maximum(n_words, 1)
    length = (words.end - words.start).astype(np.float64)
    share = {name: per_row(table[words.data], bounds, np.add, 0.0) for name, table in classes.items()}
    ends_odd = classes["signs"][words.data[words.end - 1]] + (words.data[words.end - 1] == ord("!"))
    upper = classes["upper"][words.data]
    late = per_row(upper, bounds, np.add, 0.0) - per_row(upper[words.start], words.first, np.add, 0.0)
    owner, times = repeats_per_row(words.hash, words.row)
    places = np.searchsorted(owner, np.arange(len(n_words) + 1))
    run, run_row = words.shingles(3)
    run_owner, _ = repeats_per_row(run, run_row)
    runs = np.maximum(np.bincount(run_row, minlength=len(n_words)), 1)
    distinct_runs = np.bincount(run_owner, minlength=len(n_words))
    same = np.zeros(len(length))
    if len(same):
        same[1:] = (words.hash[1:] == words.hash[:-1]) & (words.row[1:] == words.row[:-1])
    adding = lambda values: per_row(values, words.first, np.add, 0.0)
    columns = [
        np.log1p(n_bytes),
        np.log1p(n_words),
        np.log1p(adding(length) / counts),
        adding((length > 12).astype(np.float64)) / counts,
        np.sqrt(share["upper"] / texts),
        np.sqrt(share["digits"] / texts),
        np.sqrt(share["marks"] / texts),
        np.sqrt(share["signs"] / texts),
        np.sqrt(adding(ends_odd.astype(np.float64)) / counts),
        np.sqrt(share["wide"] / texts),
        np.sqrt(share["lines"] / counts),
        np.diff(places) / np.sqrt(counts),
        np.sqrt(per_row(times.astype(np.float64), places, np.maximum, 0.0) / counts),
        np.sqrt(1 - np.minimum(distinct_runs / runs, 1)),
        np.sqrt(adding(same) / counts),
        np.sqrt(np.maximum(late, 0) / texts),
    ]
    table = np.round(np.stack(columns, axis=1) / STEP) * STEP
    table[n_bytes == 0] = 0.0
    return table


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and constants of the classes 0 and 1."""

    mean: np.ndarray
    whiten: np.ndarray
    constant: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The probability of label 1."""
        logs = [
            c - 0.5 * np.square((rows - mean) @ inverse.T).sum(axis=1)
            for mean, inverse, c in zip(self.mean, self.whiten, self.constant)
        ]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def document_statistics(documents: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """The key columns and ``stats`` (array of double) of every document.

    A null text is an empty one, whose statistics are zeros. Repeated rows are rows of their own, null keys
    stay null, other columns do not matter, and an empty table gives no rows. Nothing shuffles.
    """
    rows = documents.select(*keys, text)
    schema = T.StructType(rows.schema.fields[:-1] + [T.StructField("stats", T.ArrayType(T.DoubleType()))])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, table in _measured(batches, len(keys)):
            flat = pa.array(table.ravel())
            ends = pa.array(np.arange(len(table) + 1, dtype=np.int32) * table.shape[1])
            stats = pa.ListArray.from_arrays(ends, flat)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], stats], names=schema.names)

    return rows.mapInArrow(measure, schema)


def _measured(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Each batch with the statistics of its text column, which is column ``at``."""
    reader, classes = WordReader(space_words()), _classes()
    for batch in sliced(batches):
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(at)), 0)
        offsets = np.concatenate(([0], np.cumsum(lengths.to_numpy(zero_copy_only=False)))).astype(np.int64)
        parts = [
            statistics(words, classes, offsets[low : high + 1] - offsets[low])
            for low, high, words in reader.read(batch.column(at))
        ]
        yield batch, np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))


def fit(labelled: DataFrame, label: str = "label", stats: str = "stats", shrinkage: float = SHRINKAGE) -> Discriminant:
    """Means, covariances and priors from sums that Spark adds up; one row comes to the driver.

    Rows whose label is neither 0 nor 1 are left out. A class without rows takes the other's Gaussian
    (a standard one when both are empty); priors are counts plus one.
    """
    d = len(STATISTICS)
    schema = "label int, n bigint, total array<double>, products array<double>"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, products = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(y), d)
            for k in (0, 1):
                mine = x[y == k]
                n[k] += len(mine)
                total[k] += mine.sum(axis=0)
                products[k] += mine.T @ mine
        yield pa.record_batch(
            [
                pa.array([0, 1], pa.int32()),
                pa.array(n.astype(np.int64)),
                pa.array(list(total), pa.list_(pa.float64())),
                pa.array([m.ravel() for m in products], pa.list_(pa.float64())),
            ],
            names=["label", "n", "total", "products"],
        )

    # Stored, as statistics are small and made in Python: a task that measures texts and adds up, too, would hold two workers.
    rows = checkpointed(labelled.filter(F.col(label).isin(0, 1)).select(F.col(label).cast("int"), stats))
    parts = rows.mapInArrow(add, schema)
    sums = [F.sum("n").alias("n")]
    sums += [F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(d)]
    sums += [F.sum(F.col("products")[i * d + j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
    found = {row["label"]: row for row in parts.groupBy("label").agg(*sums).collect()}
    n = np.array([found[k]["n"] if k in found else 0 for k in (0, 1)], np.float64)
    mean, cov = np.zeros((2, d)), np.stack([np.eye(d)] * 2)
    for k in (0, 1):
        if n[k]:
            mean[k] = [found[k][f"t{i}"] / n[k] for i in range(d)]
            second = np.array([[found[k][f"p{min(i, j)}_{max(i, j)}"] for j in range(d)] for i in range(d)])
            cov[k] = second / n[k] - np.outer(mean[k], mean[k])
    for k in (0, 1):
        if not n[k] and n[1 - k]:
            mean[k], cov[k] = mean[1 - k], cov[1 - k]
    weight = np.maximum(n, 1) / np.maximum(n, 1).sum()
    pooled = np.maximum(np.einsum("k,kij->ij", weight, cov).diagonal(), VARIANCE_FLOOR)
    whiten, constant = [], []
    for k in (0, 1):
        shrunk = (1 - shrinkage) * cov[k] + shrinkage * np.diag(pooled)
        factor = np.linalg.cholesky(shrunk + VARIANCE_FLOOR * 1e-3 * np.eye(d))
        whiten.append(np.linalg.inv(factor))
        constant.append(np.log((n[k] + 1) / (n.sum() + 2)) - np.log(factor.diagonal()).sum())
    return Discriminant(mean, np.stack(whiten), np.array(constant))


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: a fifth of the ids. A null id is never learned from either."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def labelled(stats: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """Statistics to learn from: of labelled rows that are not held out.

    ``stats`` has ``doc_id`` and ``stats``; labels meet these narrow rows, never texts.
    """
    known = labels.select("doc_id", F.col(label).alias("label"))
    known = known.filter(F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
    return stats.select("doc_id", "stats").join(known, "doc_id")


def score_statistics(stats: DataFrame, model: Discriminant, keys: list[str]) -> DataFrame:
    """The key columns and ``score``, the probability of label 1, for rows of ``document_statistics``."""
    rows = stats.select(*keys, "stats")
    schema = T.StructType(rows.schema.fields[:-1] + [T.StructField("score", T.DoubleType())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(len(keys)).flatten().to_numpy(zero_copy_only=False)
            score = model.score(flat.reshape(batch.num_rows, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score)], names=schema.names)

    return rows.mapInArrow(apply, schema)


def keep_good(documents: DataFrame, model: Discriminant, text: str = "text", least: float = KEEP) -> DataFrame:
    """The documents, with all their columns, that score at least ``least``; nothing shuffles.

    Null and empty texts are scored like others; repeated rows are kept or dropped together.
    """
    at = documents.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, table in _measured(batches, at):
            yield batch.filter(pa.array(model.score(table) >= least))

    return filtered_in_arrow(documents, keep)
