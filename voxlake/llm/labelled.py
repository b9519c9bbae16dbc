"""Labelled documents for fitting the classifiers, and the folds that stay out of it."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxlake.llm.common import release, staged, steps


def remainder(doc_id: Column, folds: int) -> Column:
    """crc32(doc_id as text) mod folds; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int, most_bytes: int = 64 << 20) -> DataFrame:
    """(text, y) of at most `most` labelled documents with at most `most_bytes` of text between them, spread over all of them by a hash of doc_id.

    `labels` holds doc_id and `label`; rows with a null in either are left out; of several labels for a document the largest counts.
    Rows that repeat a doc_id all count. Of equal hashes the smaller doc_id comes first, so the choice is the same in every run.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = staged(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    sizes = rows.groupBy("doc_id").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("n"))
    # over at most `most` documents
    running = F.sum("n").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    within = sizes.withColumn("running", running).where(F.col("running") <= most_bytes).select("doc_id")
    return rows.join(F.broadcast(within), "doc_id", "left_semi").select("text", "y")


def telling(rows: DataFrame, features, least_docs: int, least_chi2: float, frequent: int) -> np.ndarray:
    """The sorted feature ids, distinct in each text, that may take part in a model of the (text, y) rows, counted in Spark: those that at least `least_docs` rows
    have and whose presence depends on y (chi-squared of at least `least_chi2`), and, as features may tell nothing alone but something together, the
    `frequent` most frequent ones."""

    def count(batches):
        for batch in batches:
            for part, data, offsets in steps(batch):
                ids, at = features(data, offsets)
                own, spot = np.unique(ids, return_inverse=True)
                y = np.repeat(part.column("y").to_numpy(), np.diff(at))
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(np.bincount(spot, minlength=len(own)).astype(np.int64)), pa.array(np.bincount(spot, y, len(own)).astype(np.int64))], names=["id", "df", "hits"])

    n, bad = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not 0 < bad < n:
        return np.zeros(0, np.uint64)
    counted = staged(rows.mapInArrow(count, "id long, df long, hits long").groupBy("id").agg(F.sum("df").cast("double").alias("df"), F.sum("hits").cast("double").alias("hits")))
    odds = n * (F.col("hits") * n - F.col("df") * bad) * (F.col("hits") * n - F.col("df") * bad) / F.greatest(F.col("df") * (n - F.col("df")) * bad * (n - bad), F.lit(1e-9))
    alone, often = counted.where((F.col("df") >= least_docs) & (odds >= least_chi2)), counted.orderBy(F.desc("df"), "id").limit(frequent)
    found = alone.select("id").union(often.select("id")).toPandas()["id"].to_numpy(np.int64)
    release(counted)
    return np.unique(found.view(np.uint64))


def collect_features(rows: DataFrame, features, known: np.ndarray | None = None) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Feature ids and counts of each training row, computed in the tasks: features(data, offsets) gives (ids, offsets) for a run of texts. With `known`, the places of those of them that it holds."""

    def count(batches):
        for batch in batches:
            for part, data, offsets in steps(batch):
                ids, at = features(data, offsets)
                own = []
                for a, b in zip(at, at[1:], strict=False):
                    i, c = np.unique(ids[a:b], return_counts=True)
                    if known is not None:
                        spot = np.searchsorted(known, i)
                        hit = np.append(known, known[-1:])[np.minimum(spot, len(known))] == i if len(known) else np.zeros(len(i), bool)
                        i, c = spot[hit], c[hit]
                    own.append((i, c))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i.astype(np.uint32).tobytes() for i, _ in own], pa.binary()), pa.array([c.astype(np.uint32).tobytes() for _, c in own], pa.binary()), part.column("y")], names=["ids", "counts", "y"]
                )

    found = rows.mapInArrow(count, "ids binary, counts binary, y int").toPandas().sort_values(["ids", "counts", "y"])
    return [(np.frombuffer(i, np.uint32), np.frombuffer(c, np.uint32)) for i, c in zip(found.ids, found.counts, strict=True)], found.y.to_numpy(np.float64)


def scored(docs: DataFrame, score) -> DataFrame:
    """Adds score to doc_id, text of `docs`: score(data, offsets) gives one number for each of a run of texts."""

    def judge(batches):
        for batch in batches:
            for part, data, offsets in steps(batch):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score(data, offsets), pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(judge, f"doc_id {kind}, score double")


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of values[at[i] : at[i + 1]], also of empty runs; values may have a second axis."""
    out = np.zeros((len(at) - 1, *values.shape[1:]), np.float64)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        out[full] = np.add.reduceat(values, at[full], axis=0)
    return out


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
