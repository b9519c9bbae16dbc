"""Two-dimensional reference clouds, projection of new subjects, and nearest neighbours."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.operators.embeddings import ROI, _added, grams
from voxlake.operators.neighbours import knn as knn


def project_fit(reference: DataFrame) -> DataFrame:
    """(region, hemi, mean, axes): the first two principal axes of each region's cloud; an axis' largest loading is positive."""

    def fit(key, parts: pd.DataFrame) -> pd.DataFrame:
        n, s, _, xx, *_ = _added(parts)
        mean = s / n
        _, vectors = np.linalg.eigh(xx.reshape(len(s), len(s)) / n - np.outer(mean, mean))
        axes = vectors[:, ::-1][:, :2].T
        axes = axes * np.sign(axes[np.arange(2), np.abs(axes).argmax(1)])[:, None]
        return pd.DataFrame([(*key, mean, [list(a) for a in axes])], columns=[*ROI, "mean", "axes"])

    both = reference.select(*ROI, F.col("vec").alias("x"), F.col("vec").alias("y"))
    return grams(both, ROI).groupBy(*ROI).applyInPandas(fit, "region string, hemi string, mean array<double>, axes array<array<double>>")


def project(embeddings: DataFrame, model: DataFrame, others: tuple[str, ...] = ()) -> DataFrame:
    """(region, hemi, subject_id, the columns `others`, u, v) of the embeddings that have a model."""
    centred = F.zip_with(F.col("vec").cast("array<double>"), "mean", lambda x, m: x - m)
    on = lambda k: F.aggregate(F.zip_with(centred, F.col("axes")[k], lambda x, a: x * a), F.lit(0.0), lambda s, x: s + x)
    return embeddings.join(model, ROI).select(*ROI, "subject_id", *others, on(0).alias("u"), on(1).alias("v"))


def knn_project(neighbours: DataFrame, coords: DataFrame) -> DataFrame:
    """New subjects at the mean of their neighbours' coordinates, weighted by inverse distance."""
    own = neighbours.join(coords.withColumnRenamed("subject_id", "ref_id"), [*ROI, "ref_id"]).withColumn("w", 1 / (F.col("d") + F.lit(1e-6)))
    mean = lambda c: F.round(F.sum(F.col("w") * F.col(c)) / F.sum("w"), 5).alias(c)
    return own.groupBy(*ROI, "subject_id").agg(mean("u"), mean("v"))


def projection_summary(reference: DataFrame, new: DataFrame) -> DataFrame:
    both = reference.select(*ROI, F.lit("reference").alias("kind")).unionByName(new.select(*ROI, F.lit("new").alias("kind")))
    return both.groupBy(*ROI, "kind").agg(F.count("*").alias("n"))


def projection_pairs(embedding_files: DataFrame, models: DataFrame) -> DataFrame:
    """Embedding tables whose region and hemisphere have a fitted projection, and those that are skipped."""
    there = models.select(*ROI).distinct().withColumn("there", F.lit(True))
    return embedding_files.where(F.col("region").isNotNull()).join(there, ROI, "left").select("name", *ROI, F.when(F.col("there"), "project").otherwise("skip").alias("action"))
