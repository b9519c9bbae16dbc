"""Comparison of two annotation campaigns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def campaign_compare(counts: DataFrame, a: str = "A", b: str = "B") -> DataFrame:
    """For each sulcus of either campaign, from (campaign, subject_id, sulcus, n): subjects, percent of all its campaign's subjects, mean voxels of
    subjects that have it (0 if none has), and the ratio of the means, null where a's is 0."""
    totals = counts.groupBy("campaign").agg(F.count_distinct("subject_id").alias("total"))
    own = counts.groupBy("campaign", "sulcus").agg(F.count("*").alias("subjects"), F.avg("n").alias("mean"))
    own = own.join(totals, "campaign")
    of = lambda c, name: F.max(F.when(F.col("campaign") == c, F.col(name)))
    both = own.groupBy("sulcus").agg(*(F.coalesce(of(c, name), F.lit(0)).alias(f"{name}_{s}") for c, s in ((a, "a"), (b, "b")) for name in ("subjects", "mean", "total")))
    percent = lambda s: F.when(F.col(f"total_{s}") > 0, F.round(100.0 * F.col(f"subjects_{s}") / F.col(f"total_{s}"), 1)).otherwise(F.lit(0.0))
    return both.select(
        "sulcus", F.col("subjects_a").alias("n_a"), percent("a").alias("pct_a"), F.round("mean_a", 1).alias("mean_a"), F.col("subjects_b").alias("n_b"), percent("b").alias("pct_b"), F.round("mean_b", 1).alias("mean_b"),
        F.when(F.col("mean_a") > 0, F.round(F.col("mean_b") / F.col("mean_a"), 3)).alias("ratio"),
    )


def campaign_top(comparison: DataFrame, most: int = 30) -> DataFrame:
    """The sulci whose ratio is farthest from 1."""
    off = F.round(F.abs(F.col("ratio") - 1), 6)
    return comparison.where(F.col("ratio").isNotNull()).select("sulcus", "ratio", off.alias("off")).orderBy(F.desc("off"), "sulcus").limit(most)


def campaign_subjects(counts: DataFrame, a: str = "A", b: str = "B") -> DataFrame:
    flags = counts.groupBy("subject_id").agg(F.max(F.col("campaign") == a).alias("in_a"), F.max(F.col("campaign") == b).alias("in_b"))
    return flags.agg(F.count_if(F.col("in_a") & ~F.col("in_b")).alias("only_a"), F.count_if(F.col("in_b") & ~F.col("in_a")).alias("only_b"), F.count_if(F.col("in_a") & F.col("in_b")).alias("both"))


def with_mask_stats(comparison: DataFrame, stats: DataFrame, counts: DataFrame, a: str = "A", b: str = "B") -> DataFrame:
    """The comparison with each campaign's mask statistics; sums also for each of its subjects."""
    totals = counts.groupBy("campaign").agg(F.count_distinct("subject_id").alias("total")).withColumnRenamed("campaign", "mask_set")
    own = stats.groupBy("mask_set", "sulcus").agg(F.max("max_n").alias("max_n"), F.sum("sum_n").alias("sum_n"), F.sum("nonzero").alias("nonzero")).join(totals, "mask_set", "left")
    out = comparison
    for c, s in ((a, "a"), (b, "b")):
        per = F.round(F.col("sum_n") / F.greatest(F.coalesce("total", F.lit(1)), F.lit(1)), 6)
        out = out.join(own.where(F.col("mask_set") == c).select("sulcus", *(F.col(f).cast("double").alias(f"mask_{t}_{s}") for f, t in (("max_n", "max"), ("sum_n", "sum"), ("nonzero", "nonzero"))), per.alias(f"mask_sum_per_sub_{s}")), "sulcus", "left")
    return out
