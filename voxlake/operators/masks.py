"""Count masks: statistics, marginals, distances between two sets, and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxlake.functions.names import bucket_label

KEY = ["side", "sulcus"]


def mask_stats(masks: DataFrame) -> DataFrame:
    return masks.groupBy("mask_set", *KEY).agg(F.max("n").alias("max_n"), F.sum("n").alias("sum_n"), F.count_if(F.col("n") != 0).alias("nonzero"))


def mask_sets(masks: DataFrame, a: str, b: str) -> DataFrame:
    """Each mask of either set, and whether it is common, only in a, or only in b."""
    sides = masks.where(F.col("mask_set").isin(a, b)).groupBy(*KEY).agg(F.max(F.col("mask_set") == a).alias("in_a"), F.max(F.col("mask_set") == b).alias("in_b"))
    return sides.select(*KEY, F.when(F.col("in_a") & F.col("in_b"), "common").when(F.col("in_a"), "only_a").otherwise("only_b").alias("where_found"))


def axis_marginals(masks: DataFrame) -> DataFrame:
    """Sums over the other two axes, for each axis and position."""
    long = masks.select("mask_set", *KEY, "n", F.inline(F.array(*(F.struct(F.lit(c).alias("axis"), F.col(c).alias("pos")) for c in "xyz"))))
    return long.groupBy("mask_set", *KEY, "axis", "pos").agg(F.sum("n").alias("total"))


def wasserstein_axis(masks: DataFrame, a: str, b: str) -> DataFrame:
    """The one-dimensional Wasserstein distance between the shares of two common masks along each axis; 0 where one side is empty, and said so."""
    m = axis_marginals(masks.where(F.col("mask_set").isin(a, b) & (F.col("n") != 0)))
    share = F.col("total") / F.sum("total").over(Window.partitionBy("mask_set", *KEY, "axis"))
    both = m.withColumn("share", F.when(F.col("mask_set") == a, share).otherwise(-share)).groupBy(*KEY, "axis", "pos").agg(F.sum("share").alias("d"), F.max(F.col("mask_set") == a).alias("in_a"), F.max(F.col("mask_set") == b).alias("in_b"))
    order = Window.partitionBy(*KEY, "axis").orderBy("pos")
    run = F.abs(F.sum("d").over(order.rowsBetween(Window.unboundedPreceding, 0))) * F.coalesce(F.lead("pos").over(order) - F.col("pos"), F.lit(0))
    out = both.withColumn("part", run).groupBy(*KEY, "axis").agg(F.sum("part").alias("w"), (~(F.max("in_a") & F.max("in_b"))).alias("empty_side"))
    return out.withColumn("w", F.when(F.col("empty_side"), F.lit(0.0)).otherwise(F.col("w")))


def mask_distance(masks: DataFrame, a: str, b: str) -> DataFrame:
    """The Euclidean norm of the three axis distances; 0 where one side is empty, and said so."""
    return wasserstein_axis(masks, a, b).groupBy(*KEY).agg(F.round(F.sqrt(F.sum(F.col("w") * F.col("w"))), 6).alias("distance"), F.max("empty_side").alias("empty_side"))


def mask_buckets(distances: DataFrame) -> DataFrame:
    """Masks of both sets by unit of distance, in the order of distance."""
    name = F.concat_ws("/", *KEY)
    return distances.where(~F.col("empty_side")).groupBy(F.floor("distance").alias("low"), bucket_label(F.col("distance")).alias("bucket")).agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list(name)), ",").alias("names"))


def mask_report(distances: DataFrame, sets: DataFrame) -> DataFrame:
    """A row of summary: masks common and on one side, mean and largest distance."""
    found = sets.agg(*(F.count_if(F.col("where_found") == w).alias(w) for w in ("common", "only_a", "only_b")))
    return found.crossJoin(distances.where(~F.col("empty_side")).agg(F.round(F.avg("distance"), 6).alias("mean_distance"), F.max("distance").alias("max_distance")))


def report_rows(distances: DataFrame, sets: DataFrame) -> DataFrame:
    """The whole report as rows (section, name, value): the summary, the number of masks in each bucket, and the distance of each mask."""
    summary = mask_report(distances, sets)
    summary = summary.select(F.inline(F.array(*(F.struct(F.lit("summary").alias("section"), F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in summary.columns))))
    buckets = mask_buckets(distances).select(F.lit("buckets").alias("section"), F.col("bucket").alias("name"), F.col("n").cast("double").alias("value"))
    return summary.unionByName(buckets).unionByName(distances.select(F.lit("masks").alias("section"), F.concat_ws("/", *KEY).alias("name"), F.col("distance").alias("value")))
