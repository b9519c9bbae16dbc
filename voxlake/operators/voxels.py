"""Labelled voxels: counts, count masks, transforms, and crops of regions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxlake.operators import volumes

#: Voxels of a task, where those of a subject are brought together.
TASK_ROWS = 500_000


def dealt(voxels: DataFrame, *keys: str) -> DataFrame:
    """The voxels in as many partitions by `keys` as their number asks for, so that a task's share doesn't grow with the table; grouping by these keys and others needs no further shuffle."""
    return voxels.repartition(max(voxels.sparkSession.sparkContext.defaultParallelism, -(-voxels.count() // TASK_ROWS)), *keys)


def sulcus_voxels(voxels: DataFrame) -> DataFrame:
    """Voxels of each subject and sulcus; voxels without a name are left out."""
    return voxels.where(F.col("sulcus").isNotNull()).groupBy("campaign", "side", "subject_id", "sulcus").agg(F.count("*").alias("n"))


def merge_sides(counts: DataFrame) -> DataFrame:
    """One count for each subject and sulcus: where both sides have the name, the right one's."""
    return counts.groupBy("campaign", "subject_id", "sulcus").agg(F.max_by("n", "side").alias("n"))


def to_template(voxels: DataFrame, space: DataFrame, size: float) -> DataFrame:
    """Voxels (i, j, k) in the grid of the template (x, y, z): affine, divided by the voxel size, rounded half to even; each once a subject and sulcus."""
    a, v = F.col("affine"), F.col("voxel_size")
    i, j, k = (F.col(c) * v[n] for n, c in enumerate("ijk"))
    axis = lambda r: F.rint((a[4 * r] * i + a[4 * r + 1] * j + a[4 * r + 2] * k + a[4 * r + 3]) / F.lit(size)).cast("int")
    moved = dealt(voxels, "subject_id", "side").join(space.hint("shuffle_hash"), ["subject_id", "side"]).select("subject_id", "side", "sulcus", *(axis(r).alias(c) for r, c in enumerate("xyz")))
    return moved.dropDuplicates()


def inside(dims: tuple[int, int, int]) -> Column:
    return reduce(Column.__and__, (F.col(c).between(0, d - 1) for c, d in zip("xyz", dims, strict=True)))


def count_mask(voxels: DataFrame, dims: tuple[int, int, int], sulci: DataFrame | None = None, keys: tuple = ("side", "sulcus")) -> DataFrame:
    """At each voxel the number of subjects that occupy it."""
    if sulci is not None:
        voxels = voxels.join(sulci.select("sulcus").distinct(), "sulcus", "left_semi")
    # few voxels are there twice, so they meet by subject before they are told apart
    once = dealt(voxels.select("subject_id", *keys, "x", "y", "z"), "subject_id").where(inside(dims)).dropDuplicates(["subject_id", *keys, "x", "y", "z"])
    return once.groupBy(*keys, "x", "y", "z").agg(F.count("*").cast("int").alias("n"))


def add_subjects(mask: DataFrame, new: DataFrame) -> DataFrame:
    """A count mask with that of other subjects added."""
    keys = [c for c in mask.columns if c != "n"]
    return mask.unionByName(new).groupBy(*keys).agg(F.sum("n").cast("int").alias("n"))


def contributors(voxels: DataFrame) -> DataFrame:
    return voxels.groupBy("side", "sulcus").agg(F.count_distinct("subject_id").alias("n_subjects"), F.count("*").alias("n_voxels"))


def region_voxels(voxels: DataFrame, region_sulci: DataFrame) -> DataFrame:
    """(region, side, subject_id, x, y, z, bottom): the voxels of the sulci of each region, once, and whether one of them is of the fold's bottom (column bucket).

    The regions of a voxel are bits while voxels meet, 64 to a word, and become rows after that; so each voxel is shuffled once, by subject and side, however many regions have it.
    """
    n = F.dense_rank().over(Window.partitionBy("side").orderBy("region")) - 1
    words = region_sulci.select("side", "sulcus", "region", F.floor(n / volumes.BITS).cast("int").alias("word"), (n % volumes.BITS).alias("bit"))
    codes = words.groupBy("side", "sulcus", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    numbered = words.select("side", "region", "word", "bit").distinct()
    low = F.when(F.col("bucket") == "aims_bottom", F.col("bits")).otherwise(F.lit(0).cast("long")) if "bucket" in voxels.columns else F.lit(0).cast("long")
    own = dealt(voxels, "subject_id", "side").join(F.broadcast(codes), ["side", "sulcus"])  # names are few
    own = own.groupBy("subject_id", "side", "x", "y", "z", "word").agg(F.bit_or("bits").alias("bits"), F.bit_or(low).alias("low"))
    each = own.join(F.broadcast(numbered), ["side", "word"]).where(F.getbit("bits", F.col("bit")) == 1)
    return each.select("region", "side", "subject_id", "x", "y", "z", (F.getbit("low", F.col("bit")) == 1).alias("bottom"))


def region_mask(masks: DataFrame, region_sulci: DataFrame, threshold: int) -> DataFrame:
    """The voxels of each region whose sulcus masks sum up to more than `threshold`."""
    own = masks.join(region_sulci, ["side", "sulcus"])
    return own.groupBy("region", "side", "x", "y", "z").agg(F.sum("n").cast("int").alias("n")).where(F.col("n") > threshold)


def dilate(mask: DataFrame, radius: int) -> DataFrame:
    """The mask grown by `radius` voxels (largest coordinate difference), one axis after the other, as columns of bits."""
    keys = [c for c in mask.columns if c not in ("x", "y", "z", "n")]
    return volumes.voxels_of(volumes.grown(volumes.columns_of(mask, keys), radius))


def bounding_box(mask: DataFrame) -> DataFrame:
    sides = [f(c).alias(f"{n}_{c}") for c in "xyz" for n, f in (("min", F.min), ("max", F.max))]
    box = mask.groupBy("region", "side").agg(*sides)
    return box.withColumns({f"size_{c}": F.col(f"max_{c}") - F.col(f"min_{c}") + 1 for c in "xyz"})


def mask_apply(voxels: DataFrame, mask: DataFrame) -> DataFrame:
    """The voxels that lie in the mask of their region and side. Masks, which don't grow with the subjects, go to every task as columns of bits."""
    columns = volumes.columns_of(mask, ["region", "side"]).withColumnsRenamed({"w": "mask_w", "bits": "mask_bits"})
    own = voxels.withColumn("mask_w", F.floor(F.col("z") / volumes.BITS).cast("int")).join(F.broadcast(columns), ["region", "side", "x", "y", "mask_w"])
    return own.where(F.getbit("mask_bits", F.pmod("z", F.lit(volumes.BITS))) == 1).select(*voxels.columns)


def input_volumes(voxels: DataFrame) -> DataFrame:
    """Voxel values by kind of input: skeleton 1, foldlabel the number of the label, extremities 1 at the bottom."""
    label = F.dense_rank().over(Window.partitionBy("side").orderBy("sulcus"))
    kinds = F.array(
        F.struct(F.lit("skeleton").alias("input_type"), F.lit(1).alias("value")),
        F.struct(F.lit("foldlabel").alias("input_type"), F.col("label").alias("value")),
        F.when(F.col("bucket") == "aims_bottom", F.struct(F.lit("extremities").alias("input_type"), F.lit(1).alias("value"))),
    )
    # labels are numbered over the names, which are few, not over the voxels
    names = voxels.select("side", "sulcus").distinct().withColumn("label", label)
    numbered = voxels.join(names, ["side", "sulcus"])
    flat = numbered.select("subject_id", "side", "x", "y", "z", F.inline(F.filter(kinds, lambda k: k.isNotNull())))
    return flat.groupBy("input_type", "subject_id", "side", "x", "y", "z").agg(F.max("value").alias("value"))


def crop(voxels: DataFrame, box: DataFrame) -> DataFrame:
    """Voxels in the box of their region and side, from the box's corner on."""
    own = voxels.join(F.broadcast(box), ["region", "side"])  # a row for each region and side
    own = own.where(reduce(Column.__and__, (F.col(c).between(F.col(f"min_{c}"), F.col(f"max_{c}")) for c in "xyz")))
    return own.select(*(c for c in voxels.columns if c not in "xyz"), *((F.col(c) - F.col(f"min_{c}")).alias(c) for c in "xyz"), "size_x", "size_y", "size_z")


def crop_tensor(cropped: DataFrame) -> DataFrame:
    """A dense array, row-major, for each subject of a region and side, and its place among them. Subjects are numbered by their ids alone; voxels meet by subject and side and are laid out batch by batch."""
    spot = (F.col("x") * F.col("size_y") + F.col("y")) * F.col("size_z") + F.col("z")
    keys, sizes = ["region", "side", "subject_id"], ["size_x", "size_y", "size_z"]
    rows = cropped.groupBy(*keys, *sizes).agg(F.collect_list(F.struct(spot.cast("int").alias("spot"), "value")).alias("at"))
    place = F.row_number().over(Window.partitionBy("region", "side").orderBy("subject_id")) - 1
    places = cropped.select(*keys).distinct().withColumn("row_idx", place).groupBy("subject_id", "side").agg(F.map_from_entries(F.collect_list(F.struct("region", "row_idx"))).alias("places"))
    places = places.withColumnsRenamed({"subject_id": "of_subject", "side": "of_side"}).hint("shuffle_hash")
    own = rows.join(places, F.col("subject_id").eqNullSafe(F.col("of_subject")) & (F.col("side") == F.col("of_side")))
    numbered = own.select("region", "side", F.element_at("places", F.col("region")).alias("row_idx"), "subject_id", F.array(*sizes).alias("shape"), "at", (F.col("size_x") * F.col("size_y") * F.col("size_z")).alias("cells"))
    return volumes.dense(numbered, "at", "cells", "value").drop("cells")
