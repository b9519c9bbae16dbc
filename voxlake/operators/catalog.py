"""The derivative files as a table: what exists, what is complete, what is pending."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxlake.functions import names


def constants(spark: SparkSession, name: str, *values: str) -> DataFrame:
    """A small table of one column."""
    return spark.range(0, 1, 1, 1).select(F.explode(F.array(*(F.lit(v) for v in values))).alias(name))


def subject_discovery(paths: DataFrame) -> DataFrame:
    """(subject_id, side) of paths <db>/<subject>/.../<side><anything><subject>*.arg."""
    name = names.file_name(F.col("path"))
    subject = F.regexp_extract("path", "/(sub-[^/]+)/", 1)
    return paths.where(name.endswith(".arg") & F.instr(name, subject).cast("boolean")).select(subject.alias("subject_id"), F.left(name, F.lit(1)).alias("side")).where(F.col("side").isin("L", "R")).distinct()


def graph_files(paths: DataFrame, acquisition: str | None = None) -> DataFrame:
    """Paths of fold graphs: .arg with sulci or folds in the path, in any case; of one acquisition if named."""
    found = paths.where(F.col("path").endswith(".arg") & F.lower("path").rlike("sulci|folds"))
    return found if acquisition is None else found.where(F.array_contains(F.split("path", "/"), acquisition))


def acquisitions(paths: DataFrame) -> DataFrame:
    """The acquisitions of each subject that hold a fold graph, sorted."""
    found = graph_files(paths).select(F.regexp_extract("path", "/(sub-[^/]+)/", 1).alias("subject_id"), F.regexp_extract("path", "/t1mri/([^/]+)/", 1).alias("acquisition"))
    return found.groupBy("subject_id").agg(F.array_join(F.sort_array(F.collect_set("acquisition")), ",").alias("acquisitions"))


def first_graph(paths: DataFrame) -> DataFrame:
    """The first graph of each subject and hemisphere, by path, with the number of candidates."""
    found = graph_files(paths).select("path", F.regexp_extract("path", "/(sub-[^/]+)/", 1).alias("subject_id"), names.graph_hemi(names.file_name(F.col("path"))).alias("hemi"))
    own = Window.partitionBy("subject_id", "hemi")
    return found.withColumns({"rn": F.row_number().over(own.orderBy("path")), "n_candidates": F.count("*").over(own)}).where("rn = 1").drop("rn")


def graph_mesh(paths: DataFrame) -> DataFrame:
    """The white mesh of each fold graph: below the same analysis folder, on the same side."""
    anchor = F.regexp_extract("path", "^(.*/default_(?:analysis|acquisition/0))/", 1).alias("anchor")
    graphs = graph_files(paths).select("path", anchor, names.graph_hemi(names.file_name(F.col("path"))).alias("hemi"))
    meshes = paths.where(F.col("path").rlike("_[LR]white\\.gii$")).select(anchor, F.when(F.col("path").endswith("_Rwhite.gii"), "right").otherwise("left").alias("hemi"), F.col("path").alias("mesh"))
    return graphs.join(meshes, ["anchor", "hemi"], "left").groupBy("path").agg(F.min("mesh").alias("mesh"))


def input_files(paths: DataFrame) -> DataFrame:
    """Scans by their last suffix, nii or gz."""
    return paths.where(F.lower(F.element_at(F.split(names.file_name(F.col("path")), "\\."), -1)).isin("nii", "gz"))


def mask_catalog(paths: DataFrame, root: str) -> DataFrame:
    """Masks exactly one folder below the root, by relative path."""
    rel = F.substring("path", len(root) + 2, 1 << 20)
    return paths.where(F.col("path").startswith(root + "/") & (F.size(F.split(rel, "/")) == 2)).select(rel.alias("rel"), "path")


def completed_regions(files: DataFrame) -> DataFrame:
    """Regions that have a skeleton mask, a list for each hemisphere, empty ones too."""
    sides = constants(files.sparkSession, "hemi", "left", "right").withColumn("side", F.when(F.col("hemi") == "left", "L").otherwise("R"))
    done = files.where(F.col("kind") == "mask_skeleton").groupBy("side").agg(F.array_join(F.sort_array(F.collect_set("region")), ",").alias("regions"))
    return sides.join(done, "side", "left").select("hemi", F.coalesce("regions", F.lit("")).alias("regions"))


def crop_versions(files: DataFrame) -> DataFrame:
    """Files of each version and voxel size; the unversioned layout has an empty version."""
    parts = F.regexp_extract("path", "/crops/(?:([^/]+)/)?(\\d+mm)/", 1).alias("version"), F.regexp_extract("path", "/crops/(?:([^/]+)/)?(\\d+mm)/", 2).alias("voxel")
    return files.select(*parts).groupBy("version", "voxel").agg(F.count("*").alias("n_files"), (F.count("*") > 0).alias("exists"))


def discover_subjects(files: DataFrame) -> DataFrame:
    return files.select(names.file_stem(names.file_name(F.col("path")), names.DISCOVER_SUFFIXES).alias("subject_id")).distinct()


def output_report(files: DataFrame) -> DataFrame:
    return files.groupBy("region", "side", "kind").agg(F.count("*").alias("n_files"), F.sum("length").alias("bytes"))


def model_folders(paths: DataFrame, root: str) -> DataFrame:
    """(folder, region, hemi, n_files) of the folders below the root; region is null where the name isn't understood."""
    rel = F.substring("path", len(root) + 2, 1 << 20)
    folder = F.split(rel, "/")[0]
    found = paths.where(F.col("path").startswith(root + "/")).groupBy(folder.alias("folder")).agg(F.count("*").alias("n_files"))
    return found.select("folder", names.region_of(F.col("folder")).alias("region"), names.hemi_of(F.col("folder")).alias("hemi"), "n_files")


def region_sulci(nomenclature: DataFrame, regions: DataFrame, sides: DataFrame) -> DataFrame:
    """The distinct sulci of the requested regions on the requested sides; unknown regions are left out."""
    return nomenclature.join(regions.crossJoin(sides), ["region", "side"]).select("region", "side", "sulcus").distinct()


def work_grid(regions: DataFrame, kinds: tuple[str, ...] = ("skeleton", "foldlabel", "extremities")) -> DataFrame:
    """Every region, side and kind of input, with the settings that single regions have."""
    spark = regions.sparkSession
    sides, types = constants(spark, "side", "L", "R"), constants(spark, "input_type", *kinds)
    lax = F.col("region").isin("OCCIPITAL", "F.C.L.p.-subsc.-F.C.L.a.-INSULA.")
    return regions.crossJoin(sides).crossJoin(types).select("region", "side", "input_type", F.when(lax, 1).otherwise(0).alias("threshold"), (F.col("region") == "CINGULATE.").alias("combine_type"))


def pending(tasks: DataFrame, done: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """Tasks without a result; all of them with `force`."""
    return tasks if force else tasks.join(done, keys, "left_anti")


def eligibility(subjects: DataFrame, files: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Whether each subject has a file of every required kind, and the kinds that are missing."""
    wanted = subjects.crossJoin(constants(subjects.sparkSession, "kind", *kinds))
    there = files.select("subject_id", "kind").distinct().withColumn("found", F.lit(True))
    checked = wanted.join(there, ["subject_id", "kind"], "left").withColumn("found", F.coalesce("found", F.lit(False)))
    missing = F.array_join(F.sort_array(F.collect_list(F.when(~F.col("found"), F.col("kind")))), ",")
    return checked.groupBy("subject_id").agg(F.bool_and("found").alias("eligible"), missing.alias("missing"))


def paths_found(wanted: DataFrame, listing: DataFrame) -> DataFrame:
    """Each wanted path and whether the listing has it; an error where no path is wanted."""
    if wanted.isEmpty():
        raise ValueError("no paths to check")
    there = listing.select("path").distinct().withColumn("there", F.lit(True))
    return wanted.join(there, "path", "left").select("path", F.col("there").isNotNull().alias("found"))


def status_summary(status: DataFrame) -> DataFrame:
    """Counts of outcomes; whatever isn't ok, skipped or invalid counts as failed."""
    is_ = lambda *s: F.count_if(F.col("status").isin(*s))
    known = ("ok", "skipped", "invalid_foldlabel")
    return status.agg(F.count("*").alias("total"), is_("skipped").alias("skipped"), is_("ok").alias("ok"), is_("invalid_foldlabel").alias("invalid"), (F.count("*") - is_(*known)).alias("failed"))


def crop_sizes(tensors: DataFrame, boxes: DataFrame) -> DataFrame:
    """The crop size of each region and side: of the skeleton tensor, else the foldlabel, else distbottom, else the mask's box; null where there is none."""
    of = lambda k: F.max(F.when(F.col("kind") == k, F.col("size")))
    known = tensors.groupBy("region", "side").agg(F.coalesce(of("skeleton"), of("foldlabel"), of("distbottom")).alias("size"))
    return known.join(boxes.select("region", "side", F.col("size").alias("box")), ["region", "side"], "full").select("region", "side", F.coalesce("size", "box").alias("size"))


def dataset_manifest(sizes: DataFrame, crops: str) -> DataFrame:
    """The settings of each dataset: name, paths of its arrays and subjects, and size; datasets without a size are left out."""
    base = F.concat(F.lit(crops + "/"), F.col("region"), F.lit("/mask/"), F.col("side"))
    return sizes.where(F.col("size").isNotNull()).select(names.dataset_name(F.col("region"), F.col("side")).alias("dataset"), F.concat(base, F.lit("skeleton.npy")).alias("numpy_all"), F.concat(base, F.lit("skeleton_subject.csv")).alias("subjects_all"), F.col("size").alias("input_size"))


def migrate_plan(legacy: DataFrame, versioned: DataFrame, overwrite: bool = False) -> DataFrame:
    """What becomes of each legacy region folder: move, or where the versioned one exists conflict or overwrite."""
    there = versioned.select("region").distinct().withColumn("there", F.lit(True))
    old = legacy.groupBy("region").agg(F.count("*").alias("n_files"))
    return old.join(there, "region", "left").select("region", "n_files", F.when(F.col("there").isNull(), "move").otherwise("overwrite" if overwrite else "conflict").alias("action"))


def in_order(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows sorted by the columns, nulls first, with their place from 1 on. Ranges are sorted side by side; only their sizes meet."""
    spark = rows.sparkSession
    place = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *columns).sortWithinPartitions(*columns).withColumn("place", F.monotonically_increasing_id()).persist()
    sizes = place.groupBy(F.shiftright("place", 33).alias("part")).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = place.withColumn("part", F.shiftright("place", 33)).join(F.broadcast(sizes.select("part", before.alias("before"))), "part")  # a row for each range
    return own.withColumn("place", F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1).drop("part", "before")
