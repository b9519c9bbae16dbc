"""Reading embedding tables, QC tables, nomenclatures, tensors and listings; writing masks, reports and collected embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake import schema


def read_embeddings(spark: SparkSession, path: str, dims: int) -> DataFrame:
    """(subject_id, vec) of CSV tables with a column ID and dim1..dimD."""
    names = [f"dim{i + 1}" for i in range(dims)]
    raw = spark.read.schema(", ".join(["ID string", *(f"{n} float" for n in names)])).csv(path, header=True)
    return raw.select(F.col("ID").alias("subject_id"), F.array(*names).alias("vec"))


def read_qc(spark: SparkSession, path: str) -> DataFrame:
    """A QC table; tabs if the name ends in .tsv, otherwise commas."""
    return spark.read.option("sep", "\t" if path.endswith(".tsv") else ",").schema(schema.QC).csv(path, header=True)


def read_nomenclature(spark: SparkSession, path: str) -> DataFrame:
    """(region, side, sulcus) of a nested JSON nomenclature."""
    brain = spark.read.option("multiLine", True).schema(schema.NOMENCLATURE).json(path).select(F.explode("brain").alias("region", "own"))
    named = brain.select("region", F.explode("own").alias("name", "members")).select("region", F.explode("members").alias("member"))
    right = F.col("member").endswith("_right")
    return named.select(F.regexp_replace("region", "_(left|right)$", "").alias("region"), F.when(right, "R").otherwise("L").alias("side"), F.regexp_replace("member", "_(left|right)$", "").alias("sulcus")).distinct()


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, length) of the files below a folder; their content isn't read."""
    from voxlake.sources.listing import Listing

    spark.dataSource.register(Listing)
    return spark.read.format("listing").option("glob", glob).load(path)


def read_arrays(spark: SparkSession, path: str) -> DataFrame:
    """(path, row_idx, shape, values) of .npy files, a row for each first index; files are read by ranges of rows."""
    from voxlake.sources.tensors import read_tensors

    return read_tensors(spark, path).select("path", F.col("row_idx").cast("int").alias("row_idx"), "shape", "values")


def write_masks(masks: DataFrame, path: str) -> None:
    """A partition for each side and sulcus; masks of single subjects have a column subject_id."""
    masks.write.partitionBy("side", "sulcus").parquet(path)


def write_subject_masks(masks: DataFrame, path: str, public_use: bool) -> bool:
    """Masks of single subjects, unless the output is for public use; whether they were written."""
    if not public_use:
        write_masks(masks, path)
    return not public_use


def write_splits(subsets: DataFrame, path: str) -> None:
    """Embeddings with a column subset: a partition for each, and all of them as `full`."""
    subsets.unionByName(subsets.withColumn("subset", F.lit("full"))).write.partitionBy("subset").parquet(path)


def write_projection(model: DataFrame, path: str) -> None:
    """A fitted projection, a partition for each region and hemisphere."""
    model.write.partitionBy("region", "hemi").parquet(path)


def read_projection(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("mean array<double>, axes array<array<double>>, region string, hemi string").parquet(path)


def write_manifest(files: DataFrame, path: str) -> None:
    """The files of each region and side, a line of JSON for each."""
    own = files.groupBy("region", "side").agg(F.sort_array(F.collect_list("path")).alias("files"))
    write_report(own.select("region", "side", F.size("files").alias("n_files"), "files"), path)


def write_report(report: DataFrame, path: str) -> None:
    """Rows as lines of JSON."""
    report.select(F.to_json(F.struct(*report.columns)).alias("value")).write.text(path)


def write_comparison(comparison: DataFrame, path: str) -> None:
    comparison.write.option("header", True).csv(path)


def collect_embeddings(runs: DataFrame, path: str) -> None:
    """Embeddings of all models in one place, a partition for each region and hemisphere."""
    runs.write.partitionBy("region", "hemi").parquet(path)


def read_report(spark: SparkSession, path: str, fields: str) -> DataFrame:
    return spark.read.text(path).select(F.from_json("value", fields).alias("r")).select("r.*")


def log_invalid(status: DataFrame, path: str) -> None:
    """Appends the subjects whose run went wrong, with the time."""
    bad = status.where(~F.col("status").isin("ok", "skipped"))
    bad.withColumn("at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")).write.mode("append").parquet(path)
