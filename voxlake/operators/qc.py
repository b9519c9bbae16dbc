"""Quality control, pruning and erasure of subjects."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.functions import names
from voxlake.operators.catalog import constants


def passing(qc: DataFrame) -> DataFrame:
    """Participants with a row whose qc isn't 0; a null passes."""
    return qc.where(~F.col("qc").eqNullSafe(F.lit(0))).select("participant_id").distinct()


def non_passing(qc: DataFrame) -> DataFrame:
    return qc.where(~F.col("qc").eqNullSafe(F.lit(1))).select("participant_id").distinct()


def qc_filter(subjects: DataFrame, qc: DataFrame) -> DataFrame:
    """Subjects that aren't listed as failed; those without a row stay."""
    return subjects.join(qc.where("qc = 0").select(F.col("participant_id").alias("subject_id")), "subject_id", "left_anti")


def to_remove(subjects: DataFrame, qc: DataFrame) -> DataFrame:
    """Subjects that don't pass; those without a row don't."""
    return subjects.select("subject_id").distinct().join(passing(qc).withColumnRenamed("participant_id", "subject_id"), "subject_id", "left_anti")


def substrings(text: Column, n: int, at: Column) -> Column:
    """The substrings of n characters that begin at the places `at` of a text."""
    return F.transform(F.filter(at, lambda i: i <= F.length(text) - n + 1), lambda i: F.substring(text, i, n))


def offered(files: DataFrame, own: DataFrame, match: str = "exact") -> DataFrame:
    """(path, subject_id): the ids that a file's stem may be named for, of those `own` that are looked for."""
    stem = F.col("stem")
    if match == "contains":
        # as many as there are lengths of a file's name, at most
        sizes = own.where("length(subject_id) > 0").groupBy(F.length("subject_id").alias("n")).agg(F.min("subject_id").alias("low"), F.max("subject_id").alias("high")).orderBy("n").collect()
        # whatever lies between the first and the last id in their order begins as both do
        head = os.path.commonprefix([min(r.low for r in sizes), max(r.high for r in sizes)]) if sizes else ""
        places = F.sequence(F.lit(1), F.length(stem))
        at = F.filter(places, lambda i: F.substring(stem, i, len(head)) == head) if head else places
        parts = F.array_distinct(F.concat(*(substrings(stem, r.n, F.col("at")) for r in sizes))) if sizes else F.array().cast("array<string>")
    else:
        words = F.split(stem, "_")
        parts = F.transform(F.sequence(F.lit(1), F.size(words)), lambda n: F.array_join(F.slice(words, F.lit(1), n), "_"))
    # step by step, so that a stem and its places are found once a file
    named = files.select("path", names.file_stem(names.file_name(F.col("path"))).alias("stem"))
    if match == "contains":
        named = named.where("stem <> ''").select("path", "stem", at.alias("at"))
    return named.select("path", F.explode(parts).alias("subject_id"))


def files_of(files: DataFrame, subjects: DataFrame, match: str = "exact") -> DataFrame:
    """Files of the subjects: `exact`, the stem is the id or starts with id_ ; `contains`, the id anywhere in the stem.

    Both join on what a stem offers: its prefixes that end before an underscore, or its substrings of the lengths that ids have, at the places where it holds what all ids
    begin with. Contains takes more than meant, as sub-1 is in sub-10; an empty id names no file. Subjects and their files grow with the table, however small Spark takes
    them to be, so both joins are by sorting: no task holds them all.
    """
    own = subjects.select("subject_id").distinct()
    hits = offered(files, own, match).join(own.hint("merge"), "subject_id", "left_semi").select("path")
    return files.join(hits.hint("merge"), "path", "left_semi")


def files_in_folders_of(files: DataFrame, subjects: DataFrame) -> DataFrame:
    """Files below a folder whose name is a subject's id."""
    folders = F.split("path", "/")
    offered = files.select("path", F.explode(F.slice(folders, F.lit(1), F.size(folders) - 1)).alias("subject_id"))
    return files.join(offered.join(subjects.select("subject_id").distinct(), "subject_id", "left_semi").select("path"), "path", "left_semi")


def prune_plan(files: DataFrame, qc: DataFrame) -> DataFrame:
    """Each file and whether pruning keeps or deletes it."""
    gone = files_of(files, to_remove(files.select("subject_id"), qc)).select("path", F.lit("delete").alias("action"))
    return files.join(gone, "path", "left").select("path", "subject_id", F.coalesce("action", F.lit("keep")).alias("action"))


def erase_plan(files: DataFrame, subject: str) -> DataFrame:
    """What erasing a subject removes, by folder kind."""
    own = constants(files.sparkSession, "subject_id", subject)
    return files_of(files, own).groupBy("region", "side").agg(F.count("*").alias("n_files"))


def erase_rows(tensor: DataFrame, subject: str) -> DataFrame:
    """Rows of a tensor without a subject, numbered anew in their order. Arrays aren't sorted: a row goes back by the rows of the subject before it."""
    keys = ["region", "side", "input_type"]
    gone = tensor.where(F.col("subject_id") == subject).groupBy(*keys).agg(F.sort_array(F.collect_list("row_idx")).alias("gone"))
    before = F.size(F.filter("gone", lambda g: g < F.col("row_idx")))
    kept = tensor.where(F.col("subject_id") != subject).join(gone, keys, "left")
    return kept.withColumn("row_idx", (F.col("row_idx") - F.coalesce(before, F.lit(0))).cast("int")).select(*tensor.columns)


def first_subjects(subjects: DataFrame, n: int) -> DataFrame:
    """The first n subjects by id; all for -1."""
    own = subjects.select("subject_id").distinct()
    return own if n < 0 else own.orderBy("subject_id").limit(n)


def erase_report(tables: dict[str, DataFrame], subject: str) -> DataFrame:
    """How many rows of each table (by name, with a column subject_id) erasing a subject removes and leaves, and whether the subject was found in it."""
    gone = F.col("subject_id") == subject
    counts = [t.agg(F.count_if(gone).alias("n_removed"), F.count_if(~gone | gone.isNull()).alias("n_kept")).select(F.lit(n).alias("table"), "*") for n, t in tables.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out.withColumn("found", F.col("n_removed") > 0)
