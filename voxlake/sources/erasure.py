"""Pruning and erasure carried out on a folder of files: what is listed is deleted, and tensors lose their rows."""

from __future__ import annotations

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.operators import qc as rules
from voxlake.operators.catalog import constants
from voxlake.sources.tables import list_files
from voxlake.sources.tensors import erase_subjects, open_folder, versions


def spread(files: DataFrame) -> DataFrame:
    """The paths, dealt out to all tasks: what is done with a file takes longer than its row, so that neither the size of a table nor that of a shuffle tells how many tasks it needs."""
    return files.select("path").repartition(4 * files.sparkSession.sparkContext.defaultParallelism, "path")


def delete_files(files: DataFrame) -> int:
    """Deletes the files (path), in the tasks; how many were still there. A file that is gone already is none, so a run that failed can be repeated."""

    def delete(batches):
        for batch in batches:
            n = 0
            for path in batch["path"]:
                store, name = fs.FileSystem.from_uri(path)
                if store.get_file_info(name).is_file:
                    store.delete_file(name)
                    n += 1
            yield pd.DataFrame({"n": [n]})

    return spread(files).mapInPandas(delete, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def prune_failed(spark: SparkSession, folder: str, subjects: DataFrame, qc: DataFrame, match: str = "contains", dry_run: bool = False) -> int:
    """Deletes the files below a folder of those `subjects` that don't pass quality control, by the rule `match` of `files_of`: how many files. A dry run only counts them."""
    found = list_files(spark, folder).persist()  # met twice, listed once
    try:
        gone = rules.files_of(found, rules.to_remove(subjects, qc), match)
        return gone.count() if dry_run else delete_files(gone)
    finally:
        found.unpersist()


def purge_subject(spark: SparkSession, folder: str, subject: str, tensors: str | None = None, dry_run: bool = False) -> dict[str, int]:
    """Deletes all of one subject below a folder: files named for it, files in folders named for it, and its rows of the tensors of the folder `tensors`; how many of each. A dry run only counts them."""
    own, listed = constants(spark, "subject_id", subject), list_files(spark, folder).persist()  # met four times, listed once
    found = listed
    if tensors:  # parts of tensors, their indices and manifests are never deleted by name
        store, root = open_folder(tensors)
        found = found.where(~F.startswith("path", F.lit(f"{root}/")))
    try:
        gone = rules.files_of(found, own).union(rules.files_in_folders_of(found, own)).distinct()
        rows = erase_subjects(spark, tensors, own, dry_run).agg(F.coalesce(F.sum("n_removed"), F.lit(0))).first()[0] if tensors and versions(store, root) else 0
        return {"files": gone.count() if dry_run else delete_files(gone), "rows": rows}
    finally:
        listed.unpersist()
