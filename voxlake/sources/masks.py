"""Count masks that are stored and added to: by side and sulcus, with the subjects that each counts."""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyarrow import fs
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.operators.voxels import dealt, inside
from voxlake.sources.tensors import open_folder

CLASS = ["side", "sulcus"]
_ROWS = "x int, y int, z int, n int, subject_id string, version string, kind string, side string, sulcus string"
_CURRENT = "_current.json"


def _current(path: str) -> list[dict]:
    store, root = open_folder(path)
    if store.get_file_info(f"{root}/{_CURRENT}").type == fs.FileType.NotFound:
        return []
    with store.open_input_stream(f"{root}/{_CURRENT}") as f:
        return json.loads(f.read())


def _stored(spark: SparkSession, path: str, kind: str, current: list[dict]) -> DataFrame:
    """Rows of the versions that are valid; only their folders are read."""
    rows = spark.read.schema(_ROWS).option("basePath", path)
    where = [f"{path}/{c['folders'][kind]}" for c in current if kind in c["folders"]]
    return rows.parquet(*where) if where else spark.createDataFrame([], _ROWS)


def read_mask(spark: SparkSession, path: str) -> DataFrame:
    """(side, sulcus, x, y, z, n) of the stored masks."""
    return _stored(spark, path, "voxels", _current(path)).select(*CLASS, "x", "y", "z", "n")


def add_subjects(spark: SparkSession, path: str, voxels: DataFrame, dims: tuple[int, int, int]) -> int:
    """Adds the voxels (subject_id, side, sulcus, x, y, z) of subjects that a class's mask doesn't count yet, and writes anew the classes touched: how many.

    Masks and the subjects they count are written under a new version first; one small file, replaced as a whole, then says which version of each class is valid. A run that
    fails before that has changed nothing, and one that is repeated finds its subjects counted. One writer at a time; versions that nothing refers to are deleted.
    """
    current = _current(path)
    seen = _stored(spark, path, "subjects", current).select(*CLASS, "subject_id")
    # shuffled once and kept on the executors' disks, as classes, masks and subjects all come from it
    once = dealt(voxels.select("subject_id", *CLASS, "x", "y", "z"), "subject_id", *CLASS).dropDuplicates()
    fresh = once.join(seen.hint("shuffle_hash"), [*CLASS, "subject_id"], "left_anti").persist(StorageLevel.DISK_ONLY)
    try:
        return _add(spark, path, fresh, dims, current)
    finally:
        fresh.unpersist()


def _add(spark: SparkSession, path: str, fresh: DataFrame, dims: tuple[int, int, int], current: list[dict]) -> int:
    """Adds voxels that are there once and not counted yet."""
    touched = {(r.side, r.sulcus) for r in fresh.select(*CLASS).distinct().collect()}  # as many as there are classes
    if not touched:
        return 0
    old = [c for c in current if (c["side"], c["sulcus"]) in touched]
    new = fresh.where(inside(dims)).groupBy(*CLASS, "x", "y", "z").agg(F.count("*").cast("int").alias("n"))
    masks = _stored(spark, path, "voxels", old).select(*CLASS, "x", "y", "z", "n").unionByName(new)
    masks = masks.groupBy(*CLASS, "x", "y", "z").agg(F.sum("n").cast("int").alias("n")).withColumn("kind", F.lit("voxels"))
    subjects = _stored(spark, path, "subjects", old).select(*CLASS, "subject_id").unionByName(fresh.select(*CLASS, "subject_id").distinct()).withColumn("kind", F.lit("subjects"))
    version = uuid.uuid4().hex
    masks.unionByName(subjects, allowMissingColumns=True).repartition("kind", *CLASS).write.partitionBy("kind", *CLASS).parquet(f"{path}/version={version}")
    store, root = open_folder(path)
    folders: dict[tuple, dict] = {}
    for f in store.get_file_info(fs.FileSelector(f"{root}/version={version}", recursive=True)):
        if f.base_name.startswith("sulcus="):
            *_, kind, of, sulcus = (unquote(p.partition("=")[2]) for p in f.path.split("/"))
            folders.setdefault((of, sulcus), {})[kind] = f.path[len(root) + 1 :]
    valid = [c for c in current if c not in old] + [{"side": s, "sulcus": u, "version": version, "folders": own} for (s, u), own in folders.items()]
    with store.open_output_stream(draft := f"{root}/{_CURRENT}.{version}") as f:
        f.write(json.dumps(valid).encode())
    store.move(draft, f"{root}/{_CURRENT}")
    kept = {f"version={c['version']}" for c in valid}
    for f in store.get_file_info(fs.FileSelector(root)):
        if f.base_name.startswith("version=") and f.base_name not in kept:
            store.delete_dir(f.path)
    return len(touched)
