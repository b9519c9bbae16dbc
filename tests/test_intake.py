"""Intake and stored masks that fail on the way, or are repeated, and count everything once."""

import os

import pytest

from voxlake.operators import embeddings, voxels
from voxlake.sources import masks
from voxlake.streaming import intake

SCHEMA = "region string, hemi string, subject_id string, vec array<float>"
MODEL = [("1", "left", [0.0, 0.0], [[1.0, 0.0], [0.0, 1.0]]), ("b", "left", [1.0, 1.0], [[1.0, 0.0], [0.0, 1.0]])]


def model(spark):
    return spark.createDataFrame(MODEL, "region string, hemi string, mean array<double>, axes array<array<double>>")


def arrive(spark, path, rows):
    spark.createDataFrame([(r, "left", s, [float(len(s)), 2.0]) for r, s in rows], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def taken(spark, sink):
    return sorted((r.region, r.subject_id) for r in intake.read_intake(spark, sink).collect())


def test_a_batch_that_fails_after_its_write(spark, tmp_path, monkeypatch):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    run = lambda: intake.project_new_files(spark, SCHEMA, source, model(spark), sink, checkpoint)
    arrive(spark, source, [("1", "s1"), ("1", "s2"), ("b", "s1"), ("1", "s1")])
    run()
    assert taken(spark, sink) == [("1", "s1"), ("1", "s2"), ("b", "s1")]
    arrive(spark, source, [("1", "s2"), ("1", "s3"), ("b", "s4")])
    whole = intake.write_batch

    def failing(rows, sink, batch):
        whole(rows, sink, batch)
        raise OSError("the driver is lost")

    monkeypatch.setattr(intake, "write_batch", failing)
    with pytest.raises(Exception, match="the driver is lost"):
        run()
    assert len(taken(spark, sink)) == 5  # written, but not counted as done
    monkeypatch.undo()
    arrive(spark, source, [("1", "s3"), ("1", "s5")])
    run()
    assert taken(spark, sink) == [("1", "s1"), ("1", "s2"), ("1", "s3"), ("1", "s5"), ("b", "s1"), ("b", "s4")]
    run()
    assert len(taken(spark, sink)) == 6


def test_batches_do_not_read_the_sink(spark, tmp_path, monkeypatch):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    plans, whole = [], intake.write_batch
    monkeypatch.setattr(intake, "write_batch", lambda rows, sink, i: (plans.append(rows._jdf.queryExecution().executedPlan().toString()), whole(rows, sink, i)))
    for k in range(3):
        arrive(spark, source, [("1", f"s{k}"), ("1", "s0")])
        intake.project_new_files(spark, SCHEMA, source, model(spark), sink, str(tmp_path / "checkpoint"))
    assert len(plans) >= 3 and not any("out/batch" in p or f"{sink}]" in p for p in plans) and len(taken(spark, sink)) == 3


def table(spark, rows):
    return spark.createDataFrame(rows, "subject_id string, side string, sulcus string, x int, y int, z int")


def stored(spark, path):
    return sorted(map(tuple, masks.read_mask(spark, path).collect()))


def test_stored_masks(spark, tmp_path, monkeypatch):
    path, dims = str(tmp_path / "masks"), (4, 4, 4)
    rows = [(f"s{i}", "LR"[i % 2], f"S: {k}%", i % 4, k, 0) for i in range(12) for k in range(3)] + [("s1", "L", "out", 9, 9, 9), ("s0", "L", "S: 0%", 0, 0, 0)]
    whole = sorted(map(tuple, voxels.count_mask(table(spark, rows), dims).select("side", "sulcus", "x", "y", "z", "n").collect()))
    assert masks.add_subjects(spark, path, table(spark, [r for r in rows if r[0] in ("s0", "s2")]), dims) == 3
    before = masks._current(path)

    class Lost(Exception):
        pass

    def fail(path):
        store, root = open_folder(path)

        class Store:
            def __getattr__(self, name):
                if name == "move":
                    raise Lost
                return getattr(store, name)

        return Store(), root

    open_folder = masks.open_folder
    monkeypatch.setattr(masks, "open_folder", fail)
    with pytest.raises(Lost):
        masks.add_subjects(spark, path, table(spark, rows), dims)
    monkeypatch.undo()
    assert masks._current(path) == before
    assert masks.add_subjects(spark, path, table(spark, [r for r in rows if r[1] == "L" and r[2] == "S: 1%"]), dims) == 1
    touched = {c["version"] for c in masks._current(path)} - {c["version"] for c in before}
    assert len(touched) == 1 and sum(c in before for c in masks._current(path)) == 2  # the others keep their version
    masks.add_subjects(spark, path, table(spark, rows), dims)
    assert stored(spark, path) == whole
    assert masks.add_subjects(spark, path, table(spark, rows), dims) == 0 and stored(spark, path) == whole
    assert {f for f in os.listdir(path) if f.startswith("version=")} == {f"version={c['version']}" for c in masks._current(path)}


def test_chosen_reaches_the_folders(spark, tmp_path):
    spark.createDataFrame([(f"{r}{s}", r, s) for r in "abc" for s in "LR"], "path string, region string, side string").write.partitionBy("region", "side").parquet(str(tmp_path / "t"))
    rows = embeddings.chosen(spark.read.parquet(str(tmp_path / "t")), region=["a", "c"], side=["R"])
    assert {r.path for r in rows.collect()} == {"aR", "cR"} and embeddings.chosen(rows, side=None).count() == 2
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "region" in plan.split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(ValueError, match="no rows with region z"):
        embeddings.chosen(rows, region=["a", "z"])
