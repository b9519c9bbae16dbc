"""What tasks and shuffles carry must not grow faster than the tables."""

import pytest

from voxlake.operators import voxels
from voxlake.sources import erasure, masks

VOXELS = "region string, side string, subject_id string, x int, y int, z int, value int"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def counted(spark, df):
    """The rows, and how often one of them was made."""
    made = spark.sparkContext.accumulator(0)
    return spark.createDataFrame(df.rdd.map(lambda r: (made.add(1), r)[1]), df.schema), made


def test_boxes_go_to_the_voxels(spark):
    own = spark.createDataFrame([("R", "L", "a", x, 2, 70 + x, 1) for x in range(6)], VOXELS)
    mask = spark.createDataFrame([("R", "L", x, 2, 70 + x) for x in (1, 2, 4)], "region string, side string, x int, y int, z int")
    out = voxels.crop(own, voxels.bounding_box(mask))
    assert sorted((r.x, r.y, r.z, r.size_x) for r in out.collect()) == [(0, 0, 0, 4), (1, 0, 1, 4), (2, 0, 2, 4), (3, 0, 3, 4)]
    assert "SortMergeJoin" not in plan(out)


def test_masks_go_to_the_voxels(spark):
    spots = [(0, 0, -1), (0, 0, 63), (0, 0, 64), (1, 0, 64), (-1, 3, 5)]
    own = spark.createDataFrame([(r, "L", s, *p, 1) for r in "RQ" for s in "ab" for p in spots], VOXELS)
    mask = spark.createDataFrame([("R", "L", *p) for p in (*spots[:2], spots[4], (7, 7, 7))] * 2, "region string, side string, x int, y int, z int")
    out = voxels.mask_apply(own, mask)
    assert sorted(map(tuple, out.collect())) == sorted(("R", "L", s, *p, 1) for s in "ab" for p in (*spots[:2], spots[4]))
    assert "SortMergeJoin" not in plan(out)


def test_subjects_are_numbered_without_their_voxels(spark):
    own = spark.createDataFrame([(r, "L", s, x, 0, 0, 1) for r, of in (("R", "ac"), ("Q", "abc")) for s in (*of, None) for x in range(2)], VOXELS)
    box = spark.createDataFrame([(r, "L", 0, 1, 0, 0, 0, 0, 2, 1, 1) for r in "RQ"], "region string, side string, min_x int, max_x int, min_y int, max_y int, min_z int, max_z int, size_x int, size_y int, size_z int")
    out = voxels.crop_tensor(voxels.crop(own, box))
    want = [("Q", None, 0), ("Q", "a", 1), ("Q", "b", 2), ("Q", "c", 3), ("R", None, 0), ("R", "a", 1), ("R", "c", 2)]
    assert sorted(((r.region, r.subject_id, r.row_idx) for r in out.collect()), key=str) == sorted(want, key=str) and all(list(r["values"]) == [1, 1] for r in out.collect())
    text = plan(out)
    assert not any("at#" in line for line in text.splitlines() if "Window " in line or "Sort [region" in line) and "ShuffledHashJoin" in text


def test_a_task_transforms_a_bounded_number_of_voxels(spark, monkeypatch):
    monkeypatch.setattr(voxels, "TASK_ROWS", 10)
    own = spark.createDataFrame([(f"s{i}", "L", "S", i, 0, 0) for i in range(200)], "subject_id string, side string, sulcus string, i int, j int, k int")
    space = own.selectExpr("subject_id", "side", "array(1d, 1d, 1d) as voxel_size", "array(1d, 0d, 0d, 0d, 0d, 1d, 0d, 0d, 0d, 0d, 1d, 0d) as affine")
    out = voxels.to_template(own, space, 1.0)
    assert sorted(r.x for r in out.collect()) == list(range(200)) and out.rdd.getNumPartitions() >= 20


def test_stored_masks_take_the_voxels_once(spark, tmp_path):
    rows, made = counted(spark, spark.createDataFrame([(f"s{i % 7}", "L", f"S{i % 3}", i % 5, 0, 0) for i in range(50)], "subject_id string, side string, sulcus string, x int, y int, z int"))
    assert masks.add_subjects(spark, str(tmp_path), rows, (5, 1, 1)) == 3
    assert made.value <= 100  # counted, and shuffled


@pytest.mark.parametrize("prune", [True, False])
def test_a_folder_is_listed_once(spark, monkeypatch, prune):
    listed, made = counted(spark, spark.createDataFrame([(f"/d/sub-{i}/sub-{i}.nii", 0) for i in range(20)], "path string, length long"))
    monkeypatch.setattr(erasure, "list_files", lambda spark, folder: listed)
    subjects, qc = spark.createDataFrame([("sub-3",)], "subject_id string"), spark.createDataFrame([], "participant_id string, qc int")
    found = erasure.prune_failed(spark, "/d", subjects, qc, dry_run=True) if prune else erasure.purge_subject(spark, "/d", "sub-3", dry_run=True)["files"]
    assert found == 1 and made.value == 20


def test_deleting_is_dealt_out(spark):
    few = spark.range(50).selectExpr("concat('/d/', id) as path").coalesce(1)
    assert erasure.spread(few).rdd.getNumPartitions() > 4
