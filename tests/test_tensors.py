"""Tensors read by ranges and written in parts, and erasure that is carried out."""

import json
import os

import numpy as np
import pytest

from voxlake.sources import erasure, tensors
from voxlake.sources.tensors import ROW, clean, erase_subjects, open_folder, parts, read_tensors, write_tensors


def save(folder, name, array, subjects=None):
    folder.mkdir(parents=True, exist_ok=True)
    np.save(folder / f"{name}.npy", array)
    if subjects is not None:
        (folder / f"{name}_subject.csv").write_text("\n".join(["participant_id", *subjects]) + "\n")


class Counted:
    """A file store that counts the bytes read of arrays."""

    def __init__(self, store):
        self.store, self.n = store, 0

    def open_input_file(self, path):
        outer, f = self, self.store.open_input_file(path)

        class File:
            def seek(self, at):
                f.seek(at)

            def read(self, n):
                outer.n += n
                return f.read(n)

            def close(self):
                f.close()

        return File()

    def __getattr__(self, name):
        return getattr(self.store, name)


def test_a_task_reads_its_range_only(tmp_path, monkeypatch):
    array = np.arange(1000 * 24, dtype=np.float64).reshape(1000, 2, 3, 4)
    save(tmp_path, "t", array, [f"s{i}" for i in range(1000)])
    reader = tensors.ArrayReader({"path": str(tmp_path), "partitionbytes": str(100 * 24 * 8)})
    ranges = reader.partitions()
    assert [(p.lo, p.hi) for p in ranges] == [(lo, lo + 100) for lo in range(0, 1000, 100)]
    store, root = open_folder(str(tmp_path))
    for slab in (tensors.SLAB_BYTES, 7 * 24 * 8):
        monkeypatch.setattr(tensors, "SLAB_BYTES", slab)
        for p in ranges:
            counted = Counted(store)
            monkeypatch.setattr(tensors, "open_folder", lambda path, c=counted: (c, root))
            rows = [r for b in reader.read(p) for r in b.to_pylist()]
            assert counted.n == 100 * 24 * 8
            assert [r["row_idx"] for r in rows] == list(range(p.lo, p.hi)) and [r["subject_id"] for r in rows] == [f"s{i}" for i in range(p.lo, p.hi)]
            assert np.array_equal([r["values"] for r in rows], array[p.lo : p.hi].reshape(100, 24))


def test_plain_files(spark, tmp_path):
    save(tmp_path / "R1" / "mask", "Lskeleton", np.arange(24, dtype=np.int16).reshape(4, 1, 2, 3), ["1", "02", '"x,y"', "4"])
    save(tmp_path / "R2", "Rlabel", np.zeros((0, 2, 2), np.float32), [])
    save(tmp_path / "R3", "none", np.ones(3, np.float32))
    got = sorted((r.tensor, r.row_idx, r.subject_id, list(r["shape"]), list(r["values"])) for r in read_tensors(spark, str(tmp_path), partition_bytes=24).collect())
    assert got == [("R1/mask/Lskeleton", i, s, [1, 2, 3], list(range(6 * i, 6 * i + 6))) for i, s in enumerate(["1", "02", "x,y", "4"])] + [("R3/none", i, None, [], [1.0]) for i in range(3)]
    ids = read_tensors(spark, f"file://{tmp_path}", ids_only=True).collect()
    assert len(ids) == 7 and all(r["values"] is None for r in ids)


@pytest.mark.parametrize("names", [["a", "b"], ["a", "b", "c", "d"]])
def test_an_index_of_another_length_is_an_error(spark, tmp_path, names):
    save(tmp_path, "t", np.zeros((3, 2)), names)
    with pytest.raises(Exception, match=f"3 rows, its index {len(names)}"):
        read_tensors(spark, str(tmp_path), partition_bytes=16).collect()


@pytest.mark.parametrize("array", [np.asfortranarray(np.ones((3, 4))), np.array(3.0)])
def test_arrays_without_rows_one_after_the_other_are_refused(spark, tmp_path, array):
    save(tmp_path, "t", array)
    with pytest.raises(Exception, match="rows one after the other"):
        read_tensors(spark, str(tmp_path)).collect()


def stored(spark, path):
    return sorted((r.tensor, r.row_idx, r.subject_id, list(r["values"])) for r in read_tensors(spark, path).collect())


def numbered(rows):
    out, at = [], {}
    for t, _, s, v in sorted(rows):
        out.append((t, at.get(t, 0), s, v))
        at[t] = at.get(t, 0) + 1
    return out


def files(path):
    return {p["file"] for p in parts(*open_folder(path))}


def test_erasure_in_many_steps(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [(f"R{t}/L/v", i, f"s{i * (t + 1) % 40}", [2, 3], [float(100 * t + i)] * 6) for t in range(2) for i in range(40)]
    write_tensors(spark.createDataFrame(rows, ROW).repartition(3), path, file_bytes=5 * 24)
    want = numbered([(t, i, s, v) for t, i, s, _, v in rows])
    assert stored(spark, path) == want and len(files(path)) >= 16
    for gone in (["s0", "s1", "s2", "s3", "s4", "s5"], ["s30"], [f"s{i}" for i in range(6, 20)], ["s39", "s22", "nobody"]):
        own, before = spark.createDataFrame([(s,) for s in gone], "subject_id string"), files(path)
        planned = erase_subjects(spark, path, own, dry_run=True, file_bytes=5 * 24).collect()
        assert files(path) == before and stored(spark, path) == want
        done = erase_subjects(spark, path, own, file_bytes=5 * 24).collect()
        assert sorted(done) == sorted(planned) and sum(r.n_removed for r in done) == sum(s in gone for _, _, s, _ in want)
        want = numbered([w for w in want if w[2] not in gone])
        assert stored(spark, path) == want
        assert before - files(path) == {r.file for r in done}  # parts that held none keep their names
        after = files(path)
        assert erase_subjects(spark, path, own).count() == 0 and files(path) == after
        found = {os.path.relpath(os.path.join(a, f), path) for a, _, c in os.walk(path) for f in c if f.endswith(".npy")}
        assert found == after  # nothing of the erased rows is left on disk
    more = [("R0/L/v", i, f"new{i}", [2, 3], [0.5] * 6) for i in range(3)]
    write_tensors(spark.createDataFrame(more, ROW), path, "append")
    n = sum(w[0] == "R0/L/v" for w in want)
    assert stored(spark, path) == sorted(want + [(t, n + i, s, v) for t, i, s, _, v in more])


def test_an_erasure_that_failed_is_made_good(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    rows = [("R/L/v", i, f"s{i}", [2], [float(i)] * 2) for i in range(12)]
    write_tensors(spark.createDataFrame(rows, ROW), path, file_bytes=32)
    own = spark.createDataFrame([("s3",), ("s7",)], "subject_id string")
    save(tmp_path / "store" / "R" / "L", "v-stray", np.zeros((2, 2), np.float32), ["s3", "s7"])  # written, not published
    (tmp_path / "store" / "_manifest" / "00000002.json.draft").write_text("[")
    assert len(stored(spark, path)) == 12
    monkeypatch.setattr(tensors, "clean", lambda path: None)  # published, not cleaned
    assert erase_subjects(spark, path, own, file_bytes=32).count() == 2
    monkeypatch.undo()
    assert erase_subjects(spark, path, own).count() == 0
    left = {f for a, _, c in os.walk(path) for f in c}
    assert not any("stray" in f or "draft" in f for f in left) and sum(f.endswith(".npy") for f in left) == len(files(path))
    assert [r[2] for r in stored(spark, path)] == [f"s{i}" for i in range(12) if i not in (3, 7)]
    assert clean(path) == 0


def test_one_writer_at_a_time(spark, tmp_path):
    path = str(tmp_path / "store")
    write_tensors(spark.createDataFrame([("t", 0, "a", [1], [1.0])], ROW), path)
    store, root = open_folder(path)
    old = tensors.versions
    tensors.versions = lambda *a: [0]
    try:
        with pytest.raises(RuntimeError, match="another writer"):
            tensors.publish(store, root, [], [], True)
    finally:
        tensors.versions = old
    with pytest.raises(ValueError, match="no manifest"):
        erase_subjects(spark, str(tmp_path), spark.createDataFrame([("a",)], "subject_id string"))
    assert json.loads((tmp_path / "store" / "_manifest" / "00000001.json").read_text())[0]["n"] == 1


def tree(root, names):
    for n in names:
        (root / n).parent.mkdir(parents=True, exist_ok=True)
        (root / n).touch()
    return str(root)


def left(root):
    return {os.path.relpath(os.path.join(a, f), root) for a, _, c in os.walk(root) for f in c}


def test_purge_takes_files_folders_and_rows(spark, tmp_path):
    names = ["crops/2mm/R/mask/Lcrops/sub-1.nii.gz", "crops/2mm/R/mask/Lcrops/sub-1_x.nii.gz.minf", "skeletons/sub-1/a/b.nii", "transforms/sub-10/c.trm", "crops/2mm/R/mask/Lcrops/sub-10.nii.gz", "sub-1.d/e.csv"]
    root = tree(tmp_path / "d", names)
    write_tensors(spark.createDataFrame([("R/v", i, f"sub-{i}", [1], [1.0]) for i in range(12)], ROW), f"{root}/tensors", file_bytes=12)
    everything = left(root)
    assert erasure.purge_subject(spark, root, "sub-1", f"{root}/tensors", dry_run=True) == {"files": 3, "rows": 1} and left(root) == everything
    assert erasure.purge_subject(spark, root, "sub-1", f"{root}/tensors") == {"files": 3, "rows": 1}
    assert {f for f in left(root) if not f.startswith("tensors")} == set(names[3:])
    assert "sub-1" not in {r.subject_id for r in read_tensors(spark, f"{root}/tensors").collect()}
    assert erasure.purge_subject(spark, root, "sub-1", f"{root}/tensors") == {"files": 0, "rows": 0}


def test_prune_by_both_rules(spark, tmp_path):
    names = ["a/sub-1.nii.gz", "a/sub-10.nii", "b/L_sub-1_skel.nii.gz.minf", "b/sub-2_x.csv", "c/sub-3.json", "c/other.txt"]
    subjects = spark.createDataFrame([(f"sub-{i}",) for i in (1, 2, 3, 10)], "subject_id string")
    qc = spark.createDataFrame([("sub-1", 0), ("sub-2", None), ("sub-10", 1)], "participant_id string, qc int")
    root = tree(tmp_path / "e", names)
    assert erasure.prune_failed(spark, root, subjects, qc, "exact", dry_run=True) == 2
    assert erasure.prune_failed(spark, root, subjects, qc, dry_run=True) == 4 and left(root) == set(names)
    assert erasure.prune_failed(spark, root, subjects, qc, "exact") == 2 and left(root) == set(names) - {"a/sub-1.nii.gz", "c/sub-3.json"}
    assert erasure.prune_failed(spark, root, subjects, qc) == 2 and left(root) == {"b/sub-2_x.csv", "c/other.txt"}
    assert erasure.prune_failed(spark, root, subjects, qc) == 0


def test_contains_has_no_nested_loop(spark):
    from voxlake.operators import qc

    files = spark.createDataFrame([("/r/sub-1.nii",), ("/r/x.nii",)], "path string")
    own = spark.createDataFrame([("b-1",), ("",), ("x",), ("xyz" * 40,), (None,)], "subject_id string")
    found = qc.files_of(files, own, "contains")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert {r[0] for r in found.collect()} == {"/r/sub-1.nii", "/r/x.nii"}
    assert qc.files_of(files, own.limit(0), "contains").count() == 0
