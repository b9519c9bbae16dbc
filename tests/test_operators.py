"""Operators on small tables made by hand, and their properties."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voxlake.functions import names
from voxlake.operators import campaign, catalog, embeddings, masks, probe, projection, qc, voxels

SLOW = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def one(spark, column, **values):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())).select(column.alias("c")).first()["c"]


@pytest.mark.parametrize(
    ("name", "region", "hemi"),
    [
        ("FColl-SRh_left_name01_embeddings.csv", "FColl-SRh", "left"),
        ("_S.T.s.--right--name05_embeddings.csv", "S.T.s.", "right"),
        ("_A--B--left--m_embeddings.csv", "A_B", "left"),
        ("R_both_m_embeddings.csv", None, None),
        ("R_left_m.csv", None, None),
    ],
)
def test_embedding_names(spark, name, region, hemi):
    assert one(spark, names.embedding_region(F.col("n")), n=name) == region
    assert one(spark, names.embedding_hemi(F.col("n")), n=name) == hemi


def test_graph_hemi_quirks(spark):
    assert [one(spark, names.graph_hemi(F.col("n")), n=n) for n in ("Lx.arg", "Rx.arg", "L_rest.arg", "Left_right.arg")] == ["left", "right", "right", "right"]


def test_paths(spark):
    assert one(spark, names.nth_parent(F.col("p"), F.lit(1)), p="/a/b/c/d/e") == "/a/b/c/d"
    assert one(spark, names.nth_parent(F.col("p"), F.lit(9)), p="/a/b/c") == "/a/"
    assert one(spark, names.parent_of(F.col("p"), "derivatives"), p="/d/x/derivatives/y") == "/d/x"
    assert one(spark, names.parent_of(F.col("p"), "none"), p="/d/x") is None
    assert one(spark, names.rewrite_derivatives(F.col("p"), F.lit("new")), p="a: /x/derivatives/old/crops/v/2mm/R") == "a: /x/derivatives/new/crops/v/2mm/R"


def test_qc_nulls_pass_and_absent_fail(spark):
    q = spark.createDataFrame([("a", 1), ("b", 0), ("c", None), ("d", 0), ("d", 1)], "participant_id string, qc int")
    s = spark.createDataFrame([(x,) for x in "abcde"], "subject_id string")
    assert {r[0] for r in qc.to_remove(s, q).collect()} == {"b", "e"}
    assert {r[0] for r in qc.passing(q).collect()} == {"a", "c", "d"}
    assert {r[0] for r in qc.qc_filter(s, q).collect()} == {"a", "c", "e"}


def test_files_of_subject(spark):
    paths = ["/r/sub-1.nii.gz", "/r/sub-10.nii.gz", "/r/sub-1_x.nii.gz.minf", "/r/sub-1.nii.gz.minf", "/r/other.nii"]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    own = spark.createDataFrame([("sub-1",)], "subject_id string")
    assert {r[0] for r in qc.files_of(files, own).collect()} == {paths[0], paths[2], paths[3]}
    assert {r[0] for r in qc.files_of(files, own, "contains").collect()} == set(paths[:4])


def test_erase_rows_keeps_the_order(spark):
    t = spark.createDataFrame([("r", "L", "k", i, f"s{i % 3}") for i in range(6)], "region string, side string, input_type string, row_idx int, subject_id string")
    assert [(r.row_idx, r.subject_id) for r in qc.erase_rows(t, "s1").orderBy("row_idx").collect()] == [(0, "s0"), (1, "s2"), (2, "s0"), (3, "s2")]


def test_count_mask_counts_a_subject_once(spark):
    v = spark.createDataFrame([("a", "L", "S", 1, 1, 1), ("a", "L", "S", 1, 1, 1), ("b", "L", "S", 1, 1, 1), ("b", "L", "S", 9, 0, 0)], "subject_id string, side string, sulcus string, x int, y int, z int")
    assert [tuple(r) for r in voxels.count_mask(v, (4, 4, 4)).collect()] == [("L", "S", 1, 1, 1, 2)]


def test_transform_rounds_half_to_even(spark):
    v = spark.createDataFrame([("a", "L", "S", 1, 3, 5)], "subject_id string, side string, sulcus string, i int, j int, k int")
    space = spark.createDataFrame([("a", "L", [1.0, 1.0, 1.0], [1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0])], "subject_id string, side string, voxel_size array<double>, affine array<double>")
    assert tuple(voxels.to_template(v, space, 2.0).first())[3:] == (0, 2, 2)


def mask(spark, a, b):
    rows = [(s, "L", "S", x, y, z, 1) for s, cells in (("A", a), ("B", b)) for x, y, z in cells]
    return spark.createDataFrame(rows, "mask_set string, side string, sulcus string, x int, y int, z int, n int")


@SLOW
@given(st.sets(st.tuples(*[st.integers(0, 6)] * 3), min_size=1, max_size=8), st.tuples(*[st.integers(0, 4)] * 3))
def test_distance_of_a_shift(spark, cells, by):
    moved = {tuple(int(c + d) for c, d in zip(cell, by, strict=True)) for cell in cells}
    there = masks.mask_distance(mask(spark, cells, moved), "A", "B").first()["distance"]
    back = masks.mask_distance(mask(spark, moved, cells), "A", "B").first()["distance"]
    assert there == back == pytest.approx(np.linalg.norm(by), abs=1e-5)


def test_distance_with_an_empty_side(spark):
    m = mask(spark, [(1, 1, 1)], [])
    assert {(r.w, r.empty_side) for r in masks.wasserstein_axis(m, "A", "B").collect()} == {(0.0, True)}
    assert [(r.distance, r.empty_side) for r in masks.mask_distance(m, "A", "B").collect()] == [(0.0, True)]


def test_campaign_ratio(spark):
    c = spark.createDataFrame([("A", "s", "one", 4), ("A", "t", "both", 2), ("B", "s", "both", 3), ("B", "u", "two", 5)], "campaign string, subject_id string, sulcus string, n long")
    got = {r.sulcus: r for r in campaign.campaign_compare(c).collect()}
    assert (got["one"].ratio, got["one"].n_b, got["one"].mean_b) == (0.0, 0, 0.0)
    assert got["two"].ratio is None and got["both"].ratio == 1.5 and got["both"].pct_a == 50.0
    assert tuple(campaign.campaign_subjects(c).first()) == (1, 1, 1)


def test_cka(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 5))
    turn, _ = np.linalg.qr(rng.normal(size=(5, 5)))
    y = rng.normal(size=(40, 3))
    rows = [(k, a.tolist(), b.tolist()) for k, other in (("same", x), ("scaled", 3 * x), ("turned", x @ turn), ("other", y)) for a, b in zip(x, other, strict=True)]
    got = {r.k: r.cka for r in embeddings.cka(spark.createDataFrame(rows, "k string, x array<double>, y array<double>"), ["k"]).collect()}
    cx, cy = x - x.mean(0), y - y.mean(0)
    want = np.linalg.norm(cx.T @ cy) ** 2 / np.linalg.norm(cx.T @ cx) / np.linalg.norm(cy.T @ cy)
    assert got == {"same": 1.0, "scaled": 1.0, "turned": 1.0, "other": pytest.approx(want, abs=1e-6)}


def test_projection_equals_svd(spark):
    x = np.random.default_rng(2).normal(size=(60, 4)) * [5, 3, 1, 0.5]
    rows = spark.createDataFrame([("r", "left", str(i), v.tolist()) for i, v in enumerate(x)], "region string, hemi string, subject_id string, vec array<double>")
    model = projection.project_fit(rows)
    got = np.array([(r.u, r.v) for r in projection.project(rows, model).orderBy(F.col("subject_id").cast("int")).collect()])
    c = x - x.mean(0)
    axes = np.linalg.svd(c)[2][:2]
    axes = axes * np.sign(axes[np.arange(2), np.abs(axes).argmax(1)])[:, None]
    assert np.allclose(got, c @ axes.T, atol=1e-8)


def test_folds_are_even(spark):
    rows = spark.createDataFrame([(str(i), "l", int(i % 2)) for i in range(50)], "subject_id string, label_name string, label int")
    assert {r["count"] for r in probe.cv_folds(rows).groupBy("label", "fold").count().collect()} == {5}


def test_auc_with_ties(spark):
    rows = spark.createDataFrame([("r", "h", s, y) for s, y in [(0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1)]], "region string, hemi string, score double, label int")
    assert probe.auc(rows).first()["auc"] == 0.875


def test_eligibility_and_grid(spark):
    s = spark.createDataFrame([("a",), ("b",)], "subject_id string")
    f = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "subject_id string, kind string")
    assert {tuple(r) for r in catalog.eligibility(s, f, ("x", "y")).collect()} == {("a", True, ""), ("b", False, "y")}
    grid = catalog.work_grid(spark.createDataFrame([("OCCIPITAL",), ("CINGULATE.",)], "region string"))
    assert grid.count() == 12 and {r.region for r in grid.where("threshold = 1").collect()} == {"OCCIPITAL"}


@SLOW
@given(st.dictionaries(st.sampled_from("abcdef"), st.text("xyz", max_size=3), max_size=5), st.dictionaries(st.sampled_from("abcdef"), st.text("xyz", max_size=3), max_size=5))
def test_config_merge(spark, base, patch):
    df = spark.createDataFrame([(base, patch)], "base map<string,string>, patch map<string,string>")
    assert df.select(names.merged_config(F.col("base"), F.col("patch")).alias("c")).first()["c"] == base | patch


def test_sources(spark, tmp_path):
    from voxlake.sources import tables

    (tmp_path / "q.tsv").write_text("participant_id\tqc\tcomments\n007\t1\tok\n8\t\t\n")
    assert {(r.participant_id, r.qc) for r in tables.read_qc(spark, str(tmp_path / "q.tsv")).collect()} == {("007", 1), ("8", None)}
    (tmp_path / "n.json").write_text('{"brain": {"R1_left": {"S.C._left": ["S.C._left"]}, "R1_right": {"S.C._right": ["S.C._right"]}}}')
    assert {tuple(r) for r in tables.read_nomenclature(spark, str(tmp_path / "n.json")).collect()} == {("R1", "L", "S.C."), ("R1", "R", "S.C.")}
    (tmp_path / "t").mkdir()
    np.save(tmp_path / "t" / "a.npy", np.arange(12, dtype=np.float32).reshape(2, 1, 2, 3))
    got = tables.read_arrays(spark, str(tmp_path / "t")).orderBy("row_idx").collect()
    assert [r["shape"] for r in got] == [[1, 2, 3]] * 2 and got[1]["values"] == list(range(6, 12))
    assert tables.list_files(spark, str(tmp_path / "t")).count() == 1


def test_sinks_and_small_rules(spark, tmp_path):
    from voxlake.sources import tables

    m = spark.createDataFrame([("s1", "L", "S", 1, 1, 1, 1)], "subject_id string, side string, sulcus string, x int, y int, z int, n int")
    assert not tables.write_subject_masks(m, str(tmp_path / "p"), public_use=True) and not (tmp_path / "p").exists()
    assert tables.write_subject_masks(m, str(tmp_path / "q"), public_use=False) and spark.read.parquet(str(tmp_path / "q")).count() == 1
    assert one(spark, names.relative_path(F.col("p"), F.lit("/a/b")), p="/a/b/c/d") == "c/d"
    assert one(spark, names.relative_path(F.col("p"), F.lit("/a/b/")), p="/a/x") == "../x"
    assert one(spark, names.relative_path(F.col("p"), F.lit("/a/b")), p="/a/b") == "."
    assert one(spark, names.bare_sulcus(F.col("n"), F.lit("L")), n="S.C._left") == "S.C." and one(spark, names.voxel_folder(F.col("v")), v=2.0) == "2mm"
    rows = spark.createDataFrame([("R1",), ("R17",)], "region string")
    assert embeddings.of_regions(rows, ["R1"]).count() == 1 and embeddings.of_regions(rows, ["R1"], contains=True).count() == 2
    with pytest.raises(ValueError):
        embeddings.of_regions(rows, ["none"])
    report = {r.table: r for r in qc.erase_report({"a": spark.createDataFrame([("x",), ("y",), (None,)], "subject_id string")}, "x").collect()}
    assert (report["a"].n_removed, report["a"].n_kept, report["a"].found) == (1, 2, True)
    lists = spark.createDataFrame([("x", "train")], "subject_id string, subset string")
    assert {tuple(r) for r in probe.custom_split(spark.createDataFrame([("x",), ("y",)], "subject_id string"), lists).collect()} == {("x", "train"), ("y", None)}


def test_count_mask_of_named_sulci(spark):
    v = spark.createDataFrame([("a", "L", "S", 1, 1, 1), ("a", "L", "T", 1, 1, 1), ("a", "L", None, 1, 1, 1)], "subject_id string, side string, sulcus string, x int, y int, z int")
    wanted = spark.createDataFrame([("S",)], "sulcus string")
    assert [r.sulcus for r in voxels.count_mask(v, (4, 4, 4), wanted).collect()] == ["S"]
    named = v.withColumn("campaign", F.lit("A"))
    assert {r.sulcus for r in voxels.sulcus_voxels(named).collect()} == {"S", "T"}


def test_no_paths_to_check_is_an_error(spark):
    paths = spark.createDataFrame([("/a",), ("/b",)], "path string")
    assert {r.path: r.found for r in catalog.paths_found(paths, paths.where("path = '/a'")).collect()} == {"/a": True, "/b": False}
    with pytest.raises(ValueError, match="no paths"):
        catalog.paths_found(paths.limit(0), paths)


def test_best_epoch_of_equals_is_the_earlier(spark):
    models = spark.createDataFrame([("d", 1, 0.5), ("d", 2, 0.7), ("d", 3, 0.7), ("e", 9, 0.1)], "dataset string, epoch int, score double")
    assert {r.dataset: r.epoch for r in probe.best_epoch(models).collect()} == {"d": 2, "e": 9}


def test_voxels_without_a_name_do_not_count(spark):
    rows = spark.createDataFrame([("A", "L", "1", None), ("A", "L", "1", "S1")], "campaign string, side string, subject_id string, sulcus string")
    assert [(r.sulcus, r.n) for r in voxels.sulcus_voxels(rows).collect()] == [("S1", 1)]


def test_contains_offers_only_what_ids_begin_with(spark):
    """Names that share long words aren't joined by the substrings of these."""
    names_ = ["sub-12_cropped_skeleton", "xsub-120", "sub-7_sub-31", "su-12", "sub-", "31", "ub-12sub-12", "", "cropped"]
    files = spark.createDataFrame([(f"/d/{n}.nii",) for n in names_], "path string")
    found = lambda *ids: {r[0][3:-4] for r in qc.files_of(files, spark.createDataFrame([(i,) for i in ids], "subject_id string"), "contains").collect()}
    for ids in (["sub-12", "sub-3", None, ""], ["sub-12"], ["sub-12", "31", "cropped_skeleton"], ["é1", "éa"], [None]):
        assert found(*ids) == {n for n in names_ if any(i and i in n for i in ids)}
    own = spark.createDataFrame([("sub-12",), ("sub-3",)], "subject_id string")
    assert max(r["count"] for r in qc.offered(files, own, "contains").groupBy("path").count().collect()) <= 4
    names_of = qc.files_of(files.limit(5), own.limit(1), "contains")
    assert "BroadcastHashJoin" not in names_of._jdf.queryExecution().executedPlan().toString()
