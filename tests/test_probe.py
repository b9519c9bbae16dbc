"""The label probe against plain Newton rounds, and similarities of many models, of odd vectors and of summed parts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxlake.operators import embeddings, probe


def newton(x, y, ridge, rounds):
    x1, w = np.column_stack((x, np.ones(len(x)))), np.zeros(x.shape[1] + 1)
    for turn in range(rounds):
        near = y * (x1 @ w) < 1 if turn else np.ones(len(x), bool)
        below = x1[near].T @ x1[near] + ridge * len(x) * np.diag([1.0] * x.shape[1] + [0.0])
        w = np.linalg.solve(below + 1e-12 * np.eye(len(below)), x1[near].T @ y[near])
    return w


def made(spark, regions, n=60, d=4, seed=0):
    rng = np.random.default_rng(seed)
    y = {lab: rng.integers(0, 2, n) for lab in ("Sex", "Site")}
    vectors = {r: rng.normal(size=(n, d)) + 0.7 * y["Sex"][:, None] * rng.normal(size=d) for r in regions}
    rows = [(r, "left", str(i), v.tolist()) for r, x in vectors.items() for i, v in enumerate(x)]
    labels = [(str(i), lab, int(v)) for lab, own in y.items() for i, v in enumerate(own)]
    return vectors, y, spark.createDataFrame(rows, "region string, hemi string, subject_id string, vec array<double>").repartition(3), spark.createDataFrame(labels, "subject_id string, label_name string, label int")


@pytest.mark.parametrize("rounds", [1, 4, 20])
def test_scores_equal_a_plain_fit(spark, rounds):
    vectors, y, rows, labels = made(spark, ["a", "b", "c"])
    fold = {(r.subject_id, r.label_name): r.fold for r in probe.cv_folds(labels, 5).collect()}
    got = {(r.region, r.label_name, r.subject_id): r.score for r in probe.probe_scores(rows, labels, 5, 0.1, rounds).collect()}
    assert len(got) == 3 * 2 * 60
    for region, x in vectors.items():
        for lab, own in y.items():
            f, sign = np.array([fold[str(i), lab] for i in range(60)]), 2.0 * own - 1
            for k in range(5):
                w = newton(x[f != k], sign[f != k], 0.1, rounds)
                for i in np.flatnonzero(f == k):
                    assert got[region, lab, str(i)] == pytest.approx(x[i] @ w[:-1] + w[-1], abs=1e-6)
                if rounds == 20:  # the gradient of what is minimised
                    x1 = np.column_stack((x[f != k], np.ones((f != k).sum())))
                    slack = np.maximum(0, 1 - sign[f != k] * (x1 @ w))
                    assert np.abs(0.1 * len(x1) * np.append(w[:-1], 0) - x1.T @ (sign[f != k] * slack)).max() < 1e-6


def test_jobs_do_not_grow_with_regions(spark):
    def jobs(regions, name):
        *_, rows, labels = made(spark, regions)
        spark.sparkContext.setJobGroup(name, name)
        probe.probe_scores(rows, labels, 5, 0.1, 3).count()
        spark.sparkContext.setJobGroup("", "")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    few, many = jobs(["a"], "one region"), jobs([f"r{i}" for i in range(25)], "many regions")
    assert abs(few - many) <= 4  # adaptive plans may run a stage more or less as a job of its own


def test_labels_that_cannot_be_learned(spark):
    rows = spark.createDataFrame([("a", "left", str(i), [float(i % 7), 1.0 * i] if i != 3 else None) for i in range(20)] + [("b", "left", str(i), [1.0]) for i in range(20)], "region string, hemi string, subject_id string, vec array<double>")
    labels = spark.createDataFrame([(str(i), "one", 1) for i in range(20)] + [(str(i), "few", int(i == 0)) for i in range(20)], "subject_id string, label_name string, label int")
    got = {(r.region, r.label_name): (r.n, r.auc) for r in probe.label_probe(rows, labels).collect()}
    assert set(got) == {("a", "few"), ("b", "few")}  # nothing tells the label that all have
    # the machine of the fold that holds the only 1 has no 1 to learn from, so that fold isn't scored
    assert got["b", "few"] == (15, None) and got["a", "few"][0] in (14, 15)


def test_machines_in_groups(spark, monkeypatch):
    *_, rows, labels = made(spark, ["a", "b", "c", "d"], seed=3)
    whole = sorted(map(tuple, probe.probe_scores(rows, labels).collect()))
    monkeypatch.setattr(probe, "WEIGHT_BYTES", 500)
    parts = sorted(map(tuple, probe.probe_scores(rows, labels).collect()))
    assert [p[:-1] for p in parts] == [w[:-1] for w in whole] and np.allclose([p[-1] for p in parts], [w[-1] for w in whole])


def plain_cka(x, y):
    cx, cy = x - x.mean(0), y - y.mean(0)
    return np.linalg.norm(cx.T @ cy) ** 2 / np.linalg.norm(cx.T @ cx) / np.linalg.norm(cy.T @ cy)


@pytest.mark.parametrize(("models", "subjects"), [(16, 5000), (2, 5000), (1, 7)])
def test_cka_of_models_with_missing_subjects(spark, monkeypatch, models, subjects):
    monkeypatch.setattr(embeddings, "TILE_MODELS", models)
    monkeypatch.setattr(embeddings, "TILE_SUBJECTS", subjects)
    rng = np.random.default_rng(4)
    held = {m: {s: rng.normal(size=2 + k % 3) for s in range(40) if (s + k) % 4} for k, m in enumerate("abcde")}
    rows = [(m, str(s), v.tolist()) for m, own in held.items() for s, v in own.items()]
    got = {(r.model_a, r.model_b): (r.n, r.cka) for r in embeddings.cka_matrix(spark.createDataFrame(rows, "model_id string, subject_id string, vec array<double>").repartition(5)).collect()}
    assert len(got) == 10
    for (a, b), (n, value) in got.items():
        both = sorted(set(held[a]) & set(held[b]))
        assert n == len(both) and value == pytest.approx(plain_cka(np.array([held[a][s] for s in both]), np.array([held[b][s] for s in both])), abs=1e-6)


def test_cka_of_models_that_cannot_be_compared(spark):
    rng = np.random.default_rng(5)
    rows = [(m, str(s), rng.normal(size=3).tolist()) for m in "abc" for s in range(9)]
    rows = [(m, s, None if (m, s) == ("b", "4") else v[:2] if (m, s) == ("c", "5") else v) for m, s, v in rows]
    frame = spark.createDataFrame([*rows, ("d", "none", [1.0])], "model_id string, subject_id string, vec array<double>")
    assert {(r.model_a, r.model_b): r.cka for r in embeddings.cka_matrix(frame).collect()} == {("a", "b"): None, ("a", "c"): None, ("b", "c"): None}
    assert embeddings.cka_matrix(frame.limit(0)).count() == 0


def test_shuffle_of_the_matrix_has_no_pairs(spark):
    rows = spark.createDataFrame([("a", "1", [1.0]), ("b", "1", [2.0])], "model_id string, subject_id string, vec array<double>")
    assert "Join" not in embeddings.cka_matrix(rows)._jdf.queryExecution().executedPlan().toString()


def test_statuses(spark):
    nan = float("nan")
    pairs = [("ok", [1.0, 2.0], [1.0]), ("ok", [2.0, 1.0], [3.0]), ("flat", [1.0], [1.0]), ("flat", [1.0], [2.0]), ("null", None, [1.0]), ("null", [1.0], [2.0]), ("hole", [None, 1.0], [1.0]), ("nan", [1.0], [nan]), ("mixed", [1.0], [1.0]), ("mixed", [1.0, 2.0], [1.0]), ("side", [1.0], [1.0]), ("side", [3.0], [1.0, 2.0])]
    got = {r.k: (r.n, r.cka, r.status) for r in embeddings.cka_status(spark.createDataFrame(pairs, "k string, x array<double>, y array<double>").repartition(3), ["k"]).collect()}
    assert got == {"ok": (2, 1.0, "ok"), "flat": (2, None, "constant"), "null": (2, None, "null vector"), "hole": (1, None, "null vector"), "nan": (1, None, "null vector"), "mixed": (2, None, "lengths differ"), "side": (2, None, "lengths differ")}


def test_sums_of_many_parts(spark, monkeypatch):
    x = np.random.default_rng(6).normal(size=(500, 3))
    rows = spark.createDataFrame([(i % 2, v.tolist(), v[:1].tolist()) for i, v in enumerate(x)], "k int, x array<double>, y array<double>").repartition(40)
    for k, parts in embeddings.grams(rows, ["k"]).groupBy("k").agg(F.collect_list(F.struct("n", "xx")).alias("parts")).collect():
        assert len(parts) <= embeddings.SALTS and sum(p.n for p in parts) == 250
        assert np.allclose(np.sum([np.frombuffer(p.xx) for p in parts], axis=0).reshape(3, 3), x[k::2].T @ x[k::2])
