"""Nearest neighbours against all distances, whatever the cells, and how many cells are visited."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxlake.operators import neighbours

ROWS = "region string, hemi string, subject_id string, vec array<double>"


def table(spark, x, prefix, region="r"):
    return spark.createDataFrame([(region, "left", f"{prefix}{i}", v if v is None else np.asarray(v).tolist()) for i, v in enumerate(x)], ROWS).repartition(3)


def clustered(rng, n, clusters, d=3):
    return rng.normal(size=(clusters, d))[rng.integers(0, clusters, n)] * 20 + rng.normal(size=(n, d))


def plain(new, reference, k):
    out = {}
    for name, v in new.items():
        far = sorted((float(np.sqrt(((np.array(v) - w) ** 2).sum())), other) for other, w in reference.items() if other != name)
        out[name] = [(o, round(d, 6)) for d, o in far[:k]]
    return out


def got(rows):
    out = {}
    for r in sorted(rows.collect(), key=lambda r: r["rank"]):
        out.setdefault(r.subject_id, []).append((r.ref_id, r.d))
    return out


@pytest.mark.parametrize(("cell_rows", "block"), [(1000, 50_000), (20, 50_000), (5, 7), (1, 3)])
def test_equals_all_distances(spark, monkeypatch, cell_rows, block):
    monkeypatch.setattr(neighbours, "REFERENCE_BLOCK", block)
    monkeypatch.setattr(neighbours, "NEW_BLOCK", block)
    rng = np.random.default_rng(cell_rows)
    x = clustered(rng, 150, 6).round(1)  # with ties
    x[20:30] = x[10]
    q = np.concatenate((x[:25], clustered(rng, 10, 6)))
    reference, new = table(spark, x, "s"), table(spark, q, "s")
    want = plain({f"s{i}": v for i, v in enumerate(q)}, {f"s{i}": v for i, v in enumerate(x)}, 7)
    assert got(neighbours.knn(new, reference, 7, cell_rows)) == want


def test_few_visits_where_vectors_lie_in_clusters(spark):
    rng = np.random.default_rng(1)
    x, q = clustered(rng, 600, 30, 2), None
    q = x[:40] + 0.01
    reference, new = table(spark, x, "s"), table(spark, q, "n")
    centre = neighbours.centres(reference, 10)
    there = neighbours.in_cells(reference, centre)
    cells = {("r", "left"): {r.cell: (r.n, r.radius) for r in there.groupBy("cell").agg({"*": "count", "far": "max"}).toDF("cell", "n", "radius").collect()}}
    assert 40 <= len(centre["r", "left"]) <= 60
    first = neighbours.visits(new, centre, cells, 5)
    from pyspark.sql import functions as F

    kth = {name: own[-1][1] for name, own in plain({f"n{i}": v for i, v in enumerate(q)}, {f"s{i}": v for i, v in enumerate(x)}, 5).items()}
    again = new.withColumn("kth", F.element_at(F.create_map(*(F.lit(x) for p in kth.items() for x in p)), F.col("subject_id")))
    visited = first.count() + neighbours.visits(again, centre, cells, 5).count()
    assert visited < 40 * len(centre["r", "left"]) / 3


def test_odd_vectors_and_tables(spark):
    reference = table(spark, [[0.0, 0.0], None, [1.0, 0.0], [float("nan"), 1.0], [3.0, 0.0]], "s").union(table(spark, [[1.0]], "only", "q"))
    new = table(spark, [[0.0, 0.0], None, [2.0, 0.0]], "n").union(table(spark, [[5.0]], "m", "q")).union(table(spark, [[5.0]], "x", "nowhere"))
    assert got(neighbours.knn(new, reference, 2)) == {"n0": [("s0", 0.0), ("s2", 1.0)], "n2": [("s2", 1.0), ("s4", 1.0)], "m0": [("only0", 4.0)]}
    assert neighbours.knn(new.limit(0), reference).count() == 0 and neighbours.knn(new, reference.limit(0)).count() == 0


def cells_of(there):
    return {("r", "left"): {r.cell: (r.n, r.radius) for r in there.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius")).collect()}}


@pytest.mark.parametrize(("block", "most"), [(50_000, 1), (60, 5)])
def test_a_vector_goes_to_a_block_once(spark, monkeypatch, block, most):
    monkeypatch.setattr(neighbours, "REFERENCE_BLOCK", block)
    monkeypatch.setattr(neighbours, "VISITS", 7, raising=False)
    x = np.random.default_rng(3).normal(size=(200, 30))  # no clusters: every cell must be met
    reference, new = table(spark, x, "s"), table(spark, x[:20] + 0.01, "n")
    centre = neighbours.centres(reference, 4)
    cells = cells_of(neighbours.in_cells(reference, centre))
    first = neighbours.visits(new, centre, cells, 5)
    again = neighbours.visits(new.withColumn("kth", F.lit(1e9)).withColumn("seen", F.array(F.lit(0))), centre, cells, 5)
    assert len(centre["r", "left"]) > 40 and 20 <= first.count() <= 20 * most
    assert again.count() == 20 * (max(a + n for a, n in neighbours.blocks(cells)["r", "left"].values()) - 1) < 20 * most
    want = plain({f"n{i}": v + 0.01 for i, v in enumerate(x[:20])}, {f"s{i}": v for i, v in enumerate(x)}, 5)
    assert got(neighbours.knn(new, reference, 5, 4)) == want


def test_blocks_hold_a_bounded_number_of_vectors(monkeypatch):
    monkeypatch.setattr(neighbours, "REFERENCE_BLOCK", 10)
    assert neighbours.blocks({"q": {0: (4, 1.0), 2: (6, 1.0), 3: (1, 1.0), 5: (25, 1.0), 6: (3, 1.0), 7: (7, 1.0), 8: (1, 1.0)}}) == {
        "q": {0: (0, 1), 2: (0, 1), 3: (1, 1), 5: (2, 3), 6: (5, 1), 7: (5, 1), 8: (6, 1)}
    }


@pytest.mark.parametrize("block", [50_000, 40])
def test_copies(spark, monkeypatch, block):
    """Of equal vectors only those with the smallest ids can be neighbours, so a crowd of them isn't measured."""
    monkeypatch.setattr(neighbours, "REFERENCE_BLOCK", block)
    rng = np.random.default_rng(4)
    x = np.concatenate((np.ones((150, 3)), clustered(rng, 40, 4)))
    rows, q = table(spark, x, "s"), table(spark, x[:160], "s")
    every = {f"s{i}": v for i, v in enumerate(x)}
    assert got(neighbours.knn(q, rows, 4, 10)) == plain({f"s{i}": v for i, v in enumerate(x[:160])}, every, 4)
    needed = neighbours._needed(x, np.r_[0, 0, 0, np.arange(3, 190)], 4)
    assert list(needed) == [0, 1, 2, 3, 4, 5, 6, *range(150, 190)]


def test_far_from_zero_and_without_ids(spark):
    """Bounds allow for the rounding of large numbers; a subject without an id is in no pair, as in SQL."""
    x = clustered(np.random.default_rng(5), 200, 20, 2).round(1) * 0.01 + 3e5
    reference, new = table(spark, x, "s"), table(spark, x[:60], "s")
    odd = spark.createDataFrame([("r", "left", None, x[0].tolist())] * 3, ROWS)
    want = plain({f"s{i}": v for i, v in enumerate(x[:60])}, {f"s{i}": v for i, v in enumerate(x)}, 3)
    assert got(neighbours.knn(new.union(odd), reference.union(odd), 3, 4)) == want
