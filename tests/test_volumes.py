"""Columns of bits against plain sets of voxels."""

import random

import pytest

from voxlake.operators import volumes, voxels

VOXELS = "region string, x int, y int, z int"


def table(spark, cells):
    return spark.createDataFrame([(r, *c) for r, own in cells.items() for c in own] * 2, VOXELS)


def sets(rows):
    out = {}
    for r in rows.collect():
        cell = out.setdefault(r.region, [])
        cell.append((r.x, r.y, r.z))
    assert all(len(v) == len(set(v)) for v in out.values())
    return {k: set(v) for k, v in out.items()}


def cells(seed, n=40):
    rng = random.Random(seed)
    return {r: {(rng.randrange(-3, 4), rng.randrange(5), rng.randrange(low, high)) for _ in range(n)} for r, low, high in (("a", 0, 11), ("b", -70, 140), ("edges", 60, 68))} | {"one": {(0, 0, 63)}, "low": {(5, 5, -1), (5, 5, -64), (5, 5, 127)}}


def test_round_trip_union_and_box(spark):
    a, b = cells(1), cells(2)
    columns = volumes.columns_of(table(spark, a), ["region"])
    assert sets(volumes.voxels_of(columns)) == a and columns.count() <= sum(map(len, a.values()))
    both = volumes.union(columns, volumes.columns_of(table(spark, b), ["region"]))
    assert sets(volumes.voxels_of(both)) == {k: a[k] | b[k] for k in a}
    for r in volumes.box_of(columns, ["region"]).collect():
        for i, c in enumerate("xyz"):
            own = [v[i] for v in a[r.region]]
            assert (r[f"min_{c}"], r[f"max_{c}"], r[f"size_{c}"]) == (min(own), max(own), max(own) - min(own) + 1)


@pytest.mark.parametrize("radius", [0, 1, 2, 5])
def test_growing(spark, radius):
    a = cells(3, 12)
    steps = range(-radius, radius + 1)
    want = {k: {(x + i, y + j, z + m) for x, y, z in own for i in steps for j in steps for m in steps} for k, own in a.items()}
    assert sets(volumes.voxels_of(volumes.grown(volumes.columns_of(table(spark, a), ["region"]), radius))) == want
    assert sets(voxels.dilate(table(spark, a), radius)) == want


def test_growing_by_more_than_a_word(spark):
    got = sets(volumes.voxels_of(volumes.grown(volumes.columns_of(table(spark, {"a": {(0, 0, 3)}}), ["region"]), 70)))
    assert {z for _, _, z in got["a"]} == set(range(-67, 74)) and len(got["a"]) == 141**3


def test_dense_rows(spark):
    rows = spark.createDataFrame([("a", 5, [(1, 2.0), (4, 3.0), (1, 7.0)]), ("b", 2, []), ("c", 0, []), ("d", 1, [(0, -1.0)])], "k string, n int, at array<struct<spot: int, value: float>>")
    assert {r.k: r["values"] for r in volumes.dense(rows, "at", "n", "value").collect()} == {"a": [0.0, 7.0, 0.0, 0.0, 3.0], "b": [0.0, 0.0], "c": [], "d": [-1.0]}
    assert volumes.columns_of(table(spark, {"a": {(0, 0, 0)}}).limit(0), ["region"]).count() == 0
