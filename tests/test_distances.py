import numpy as np
import pytest
from pyspark.sql import functions as F

from voxlake.operators import distances


def _plain(cells, bottom):
    return ((cells[:, None] - bottom[None]) ** 2).sum(2).min(1)


@pytest.mark.parametrize("most", [distances.MOST_CELLS, 40])
@pytest.mark.parametrize("n_cells, n_bottom", [(200, 7), (4000, 900)])
def test_square_distance_equals_all_pairs(most, n_cells, n_bottom, monkeypatch):
    monkeypatch.setattr(distances, "MOST_CELLS", most)
    rng = np.random.default_rng(5)
    cells, bottom = rng.integers(-9, 9, (n_cells, 3)), rng.integers(-12, 12, (n_bottom, 3))
    assert distances.square_distance(cells, bottom).tolist() == _plain(cells, bottom).tolist()


def _crops():
    """Crops with bottoms all over, in a corner, thousands of voxels off, at negative places, and none."""
    rng = np.random.default_rng(3)
    out = {"all over": (rng.integers(-40, 40, (300, 3)), rng.integers(-40, 40, (60, 3))), "corner": (rng.integers(0, 200, (200, 3)), rng.integers(0, 6, (5, 3)))}
    out["far"] = np.concatenate([rng.integers(0, 9, (40, 3)), rng.integers(3000, 3020, (40, 3))]), rng.integers(-5000, -4990, (3, 3))
    out["none"] = rng.integers(0, 9, (20, 3)), np.zeros((0, 3), int)
    return out


@pytest.mark.parametrize("tile", [1, 8, 32])
def test_bottom_distance_equals_all_pairs(spark, tile):
    rows, expected = [], set()
    for crop, (other, bottom) in _crops().items():
        rows += [(crop, *map(int, p), "other") for p in other] + [(crop, *map(int, p), "aims_bottom") for p in bottom]
        every = np.unique(np.concatenate([other, bottom]), axis=0)
        if len(bottom):
            expected |= {(crop, *map(int, p), round(float(v) ** 0.5, 6)) for p, v in zip(every, _plain(every, bottom), strict=True)}
    given = spark.createDataFrame(rows + rows[:50], "crop string, x int, y int, z int, bucket string")
    got = distances.bottom_distance(given, ("crop",), tile).collect()
    assert len(got) == len(expected) and {tuple(r) for r in got} == expected


def test_odd_rows_have_no_distance(spark):
    rows = [("a", 1, 1, 1, None), ("a", 1, 1, 3, "aims_bottom"), ("a", None, 1, 1, "aims_bottom"), (None, 1, 1, 1, "aims_bottom")]
    given = spark.createDataFrame(rows, "crop string, x int, y int, z int, bucket string")
    assert sorted(map(tuple, distances.bottom_distance(given, ("crop",)).collect())) == [("a", 1, 1, 1, 2.0), ("a", 1, 1, 3, 0.0)]
    assert distances.bottom_distance(given.limit(0), ("crop",)).count() == 0


def test_only_tiles_that_may_be_nearest_are_met(spark):
    """Of a line of bottoms each tile meets its own neighbours, not the whole line."""
    cells = spark.range(4000).select(F.lit("a").alias("crop"), F.col("id").cast("int").alias("x"), F.lit(0).alias("y"), F.lit(0).alias("z"), (F.col("id") % 5 == 0).alias("bottom"))
    cells = cells.withColumn("tile", F.struct(*(F.floor(F.col(c) / 32).alias(c) for c in "xyz")))
    met = distances.needed_tiles(cells, ["crop"], 32).groupBy("tile").count().collect()
    assert len(met) == 125 and max(r["count"] for r in met) <= 3


def _wide():
    """Subjects of regions that share sulci, more regions than a word has bits; some crops longer than a batch, some without a bottom."""
    rng = np.random.default_rng(8)
    sulci = [(f"R{r:02}", "L", f"S{s}") for r in range(70) for s in range(4) if (r + s) % 3]
    voxels = [(f"s{i % 5}", "L", f"S{rng.integers(0, 4)}", *map(int, rng.integers(0, 30, 3)), "aims_bottom" if i % 5 and rng.random() < 0.1 else "aims_ss") for i in range(400)]
    return voxels + voxels[:40], sulci


def test_regions_of_voxels_come_as_rows_after_one_shuffle(spark):
    from voxlake.operators import voxels as own

    rows, sulci = _wide()
    given, regions = spark.createDataFrame(rows, "subject_id string, side string, sulcus string, x int, y int, z int, bucket string"), spark.createDataFrame(sulci, "region string, side string, sulcus string")
    expected = {}
    for s, d, u, *at, b in rows:
        for r in (r for r, _, v in sulci if v == u):
            key = (r, d, s, *at)
            expected[key] = expected.get(key, False) or b == "aims_bottom"
    out = own.region_voxels(given, regions)
    assert sorted(map(tuple, out.collect())) == sorted((*k, b) for k, b in expected.items())
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()


def test_crops_within_a_tile_need_no_tiles(spark, monkeypatch):
    rows, sulci = _wide()
    given, regions = spark.createDataFrame(rows, "subject_id string, side string, sulcus string, x int, y int, z int, bucket string"), spark.createDataFrame(sulci, "region string, side string, sulcus string")
    joined = given.join(regions, ["side", "sulcus"])
    expected = sorted(map(tuple, distances.bottom_distance(joined, ("subject_id", "side", "region"), 8).collect()))
    monkeypatch.setattr(distances, "needed_tiles", None)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        assert sorted(map(tuple, distances.region_distance(given, regions).collect())) == expected
        assert sorted(map(tuple, distances.bottom_distance(joined, ("subject_id", "side", "region")).collect())) == expected
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
