"""Distance to the fold bottom, exact, in tiles.

Space is cut into cubes of TILE voxels a side. A tile's voxels are compared with the bottoms of those tiles alone that may hold a nearest one. These are found
from the tiles' boxes: the smallest cube around a tile, of 1, 2, 4, ... tiles a side, that holds a bottom bounds how far the nearest one is; of the tiles within that
reach, those stay that are no farther off than some other is at its farthest. A task so holds one tile and the bottoms around it, however large the crop.
Where all voxels lie within one tile, no tile has another beside it: crops are then sorted together and told apart batch by batch.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from voxlake.operators.voxels import dealt, region_voxels

#: Voxels along the side of a tile.
TILE = 64
#: Cubes of 2^0 to 2^LEVELS tiles a side are tried; after them all of the crop.
LEVELS = 6
#: Cells of a box that a task fills; eight times as many numbers as it compares at a time.
MOST_CELLS = 1 << 25


def square_distance(cells: np.ndarray, bottom: np.ndarray) -> np.ndarray:
    """Of each cell the squared distance to the nearest of `bottom`: all pairs in slices, or, where that is less work, one axis after the other over the box of both, as squares of the axes add up."""
    low, high = np.minimum(cells.min(0), bottom.min(0)), np.maximum(cells.max(0), bottom.max(0))
    # numbers of Python, as boxes of voxels far apart overflow
    shape = [int(n) for n in high - low + 1]
    filled = math.prod(shape)
    if filled > MOST_CELLS or len(cells) * len(bottom) <= 2 * filled * sum(shape):
        step = max(1, MOST_CELLS // (8 * len(bottom)))
        return np.concatenate([((cells[k : k + step, None] - bottom[None]) ** 2).sum(2).min(1) for k in range(0, len(cells), step)])
    box = np.full(shape, 4 * sum(n * n for n in shape), np.int64)
    box[tuple((bottom - low).T)] = 0
    for axis in range(3):
        lines = np.moveaxis(box, axis, 0)
        out = lines.copy()
        for by in range(1, len(lines)):
            np.minimum(out[by:], lines[:-by] + by * by, out=out[by:])
            np.minimum(out[:-by], lines[by:] + by * by, out=out[:-by])
        box = np.moveaxis(out, 0, axis)
    return box[tuple((cells - low).T)]


def _cube(level: Column, tile: Column) -> Column:
    """Place of the cube of 2^level tiles a side around a tile; beyond LEVELS one cube holds everything."""
    return F.when(level <= LEVELS, F.floor(tile / F.pow(F.lit(2.0), level))).otherwise(0).cast("long")


def _boxes(cells: DataFrame, keys: list[str]) -> DataFrame:
    """The tiles that have voxels, the box of these (own_) and that of the bottoms among them (low_, null for none)."""
    ends = [f(F.when(which, F.col(c))).cast("long").alias(f"{name}_{n}_{c}") for name, which in (("own", F.lit(True)), ("low", F.col("bottom"))) for c in "xyz" for n, f in (("low", F.min), ("high", F.max))]
    return cells.groupBy(*keys, "tile").agg(*ends)


def _square(parts) -> Column:
    return sum((F.pow(p, 2) for p in parts), F.lit(0.0))


def _farthest(own: str, low: str) -> Column:
    """Square of the largest distance between voxels of two boxes."""
    return _square(F.greatest(F.col(f"{low}_high_{c}") - F.col(f"{own}_low_{c}"), F.col(f"{own}_high_{c}") - F.col(f"{low}_low_{c}")) for c in "xyz")


def needed_tiles(cells: DataFrame, keys: list[str], tile: int = TILE) -> DataFrame:
    """Pairs (keys, tile, bottom_tile): the tiles whose bottoms may be nearest to a voxel of `tile`. `cells` has keys, tile (struct of x, y, z), x, y, z, bottom."""
    boxes = _boxes(cells, keys)
    ends = lambda name: [c for c in boxes.columns if c.startswith(f"{name}_")]
    has = F.col("low_low_x").isNotNull()
    low = boxes.where(has).withColumnRenamed("tile", "low_tile").drop(*ends("own"))
    # how far at most the nearest bottom is: within the tile, or, for tiles without one, across the smallest cube that holds one
    near = boxes.where(has).select(*keys, "tile", *ends("own"), F.lit(0).alias("level"), F.ceil(F.sqrt(_farthest("own", "low"))).alias("reach"))
    levels = F.explode(F.sequence(F.lit(0), F.lit(LEVELS + 1))).alias("level")

    def cubes(tiles: DataFrame, of: str) -> DataFrame:
        return tiles.select("*", levels).withColumns({f"c{c}": _cube(F.col("level"), F.col(f"{of}.{c}")) for c in "xyz"})

    at = ["level", "cx", "cy", "cz"]
    lows = cubes(low, "low_tile")
    bare = boxes.where(~has).drop(*ends("low"))
    first = cubes(bare.select(*keys, "tile"), "tile").join(lows.select(*keys, *at).distinct(), [*keys, *at], "left_semi").groupBy(*keys, "tile").agg(F.min("level").alias("level"))
    far = bare.join(first, [*keys, "tile"]).withColumn("reach", F.ceil(F.sqrt(F.lit(3.0)) * tile * F.pow(F.lit(2.0), F.col("level"))))
    about = near.unionByName(far)
    for c in "xyz":
        first_cube, last_cube = (_cube(F.col("level"), F.floor(end / tile)) for end in (F.col(f"own_low_{c}") - F.col("reach"), F.col(f"own_high_{c}") + F.col("reach")))
        about = about.select("*", F.explode(F.sequence(first_cube, last_cube)).alias(f"c{c}"))
    pairs = about.withColumnRenamed("tile", "own_tile").join(lows, [*keys, *at])
    gap = _square(F.greatest(F.lit(0), F.col(f"low_low_{c}") - F.col(f"own_high_{c}"), F.col(f"own_low_{c}") - F.col(f"low_high_{c}")) for c in "xyz")
    pairs = pairs.select(*keys, F.col("own_tile").alias("tile"), F.col("low_tile").alias("bottom_tile"), gap.alias("gap"), _farthest("own", "low").alias("most"))
    bound = pairs.groupBy(*keys, "tile").agg(F.min("most").alias("bound"))
    return pairs.join(bound, [*keys, "tile"]).where("gap <= bound").select(*keys, "tile", "bottom_tile")


def in_one_tile(voxels: DataFrame, tile: int = TILE) -> bool:
    """Whether all voxels lie within one tile; a single aggregate of their coordinates."""
    ends = voxels.agg(*(F.floor(f(c) / tile).alias(f"{n}_{c}") for c in "xyz" for n, f in (("low", F.min), ("high", F.max)))).first()
    return all(ends[f"low_{c}"] == ends[f"high_{c}"] for c in "xyz")


def _in_crops(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Distances of crops that are a tile each. The rows of a crop follow each other, and the last one of a batch waits for the next batch."""
    kept = [c for c in cells.columns if c != "bottom"]
    schema = StructType([*(cells.schema[c] for c in kept), StructField("distance", DoubleType())])

    def crops(batch: pa.Table) -> np.ndarray:
        """Where crops begin, and the end."""
        new = np.zeros(max(0, len(batch) - 1), bool)
        for c in keys:
            column = batch.column(c)
            new |= pc.not_equal(column.slice(1), column.slice(0, max(0, len(batch) - 1))).to_numpy()
        return np.concatenate(([0], np.flatnonzero(new) + 1, [len(batch)]))

    def measured(batch: pa.Table, ends: np.ndarray):
        at = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in "xyz"], 1)
        low, square = batch.column("bottom").to_numpy(), np.full(len(at), -1)
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            if low[a:b].any():
                square[a:b] = square_distance(at[a:b], at[a:b][low[a:b]])
        out = batch.select(kept).append_column("distance", pa.array(np.round(np.sqrt(np.maximum(square, 0).astype(float)), 6)))
        yield from out.filter(pa.array(square >= 0)).to_batches()

    def measure(batches):
        waiting: list[pa.Table] = []
        for batch in batches:
            if not len(batch):
                continue
            first = pa.Table.from_batches([batch])
            # a crop that fills whole batches is put together once, when it ends
            ends = crops(pa.concat_tables([waiting[-1].slice(len(waiting[-1]) - 1), first]) if waiting else first)
            if len(ends) == 2:
                waiting.append(first)
                continue
            table = pa.concat_tables([*waiting, first])
            cut = len(table) - (ends[-1] - ends[-2])
            done = table.slice(0, cut)
            yield from measured(done, crops(done))
            waiting = [table.slice(cut)]
        if waiting:
            table = pa.concat_tables(waiting)
            yield from measured(table, crops(table))

    return cells.sortWithinPartitions(*keys).mapInArrow(measure, schema)


def region_distance(voxels: DataFrame, region_sulci: DataFrame) -> DataFrame:
    """Distances to the fold bottom within the crop of each region, side and subject; voxels are shuffled once, not once for each region."""
    keys, spots = ["subject_id", "side", "region"], ["x", "y", "z"]
    voxels = voxels.select("subject_id", "side", "sulcus", *spots, "bucket")
    if not in_one_tile(voxels):
        return bottom_distance(voxels.join(region_sulci, ["side", "sulcus"]), tuple(keys))
    cells = region_voxels(voxels, region_sulci).select(*keys, *spots, "bottom")
    return _in_crops(cells.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, *spots])), keys)


def bottom_distance(voxels: DataFrame, keys: tuple[str, ...] = ("subject_id", "side"), tile: int = TILE) -> DataFrame:
    """Of each voxel the distance to the nearest bottom voxel of its crop: rows of the same `keys`, each voxel once. Crops without a bottom voxel have no rows, nor have rows with a null key or coordinate."""
    keys = list(keys)
    cells = voxels.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, *"xyz"]))
    together = in_one_tile(cells, tile)
    cells = dealt(cells, *keys) if together else cells
    cells = cells.groupBy(*keys, "x", "y", "z").agg(F.coalesce(F.max(F.col("bucket") == "aims_bottom"), F.lit(False)).alias("bottom"))
    if together:
        return _in_crops(cells, keys)
    cells = cells.withColumn("tile", F.struct(*(F.floor(F.col(c) / tile).cast("long").alias(c) for c in "xyz")))
    places = [F.col(c) for c in "xyz"]
    bottoms = cells.where("bottom").select(*keys, F.col("tile").alias("bottom_tile"), *places)
    # columns of new names, so that both sides of the cogroup are told apart
    around = needed_tiles(cells, keys, tile).join(bottoms, [*keys, "bottom_tile"]).select(*(F.col(c).alias(f"of_{c}") for c in [*keys, "tile"]), *(F.col(c).alias(f"low_{c}") for c in "xyz"))
    kept = StructType([f for f in cells.schema if f.name not in ("bottom", "tile")])

    def one(own: pa.Table, low: pa.Table) -> pa.Table:
        own = own.select(kept.names)
        if not own.num_rows or not low.num_rows:
            return own.slice(0, 0).append_column("distance", pa.array([], pa.float64()))
        at, to = (np.stack([t[f"{by}{c}"].to_numpy().astype(np.int64) for c in "xyz"], 1) for t, by in ((own, ""), (low, "low_")))
        return own.append_column("distance", pa.array(np.round(np.sqrt(square_distance(at, to).astype(float)), 6), pa.float64()))

    groups = cells.groupBy(*keys, "tile").cogroup(around.groupBy(*(f"of_{c}" for c in keys), "of_tile"))
    return groups.applyInArrow(one, StructType([*kept, StructField("distance", DoubleType())]))
