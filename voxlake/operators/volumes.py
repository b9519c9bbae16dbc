"""Volumes as columns of voxels: a row for 64 voxels above each other, one bit for each.

A column (keys, x, y, w, bits) holds the voxels z = 64 w to 64 w + 63. Unions are ORs, growing along z is shifting, and
boxes come from the lowest and highest bits, so voxels are listed, or laid out as dense arrays, only where that is asked for.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

BITS = 64
_COLUMN = ["x", "y", "w"]


def _or(values: list[Column]) -> Column:
    out = values[0]
    for v in values[1:]:
        out = out.bitwiseOR(v)
    return out


def columns_of(voxels: DataFrame, keys: list[str]) -> DataFrame:
    """Columns of the voxels (keys, x, y, z); a voxel that is there several times counts once."""
    bit = F.expr(f"shiftleft(1L, cast(pmod(z, {BITS}) as int))")
    return voxels.select(*keys, "x", "y", F.floor(F.col("z") / BITS).cast("int").alias("w"), bit.alias("bits")).groupBy(*keys, *_COLUMN).agg(F.bit_or("bits").alias("bits"))


def union(*volumes: DataFrame) -> DataFrame:
    """Columns of the voxels that lie in one of the volumes."""
    out = volumes[0]
    for v in volumes[1:]:
        out = out.unionByName(v)
    return out.groupBy(*(c for c in out.columns if c != "bits")).agg(F.bit_or("bits").alias("bits"))


def voxels_of(columns: DataFrame) -> DataFrame:
    """(keys, x, y, z) of the voxels."""
    keys = [c for c in columns.columns if c not in (*_COLUMN, "bits")]
    places = F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda k: F.getbit("bits", k) == 1)
    return columns.select(*keys, "x", "y", "w", F.explode(places).alias("k")).select(*keys, "x", "y", (F.col("w") * BITS + F.col("k")).alias("z"))


def grown(columns: DataFrame, radius: int) -> DataFrame:
    """Columns of the voxels within `radius` of the volume's (largest coordinate difference), one axis after the other."""
    keys = [c for c in columns.columns if c not in (*_COLUMN, "bits")]
    out = columns
    while radius > 0:
        r, radius = min(radius, BITS - 1), radius - min(radius, BITS - 1)
        bits = F.col("bits")
        own = _or([bits, *(s for k in range(1, r + 1) for s in (F.shiftleft(bits, k), F.shiftrightunsigned(bits, k)))])
        above, below = (_or([f(bits, BITS - k) for k in range(1, r + 1)]) for f in (F.shiftrightunsigned, F.shiftleft))
        parts = F.array(*(F.struct((F.col("w") + d).alias("w"), b.alias("bits")) for d, b in ((0, own), (1, above), (-1, below))))
        out = union(out.select(*keys, "x", "y", F.inline(F.filter(parts, lambda p: p["bits"] != 0))))
        for c in "xy":
            rest = [k for k in out.columns if k != c]
            out = union(out.select(*rest, F.explode(F.sequence(F.col(c) - r, F.col(c) + r)).alias(c)))
    return out


def box_of(columns: DataFrame, keys: list[str]) -> DataFrame:
    """Smallest and largest coordinates and sizes of the volume of each key."""
    # zeros behind the last one of the binary digits
    low = F.col("w") * BITS + F.length(F.bin("bits")) - F.length(F.expr("trim(TRAILING '0' FROM bin(bits))"))
    high = F.col("w") * BITS + F.length(F.bin("bits")) - 1
    box = columns.groupBy(*keys).agg(F.min("x").alias("min_x"), F.max("x").alias("max_x"), F.min("y").alias("min_y"), F.max("y").alias("max_y"), F.min(low).cast("int").alias("min_z"), F.max(high).cast("int").alias("max_z"))
    return box.withColumns({f"size_{c}": F.col(f"max_{c}") - F.col(f"min_{c}") + 1 for c in "xyz"})


def dense(rows: DataFrame, spots: str, size: str, value: str) -> DataFrame:
    """The column `spots` (array of struct of spot and `value`) of each row laid out as an array `values` of `size` cells, zeros elsewhere; of several values at a spot the largest counts."""
    kept = [c for c in rows.columns if c != spots]
    kind = rows.schema[spots].dataType.elementType[value].dataType

    def lay(batches):
        for batch in batches:
            held = batch.column(spots)
            n = np.diff(held.offsets.to_numpy())
            cells = batch.column(size).to_numpy().astype(np.int64)
            at = np.concatenate(([0], np.cumsum(cells)))
            flat = held.flatten()
            where = np.repeat(at[:-1], n) + flat.field("spot").to_numpy(zero_copy_only=False)
            values = flat.field(value).to_numpy(zero_copy_only=False)
            out = np.zeros(at[-1], values.dtype)
            order = np.argsort(values, kind="stable")
            out[where[order]] = values[order]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(out))], names=[*kept, "values"])

    return rows.mapInArrow(lay, StructType([*(rows.schema[c] for c in kept), StructField("values", ArrayType(kind))]))
