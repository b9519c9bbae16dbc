"""Exact nearest neighbours within regions, by cells around centres.

Each reference vector lies in the cell of its nearest centre; a cell's radius is the distance of its farthest vector. No
vector of a cell is nearer to a new one than the distance to the centre less the radius. Cells are dealt into blocks, and
a new vector goes to a block once, however many of its cells it has to meet there. It first visits the blocks of the
cells nearest to it that hold k vectors between them, and then those with a cell whose bound is within the k-th distance
found; where a region is one block, the first visit is the whole of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from voxlake.operators.embeddings import ROI, by_key, matrix, some

#: Cells of a region at most (so many vectors a region come to the driver), and vectors of a cell that are aimed at.
MOST_CELLS, CELL_ROWS = 256, 1_000
#: Vectors of a block, and new subjects of those visiting it that are met by one task.
REFERENCE_BLOCK, NEW_BLOCK = 50_000, 5_000
#: New vectors and vectors of the block that meet in one product, pairs that are measured at once, and visits of a batch.
NEW_TILE, REFERENCE_TILE, PAIRS, VISITS = 256, 2_048, 50_000, 5_000
_FOUND = "region string, hemi string, subject_id string, ref_id string, d double, block int"


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, (x**2).sum(1)[:, None] - 2 * x @ c.T + (c**2).sum(1)))


def bounds(x: np.ndarray, c: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """How far each x is from the vectors of each cell at least, whatever the rounding."""
    d = np.sqrt(np.maximum(0, distances(x, c) ** 2 - 1e-12 * ((x**2).sum(1)[:, None] + (c**2).sum(1))))
    return (d - radius) * (1 - 1e-9) - 1e-9 * (1 + d)


def centres(reference: DataFrame, cell_rows: int = CELL_ROWS) -> dict[tuple, np.ndarray]:
    """Centres of each region: a vector for each `cell_rows` of it, MOST_CELLS at most, those whose ids have the smallest hashes among all of its vectors."""
    counts = reference.groupBy(*ROI).agg(F.count("*").alias("n")).withColumn("cells", F.least(F.lit(MOST_CELLS), F.ceil(F.col("n") / cell_rows)))
    own = F.xxhash64("subject_id", F.lit("centre"))
    # a few times as many as are wanted, before they are sorted
    some_rows = reference.join(counts, ROI).where((F.pmod(own, F.col("n")) < 4 * F.col("cells") + 16) & F.col("vec").isNotNull())
    first = F.row_number().over(Window.partitionBy(*ROI).orderBy(own, "subject_id"))
    out: dict[tuple, list] = {}
    for r in some_rows.withColumn("first", first).where("first <= cells").select(*ROI, "vec").collect():
        if all(x is not None and np.isfinite(x) for x in r.vec):
            out.setdefault((r.region, r.hemi), []).append(r.vec)
    return {key: np.unique(np.array(v, float), axis=0) for key, v in out.items()}


def in_cells(reference: DataFrame, centre: dict[tuple, np.ndarray]) -> DataFrame:
    """Adds cell and far, the distance to its centre; vectors that are null or hold a null are in none. A region without centres has one cell around zero."""
    shared = reference.sparkSession.sparkContext.broadcast(centre)

    def assign(batches):
        for batch in batches:
            n, ok, flat = matrix(batch.column("vec"))
            cell, far = np.full(len(ok), -1, np.int32), np.zeros(len(ok))
            for key, rows in by_key(batch, ROI):
                rows = rows[ok[rows]]
                if len(rows):
                    x = some(n, flat, rows)
                    c = shared.value.get(key, np.zeros((1, x.shape[1])))
                    cell[rows] = ((c**2).sum(1) - 2 * x @ c.T).argmin(1)
                    far[rows] = np.sqrt(((x - c[cell[rows]]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], names=names).filter(pa.array(ok))

    rows = reference.select(*ROI, "subject_id", "vec")
    schema = StructType([*rows.schema, *StructType.fromDDL("cell int, far double")])
    names = schema.names
    return rows.mapInArrow(assign, schema)


def blocks(cells: dict[tuple, dict[int, tuple[int, float]]]) -> dict[tuple, dict[int, tuple[int, int]]]:
    """The first block of each cell, and over how many it is dealt: one that cells side by side share, of REFERENCE_BLOCK vectors at most, or several for a larger cell."""
    out: dict[tuple, dict[int, tuple[int, int]]] = {}
    for key, own in cells.items():
        after, room = 0, 0
        for cell in sorted(own):
            n = own[cell][0]
            shares = 0 < n <= room
            many = 1 if shares else max(1, int(np.ceil(n / REFERENCE_BLOCK)))
            out.setdefault(key, {})[cell] = after - 1 if shares else after, many
            after, room = (after, room - n) if shares else (after + many, max(0, REFERENCE_BLOCK - n))
    return out


def visits(new: DataFrame, centre: dict[tuple, np.ndarray], cells: dict[tuple, dict[int, tuple[int, float]]], k: int) -> DataFrame:
    """(region, hemi, subject_id, vec, kth, block) of the blocks that new vectors visit first or, where a column `kth` has the k-th distance found in these, after that; `seen` has the blocks where some were found."""
    shared, later = new.sparkSession.sparkContext.broadcast((centre, cells, blocks(cells))), "kth" in new.columns

    def choose(batches):
        centre_, cells_, blocks_ = shared.value
        for batch in batches:
            n, ok, flat = matrix(batch.column("vec"))
            kth = batch.column("kth").to_numpy(zero_copy_only=False)
            been = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if "seen" in names:
                many = pc.fill_null(pc.list_value_length(batch.column("seen")), 0).to_numpy(zero_copy_only=False)
                been = np.repeat(np.arange(len(many)), many), pc.list_flatten(batch.column("seen")).to_numpy(zero_copy_only=False)
            for key, every in by_key(batch, ROI):
                every = every[ok[every]]
                if key not in cells_:
                    continue
                within = None
                for rows in (every[s : s + NEW_BLOCK] for s in range(0, len(every), NEW_BLOCK)):
                    x = some(n, flat, rows)
                    c = centre_.get(key, np.zeros((1, x.shape[1])))
                    count, radius = (np.array([cells_[key].get(i, (0, -np.inf))[f] for i in range(len(c))], float) for f in (0, 1))
                    if within is None:
                        within = np.zeros((len(c), max(first + many for first, many in blocks_[key].values())), np.float32)
                        for cell, (first, many) in blocks_[key].items():
                            within[cell, first : first + many] = 1
                    if later:
                        cell = bounds(x, c, radius) <= kth[rows][:, None]
                    else:
                        order = np.argsort(distances(x, c), axis=1, kind="stable")
                        # vectors in the cells before, nearest cells first; one more than k, as a vector may meet itself
                        before = np.cumsum(count[order], axis=1) - count[order]
                        cell = np.empty(order.shape, bool)
                        np.put_along_axis(cell, order, before <= k, 1)
                    chosen = (cell & (count > 0)).astype(np.float32) @ within > 0
                    place = np.full(len(ok), -1)
                    place[rows] = np.arange(len(rows))
                    here = place[been[0]] >= 0
                    chosen[place[been[0][here]], been[1][here]] = False
                    i, j = np.nonzero(chosen)
                    for s in range(0, len(i), VISITS):
                        own = batch.select(schema.names[:5]).take(pa.array(rows[i[s : s + VISITS]]))
                        yield pa.RecordBatch.from_arrays([*own.columns, pa.array(j[s : s + VISITS].astype(np.int32))], names=schema.names)

    kth = F.col("kth") if later else F.lit(float("inf"))
    rows = new.select(*ROI, "subject_id", "vec", kth.cast("double").alias("kth"), *(["seen"] if "seen" in new.columns else []))
    schema, names = StructType([*rows.schema.fields[:5], *StructType.fromDDL("block int")]), rows.columns
    return rows.mapInArrow(choose, schema)


def _needed(y: np.ndarray, y_id: np.ndarray, k: int) -> np.ndarray:
    """The rows that can be among the k nearest of anything: of equal vectors those with the k + 1 smallest ids, as one id may be the new vector's own."""
    _, same = np.unique(np.ascontiguousarray(y).view(np.dtype((np.void, y.itemsize * y.shape[1]))).ravel(), return_inverse=True) if y.shape[1] else (None, np.zeros(len(y), int))
    order = np.lexsort((y_id, same))
    same, ids = same[order], y_id[order]
    other = np.concatenate(([True], same[1:] != same[:-1]))
    number = np.cumsum(other | np.concatenate(([True], ids[1:] != ids[:-1])))
    return np.sort(order[number - number[np.flatnonzero(other)[np.cumsum(other) - 1]] <= k])


def _nearest(x: np.ndarray, x_id: np.ndarray, kth: np.ndarray, y: np.ndarray, y_id: np.ndarray, cell: np.ndarray, centre: np.ndarray, radius: np.ndarray, k: int):
    """(new index, reference index, distance) of the k nearest of each new vector that are within its `kth`; ties by id, which are numbers in order.

    Cells near the new vectors come first, and those whose bound is beyond the k-th distance found so far are left out. Products of matrices name the candidates, whose distances are then taken exactly.
    """
    own_cells, cell = np.unique(cell, return_inverse=True)
    low, square = bounds(x, centre[own_cells], radius[own_cells]), (y**2).sum(1)
    in_cell, first = np.argsort(cell, kind="stable"), np.searchsorted(np.sort(cell), np.arange(len(own_cells) + 1))
    together = np.argsort(low.argmin(1), kind="stable")
    for rows in (together[a : a + NEW_TILE] for a in range(0, len(x), NEW_TILE)):
        part, limit = x[rows], kth[rows].copy()
        length = (part**2).sum(1)
        walk = np.concatenate([in_cell[first[c] : first[c + 1]] for c in np.argsort(low[rows].min(0), kind="stable")])
        i, j, d = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for there in (walk[s : s + REFERENCE_TILE] for s in range(0, len(walk), REFERENCE_TILE)):
            who = np.flatnonzero(low[np.ix_(rows, np.unique(cell[there]))].min(1) <= limit)
            if not len(who):
                continue
            near = square[there] - 2 * part[who] @ y[there].T + length[who][:, None]
            near[x_id[rows[who]][:, None] == y_id[there]] = np.inf
            edge, slack = limit[who] ** 2, 1e-9 * (1 + length[who] + square.max())
            close = (near <= (edge + slack)[:, None]) & np.isfinite(near)
            if len(there) > k and close.sum() > 4 * k * len(who):
                edge = np.minimum(edge, np.partition(near, k - 1, axis=1)[:, k - 1])
                close &= near <= (edge + slack)[:, None]
            p, q = np.nonzero(close)
            p, q = who[p], there[q]
            exact = [np.sqrt(((part[p[s : s + PAIRS]] - y[q[s : s + PAIRS]]) ** 2).sum(1)) for s in range(0, len(p), PAIRS)]
            i, j, d = np.append(i, p), np.append(j, q), np.concatenate([d, *exact])
            order = np.lexsort((y_id[j], d, i))
            i, j, d = i[order], j[order], d[order]
            best = np.arange(len(i)) - np.searchsorted(i, i) < k
            i, j, d = i[best], j[best], d[best]
            after = np.searchsorted(i, who, "right")
            full = after - np.searchsorted(i, who) == k
            limit[who[full]] = np.minimum(limit[who[full]], d[after[full] - 1])
        inside = d <= kth[rows[i]]
        yield rows[i[inside]], j[inside], d[inside]


def _met(going: DataFrame, there: DataFrame, centre: dict[tuple, np.ndarray], cells: dict[tuple, dict[int, tuple[int, float]]], k: int) -> DataFrame:
    """The k nearest of each visit. Crowds of visitors are dealt over several tasks, each of which meets the block."""
    spark, keys = going.sparkSession, [*ROI, "block", "a"]
    shared = spark.sparkContext.broadcast((centre, cells))
    visited = F.broadcast(going.groupBy(*ROI, "block").agg(F.ceil(F.count("*") / NEW_BLOCK).cast("int").alias("as")))
    of_cells = spark.createDataFrame([(*key, cell, *at) for key, own in blocks(cells).items() for cell, at in own.items()], "region string, hemi string, cell int, first int, many int")
    x = going.join(visited, keys[:3]).withColumn("a", F.pmod(F.xxhash64("subject_id"), F.col("as")).cast("int"))
    placed = there.join(F.broadcast(of_cells), [*ROI, "cell"]).withColumn("block", F.col("first") + F.pmod(F.xxhash64("subject_id"), F.col("many")).cast("int"))
    y = placed.join(visited, keys[:3]).withColumn("a", F.explode(F.sequence(F.lit(0), F.col("as") - 1)))  # blocks that nobody visits go here

    def meet(key: tuple, new: pa.Table, reference: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if len(new) and len(reference):
            (n, _, flat), (m, _, other) = (matrix(t.column("vec").combine_chunks()) for t in (new, reference))
            x, y = some(n, flat, np.arange(len(n))), some(m, other, np.arange(len(m)))
            ids = pc.unique(reference.column("subject_id"))
            ids = ids.take(pc.sort_indices(ids))
            x_id, y_id = (pc.fill_null(pc.index_in(t.column("subject_id"), value_set=ids), -1).to_numpy() for t in (new, reference))
            roi = tuple(reference.column(c)[0].as_py() for c in ROI)
            c = shared.value[0].get(roi, np.zeros((1, x.shape[1])))
            radius = np.array([shared.value[1][roi].get(i, (0, -np.inf))[1] for i in range(len(c))], float)
            needed = _needed(y, y_id, k)
            for i, j, d in _nearest(x, x_id, new.column("kth").to_numpy(), y[needed], y_id[needed], reference.column("cell").to_numpy()[needed], c, radius, k):
                out[0].append(i)
                out[1].append(needed[j])
                out[2].append(d)
        i, j, d = map(np.concatenate, out)
        own = new.take(pa.array(i))
        return pa.table([own.column("region"), own.column("hemi"), own.column("subject_id"), reference.column("subject_id").take(pa.array(j)), pa.array(d), own.column("block")], schema=arrow)

    arrow = to_arrow_schema(StructType.fromDDL(_FOUND))
    x, y = (rows.select(*keys, "subject_id", "vec", more) for rows, more in ((x, "kth"), (y, "cell")))
    return x.groupBy(*keys).cogroup(y.groupBy(*keys)).applyInArrow(meet, _FOUND)


def knn(new: DataFrame, reference: DataFrame, k: int = 15, cell_rows: int = CELL_ROWS) -> DataFrame:
    """The k nearest reference subjects of each new one in its region and hemisphere: (region, hemi, subject_id, ref_id, d, rank); ties by id. No subject is its own neighbour.

    The result is exact, whatever the cells; they only spare visits. Vectors that are null or hold a null, and subjects without an id, are nobody's neighbours and have none.
    """
    new, reference = (rows.where(F.col("subject_id").isNotNull()) for rows in (new, reference))
    centre = centres(reference, cell_rows)
    there = in_cells(reference, centre)
    cells: dict[tuple, dict[int, tuple[int, float]]] = {}
    for r in there.groupBy(*ROI, "cell").agg(F.count("*").alias("n"), F.max("far").alias("radius")).collect():  # MOST_CELLS a region at most
        cells.setdefault((r.region, r.hemi), {})[r.cell] = (r.n, r.radius)
    best = F.row_number().over(Window.partitionBy(*ROI, "subject_id").orderBy("d", "ref_id", "block"))
    found = _met(visits(new, centre, cells, k), there, centre, cells, k)
    if any(first + many > 1 for own in blocks(cells).values() for first, many in own.values()):
        found = found.repartition(*ROI, "subject_id")  # both uses below read the same columns of it, so Spark makes it once
        within = F.when(F.count("*") >= k, F.max(F.when(F.col("rank") <= k, F.col("d"))))
        kth = found.withColumn("rank", best).groupBy(*ROI, "subject_id").agg(within.alias("kth"), F.collect_set("block").alias("seen"))
        again = new.join(kth, [*ROI, "subject_id"], "left").withColumn("kth", F.coalesce("kth", F.lit(float("inf"))))
        found = found.unionByName(_met(visits(again, centre, cells, k), there, centre, cells, k))
    ranked = found.withColumn("rank", best).where(F.col("rank") <= k)
    return ranked.select(*ROI, "subject_id", "ref_id", F.round("d", 6).alias("d"), "rank")
