"""Embedding tables: pairing, similarity, and batch encoding."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from voxlake.functions import names

ROI = ["region", "hemi"]


def pair_by_name(a: DataFrame, b: DataFrame) -> DataFrame:
    """Tables of both sets by equal file name, those of a alone too: (name, label, status)."""
    both = a.select("name").join(b.select("name", F.lit(True).alias("there")), "name", "left")
    return both.select("name", names.pair_label(F.col("name")).alias("label"), F.when(F.col("there"), "paired").otherwise("missing").alias("status"))


def by_model_id(a: DataFrame) -> DataFrame:
    """One table for each model id in its name; the last by name counts."""
    found = a.select("name", F.regexp_extract("name", names.MODEL_ID, 1).alias("model_id")).where(F.col("model_id") != "")
    last = F.row_number().over(Window.partitionBy("model_id").orderBy(F.desc("name")))
    return found.withColumn("rn", last).where("rn = 1").drop("rn")


def pair_by_model_id(a: DataFrame, b: DataFrame) -> DataFrame:
    return by_model_id(a).withColumnRenamed("name", "name_a").join(by_model_id(b).withColumnRenamed("name", "name_b"), "model_id")


def pair_embeddings(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs by file name; where there is none, by model id."""
    named = pair_by_name(a, b).where("status = 'paired'").select(F.col("name").alias("name_a"), F.col("name").alias("name_b"))
    return pair_by_model_id(a, b).select("name_a", "name_b") if named.isEmpty() else named


def of_regions(rows: DataFrame, regions: list[str], contains: bool = False) -> DataFrame:
    """The rows of the regions named, or of those whose name contains one of them; an error where there is none."""
    region = F.col("region")
    wanted = region.isin(*regions)
    if contains:
        wanted = F.lit(False)
        for r in regions:
            wanted = wanted | region.contains(r)
    found = rows.where(wanted)
    if found.isEmpty():
        raise ValueError(f"no rows of the regions {', '.join(regions)}")
    return found


def chosen(rows: DataFrame, **wanted: list[str] | None) -> DataFrame:
    """The rows with one of the values wanted in each column named, such as region, side or kind; None takes all. A value that no row has is an error, as it is a slip of the pen.

    Plain comparisons, so they reach the folders of partitioned tables.
    """
    for column, values in wanted.items():
        if values is not None:
            rows = rows.where(F.col(column).isin(*values))
    for column, values in wanted.items():
        if values is not None and (missing := set(values) - {r[0] for r in rows.select(column).distinct().collect()}):
            raise ValueError(f"no rows with {column} {', '.join(sorted(missing))}")
    return rows


def pair_by_region(a: DataFrame, b: DataFrame) -> DataFrame:
    """Regions of either set: (region, hemi, status)."""
    x, y = (d.select(*ROI).distinct().withColumn(f, F.lit(True)) for d, f in ((a, "in_a"), (b, "in_b")))
    return x.join(y, ROI, "full").select(*ROI, F.when(F.col("in_a") & F.col("in_b"), "paired").when(F.col("in_a"), "only_a").otherwise("only_b").alias("status"))


def roi_sizes(embeddings: DataFrame) -> DataFrame:
    """Rows and vector lengths of each region and hemisphere over all runs."""
    size = F.size("vec")
    return embeddings.groupBy(*ROI).agg(F.count("*").alias("n"), F.count_distinct("subject_id").alias("n_subjects"), F.min(size).alias("min_dim"), F.max(size).alias("max_dim"))


#: Bytes of matrices that a task holds before it gives them on, and how many sums of a key are added up side by side.
HELD_BYTES, SALTS = 128 << 20, 64
_SUMS = "p int, q int, n long, sx binary, sy binary, xx binary, yy binary, xy binary"
_BAD = -1


class Sums:
    """Counts, sums and products of pairs of vectors, for each key and pair of lengths. Pairs that can't be used, as one is null or holds a null, are only counted, with lengths of -1."""

    def __init__(self, keys: list[str]):
        self.keys, self.held, self.bytes = keys, {}, 0

    def add(self, key: tuple, x: np.ndarray, y: np.ndarray, square: np.ndarray | None = None) -> None:
        self._put((*key, x.shape[1], y.shape[1]), [len(x), x.sum(0), y.sum(0), x.T @ x if square is None else square, y.T @ y, x.T @ y])

    def bad(self, key: tuple, n: int) -> None:
        self._put((*key, _BAD, _BAD), [n, *[np.zeros(0)] * 5])

    def _put(self, at: tuple, new: list) -> None:
        if at in self.held:
            self.held[at] = [a + b for a, b in zip(self.held[at], new, strict=True)]
        else:
            self.held[at] = new
            self.bytes += sum(m.nbytes for m in new[1:])

    def full(self) -> bool:
        return self.bytes > HELD_BYTES

    def frame(self) -> pd.DataFrame:
        rows = [(*key, n, *(m.tobytes() for m in own)) for key, (n, *own) in self.held.items()]
        self.held, self.bytes = {}, 0
        return pd.DataFrame(rows, columns=[*self.keys, *(c.split()[0] for c in _SUMS.split(", "))])


def sums_schema(rows: DataFrame, keys: list[str], more: str = "") -> str:
    return ", ".join([*(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys), *([more] if more else []), _SUMS])


def matrix(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lengths, where the vector is whole, all their numbers in one array) of a column of arrays; a vector is whole if neither it nor a number of it is null, and all are finite."""
    n = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.fill_null(pc.list_flatten(vectors), np.nan).to_numpy(zero_copy_only=False).astype(np.float64)
    wrong = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    end = np.cumsum(n)
    return n, vectors.is_valid().to_numpy(zero_copy_only=False) & (wrong[end] == wrong[end - n]), flat


def some(n: np.ndarray, flat: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The matrix of rows of equal length."""
    first = np.cumsum(n)[rows] - n[rows]
    return flat[first[:, None] + np.arange(n[rows[0]])]


def by_key(batch: pa.RecordBatch, keys: list[str]):
    """(key, row numbers) of the keys of a batch."""
    for key, rows in batch.select(keys).to_pandas().groupby(keys, sort=False, dropna=False).indices.items():
        yield tuple(None if pd.isna(k) else k for k in (key if isinstance(key, tuple) else (key,))), np.asarray(rows)


def added_up(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of the tasks (keys, _SUMS), added up to about SALTS rows a key and pair of lengths at most; partial sums stream through tasks that hold HELD_BYTES."""

    def add(frames):
        total = Sums(keys)
        for frame in frames:
            for row in frame.itertuples(index=False):
                at = tuple(None if pd.isna(k) else k for k in row[: len(keys)])
                total._put((*at, row.p, row.q), [row.n, *map(np.frombuffer, row[len(keys) + 3 : len(keys) + 8])])
            if total.full():
                yield total.frame()
        yield total.frame()

    dealt = parts.withColumn("salt", F.spark_partition_id() % SALTS).repartition(*keys, "salt").drop("salt")
    return dealt.mapInPandas(add, sums_schema(parts, keys))


def grams(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Sums and products of the vectors x and y of each key and pair of lengths: partial matrices in the tasks, about one addition a key and task."""

    def part(batches):
        own = Sums(keys)
        for batch in batches:
            (nx, okx, x), (ny, oky, y) = (matrix(batch.column(c)) for c in "xy")
            for key, rows in by_key(batch, keys):
                good = rows[okx[rows] & oky[rows]]
                if len(good) < len(rows):
                    own.bad(key, len(rows) - len(good))
                for p, q in set(zip(nx[good].tolist(), ny[good].tolist(), strict=True)):
                    these = good[(nx[good] == p) & (ny[good] == q)]
                    own.add(key, some(nx, x, these), some(ny, y, these))
            if own.full():
                yield pa.RecordBatch.from_pandas(own.frame(), arrow, preserve_index=False)
        yield pa.RecordBatch.from_pandas(own.frame(), arrow, preserve_index=False)

    schema = StructType.fromDDL(sums_schema(pairs, keys))
    arrow = to_arrow_schema(schema)
    return added_up(pairs.select(*keys, "x", "y").mapInArrow(part, schema), keys)


def _added(parts: pd.DataFrame) -> tuple:
    """(n, sums and products) of a key; an error where vectors are null or of different lengths."""
    if problem := _problem(parts):
        raise ValueError(f"vectors can't be used together: {problem}")
    return (int(parts.n.sum()), *(np.sum([np.frombuffer(m) for m in parts[c]], axis=0) for c in ("sx", "sy", "xx", "yy", "xy")))


def _problem(parts: pd.DataFrame) -> str | None:
    if (parts.p == _BAD).any():
        return "null vector"
    return "lengths differ" if len(set(zip(parts.p, parts.q, strict=True))) > 1 else None


def cka_status(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Linear CKA of the aligned vectors x and y of each key: |Yt X|^2 / (|Xt X| |Yt Y|) on centred columns, with a status: ok; constant, where a side has no spread; null
    vector, where one is null or holds a null or a number that isn't finite; lengths differ, where those of a side do. All but the first have no CKA, and no key stops the others."""
    return _cka(grams(pairs, keys), keys)


def _cka(sums: DataFrame, keys: list[str]) -> DataFrame:
    def one(key, parts: pd.DataFrame) -> pd.DataFrame:
        n, value, status = int(parts.n.sum()), None, _problem(parts)
        if status is None:
            _, sx, sy, xx, yy, xy = _added(parts)
            p, q = len(sx), len(sy)
            cx, cy, cxy = xx.reshape(p, p) - np.outer(sx, sx) / n, yy.reshape(q, q) - np.outer(sy, sy) / n, xy.reshape(p, q) - np.outer(sx, sy) / n
            below = np.linalg.norm(cx) * np.linalg.norm(cy)
            value, status = (round(float((cxy**2).sum() / below), 6), "ok") if below > 1e-12 else (None, "constant")
        return pd.DataFrame([(*key, n, value, status)], columns=[*keys, "n", "cka", "status"])

    kinds = ", ".join(f"{k} {sums.schema[k].dataType.simpleString()}" for k in keys)
    return sums.groupBy(*keys).applyInPandas(one, f"{kinds}, n long, cka double, status string")


def cka(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, cka) as `cka_status` has them."""
    return cka_status(pairs, keys).drop("status")


def align(a: DataFrame, b: DataFrame) -> DataFrame:
    """Vectors of both sets, row by row of the same region, hemisphere and subject."""
    return a.select(*ROI, "subject_id", F.col("vec").alias("x")).join(b.select(*ROI, "subject_id", F.col("vec").alias("y")), [*ROI, "subject_id"])


#: Models of a tile's side, and subjects that a task takes of a tile.
TILE_MODELS, TILE_SUBJECTS = 16, 5_000


def cka_matrix(embeddings: DataFrame) -> DataFrame:
    """CKA of all pairs of models, over the subjects that both have; of a subject's vectors of one model one counts.

    A subject's vectors are put together once, and its row goes to each tile of models it has a part in: as many as there are groups of TILE_MODELS models, so what is
    shuffled grows with subjects and models, not with pairs. In a tile, subjects with the same models are stacked, and products of whole matrices are cut into pairs.
    """
    # a name for each model
    models = [r[0] for r in embeddings.select("model_id").distinct().orderBy("model_id").collect()]
    group = {m: k // TILE_MODELS for k, m in enumerate(models)}
    groups = -(-len(models) // TILE_MODELS)
    tiles = [(a, b) for a in range(groups) for b in range(a, groups)]
    subjects = embeddings.groupBy("subject_id", "model_id").agg(F.first("vec").alias("vec")).groupBy("subject_id").agg(F.collect_list(F.struct("model_id", "vec")).alias("held"))
    side = F.create_map(*(F.lit(x) for m, g in group.items() for x in (m, g))) if models else F.create_map(F.lit(""), F.lit(0))
    dealt = F.pmod(F.xxhash64("subject_id"), F.lit(max(1, -(-embeddings.select("subject_id").distinct().count() // TILE_SUBJECTS))))
    tile = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in tiles or [(0, 0)])))
    rows = subjects.select("held", dealt.alias("part"), tile.alias("tile")).select(F.col("tile.a").alias("a"), F.col("tile.b").alias("b"), "part", F.filter("held", lambda h: side[h["model_id"]].isin(F.col("tile.a"), F.col("tile.b"))).alias("held")).where(F.size("held") > 0)

    def pairs(key: tuple[Any, ...], frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = key[0].as_py(), key[1].as_py()
        own = Sums(["model_a", "model_b"])
        for batch in frames:
            held = batch.column("held")
            of = np.repeat(np.arange(len(held)), pc.list_value_length(held).to_numpy())
            flat = pc.list_flatten(held)
            names, (n, ok, numbers) = np.array(flat.field("model_id").to_pylist()), matrix(flat.field("vec"))
            at = {m: np.flatnonzero(names == m) for m in set(names.tolist())}
            spot = {m: dict(zip(of[r].tolist(), r.tolist(), strict=True)) for m, r in at.items()}
            # subjects with the same models, of the same lengths, are stacked
            kinds: dict[tuple, list] = {}
            for s in range(len(held)):
                kinds.setdefault(tuple(sorted((m, int(n[p[s]]) if ok[p[s]] else _BAD) for m, p in spot.items() if s in p)), []).append(s)
            for kind, subjects_ in kinds.items():
                x = {m: some(n, numbers, np.array([spot[m][s] for s in subjects_])) for m, size in kind if size > _BAD}
                square = {m: v.T @ v for m, v in x.items()}
                for i, (m, _) in enumerate(kind):
                    for o, _ in kind[i + 1 :]:
                        if {group[m], group[o]} == {a, b}:
                            if m in x and o in x:
                                own.add((m, o), x[m], x[o], square[m])
                            else:
                                own.bad((m, o), len(subjects_))
            if own.full():
                yield pa.RecordBatch.from_pandas(own.frame(), arrow, preserve_index=False)
        yield pa.RecordBatch.from_pandas(own.frame(), arrow, preserve_index=False)

    schema = StructType.fromDDL(f"model_a string, model_b string, {_SUMS}")
    arrow = to_arrow_schema(schema)
    return _cka(added_up(rows.groupBy("a", "b", "part").applyInArrow(pairs, schema), ["model_a", "model_b"]), ["model_a", "model_b"]).drop("status")


def batch_embed(rows: DataFrame, make_encoder: Callable[[], Callable[[np.ndarray], np.ndarray]], size: int) -> DataFrame:
    """Adds vec, what the encoder makes of `values`; the encoder is built once a worker and given whole batches."""
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import ArrayType, FloatType

    encode = predict_batch_udf(make_encoder, return_type=ArrayType(FloatType()), batch_size=256, input_tensor_shapes=[[size]])
    return rows.withColumn("vec", encode("values"))
