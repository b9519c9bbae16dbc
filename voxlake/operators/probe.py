"""Splits, folds, and how well labels can be read off embeddings."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from voxlake.operators.embeddings import ROI, Sums, added_up, by_key, matrix, some, sums_schema


def bucket(ids: Column, buckets: int, seed: int = 0) -> Column:
    """A bucket that depends on the id and the seed alone."""
    return (F.conv(F.substring(F.md5(F.concat(ids, F.lit(f"-{seed}"))), 1, 8), 16, 10).cast("long") % buckets).cast("int")


def split_subjects(subjects: DataFrame, train: int = 70, val: int = 15, seed: int = 0) -> DataFrame:
    """Adds subset: train, val or test, by percent."""
    b = bucket(F.col("subject_id"), 100, seed)
    return subjects.withColumn("subset", F.when(b < train, "train").when(b < train + val, "val").otherwise("test"))


def custom_split(subjects: DataFrame, lists: DataFrame) -> DataFrame:
    """Adds subset from lists (subject_id, subset); null for subjects in none."""
    return subjects.join(lists, "subject_id", "left")


def cv_folds(labels: DataFrame, k: int = 5, seed: int = 0) -> DataFrame:
    """Adds fold, 0 to k - 1, equally many of each label in each."""
    order = Window.partitionBy("label_name", "label").orderBy(F.md5(F.concat("subject_id", F.lit(f"-{seed}"))), "subject_id")
    return labels.withColumn("fold", ((F.row_number().over(order) - 1) % k).cast("int"))


def auc(scores: DataFrame, keys: list[str] = ROI) -> DataFrame:
    """The area under the ROC curve for each key from (score, label 0 or 1), by ranks; equal scores share their mean rank; null without both labels.

    Ranks come from the counts of each distinct score.
    """
    ties = scores.groupBy(*keys, "score").agg(F.count("*").alias("n"), F.sum(F.col("label").cast("long")).alias("hits"))
    before = F.sum("n").over(Window.partitionBy(*keys).orderBy("score").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    ranked = ties.withColumn("rank", before + (F.col("n") + 1) / 2)
    out = ranked.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("hits").alias("pos"), F.sum(F.col("rank") * F.col("hits")).alias("ranks"))
    neg = F.col("n") - F.col("pos")
    return out.select(*keys, "n", F.when((F.col("pos") > 0) & (neg > 0), F.round((F.col("ranks") - F.col("pos") * (F.col("pos") + 1) / 2) / (F.col("pos") * neg), 6)).alias("auc"))


#: Bytes of weights that go to all tasks at once; machines beyond are fitted after the others.
WEIGHT_BYTES = 64 << 20
_PROBE = [*ROI, "label_name"]


def probe_machines(rows: DataFrame, k: int, ridge: float, rounds: int) -> dict[tuple, np.ndarray]:
    """(region, hemi, label_name) -> weights and intercept of k linear machines, the f-th fitted without fold f, from rows with fold, y (-1 or 1) and vec; NaN where the other folds hold one label only.

    A machine minimises ridge n |w|^2 + sum of max(0, 1 - y (w x + b))^2 over its n rows, by Newton's rounds: each solves the normal equations of the rows within the margin,
    until the weights settle. All machines of all keys share a round, which is one job: the tasks sum products by key, as for CKA, and what is collected are the solutions. In
    the first round all rows count, so a machine's sums are those of all folds less its own; one round alone is regularised least squares.
    """
    spark = rows.sparkSession
    weights: dict[tuple, np.ndarray] = {}
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(weights)

        def part(batches):
            own, known = Sums([*_PROBE, "fold"]), shared.value
            for batch in batches:
                n, ok, flat = matrix(batch.column("vec"))
                y, fold = batch.column("y").to_numpy().astype(np.float64), batch.column("fold").to_numpy()
                for key, at in by_key(batch, _PROBE):
                    at = at[ok[at]]
                    for p in set(n[at].tolist()):
                        these = at[n[at] == p]
                        x = np.column_stack((some(n, flat, these), np.ones(len(these))))
                        if turn == 0:
                            use = [(f, fold[these] == f) for f in range(k)]
                        elif key in known and known[key].shape[1] == p + 1:
                            near = y[these, None] * (x @ known[key].T) < 1
                            use = [(f, near[:, f] & (fold[these] != f)) for f in range(k)]
                        else:
                            use = []
                        for f, rows_ in use:
                            if rows_.any():
                                own.add((*key, f), x[rows_], np.column_stack((y[these][rows_], y[these][rows_] > 0)))
                if own.full():
                    yield pa.RecordBatch.from_pandas(own.frame(), arrow, preserve_index=False)
            yield pa.RecordBatch.from_pandas(own.frame(), arrow, preserve_index=False)

        schema = StructType.fromDDL(sums_schema(rows, _PROBE, "fold int"))
        arrow = to_arrow_schema(schema)

        def solve(key, parts: pd.DataFrame) -> pd.DataFrame:
            sizes = set(parts.p)
            if len(sizes) > 1:
                raise ValueError(f"vectors of {'/'.join(map(str, key))} differ in length")
            d = sizes.pop()
            sums = {f: [own.n.sum(), *(np.sum([np.frombuffer(m) for m in own[c]], axis=0) for c in ("sy", "xx", "xy"))] for f, own in parts.groupby("fold")}
            out = np.full((k, d), np.nan)
            for f in range(k):
                if turn == 0:
                    others = [s for g, s in sums.items() if g != f]
                    n, sy, xx, xy = (sum(s[i] for s in others) for i in range(4)) if others else (0, np.zeros(2), np.zeros(d * d), np.zeros(2 * d))
                    if not 0 < sy[1] < n:  # one label only
                        continue
                    size = n
                else:
                    size = given_by[key][f]
                    if f not in sums or not size:
                        continue
                    n, sy, xx, xy = sums[f]
                below = xx.reshape(d, d) + ridge * size * np.diag([1.0] * (d - 1) + [0.0])
                out[f] = np.linalg.solve(below + 1e-12 * np.eye(d), xy.reshape(d, 2)[:, 0])
            # how many rows each machine has been given
            given = [int(sum(s[0] for g, s in sums.items() if g != f)) for f in range(k)] if turn == 0 else [0] * k
            return pd.DataFrame([(*key, out.tobytes(), given)], columns=[*_PROBE, "weights", "given"])

        sums = added_up(rows.select(*_PROBE, "fold", "y", "vec").mapInArrow(part, schema), [*_PROBE, "fold"])
        found = sums.groupBy(*_PROBE).applyInPandas(solve, ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in _PROBE) + ", weights binary, given array<long>").collect()
        new = {tuple(r[c] for c in _PROBE): np.frombuffer(r.weights).reshape(k, -1) for r in found}
        if turn == 0:
            given_by = {tuple(r[c] for c in _PROBE): r.given for r in found}
        shared.unpersist()
        # a machine none of whose rows is within the margin stays as it is
        new = {key: np.where(np.isnan(new.get(key, w)), w, new.get(key, w)) for key, w in (weights or new).items()}
        settled = turn and all(np.allclose(w, weights[key], rtol=0, atol=1e-10, equal_nan=True) for key, w in new.items())
        weights = new
        if settled:
            break
    return weights


def probe_scores(embeddings: DataFrame, labels: DataFrame, k: int = 5, ridge: float = 0.1, rounds: int = 20) -> DataFrame:
    """(region, hemi, label_name, subject_id, fold, label, score): every vector is scored, for every label its subject has, by the machine that was fitted without its fold.

    Rows whose other folds hold one label only, and vectors that are null or hold a null, have no score and are left out. Where the weights of all machines take more
    than WEIGHT_BYTES, keys are dealt into groups that are fitted one after the other.
    """
    rows = embeddings.join(cv_folds(labels, k), "subject_id").select(*_PROBE, "subject_id", "fold", F.col("label").cast("int").alias("label"), (2 * F.col("label").cast("int") - 1).alias("y"), "vec").persist()
    size = rows.groupBy(*_PROBE).agg(F.max(F.size("vec")).alias("d")).agg(F.sum((F.col("d") + 1) * 8 * k)).first()[0] or 0
    groups, out = max(1, -(-size // WEIGHT_BYTES)), None
    for g in range(groups):
        own = rows.where(F.pmod(F.xxhash64(*_PROBE), F.lit(groups)) == g) if groups > 1 else rows
        shared = rows.sparkSession.sparkContext.broadcast(probe_machines(own, k, ridge, rounds))

        def score(batches, shared=shared):
            for batch in batches:
                n, ok, flat = matrix(batch.column("vec"))
                fold, out_ = batch.column("fold").to_numpy(), np.full(len(ok), np.nan)
                for key, at in by_key(batch, _PROBE):
                    own = shared.value.get(key)
                    at = at[ok[at]]
                    if own is not None and len(at):
                        at = at[n[at] == own.shape[1] - 1]
                    if own is not None and len(at):
                        w = own[fold[at]]
                        out_[at] = (some(n, flat, at) * w[:, :-1]).sum(1) + w[:, -1]
                kept = batch.append_column("score", pa.array(out_)).filter(pa.array(np.isfinite(out_)))
                yield kept.select(names)

        schema = StructType([*(rows.schema[c] for c in (*_PROBE, "subject_id", "fold", "label")), StructField("score", DoubleType())])
        names = schema.names
        scored = own.mapInArrow(score, schema)
        out = scored if out is None else out.unionByName(scored)
    return out


def label_probe(embeddings: DataFrame, labels: DataFrame, k: int = 5, ridge: float = 0.1, rounds: int = 20) -> DataFrame:
    """(region, hemi, label_name, n, auc) of linear support vector machines: how well labels (0 or 1) can be read off the vectors, over the scores of all k folds together."""
    return auc(probe_scores(embeddings, labels, k, ridge, rounds), _PROBE)


def eval_grid(datasets: DataFrame, labels: DataFrame, subsets: DataFrame, done: DataFrame) -> DataFrame:
    """Every dataset, label and subset that has no result yet."""
    return datasets.crossJoin(labels).crossJoin(subsets).join(done, ["dataset", "label_name", "subset"], "left_anti")


def best_epoch(models: DataFrame) -> DataFrame:
    """(dataset, epoch) of the model with the highest score; the earlier of equals."""
    return models.groupBy("dataset").agg(F.max_by("epoch", F.struct("score", -F.col("epoch"))).alias("epoch"))
