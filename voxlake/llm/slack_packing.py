"""Packing by minimum bin slack.

A document is cut into whole windows of the capacity and a remainder. Remainders are known by their length, so what is
planned is a multiset of at most `capacity - 1` lengths with counts, summed by Spark, whatever the number of documents.
For each window the longest remainder left goes in first, and a subset-sum over the lengths left, held in the bits of
one number, finds the multiset that fills the window closest to capacity; counts are found by going back through the
sums, and the window is repeated as often as the counts allow. Remainders of windows that stay open are lined up and cut
at each capacity; the end of the line is cut into powers of two, so nothing is padded. A remainder's place follows from
its rank among those of its length, which tasks compute from counts by task and length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxlake.llm.common import fields, release, staged
from voxlake.llm.packing import _encode

CAPACITY = 1024


def remainders(docs: DataFrame, path: str, fallback: str, capacity: int = CAPACITY) -> DataFrame:
    """Whole windows and the remainder of each document: doc_id, doc_tokens, start, length, ids_crc32, and the ids of remainders; `part` and `nth` number the pieces of a length in each task."""

    def cut(batches):
        encode, part, seen = _encode(path, fallback), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            of, rows, held = [], [], []
            for i, text in enumerate(batch.column("text")):
                ids = np.append(encode(text.as_py() or ""), np.uint32(0)).astype("<u4")
                for a in range(0, len(ids), capacity):
                    own = ids[a : a + capacity]
                    of.append(i)
                    rows.append((len(ids), a, len(own), zlib.crc32(own.data), seen[len(own)]))
                    held.append(own.tobytes() if len(own) < capacity else None)
                    seen[len(own)] += 1
            tokens, start, length, crc, nth = np.array(rows, np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens), pa.array(start), pa.array(length.astype(np.int32)), pa.array(crc), pa.array(np.full(len(of), part, np.int32)), pa.array(nth), pa.array(held, pa.binary()), batch.column("doc_id").take(pa.array(of, pa.int64()))], names=schema.names
            )

    rows = docs.select("doc_id", "text")
    schema = fields("doc_tokens long, start long, length int, ids_crc32 long, part int, nth long, ids binary", rows, ["doc_id"])
    return rows.mapInArrow(cut, schema)


def closest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset, drawn from `counts` (length -> how many there are), that holds the longest length and whose sum is closest to `capacity` without passing it."""
    sizes = sorted(counts, reverse=True)
    left, full = counts | {sizes[0]: counts[sizes[0]] - 1}, (1 << (capacity + 1)) - 1
    sums, steps = 1 << sizes[0], []
    for s in sizes:
        steps.append((s, sums))
        n, k = min(left[s], (capacity - sizes[0]) // s), 1
        while n > 0:  # 1, 2, 4, ... copies and the rest: any number up to n
            k = min(k, n)
            sums |= sums << k * s & full
            n, k = n - k, 2 * k
        if sums >> capacity & 1:
            break
    at, used = sums.bit_length() - 1, {sizes[0]: 1}
    for s, before in reversed(steps):
        n = 0
        while not before >> at & 1:
            at, n = at - s, n + 1
        if n:
            used[s] = used.get(s, 0) + n
    return used


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[pd.DataFrame, int, int]:
    """Where pieces go, from length -> count: (runs, sequences filled whole, length of the line).

    A run says of the pieces [lo, lo + n) of a length that `take` go to each sequence from `bin` on, from place `used`; or, if `take` is 0, that they stand in the line from place `used`.
    """
    left, lo, out, bins, line = {s: n for s, n in counts.items() if n}, dict.fromkeys(counts, 0), [], 0, 0
    if n := left.pop(capacity, 0):
        out.append((capacity, 0, n, 1, 0, 0))
        bins = n
    while left:
        window = closest(left, capacity)
        times, used = min(left[s] // k for s, k in window.items()), 0
        whole = sum(s * k for s, k in window.items()) == capacity
        for s, k in window.items():
            out.append((s, lo[s], times * k, k if whole else 0, bins if whole else 0, used if whole else line))
            lo[s] += times * k
            left[s] -= times * k
            used += s * k
            line += 0 if whole else times * k * s
            if not left[s]:
                del left[s]
        bins += times if whole else 0
    return pd.DataFrame(out, columns=["size", "lo", "n", "take", "bin", "used"]).sort_values(["size", "lo"]).reset_index(drop=True), bins, line


def ends(line: int, capacity: int = CAPACITY) -> np.ndarray:
    """Where the sequences of the last, incomplete stretch of a line begin, and the line's end: powers of two from large to small."""
    rest = line % capacity
    return np.cumsum([line - rest, *(1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1)])


def pack_tight(docs: DataFrame, path: str | None = None, fallback: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Packs all `docs` (doc_id, text are read) into sequences of `capacity` tokens or a power of two: start, length, ids_crc32, doc_tokens, sequence_id, offset, doc_id, a row for each piece.

    A text's ids are followed by id 0; a null or empty text is that id alone; a very long one is encoded whole and cut. Documents of at most `capacity` tokens are
    cut only if they stand across a cut of the line. Repeated rows and rows with a null doc_id are packed one by one. Other columns aren't read. An empty
    table gives an empty result. `fallback` is the vocabulary of `path` (ranks) for the tokenizers library.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    fallback = fallback or public_tokenizers.path("byte_bpe_50k.json")
    pieces = staged(remainders(docs, path, fallback, capacity))
    counts = staged(pieces.groupBy("part", "length").agg(F.count("*").alias("n")))
    # a row for each length
    runs, bins, line = plan({r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    ranked = pieces.drop("ids").join(before, ["part", "length"]).withColumn("rank", F.col("nth") + F.col("before")).drop("before")
    schema = fields("sequence_id long, offset long", ranked, [c for c in ranked.columns if c != "rank"])

    def place(batches):
        key = runs["size"].to_numpy(np.int64) << 40 | runs["lo"].to_numpy(np.int64)
        take, used, first, lo = (runs[c].to_numpy(np.int64) for c in ("take", "used", "bin", "lo"))
        for batch in batches:
            length, rank = batch.column("length").to_numpy().astype(np.int64), batch.column("rank").to_numpy()
            at = np.searchsorted(key, length << 40 | rank, "right") - 1
            i, k = rank - lo[at], np.maximum(take[at], 1)
            lined = take[at] == 0
            own = np.where(lined, -1, first[at] + i // k)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(used[at] + np.where(lined, i, i % k) * length), *(batch.column(c) for c in schema.names[2:])], names=schema.names)

    placed = staged(ranked.mapInArrow(place, schema))
    release(counts)
    # the pieces in the line, with their ids; few as a rule, and Spark knows the size of the table
    lined = staged(placed.where("sequence_id < 0").withColumnRenamed("offset", "place").drop("sequence_id"))
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    out = fields("start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long", lined, ["doc_id"])

    def cut(batches):
        last = ends(line, capacity)
        for batch in batches:
            of, rows = [], []
            for i, (place_, ids, start, tokens) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("place", "ids", "start", "doc_tokens")), strict=True)):
                own, at = np.frombuffer(ids, "<u4"), 0
                while at < len(own):
                    p = place_ + at
                    k = int(np.searchsorted(last, p, "right")) - 1  # in the last stretch, or before it
                    begin, end, sequence = (p - p % capacity, p - p % capacity + capacity, p // capacity) if k < 0 else (last[k], last[k + 1], last[0] // capacity + k)
                    n = min(len(own) - at, int(end) - p)
                    of.append(i)
                    rows.append((start + at, n, zlib.crc32(own[at : at + n].tobytes()), tokens, bins + sequence, p - begin))
                    at += n
            yield pa.RecordBatch.from_arrays([*map(pa.array, np.array(rows, np.int64).reshape(-1, 6).T), batch.column("doc_id").take(pa.array(of, pa.int64()))], names=out.names)

    keys = ["part", "length", "nth"]
    slices = lined.join(pieces.where("ids is not null").select(*keys, "ids"), keys).mapInArrow(cut, out)
    whole = placed.where("sequence_id >= 0").withColumn("length", F.col("length").cast("long"))
    return whole.select(*names, "doc_id").union(slices.select(*names, "doc_id"))


def op13_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_tight(spark.read.parquet(f"{sf_dir}/documents.parquet"))
