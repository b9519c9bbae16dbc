"""Best-fit packing of token sequences, bulk-synchronously.

Documents (or their pieces) and the gaps of open sequences are sorted by size. A round deals both out by ranges of
size; each range is swept from large to small, so that every document meets its successor, the smallest gap left that
takes it; documents that want the same gap get it in the order of their rank, and the rest of the range's documents and
gaps go on to a sweep across ranges. Filled gaps shrink and take part in the next round. Sizes are whole numbers up to
the capacity, so documents of one length, and sequences with one gap, are kept as runs (first rank, count): a round
works on runs, whose number depends on the capacity and not on the number of documents.
"""

from __future__ import annotations

import base64
import heapq
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from voxlake.llm.common import shuffle_partitions, staged

CAPACITY, RANGES = 2048, 16
_RUN = "kind string, size int, lo long, n long, used int, take int, bin long"
_encoders: dict = {}


def _encode(path: str, fallback: str):
    """text -> uint32 ids by the byte-level BPE at `path` (ranks); `fallback` is the same vocabulary for the tokenizers library, which takes what the faster one refuses."""
    if path not in _encoders:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
        fast = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": 50256})

        def encode(text: str) -> np.ndarray:
            try:
                return fast.encode_to_numpy(text, allowed_special="all", disallowed_special=())
            except BaseException as e:  # noqa: BLE001 - a panic of the library on a pathological text isn't an Exception
                if isinstance(e, KeyboardInterrupt | SystemExit | MemoryError):
                    raise
                from tokenizers import Tokenizer

                return np.array(Tokenizer.from_file(fallback).encode(text, add_special_tokens=False).ids, np.uint32)

        _encoders[path] = encode
    return _encoders[path]


def token_pieces(docs: DataFrame, path: str, fallback: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most `capacity` tokens: doc_id, piece, start, length, ids_crc32. A text's ids are followed by id 0; if cut, the first piece is the short one."""

    def cut(batches):
        encode = _encode(path, fallback)
        for batch in batches:
            of, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column("text")):
                ids = np.append(encode(text.as_py() or ""), np.uint32(0)).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    of.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].data))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(of, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def _sweep(runs: pd.DataFrame) -> pd.DataFrame:
    """Matches the document runs of one range with its gap runs, from large to small.

    A gap run takes several documents of a length at once where enough are left; what remains of it joins the sweep
    again where its new size is due.
    """
    out, stack, due = [], [], []
    gaps = runs[runs.kind == "gap"].sort_values(["size", "lo"])
    docs = runs[runs.kind == "doc"].sort_values(["size", "lo"], ascending=[False, True])
    waiting = list(zip(gaps["size"], gaps.lo, gaps.n, gaps.used, strict=True))
    for size, lo, n in zip(docs["size"], docs.lo, docs.n, strict=True):
        while True:
            while waiting and waiting[-1][0] >= size and (not due or waiting[-1][0] >= -due[0][0]):
                stack.append(waiting.pop())
            while due and -due[0][0] >= size:
                g = heapq.heappop(due)
                stack.append((-g[0], *g[1:]))
                while waiting and waiting[-1][0] >= size and (not due or waiting[-1][0] >= -due[0][0]):
                    stack.append(waiting.pop())
            if not n or not stack:
                break
            g, first, bins, u = stack.pop()
            take = min(g // size, n)
            full = min(bins, n // take)
            out.append(("put", size, lo, full * take, u, take, first))
            if g > take * size:
                heapq.heappush(due, (take * size - g, first, full, u + take * size))
            if full < bins:
                stack.append((g, first + full, bins - full, u))
            lo, n = lo + full * take, n - full * take
        if n:
            out.append(("doc", size, lo, n, 0, 0, 0))
    left = [*stack, *waiting, *((-g[0], *g[1:]) for g in due)]
    out += [("gap", g, first, bins, u, 0, 0) for g, first, bins, u in left]
    return pd.DataFrame(out, columns=["kind", "size", "lo", "n", "used", "take", "bin"])


def _placed(lengths: DataFrame, capacity: int) -> DataFrame:
    """Runs placed, from (size, n): ranks [lo, lo + n) of a size go, `take` to a sequence, to sequences from `bin` on, at offset `used`.

    Sizes take part band by band, from large to small. In a band, sweeps within ranges of size and then across them
    are repeated while they place something; then new sequences are opened for what is left.
    """
    spark = lengths.sparkSession
    run = lambda kind, size, n, lo=0: [F.lit(kind).alias("kind"), size.cast("int").alias("size"), F.lit(lo).cast("long").alias("lo"), n.cast("long").alias("n"), F.lit(0).alias("used"), F.lit(0).alias("take"), F.lit(0).cast("long").alias("bin")]
    runs = staged(lengths.select(*run("doc", F.col("size"), F.col("n"))))
    puts, bins, top = [], 0, capacity
    while top:
        least = capacity // (capacity // top + 1) + 1 if top > capacity // 4 else top // 2 + 1 if top > capacity // 32 else 1
        waits = (F.col("kind") == "doc") & F.col("size").between(least, top)
        left = lambda df: df.agg(F.sum(F.when(waits, F.col("n"))), F.max(F.when(waits, F.col("size"))), F.sum(F.when(waits, F.col("n") * F.col("size"))), F.count_if(F.col("kind") == "put")).first()  # noqa: B023, E731
        state, width = left(runs), -(-capacity // RANGES)
        while state[0]:
            plays = waits | ((F.col("kind") == "gap") & (F.col("size") >= least))
            swept = runs.where(plays).groupBy(F.floor(F.col("size") / width)).applyInPandas(_sweep, _RUN).coalesce(4).unionByName(runs.where(~plays & (F.col("kind") != "put")))
            swept = staged(swept.coalesce(4))
            state = left(swept)
            if state[3]:
                puts.append(swept.where("kind = 'put'"))
            runs = swept.where("kind <> 'put'")
            if width <= capacity:
                width = capacity + 1
            elif not state[3] and state[0]:
                each = capacity // state[1]
                new = max(1, -(-state[0] // each)) if each < 4 else -(-int(state[2]) // capacity)
                runs = runs.unionByName(spark.range(1).select(*run("gap", F.lit(capacity), F.lit(new), bins)))
                bins += new
        top = least - 1
    out = puts[0]
    for p in puts[1:]:
        out = out.unionByName(p)
    return out.coalesce(4)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows with a `length` of 1 to `capacity`: each sequence is filled without gaps from 0, few sequences are used.

    Rows are not merged: repeated rows are placed one by one, and of rows with one length it makes no difference which goes where. All columns are kept,
    whatever their names; only those called sequence_id and offset are replaced. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset")
    salts = shuffle_partitions(spark)
    order = [c for c in pieces.columns if c != "length"]
    # the row travels as one column, so that no name of its own can clash
    dealt = pieces.select(F.struct(*(F.col(f"`{c}`") for c in pieces.columns)).alias("row"), F.col("length").cast("int").alias("size"), F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in order), F.lit(0)), F.lit(salts)).cast("int").alias("salt"))
    counts = staged(dealt.groupBy("size", "salt").agg(F.count("*").alias("n")))
    if counts.isEmpty():
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    placed = _placed(counts.groupBy("size").agg(F.sum("n").alias("n")), capacity)
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))).drop("n")
    rank = F.row_number().over(Window.partitionBy("size", "salt").orderBy("row")) - 1
    ranked = dealt.withColumn("rank", rank).join(before.hint("merge"), ["size", "salt"]).select("row", "size", (F.col("rank") + F.coalesce("before", F.lit(0))).cast("long").alias("rank"))
    # runs placed: bounded by the capacity and the number of rounds
    table = spark.sparkContext.broadcast(placed.toPandas().sort_values(["size", "lo"]).reset_index(drop=True))

    def place(batches):
        t = table.value
        key = t["size"].to_numpy(np.int64) << 40 | t.lo.to_numpy(np.int64)
        for batch in batches:
            size, r = batch.column("size").to_numpy().astype(np.int64), batch.column("rank").to_numpy()
            at = np.searchsorted(key, size << 40 | r, "right") - 1
            i, take = r - t.lo.to_numpy()[at], t["take"].to_numpy()[at]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(t.bin.to_numpy()[at] + i // take, pa.int64()), pa.array(t.used.to_numpy()[at] + i % take * size, pa.int64())], names=["row", "sequence_id", "offset"])

    out = ranked.mapInArrow(place, StructType([dealt.schema["row"], *StructType.fromDDL("sequence_id long, offset long")]))
    return out.select("row.*", "sequence_id", "offset")


def pack_documents(docs: DataFrame, path: str | None = None, fallback: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Packs all `docs` (doc_id, text are read) into few sequences of at most `capacity` tokens: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the closing id alone; a very long one is encoded whole and cut. Repeated rows and rows with a null doc_id are packed like
    others. Other columns aren't read. An empty table gives an empty result.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    fallback = fallback or public_tokenizers.path("byte_bpe_50k.json")
    return pack(staged(token_pieces(docs, path, fallback, capacity)), capacity)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
