"""Line dedup: lines that many documents share stay in one document only.

Two Bloom filters over the hashes of lines, one for hashes seen once and one for hashes seen twice, are filled by
all tasks and merged segment by segment (many lines of a segment first in parts, whose bits are then joined). Only lines that the second filter suspects are shuffled; an exact count by
a 128-bit digest of the line's key confirms them and chooses the occurrence that stays.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm.common import LOWER, SPACE, byte_codes, fields, span_hash, staged, steps

#: The filters have this many bits a line, from 2^20 bits up to 2^28 (32 MB for the one that is broadcast). Beyond
#: 2^28 / BITS_A_LINE lines the share of false suspects rises, up to shuffling all lines; the result is the same.
BITS_A_LINE, LEAST_BITS, MOST_BITS = 8, 20, 28
SEGMENT_BITS = 20
#: Lines, about, that one task sets the bits of.
PART_LINES = 1 << 24


def _lines(data: np.ndarray, offsets: np.ndarray, least_chars: int):
    """Of texts each ending in a newline: line starts, ends, rows, and of stripped keys: starts, ends, whether long enough."""
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    row = np.searchsorted(offsets, starts, "right") - 1
    solid = np.flatnonzero(~SPACE[data])
    first = np.searchsorted(solid, starts)
    last = np.searchsorted(solid, ends) - 1
    some = last >= first
    a = np.where(some, solid[np.minimum(first, max(len(solid) - 1, 0))] if len(solid) else 0, starts)
    b = np.where(some, solid[np.maximum(last, 0)] + 1 if len(solid) else 0, starts)
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    return starts, ends, row, a, b, some & (chars[b] - chars[a] >= least_chars)


def _hashed(data, offsets, least_chars):
    """Distinct (row, key hash) of the long lines of each row, with one line of each."""
    starts, ends, row, a, b, long = _lines(data, offsets, least_chars)
    at = np.flatnonzero(long)
    h = span_hash(byte_codes(LOWER[data]), a[at], b[at])
    return starts, ends, row, a, b, at, h


def _filters(docs: DataFrame, least_chars: int, bits: int, n_lines: int) -> np.ndarray:
    """The twice-seen filter: the bits that two or more (document, line key) insertions set."""
    parts, mask = 1 << (bits - SEGMENT_BITS), np.uint64((1 << bits) - 1)
    salts = max(1, -(-n_lines // (parts * PART_LINES)))

    def insert(batches):
        held, salt = [], TaskContext.get().partitionId() % salts

        def flush():
            spot, times = np.unique(np.concatenate(held), return_counts=True)
            segment = (spot >> SEGMENT_BITS).astype(np.int64)
            cuts = np.searchsorted(segment, np.arange(parts + 1))
            low = (spot & ((1 << SEGMENT_BITS) - 1)).astype(np.uint32)
            some = [s for s in range(parts) if cuts[s] < cuts[s + 1]]
            own = [(low[cuts[s] : cuts[s + 1]], low[cuts[s] : cuts[s + 1]][times[cuts[s] : cuts[s + 1]] > 1]) for s in some]
            return pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array([salt] * len(some), pa.int32()), pa.array([x.tobytes() for x, _ in own], pa.binary()), pa.array([y.tobytes() for _, y in own], pa.binary())], names=["segment", "salt", "once", "twice"]
            )

        for batch in batches:
            for _, data, offsets in steps(batch, end="\n"):
                *_, row, _, _, at, h = _hashed(data, offsets, least_chars)
                one = np.unique(np.stack([row[at].astype(np.uint64), h], 1), axis=0)[:, 1] if len(at) else h
                held.append((one & mask).astype(np.int64))
            if sum(map(len, held)) > 2_000_000:
                yield flush()
                held = []
        if sum(map(len, held)):
            yield flush()

    def merge(key, rows: pd.DataFrame) -> pd.DataFrame:
        once, twice = np.zeros(1 << SEGMENT_BITS, bool), np.zeros(1 << SEGMENT_BITS, bool)
        for x, y in zip(rows["once"], rows["twice"], strict=True):
            spot = np.frombuffer(x, np.uint32)
            twice[spot[once[spot]]] = True
            once[spot] = True
            twice[np.frombuffer(y, np.uint32)] = True
        return pd.DataFrame({"segment": [key[0]], "once": [np.packbits(once).tobytes()], "twice": [np.packbits(twice).tobytes()]})

    def join(key, rows: pd.DataFrame) -> pd.DataFrame:
        once, twice = np.zeros(1 << (SEGMENT_BITS - 3), np.uint8), np.zeros(1 << (SEGMENT_BITS - 3), np.uint8)
        for x, y in zip(rows["once"], rows["twice"], strict=True):
            x = np.frombuffer(x, np.uint8)
            twice |= np.frombuffer(y, np.uint8) | (once & x)
            once |= x
        return pd.DataFrame({"segment": [key[0]], "twice": [twice.tobytes()]})

    merged = docs.select("text").mapInArrow(insert, "segment int, salt int, once binary, twice binary").groupBy("segment", "salt").applyInPandas(merge, "segment int, once binary, twice binary")
    rows = (merged if salts == 1 else merged.groupBy("segment").applyInPandas(join, "segment int, twice binary")).select("segment", "twice").collect()
    out = np.zeros((parts, 1 << (SEGMENT_BITS - 3)), np.uint8)
    for r in rows:  # at most 2^(MOST_BITS - SEGMENT_BITS) rows of 128 KB
        out[r["segment"]] = np.frombuffer(r["twice"], np.uint8)
    return out.ravel()


def dedup_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3, others: tuple[str, ...] = ()) -> DataFrame:
    """Drops repeated lines of `docs` (doc_id and text are read; the columns `others` are handed through).

    A text is split at \\n; a line's key is the line stripped of `[\\x20\\x09-\\x0D]` with A-Z lower-cased. A key of at
    least `least_chars` code points in at least `least_docs` documents loses all its lines except in the largest
    doc_id that holds it (all its lines there stay). Returns doc_id, n_lines, n_dropped, kept_text and `others`, a row for each row.

    A null or empty text is one empty line (kept_text is then ''); a very long one is worked on whole, in a step of its own. Rows that repeat a doc_id
    are one document when a key's documents are counted; each gets its own row, cut by its own text. A null doc_id counts as one document, that of the
    smallest long. An empty table gives an empty result. Columns of `docs` that clash with those added are lost unless they are read (name them otherwise).
    """
    spark, others = docs.sparkSession, [c for c in others if c not in ("doc_id", "text", "n_lines", "n_dropped", "kept_text", "tag", "lines")]
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *others).withColumn("tag", F.xxhash64("text"))
    n_lines = docs.agg(F.sum(F.length("text") - F.length(F.translate("text", "\n", "")) + 1)).first()[0] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, int(n_lines * BITS_A_LINE).bit_length()))
    twice = spark.sparkContext.broadcast(_filters(docs, least_chars, bits, n_lines))

    def suspect(batches):
        table, mask = twice.value, np.uint64((1 << bits) - 1)
        for batch in batches:
            for rows, data, offsets in steps(batch, end="\n"):
                starts, ends, row, a, b, at, h = _hashed(data, offsets, least_chars)
                spot = h & mask
                hit = at[(table[spot >> np.uint64(3)] >> (7 - (spot & np.uint64(7))).astype(np.uint8)) & 1 == 1]
                low = LOWER[data].tobytes()
                first = np.searchsorted(row, np.arange(rows.num_rows))
                of = pa.array(row[hit])
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id").take(of), rows.column("tag").take(of), pa.array((hit - first[row[hit]]).astype(np.int32)), pa.array([hashlib.md5(low[a[i] : b[i]]).digest() for i in hit], pa.binary())],
                    names=["doc_id", "tag", "line", "key"],
                )

    kind, least = docs.schema["doc_id"].dataType.simpleString(), F.lit(-(1 << 63))
    suspects = staged(docs.select("doc_id", "text", "tag").mapInArrow(suspect, f"doc_id {kind}, tag long, line int, key binary"))
    # written before it is joined, so that the join can split a key that very many documents hold
    shared = staged(suspects.select("key", F.coalesce("doc_id", least).alias("d")).distinct().groupBy("key").agg(F.count("*").alias("n"), F.max("d").alias("keeper")).where(F.col("n") >= least_docs))
    gone = (
        suspects.join(shared, "key").where(F.coalesce("doc_id", least) < F.col("keeper")).select("doc_id", "tag", "line").distinct()
        .groupBy("doc_id", "tag").agg(F.collect_list("line").alias("lines"))
    )
    same = docs["doc_id"].eqNullSafe(gone["doc_id"]) & (docs["tag"] == gone["tag"])
    found = docs.join(gone, same, "left").select(docs["doc_id"], "text", "lines", *(docs[c] for c in others))

    def cut(batches):
        for batch in batches:
            n, dropped, kept = [], [], []
            for text, lines in zip(batch.column("text").to_pylist(), batch.column("lines").to_pylist(), strict=True):
                own = text.count("\n") + 1
                if lines:
                    off = set(lines)
                    text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in off)
                n.append(own)
                dropped.append(len(lines or ()))
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string()), *(batch.column(c) for c in others)], names=["doc_id", "n_lines", "n_dropped", "kept_text", *others]
            )

    return found.mapInArrow(cut, fields(f"doc_id {kind}, n_lines long, n_dropped long, kept_text string", docs, others))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = """
WITH l AS (
  SELECT doc_id, pos, line, translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents)),
s AS (SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT l.doc_id, pos, line, keeper IS NOT NULL AND l.doc_id < keeper AS gone FROM l LEFT JOIN s USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
