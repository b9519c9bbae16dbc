"""What the operators share: staged tables, text batches as byte arrays, and word hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

#: Bytes of text that one vectorised step inside a task works on; a longer text is a step of its own.
STEP_BYTES = 1 << 20

#: `[\x20\x09-\x0D]`
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RNG = np.random.default_rng(20240607)
_BYTE_CODE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = np.zeros(0, np.uint64)


def shared_dir(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`; where none is set (tests), a new local one, set for the session."""
    sc = spark.sparkContext
    where = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not where:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = tempfile.mkdtemp(prefix="spark-voxlake-", dir="/tmp")
        sc.setCheckpointDir(where)
    return where.rstrip("/")


def staged(df: DataFrame) -> DataFrame:
    """Writes `df` as a Parquet table in the shared folder and reads it back: cuts lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/voxlake-stage-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Deletes staged tables that no later step reads."""
    for t in tables:
        if path := getattr(t, "_staged_path", None):
            jvm = t.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(t.sparkSession._jsparkSession.sparkContext().hadoopConfiguration()).delete(where, True)


def fields(ddl: str, rows: DataFrame, columns: list[str]) -> StructType:
    """The schema `ddl`, followed by `columns` of `rows` with their types, whatever their names."""
    return StructType([*StructType.fromDDL(ddl), *(StructField(c, rows.schema[c].dataType) for c in columns)])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def places(n: int) -> np.ndarray:
    """A fixed odd number for each of the first n places of a span."""
    global _PLACES
    if len(_PLACES) < n:
        _PLACES = mix(np.arange(1, (1 << (n - 1).bit_length()) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return _PLACES


def steps(batch: pa.RecordBatch, column: str = "text", end: str = " ", most: int = STEP_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cuts a batch into runs of rows of about `most` bytes: (rows, their UTF-8 bytes, offsets). Each text is followed by `end`; null texts are empty."""
    texts = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
    if end:
        texts = pc.binary_join_element_wise(texts, pa.scalar("", pa.large_string()), pa.scalar(end, pa.large_string()))
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def span_hash(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end) of a sequence of 64-bit codes, equal for equal spans wherever they stand: each code times the number of its place in the span, summed. Spans can be
    built that share a hash, so it names candidates and features, and decides nothing."""
    size = ends - starts
    longest, total = int(size.max(initial=0)), int(size.sum())
    by = places(longest)
    if total > 2 * len(codes) or longest < 8:  # spans overlap: place by place
        out = np.zeros(len(starts), np.uint64)
        for k in range(longest):
            own = size > k
            out[own] += codes[starts[own] + k] * by[k]
    else:
        first = np.cumsum(size) - size
        place = np.arange(total) - np.repeat(first, size)
        sums = np.zeros(total + 1, np.uint64)
        np.cumsum(codes[np.repeat(starts, size) + place] * by[place], out=sums[1:])
        out = sums[first + size] - sums[first]
    return mix(out + size.astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words `[^\\x20\\x09-\\x0D]+` of texts that each end in a space: (starts, ends, row of each, hashes); A-Z may be lower-cased."""
    gap = SPACE[data]
    edge = np.diff(np.concatenate(([True], gap)).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    row = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, row, span_hash(_BYTE_CODE[LOWER[data] if lower else data], starts, ends)


class _Names(dict):
    """A 64-bit name of each word met, by a cryptographic hash."""

    def __missing__(self, word: bytes) -> int:
        self[word] = name = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return name


_NAMES = _Names()
#: Names that are kept from step to step.
MOST_NAMES = 1 << 18


def named_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of each, name) of the words, as `words` has them, lower-cased; names are hashes for which no two words can be built that share one but by trying some 2^32."""
    if len(_NAMES) > MOST_NAMES:
        _NAMES.clear()
    held = LOWER[data].tobytes().split()
    gap = np.concatenate(([True], SPACE[data]))
    starts = np.flatnonzero(gap[:-1] & ~gap[1:])
    return np.searchsorted(offsets, starts, "right") - 1, np.fromiter(map(_NAMES.__getitem__, held), np.uint64, len(held))


def chained(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of short spans [start, end) of codes, one code after the other: no sum, whose parts could be made to cancel."""
    size = ends - starts
    out = mix(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    for k in range(int(size.max(initial=0))):
        own = size > k
        out[own] = mix(out[own] * np.uint64(0xD6E8FEB86659FD93) + codes[starts[own] + k])
    return out


def byte_codes(data: np.ndarray) -> np.ndarray:
    return _BYTE_CODE[data]
