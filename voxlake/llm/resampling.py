"""Target-distribution importance resampling over hashed word n-grams.

A 256-byte table lower-cases A-Z and blanks separators in the UTF-8 bytes of a text, `bytes.split` yields its words, and
the crc32 of a shorter run of words seeds that of the next longer one. Counters reduce the features of a task to counts
by bucket. Log ratios of the buckets' shares in the target and in all documents weigh each document, and Gumbel noise
from a hash of its id turns the highest scores into a sample without replacement. Ranks come from one sort by ranges.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm.common import fields, release, shuffle_partitions, staged

BUCKETS, WIDTH, LEAST_WORDS, PERCENT, SEED = 10_000, 2, 20, 25, 7
#: Bytes of a text that are split at once, and distinct features of a task that are held before they go into its buckets.
PART_BYTES, HELD = 1 << 20, 1 << 17
#: Digits, letters and all bytes beyond ASCII stay, A-Z become a-z, anything else a space.
TABLE = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def grams(text: str | None, width: int = WIDTH) -> Iterator[tuple[int, list[list[int]]]]:
    """Part by part of a text: the number of its new words, and crc32s of the runs of 1 to `width` words that end in one of them."""
    raw = (text or "").encode().translate(TABLE)
    at, before = 0, []
    while at < len(raw):
        to = raw.find(b" ", at + PART_BYTES)
        to = len(raw) if to < 0 else to
        words = before + raw[at:to].split()
        spaced = [b" " + w for w in words]
        runs, out = list(map(crc32, words)), []
        for k in range(1, width + 1):
            out.append(runs[max(0, len(before) - k + 1) :])
            runs = list(map(crc32, spaced[k:], runs))
        yield len(words) - len(before), out
        at, before = to, words[max(0, len(words) - width + 1) :] if width > 1 else []


def bucket_counts(texts: DataFrame, width: int = WIDTH, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all `texts` by bucket; what comes to the driver is one number a bucket."""

    def count(batches):
        own, seen = np.zeros(buckets, np.int64), Counter()

        def settle():
            if seen:
                np.add.at(own, np.fromiter(seen.keys(), np.int64, len(seen)) % buckets, np.fromiter(seen.values(), np.int64, len(seen)))
                seen.clear()

        for batch in batches:
            for text in batch.column(0):
                for _, runs in grams(text.as_py(), width):
                    seen.update(chain.from_iterable(runs))
                    if len(seen) > HELD:
                        settle()
        settle()
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(own[at])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for bucket, n in texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of a bucket's share in the target over its share in the source, each count plus one, rounded down."""
    s_all, t_all, n = float(source.sum()), float(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def scores(docs: DataFrame, gain: np.ndarray, width: int = WIDTH, seed: int = SEED, carried: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The `carried` columns of `docs` with n_words, n_features, weight and score; doc_id and text are read. A null doc_id is hashed as an empty one."""

    read = docs.select("doc_id", "text", *(F.col(f"`{c}`").alias(f"own {i}") for i, c in enumerate(carried)))
    schema = fields("n_words long, n_features long, weight long, score long", read, [f"own {i}" for i in range(len(carried))])

    def judge(batches):
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                n_words = n = total = 0
                for new, runs in grams(text.as_py(), width):
                    n_words += new
                    for own in runs:
                        n += len(own)
                        total += int(gain[np.array(own, np.int64) % len(gain)].sum())
                weight = total // n if n else 0
                known = "" if doc_id.as_py() is None else doc_id.as_py()
                h = int(hashlib.sha256(f"{seed}:{known}".encode()).hexdigest()[:8], 16)
                out.append((n_words, n, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
            columns = np.array(out, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), *(batch.column(f"own {i}") for i in range(len(carried)))], names=schema.names)

    scored = read.mapInArrow(judge, schema)
    return scored.select(*(F.col(f"`own {i}`").alias(c) for i, c in enumerate(carried)), "n_words", "n_features", "weight", "score")


def ranked(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """Adds rank to doc_id, n_words, score: 1, 2, ... by falling score, then doc_id, for floor(percent / 100) of the rows with at least `least_words` words; null for all others.

    Rows are dealt by ranges of (score, doc_id, place in the table), so equal rows spread over ranges too, and a row's rank is its place in its range
    after those before it. Only the sizes of the ranges are known to the driver.
    """
    spark = scored.sparkSession
    rows = staged(scored.withColumn("spot", F.monotonically_increasing_id()))
    order = [(F.col("n_words") >= least_words).desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("spot")]
    placed = staged(rows.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()))
    sizes = placed.groupBy(F.shiftright("place", 33).alias("part")).agg(F.count("*").alias("n"), F.count_if(F.col("n_words") >= least_words).alias("able")).orderBy("part").collect()
    release(rows)
    drawn = percent * sum(r.able for r in sizes) // 100
    starts = dict(zip((r.part for r in sizes), np.cumsum([0, *(r.n for r in sizes)]).tolist(), strict=False))
    # a row for each range
    begin = F.broadcast(spark.createDataFrame(list(starts.items()), "part long, begin long"))
    rank = F.col("begin") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    out = placed.withColumn("part", F.shiftright("place", 33)).join(begin, "part").withColumn("rank", F.when(rank <= drawn, rank))
    return out.drop("part", "place", "begin", "spot")


def importance(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, width: int = WIDTH, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every row of `docs` (doc_id, text are read), weighed towards `target` (text is read).

    Null and empty texts have no features and weight 0; they take part in a draw only if `least_words` is 0. Very long texts are split part by part.
    Ties go to the smaller doc_id (null first); repeated rows are drawn one by one. Other columns aren't read. An empty table gives an empty result; an
    empty target makes rare features count.
    """
    gain = gains(bucket_counts(docs, width, buckets), bucket_counts(target, width, buckets))
    return ranked(scores(docs, gain, width, seed), percent, least_words)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, width: int = WIDTH, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """The rows of `docs`, with all their columns, that `importance` draws. Texts aren't shuffled: the last row drawn is found first, and rows at or before it stay.

    Rows that repeat both doc_id and score of the last one drawn all stay. A column of `docs` called n_words, n_features, weight or score is kept as it is.
    """
    gain = gains(bucket_counts(docs, width, buckets), bucket_counts(target, width, buckets))
    last = ranked(scores(docs, gain, width, seed), percent, least_words).where(F.col("rank").isNotNull()).orderBy(F.desc("rank")).select("score", "doc_id").first()
    if last is None:
        return docs.limit(0)
    row = docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    own = scores(row, gain, width, seed, carried=("row", "doc_id"))
    tie = F.col("doc_id").isNull() if last.doc_id is None else F.coalesce(F.col("doc_id") <= F.lit(last.doc_id), F.lit(True))
    return own.where((F.col("n_words") >= least_words) & ((F.col("score") > last.score) | ((F.col("score") == last.score) & tie))).select("row.*")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return importance(docs, target).drop("n_words")


SQL = r"""WITH texts AS (
  SELECT 'd' AS side, doc_id AS id, coalesce(text, '') AS text FROM documents UNION ALL SELECT 'b', item_id, coalesce(text, '') FROM benchmark),
split AS (SELECT side, id, list_filter(string_split(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM texts),
features AS (
  SELECT side, id, unnest(w) AS f FROM split UNION ALL
  SELECT side, id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM split WHERE len(w) > 1),
counted AS (SELECT side, id, f, count(*) AS n FROM features GROUP BY ALL),
-- crc32 of the bytes of each distinct feature, a byte and then its eight bits at a time (-1)
bytes AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM counted)),
hashed AS (
  SELECT f, xor(4294967295, list_reduce(list_transform(range(0, 9 * (length(h) // 2)), lambda k: CASE WHEN k % 9 = 0 THEN ('0x' || substr(h, 2 * (k // 9) + 1, 2))::BIGINT ELSE -1 END),
    lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, 3988292384 * (c & 1)) END, 4294967295::BIGINT)) % 10000 AS bucket FROM bytes),
own AS (SELECT side, id, bucket, sum(n) AS n FROM counted JOIN hashed USING (f) GROUP BY ALL),
sides AS (SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE AS t FROM own GROUP BY bucket),
gain AS (SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM sides) + 10000) / ((s + 1) * ((SELECT sum(t) FROM sides) + 10000))))::BIGINT AS g FROM sides),
weighed AS (SELECT id, sum(n)::BIGINT AS n_features, floor(sum(n * g)::DOUBLE / sum(n))::BIGINT AS weight FROM own JOIN gain USING (bucket) WHERE side = 'd' GROUP BY id),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS able,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents LEFT JOIN weighed ON doc_id = weighed.id JOIN split ON split.side = 'd' AND split.id = doc_id)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) <= 25 * count(*) OVER (PARTITION BY able) // 100
  THEN row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) END AS rank FROM scored"""
