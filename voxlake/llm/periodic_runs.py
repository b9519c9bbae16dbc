"""Periodic runs of words, by a harmonic grid of longest common extensions over a difference cover.

Words become numbers, text by text of a step, each text followed by a number of its own. A run with period q keeps at
least g = max(q, 12 - q) neighbouring places whose word equals the one q further on, so it shows at some multiple of g.
There the words q apart are compared forwards and backwards; all the places of all periods are n log n. A comparison
looks at a few words first. Where these agree, both places reach sampled places within as many words, as the residues of
a difference cover have all differences: the suffixes that begin at samples are sorted by prefix doubling, and the
extension is the least of the common prefixes between the two in that order, a range minimum in a sparse table.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from voxlake.llm.common import fields

LEAST = 12
#: Differences of these residues give every number modulo COVER.
COVER, RESIDUES = 13, np.array([0, 1, 3, 9])
#: Words of a step (a longer text is a step of its own), and places of the grid that are looked at together.
STEP_WORDS, PLACES = 1 << 17, 1 << 20

_SLOT = np.full(COVER, -1)
_SLOT[RESIDUES] = np.arange(len(RESIDUES))
#: [i % COVER, j % COVER] -> least d for which i + d and j + d are both sampled
_REACH = np.array([[next(d for d in range(COVER) if _SLOT[(i + d) % COVER] >= 0 and _SLOT[(j + d) % COVER] >= 0) for j in range(COVER)] for i in range(COVER)])


def agree(w: np.ndarray, i: np.ndarray, j: np.ndarray, most: int, step: int = 1) -> np.ndarray:
    """How many words agree from places i and j on, up to `most`, forwards or (step -1) backwards; i < j, and places outside of w agree with none."""
    out, live = np.zeros(len(i), np.int64), np.arange(len(i))
    for k in range(most):
        a, b = i[live] + k * step, j[live] + k * step
        inside = (a >= 0) & (b < len(w))
        live, a, b = live[inside], a[inside], b[inside]
        live = live[w[a] == w[b]]
        if not len(live):
            break
        out[live] += 1
    return out


class Extensions:
    """Longest common extensions of places in a sequence of numbers from 0 on that ends in a number found nowhere else."""

    def __init__(self, w: np.ndarray):
        self.w = w
        n, width = len(w), len(RESIDUES)
        at = (np.arange(-(-n // COVER))[:, None] * COVER + RESIDUES).ravel()
        at = at[: np.searchsorted(at, n)]
        m = len(at)
        # names of the first COVER words, several packed into one key
        padded, bits = np.concatenate((w + 1, np.zeros(COVER, np.int64))), int(w.max() + 1).bit_length()
        each, keys = max(1, 63 // bits), []
        for k in range(0, COVER, each):
            key = np.zeros(m, np.int64)
            for c in range(k, min(k + each, COVER)):
                key = key << bits | padded[at + c]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.ones(m, bool)
        new[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)
        rank = np.empty(m, np.int32)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(m), 0))
        levels, ahead = [rank], width
        while True:  # a rank is the place of the first of its equals; only those that have equals go on
            share = np.bincount(rank, minlength=m)
            open_ = np.flatnonzero(share[rank] > 1)
            if not len(open_):
                break
            then = open_ + ahead
            then = np.where(then < m, rank[np.minimum(then, m - 1)], -1).astype(np.int64)
            key = rank[open_].astype(np.int64) * (m + 1) + then + 1
            own = np.argsort(key, kind="stable")
            key, open_ = key[own], open_[own]
            group, places = key // (m + 1), np.arange(len(key))
            first = np.maximum.accumulate(np.where(np.append(True, group[1:] != group[:-1]), places, 0))
            lead = np.maximum.accumulate(np.where(np.append(True, key[1:] != key[:-1]), places, 0))
            rank = rank.copy()
            rank[open_] = group + lead - first
            levels.append(rank)
            ahead *= 2
        order = np.empty(m, np.int64)
        order[rank] = np.arange(m)
        # common prefixes of neighbours: the longest stretches of equal names first
        a, b = order[:-1], order[1:]
        shared = np.zeros(m - 1, np.int64)
        for k in range(len(levels) - 1, -1, -1):
            inside = (a < m) & (b < m)
            same = inside & (levels[k][np.minimum(a, m - 1)] == levels[k][np.minimum(b, m - 1)])
            shared += same * (COVER << k)
            a, b = a + same * (width << k), b + same * (width << k)
        del levels
        i, j = at[order[:-1]] + shared, at[order[1:]] + shared
        shared += agree(w, np.minimum(i, j), np.maximum(i, j), COVER - 1)
        self.rank, self.table = rank, [shared.astype(np.int32)]
        while 2 << len(self.table) - 1 < m:
            t, k = self.table[-1], 1 << len(self.table) - 1
            self.table.append(np.minimum(t[:-k], t[k:]))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For i < j that agree in COVER words at least."""
        reach = _REACH[i % COVER, j % COVER]
        a, b = (self.rank[(p // COVER) * len(RESIDUES) + _SLOT[p % COVER]].astype(np.int64) for p in (i + reach, j + reach))
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        k = np.frexp((hi - lo).astype(np.float64))[1] - 1  # floor of the logarithm
        out = np.empty(len(i), np.int64)
        for level in np.unique(k):
            own = k == level
            out[own] = np.minimum(self.table[level][lo[own]], self.table[level][hi[own] - (1 << level)])
        return reach + out


def find_runs(texts: list[np.ndarray], least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs in texts of word numbers, by text, start and period: maximal stretches with smallest period q of length >= max(least, 2 q)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes + 1)))
    top = max((int(t.max()) for t in texts if len(t)), default=-1)
    w = np.concatenate([x for k, t in enumerate(texts) for x in (t, [top + 1 + k])]) if texts else np.zeros(0, np.int64)
    longest = int(sizes.max(initial=0))
    periods = np.arange(1, longest // 2 + 1) if longest >= least else np.zeros(0, np.int64)
    gaps = np.maximum(periods, least - periods)
    each = -(-np.maximum(len(w) - periods, 0) // gaps)
    groups = np.searchsorted(np.cumsum(each), np.arange(0, each.sum() + PLACES, PLACES)) if len(each) else [0, 0]
    settled, waiting = [], []
    for p, to in zip(groups, [*groups[1:], len(periods)], strict=True):
        n = each[p:to]
        i = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * np.repeat(gaps[p:to], n)
        q = np.repeat(periods[p:to], n)
        own = w[i] == w[i + q]
        i, q = i[own], q[own]
        ahead, back = agree(w, i, i + q, COVER), agree(w, i - 1, i + q - 1, COVER, -1)
        more = (ahead == COVER) | (back == COVER)
        waiting.append(np.stack((i[more], q[more])))
        own = ~more & (ahead + back >= np.maximum(q, least - q))
        settled.append(np.stack((i[own] - back[own], i[own] + q[own] + ahead[own], q[own])))
    i, q = np.concatenate(waiting, axis=1) if waiting else np.zeros((2, 0), np.int64)
    if len(i):
        # only the texts that still wait are sorted
        of = np.searchsorted(begins, i, "right") - 1
        some = np.unique(of)
        part = np.concatenate([w[begins[k] : begins[k + 1]] for k in some])
        _, part = np.unique(part, return_inverse=True)
        moved = begins[some] - (np.cumsum(begins[some + 1] - begins[some]) - (begins[some + 1] - begins[some]))
        shift = moved[np.searchsorted(some, of)]
        found = []
        for x, a, b in ((part, i - shift, i + q - shift), (None, len(part) - i - q + shift, len(part) - i + shift)):
            # backwards: the same in the reversed sequence, whose last place must be unlike all others
            x = np.append(part[::-1], part.max() + 1) if x is None else x
            near = agree(x, a, b, COVER)
            far = near == COVER
            if far.any():
                near[far] = Extensions(x)(a[far], b[far])
            found.append(near)
        ahead, back = found
        own = ahead + back >= np.maximum(q, least - q)
        settled.append(np.stack((i[own] - back[own], i[own] + q[own] + ahead[own], q[own])))
    start, end, q = np.concatenate(settled, axis=1) if settled else np.zeros((3, 0), np.int64)
    # a stretch is found at several places and with multiples of its period: the smallest counts
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    first = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))[: len(start)]
    start, end, q = start[first], end[first], q[first]
    order = np.lexsort((q, start))
    start, end, q = start[order], end[order], q[order]
    of = np.searchsorted(begins, start, "right") - 1
    return of, start - begins[of], end - start, q


def collapse_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period, by start and period) and kept_text (words joined by one space) of every row; doc_id and text are read.

    Words are `[^\\x20\\x09-\\x0D]+` of the whole text, numbered from 0. A run is a stretch of words with smallest period q, of at least max(least, 2 q) words, that
    can't be extended; of its words only the first q stay, unless another run drops them. Null and empty texts have no words. A text of any length is looked at as
    a whole, by one task. Repeated rows, equal and null ids are judged row by row. Other columns aren't read. An empty table gives an empty result.
    """
    rows = docs.select("doc_id", "text")
    kind = to_arrow_type(rows.schema["doc_id"].dataType)
    schema = fields("n_words long, runs array<struct<start: long, length: long, period: long>>, kept_text string", rows, ["doc_id"])

    def judge(ids: list, held: list[list[bytes]]) -> pa.RecordBatch:
        number = defaultdict(count().__next__)
        of, start, length, period = find_runs([np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in held], least)
        at, kept = np.searchsorted(of, np.arange(len(held) + 1)), []
        for k, w in enumerate(held):
            if at[k] < at[k + 1]:
                own = slice(at[k], at[k + 1])
                edge = np.zeros(len(w) + 1, np.int64)
                np.add.at(edge, start[own] + period[own], 1)
                np.add.at(edge, start[own] + length[own], -1)
                w = compress(w, (np.cumsum(edge) == 0).tolist())
            kept.append(b" ".join(w))
        runs = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], ["start", "length", "period"])
        return pa.RecordBatch.from_arrays(
            [pa.array([len(w) for w in held], pa.int64()), pa.ListArray.from_arrays(pa.array(at, pa.int32()), runs), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(ids, kind)], names=schema.names
        )

    def work(batches):
        for batch in batches:
            ids, held, n = [], [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                own = (text.as_py() or "").encode().split()
                if held and n + len(own) > STEP_WORDS:
                    yield judge(ids, held)
                    ids, held, n = [], [], 0
                ids.append(doc_id)
                held.append(own)
                n += len(own)
            if held:
                yield judge(ids, held)

    return rows.mapInArrow(work, schema).select("doc_id", "n_words", "runs", "kept_text")


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which the words of one document of ten, by the crc32 of its id (a null id counts as an empty text), repeat from some place on."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    own = docs.select("doc_id", "text", h.alias("h")).withColumn("w", words).withColumn("a", F.expr("cast(h div 10 % nullif(size(w), 0) as int)"))
    own = own.withColumn("p", F.expr("cast(1 + (size(w) - a) div (3 + h div 10 % 8) as int)"))
    repeated = F.array_join(F.expr("transform(w, (x, i) -> if(i < a, x, w[a + (i - a) % p]))"), " ")
    return own.select("doc_id", F.when(F.size("w") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse_runs(planted(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    # the longest run; of equal ones the first, then the one of smaller period
    top = found.withColumn("top", F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))"))
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return top.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"), (-F.col("top.period")).alias("period"),
        F.expr("1000 * top.length div -top.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("kept_text", 256).alias("collapsed_sha256"),
    )
