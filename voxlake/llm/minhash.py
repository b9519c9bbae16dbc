"""Near-duplicate documents by min-max hashing of word shingles.

Every permutation gives two components of a signature, the smallest and the largest value of a document's shingles
under it, so half as many hashes are evaluated as by minima alone. Bands of the signature name candidates; links are
confirmed on the full shingle sets. Documents with equal sets form one class that is compared once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxlake.llm.common import chained, mix, named_words, staged, steps
from voxlake.llm.components import components

#: 44 bands of 8 components from 176 permutations: two sets of Jaccard similarity s share a band with probability
#: 1 - (1 - s^8)^44: 0.9999991 at 0.85, 0.9997 at 0.8, 0.16 at 0.5, 0.003 at 0.3.
BANDS, ROWS = 44, 8
#: Rounds in which a bucket's members are compared with one of them.
STARS = 3
_RNG = np.random.default_rng(97)
_HASHES = BANDS * ROWS // 2
_MULTIPLY = (_RNG.integers(0, 1 << 31, _HASHES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_XOR = _RNG.integers(0, 1 << 32, _HASHES, dtype=np.uint32)
_BAND_SALT = mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def shingles(data: np.ndarray, offsets: np.ndarray, n_rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, text by text: (hashes, offsets). Fewer words than `width` are one shingle, no words none."""
    row, h = named_words(data, offsets)
    count = np.bincount(row, minlength=n_rows)
    begin = np.concatenate(([0], np.cumsum(count)))
    n = len(h)
    start = np.flatnonzero((np.arange(n) + width <= begin[row + 1]) | (np.arange(n) == begin[row]))
    key, row = chained(h, start, np.minimum(start + width, begin[row[start] + 1])), row[start]
    order = np.lexsort((key, row))
    key, row = key[order], row[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    key, row = key[new], row[new]
    return key, np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n_rows))))


def band_keys(key: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of BANDS keys for each non-empty set."""
    full = np.flatnonzero(np.diff(offsets))
    at = offsets[full]
    low = (key >> np.uint64(32)).astype(np.uint32)
    signature = np.empty((len(full), 2 * _HASHES), np.uint32)
    for k in range(_HASHES if len(full) else 0):
        g = (low ^ _XOR[k]) * _MULTIPLY[k]
        signature[:, k] = np.minimum.reduceat(g, at)
        signature[:, _HASHES + k] = np.maximum.reduceat(g, at)
    parts = signature.reshape(len(full), BANDS, ROWS).astype(np.uint64)
    out = np.broadcast_to(_BAND_SALT, (len(full), BANDS)).copy()
    for r in range(ROWS):
        out = mix(out ^ parts[:, :, r]) * np.uint64(0x9E3779B97F4A7C15)
    return out


def set_digests(key: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Two 64-bit digests of each set; 0 for an empty one."""
    full, out = np.flatnonzero(np.diff(offsets)), np.zeros((len(offsets) - 1, 2), np.uint64)
    if len(full):
        out[full, 0] = np.add.reduceat(mix(key), offsets[full])
        out[full, 1] = np.add.reduceat(mix(key ^ np.uint64(0xA5A5A5A5A5A5A5A5)), offsets[full])
    return out


def _signatures(docs: DataFrame, width: int) -> DataFrame:
    def sign(batches):
        for batch in batches:
            for rows, data, offsets in steps(batch):
                n = rows.num_rows
                key, at = shingles(data, offsets, n, width)
                digest = set_digests(key, at)
                keys = np.zeros((n, BANDS), np.uint64)
                keys[np.flatnonzero(np.diff(at))] = band_keys(key, at)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        rows.column("tag"),
                        pa.array(np.diff(at).astype(np.int64)),
                        pa.array(digest[:, 0].view(np.int64)),
                        pa.array(digest[:, 1].view(np.int64)),
                        pa.array([x.tobytes() if f else None for x, f in zip(keys, np.diff(at) > 0, strict=True)], pa.binary()),
                    ],
                    names=["doc_id", "tag", "n_shingles", "set_a", "set_b", "bands"],
                )

    return docs.select("doc_id", "tag", "text").mapInArrow(sign, "doc_id long, tag long, n_shingles long, set_a long, set_b long, bands binary")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """(id, set) of texts: the shingles of each."""

    def make(batches):
        for batch in batches:
            for rows, data, offsets in steps(batch):
                key, at = shingles(data, offsets, rows.num_rows, width)
                yield pa.RecordBatch.from_arrays([rows.column("id"), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(key.view(np.int64)))], names=["id", "set"])

    return docs.select("id", "text").mapInArrow(make, "id long, set array<long>")


def _bands(classes: DataFrame) -> DataFrame:
    """(key, id) for each band of each class."""

    def spread(batches):
        for batch in batches:
            blob = b"".join(batch.column("bands").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(blob, np.int64)), pa.array(np.repeat(batch.column("id").to_numpy(), BANDS))], names=["key", "id"])

    return classes.select("id", "bands").mapInArrow(spread, "key long, id long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= percent * union."""
    a = sets.select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    b = sets.select(F.col("id").alias("b"), F.col("set").alias("set_b"))
    both = pairs.join(a, "a").join(b, "b")
    x, y = F.size("set_a"), F.size("set_b")
    both = both.where(100 * F.least(x, y) >= percent * F.greatest(x, y))
    common = F.size(F.array_intersect("set_a", "set_b"))
    return both.where(100 * common >= percent * (x + y - common)).select("a", "b")


def _blocks(members: DataFrame, sets: DataFrame, weight: int = 60_000) -> DataFrame:
    """Members (g, id, c) of groups as blocks of bounded size: (g, block, low, high, ids, cs, sets); equal components stand together."""
    size = sets.select("id", F.size("set").alias("n"))
    counted = members.join(size, "id").join(members.groupBy("g").agg(F.ceil(F.count("*") / 10_000).alias("salts")), "g")
    counted = counted.withColumn("salt", F.pmod(F.xxhash64("id"), "salts"))
    at = F.sum(F.col("n") + 150).over(Window.partitionBy("g", "salt").orderBy("c", "id").rowsBetween(Window.unboundedPreceding, 0))
    dealt = counted.select("g", "id", "c", F.concat_ws("-", "salt", F.floor((at - 1) / weight)).alias("block"))
    own = dealt.join(sets, "id").groupBy("g", "block").agg(F.sort_array(F.collect_list(F.struct("id", "c", "set"))).alias("m"))
    return own.select("g", "block", F.array_min("m.c").alias("low"), F.array_max("m.c").alias("high"), F.col("m.id").alias("ids"), F.col("m.c").alias("cs"), F.col("m.set").alias("sets"))


def _links_between(x_sets: list[np.ndarray], y_sets: list[np.ndarray], percent: int, columns: int = 8192) -> np.ndarray:
    """Matrix of whether the sets of two blocks are linked; common shingles are counted by products of 0/1 matrices, a slice of the shingles at a time."""
    every, at = np.unique(np.concatenate([*x_sets, *y_sets]), return_inverse=True)
    sizes = np.array([len(s) for s in (*x_sets, *y_sets)])
    row = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(at, kind="stable")
    at, row = at[order], row[order]
    n = len(x_sets)
    common = np.zeros((n, len(y_sets)), np.float32)
    for first in range(0, len(every), columns):
        a, b = np.searchsorted(at, [first, first + columns])
        m = np.zeros((len(sizes), columns), np.float32)
        m[row[a:b], at[a:b] - first] = 1
        common += m[:n] @ m[n:].T
    common = common.astype(np.int64)
    return 100 * common >= percent * (sizes[:n, None] + sizes[None, n:] - common)


def _links_in_groups(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members of a group that are in different components: each member meets every block of its group; of its links to one component in a block, one is given."""
    blocks = staged(_blocks(members, sets))
    x = blocks.select("g", *(F.col(c).alias(f"x_{c}") for c in blocks.columns[1:]))
    y = blocks.select("g", *(F.col(c).alias(f"y_{c}") for c in blocks.columns[1:]))
    one = (F.col("x_low") == F.col("x_high")) & (F.col("y_low") == F.col("y_high")) & (F.col("x_low") == F.col("y_low"))

    def check(batches):
        for batch in batches:
            r = {c: batch.column(c) for c in batch.schema.names}
            for k in range(batch.num_rows):
                xs, ys = ([np.asarray(s.values) for s in r[c][k]] for c in ("x_sets", "y_sets"))
                linked = _links_between(xs, ys, percent)
                x_c, y_c = (np.asarray(r[c][k].values) for c in ("x_cs", "y_cs"))
                i, j = np.nonzero(linked & (x_c[:, None] != y_c[None, :]))
                _, one_each = np.unique(np.stack([i, y_c[j]], 1), axis=0, return_index=True)
                i, j = i[one_each], j[one_each]
                yield pa.RecordBatch.from_arrays([pa.array(np.asarray(r["x_ids"][k].values)[i], pa.int64()), pa.array(np.asarray(r["y_ids"][k].values)[j], pa.int64())], names=["a", "b"])

    columns = [f"{s}_{c}" for s in "xy" for c in ("ids", "cs", "sets")]
    pairs = x.join(y, "g").where((F.col("x_block") <= F.col("y_block")) & ~one).select(*columns)
    return pairs.mapInArrow(check, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Groups documents whose sets of `width`-word shingles have a Jaccard similarity of `percent` / 100 or more.

    Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased. Returns a row for each row of `docs` (doc_id and text are read, other columns aren't):
    doc_id, tag (a hash of the text), label (a number of the group; null for an empty set), n_shingles, component_id (the smallest doc_id reachable by links), kept (doc_id = component_id).

    Links: documents with equal sets are one class. Of each bucket of a band, the member with the smallest component
    is compared with the others; components of the links found shrink the buckets, and this is done up to three times while it
    finds links. In buckets that then still hold several components, members meet those of other components in blocks of bounded size, so no
    candidate goes unchecked; pairs inside a component, the bulk of a large group, are not compared, and pairs never become rows.

    A null or empty text, or one without words, has an empty set and is alone; a very long one is worked on whole. Fewer than `width` words are one
    shingle. Rows that repeat a doc_id are linked by their own texts; equal rows have equal results. A null doc_id counts as the smallest long
    and is returned as null. An empty table gives an empty result.
    """
    null_id = -(1 << 63)
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(null_id)).alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tag"), "text")
    signed = staged(_signatures(docs, width))
    full = signed.where("n_shingles > 0")
    # a class is known by both digests and the size of its set, and has a number of its own
    digests = ["set_a", "set_b", "n_shingles"]
    one = full.groupBy(*digests).agg(F.min_by(F.struct("bands", "doc_id", "tag"), F.struct("doc_id", "tag")).alias("one"), F.min("doc_id").alias("least"))
    classes = staged(one.select(F.monotonically_increasing_id().alias("id"), *digests, "least", "one.*"))
    dealt = _bands(classes)
    shared = dealt.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    buckets = staged(dealt.join(shared, "key"))
    suspects = classes.select("id", "doc_id", "tag").join(buckets.select("id").distinct(), "id", "left_semi")
    texts = docs.join(suspects.select("id", "doc_id", "tag"), ["doc_id", "tag"])
    sets = staged(_sets(texts, width).groupBy("id").agg(F.first("set").alias("set")))

    links = tested = None
    named = buckets.withColumn("c", F.col("id"))
    for _ in range(STARS):
        pivots = named.groupBy("key").agg(F.min(F.struct("c", "id")).alias("p"), F.max("c").alias("most")).where("most > p.c")
        pairs = named.join(pivots, "key").where(F.col("c") > F.col("p.c"))
        pairs = pairs.select(F.least("p.id", "id").alias("a"), F.greatest("p.id", "id").alias("b")).distinct()
        pairs = staged(pairs.join(tested, ["a", "b"], "left_anti") if tested is not None else pairs)
        tested = tested.unionByName(pairs) if tested is not None else pairs
        found = staged(_confirmed(pairs, sets, percent))
        if links is not None and found.isEmpty():
            break
        links = staged(links.unionByName(found)) if links is not None else found
        group = staged(components(links))
        named = staged(buckets.join(group, F.col("id") == F.col("node"), "left").select("key", "id", F.coalesce("component", "id").alias("c")))
    mixed = named.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count("*").alias("n")).where("low < high and n > 2")
    open_ = staged(named.join(mixed.select("key"), "key").select(F.col("key").alias("g"), "id", "c"))
    if not open_.isEmpty():
        found = staged(_links_in_groups(open_, sets, percent))
        if not found.isEmpty():
            group = staged(components(links.unionByName(found)))
    # the smallest doc_id of a class, then of a component
    least = classes.select("id", *digests, "least").join(group, F.col("id") == F.col("node"), "left").withColumn("c", F.coalesce("component", "id"))
    least = staged(least.select(*digests, "c", "least"))
    lowest = staged(least.groupBy("c").agg(F.min("least").alias("component")))
    whole = least.join(lowest, "c").select(*digests, F.col("c").alias("label"), "component")
    out = signed.join(whole, digests, "left")
    id_, component = F.col("doc_id"), F.coalesce(F.when(F.col("n_shingles") > 0, F.col("component")), F.col("doc_id"))
    return out.select(F.nullif(id_, F.lit(null_id)).alias("doc_id"), "tag", F.when(F.col("n_shingles") > 0, F.col("label")).alias("label"), "n_shingles", F.nullif(component, F.lit(null_id)).alias("component_id"), (id_ == component).alias("kept"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs`, with all their columns, that stay if each group of near-duplicates keeps one document: that of the smallest doc_id.

    Rows with an empty set all stay. Of rows with one doc_id in one group the one with the smallest hash of the text stays, of rows with one doc_id and text any
    one. A null doc_id counts as the smallest. An empty table stays empty.
    """
    found = near_duplicates(docs, width, percent).where("kept")
    one = found.where("n_shingles > 0").groupBy("doc_id", "label").agg(F.min("tag").alias("t")).unionByName(found.where("n_shingles = 0").select("doc_id", "label", F.col("tag").alias("t")).distinct())
    kept = staged(one.select(F.col("doc_id").alias("i"), "t").distinct())
    text = F.coalesce(docs["text"], F.lit(""))
    if not docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        empty = F.size(F.filter(F.split(text, "[ \t\n\x0b\f\r]+"), lambda w: w != "")) == 0
        docs = docs.where(empty).unionByName(docs.where(~empty).dropDuplicates(["doc_id", "text"]))
        text = F.coalesce(docs["text"], F.lit(""))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["i"]) & (F.xxhash64(text) == kept["t"]), "left_semi")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), percent=85).drop("tag", "label")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, least(len(ws), 1)) + 1)) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.node),
k AS (SELECT node, min(c) AS component_id FROM r GROUP BY node)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN k ON k.node = doc_id LEFT JOIN n USING (doc_id)
"""
