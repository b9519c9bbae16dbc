"""Document fingerprints from closed syncmers.

A text is a sequence of units: runs of letters and digits, and each other character, as each character of a script that doesn't part its words, by itself.
Framed by marks for its two ends, its k-mers are looked at, and those are chosen whose smallest s-mer, by hash, is the first or the last: whether a
k-mer is chosen depends on nothing outside it, so texts that share a passage share the anchors inside it wherever it stands, and as any k - s
k-mers in a row hold a chosen one, every text with a unit has an anchor. The chosen k-mers with their places, in text order, are the fingerprint; two
fingerprints are alike as far as they have the same anchors in the same order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxlake.llm.native import let

K, S = 6, 2
#: Units. The scripts whose characters are units by themselves.
UNIT = r"[\p{L}\p{M}\p{N}&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}]]+|[^\x20\x09-\x0D]"
BEGIN, END = "", "\n"
#: Blocks of neighbouring doc_ids: about so many rows each, but at most so many blocks, as their heads are broadcast.
BLOCK_ROWS, BLOCKS = 5_000, 20_000
_LOW = (1 << 31) - 1


def units(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(UNIT), F.lit(0))


def _hash(*parts: Column) -> Column:
    return F.xxhash64(*parts).bitwiseAND(F.lit(_LOW))


def syncmers(own: Column, k: int = K, s: int = S) -> Column:
    """The closed syncmers of a list of strings with its frame, in order, each as place * 2^32 + hash (31 bits); of equal hashes the first. None for an empty list."""
    steps = k - s
    spots = sorted({*range(0, steps, s), steps})
    framed = F.concat(F.array_repeat(F.lit(BEGIN), k - 1), own, F.array_repeat(F.lit(END), k - 1))
    grams = lambda u: F.transform(F.sequence(F.lit(0), F.size(u) - s), lambda p: F.xxhash64(*(F.get(u, p + i) for i in range(s))))

    def chosen(g: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(g) - 1 - steps), lambda p: F.least(F.get(g, p), F.get(g, p + steps)) <= F.least(*(F.get(g, p + i) for i in range(1, steps))))
        return F.sort_array(F.transform(at, lambda p: F.shiftleft(_hash(*(F.get(g, p + i) for i in spots)), 32) + p))

    # by hash, then place: the first of each hash; then by place
    first = lambda x: F.filter(x, lambda v, i: ~F.coalesce(F.shiftright(F.get(x, i - 1), 32) == F.shiftright(v, 32), F.lit(False)))
    by_place = lambda x: F.sort_array(F.transform(x, lambda v: F.shiftleft(v.bitwiseAND(F.lit(_LOW)), 32) + F.shiftright(v, 32)))
    found = let(framed, lambda u: let(let(grams(u), chosen), lambda x: by_place(first(x))))
    return F.when(F.size(own) == 0, F.array().cast("array<bigint>")).otherwise(found)


def anchors(text: Column) -> Column:
    """The anchors of a text, in text order: place * 2^32 + hash."""
    return let(units(text), lambda u: syncmers(u))


def likeness(a: Column, b: Column) -> Column:
    """2 m / (|a| + |b|) of two lists of anchors; 1 for two empty ones. m counts the anchors of both that stand in one order: of those that both have, by their place in a,
    those whose place in b is after that of the one before or before that of the one after."""
    side = lambda x, n: F.transform(x, lambda v: F.shiftleft(v.bitwiseAND(F.lit(_LOW)), 32) + F.lit(n << 31) + F.shiftright(v, 32))
    both = F.sort_array(F.concat(side(a, 0), side(b, 1)))
    same = lambda x: F.filter(F.transform(x, lambda v, i: F.when(F.shiftright(F.get(x, i + 1), 32) == F.shiftright(v, 32), F.shiftleft(v.bitwiseAND(F.lit(_LOW)), 32) + F.get(x, i + 1).bitwiseAND(F.lit(_LOW)))), lambda v: v.isNotNull())
    place = lambda v: v.bitwiseAND(F.lit(_LOW))
    kept = lambda x: F.when(F.size(x) < 2, F.size(x)).otherwise(F.size(F.filter(x, lambda v, i: F.coalesce(place(F.get(x, i - 1)) < place(v), F.lit(False)) | F.coalesce(place(v) < place(F.get(x, i + 1)), F.lit(False)))))
    total = F.size(a) + F.size(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(F.lit(2.0) * let(let(both, lambda x: F.sort_array(same(x))), kept) / total)


def as_text(a: Column) -> Column:
    """place:hash of each anchor, by spaces."""
    return F.concat_ws(" ", F.transform(a, lambda v: F.concat_ws(":", F.shiftright(v, 32).cast("string"), v.bitwiseAND(F.lit(_LOW)).cast("string"))))


def with_next(docs: DataFrame, columns: list[str], add: dict[str, Column] | None = None) -> DataFrame:
    """Adds next_<column> of the next row in descending doc_id (after the last: of the first) for each of `columns`, and before that the columns `add`.

    Rows are dealt by blocks of neighbouring ids, which hold about equally many rows however the ids lie; the first row of each block is also sent to the block
    above it. Rows that repeat a doc_id are ordered by `columns`; a null doc_id counts as smaller than all others. Any other columns stay, whatever their
    names; an empty table gives an empty result.
    """
    from pyspark.ml.feature import Bucketizer

    number = F.coalesce(F.col("doc_id").cast("double"), F.lit(-math.inf))
    blocks = max(1, min(BLOCKS, docs.count() // BLOCK_ROWS))
    cuts = docs.select(F.col("doc_id").cast("double").alias("number")).approxQuantile("number", [i / blocks for i in range(1, blocks)], 0.25 / blocks) if blocks > 1 else []
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), number.alias("number"))
    rows = Bucketizer(splits=[-math.inf, *sorted(set(cuts)), math.inf], inputCol="number", outputCol="block").transform(rows).select("row", F.col("block").cast("int")) if cuts else rows.select("row", F.lit(0).alias("block"))
    heads = rows.groupBy("block").agg(F.max("row.doc_id").alias("id"))
    above = Window.orderBy("block")  # over at most BLOCKS rows
    heads = heads.select(F.col("block").alias("from"), "id", F.coalesce(F.lead("block").over(above), F.min("block").over(above.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("to"))
    guests = rows.join(F.broadcast(heads), (F.col("block") == F.col("from")) & F.col("row.doc_id").eqNullSafe(F.col("id"))).select("row", F.col("to").alias("block"), F.lit(True).alias("guest"))
    both = rows.select("row", "block", F.lit(False).alias("guest")).unionByName(guests)
    # the texts are dealt before the columns are added, so that only they travel
    flat = both.repartition("block").select("row", "block", "guest", *(e.alias(c) for c, e in (add or {}).items()))
    own = {c: F.col(c) if c in (add or {}) else F.col(f"row.`{c}`") for c in columns}
    order = Window.partitionBy("block").orderBy("guest", F.desc_nulls_last("row.doc_id"), *own.values())
    return flat.select("row", "guest", *(add or {}), *(F.lead(e).over(order).alias(f"next_{c}") for c, e in own.items())).where(~F.col("guest")).select("row.*", *(add or {}), *(f"next_{c}" for c in columns))


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, anchors (place * 2^32 + hash), fingerprint (text) of each row of `docs`.

    A null or empty text has none; a very long one is worked on whole; equal texts have equal fingerprints; repeated rows and null doc_ids stay. Other columns aren't read.
    """
    return docs.select("doc_id", anchors(F.coalesce("text", F.lit(""))).alias("anchors")).withColumn("fingerprint", as_text(F.col("anchors")))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    marked = with_next(docs, ["text", "marks"], {"marks": anchors(F.col("row.text"))})
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("text", n - half), F.left("next_text", half))
    # the generators keep the optimizer from evaluating a column once for each use
    pair = marked.select("doc_id", n.cast("long").alias("n_chars"), "marks", "next_marks", F.inline(F.array(F.struct(edited.alias("edited")))))
    pair = pair.select("*", F.inline(F.array(F.struct(anchors(F.col("edited")).alias("edited_marks")))))
    return pair.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("marks")).alias("fingerprint"), as_text(F.col("edited_marks")).alias("edited_fingerprint"),
        likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"), likeness(F.col("marks"), F.col("next_marks")).alias("near_next"),
    )
