"""Importance resampling against a plain version, and on odd tables."""

import random

import pytest

pytest.importorskip("voxlake.llm.common")
from pyspark.sql import functions as F  # noqa: E402

from tests.llm import brute  # noqa: E402
from tests.llm.test_llm import VOCABULARY, corpus, frame  # noqa: E402
from voxlake.llm import resampling  # noqa: E402

TARGET = ["A text on an Antor, of 9 BELMI words.", None, "", "cordu-eßla cordu fi fi ñutor antor"]


def target(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TARGET)], "item_id long, text string")


def test_ranks_equal_the_plain_version(spark):
    docs = corpus(4) + [(900, "Ünï-codé 日本 A1b2 " * 30), (901, "x\x00y\x7fz _q_ " * 15), (-5, " ".join(VOCABULARY))]
    got = {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in resampling.importance(frame(spark, docs), target(spark)).collect()}
    want = dict(zip((i for i, _ in docs), brute.importance(docs, TARGET), strict=True))
    assert got == want and sum(w[3] is not None for w in want.values()) >= 10


def test_rows_drawn_keep_their_columns(spark):
    docs = corpus(5)
    drawn = {i for (i, _), w in zip(docs, brute.importance(docs, TARGET), strict=True) if w[3]}
    rows = frame(spark, docs).withColumn("weight", F.lit(8)).withColumn("n_words", F.lit("own"))
    got = resampling.resample(rows, target(spark))
    assert got.dtypes == rows.dtypes and {r.doc_id for r in got.collect()} == drawn
    assert {(r.weight, r.n_words) for r in got.collect()} == {(8, "own")}


def test_null_ids_repeated_rows_and_ties(spark):
    rng = random.Random(2)
    text = " ".join(rng.choice(VOCABULARY) for _ in range(30))
    rows = [(None, text)] * 9 + [(7, text)] * 9 + [(i, text) for i in range(20, 40)] + [(50, None), (51, "")]
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_features, r.weight, r.score, r["rank"] or 0) for r in resampling.importance(frame(spark, rows), target(spark)).collect())
    want = sorted((i is not None, i or 0, *w[:3], w[3] or 0) for (i, _), w in zip(rows, brute.importance(rows, TARGET), strict=True))
    assert got == want


def test_empty_tables(spark):
    none = frame(spark, []).limit(0)
    assert resampling.importance(none, target(spark)).count() == 0 and resampling.resample(none, target(spark)).count() == 0
    docs = corpus(6)
    got = {r.doc_id: r.weight for r in resampling.importance(frame(spark, docs), target(spark).limit(0)).collect()}
    assert got == {i: w[1] for (i, _), w in zip(docs, brute.importance(docs, []), strict=True)}


@pytest.mark.parametrize("width", [1, 2, 3])
def test_parts_of_long_texts_join_up(monkeypatch, width):
    rng = random.Random(3)
    text = " ".join(rng.choice(VOCABULARY) for _ in range(400)) + "  " + "nogap" * 60 + " . " + "a " * 40
    whole = [sorted(sum(runs, [])) for runs in zip(*(own for _, own in resampling.grams(text, width)), strict=True)]
    n = sum(n for n, _ in resampling.grams(text, width))
    for size in (1, 7, 100):
        monkeypatch.setattr(resampling, "PART_BYTES", size)
        parts = list(resampling.grams(text, width))
        assert len(parts) > 3 and sum(n for n, _ in parts) == n
        assert [sorted(sum(runs, [])) for runs in zip(*(own for _, own in parts), strict=True)] == whole
