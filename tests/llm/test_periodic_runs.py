"""Periodic runs against a comparison of all places with all periods, and on odd tables."""

import random

import numpy as np
import pytest

pytest.importorskip("voxlake.llm.common")
from tests.llm import brute  # noqa: E402
from tests.llm.test_llm import VOCABULARY, corpus, frame  # noqa: E402
from voxlake.llm import periodic_runs  # noqa: E402


def repeated(rng, n, k):
    """n numbers below k with stretches that repeat, some of them within others."""
    x = [rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randrange(4) if n > 30 else 0):
        a = rng.randrange(n - 20)
        p = rng.randrange(1, min(60, n - a))
        for i in range(a + p, min(n, a + p * rng.randrange(2, 9))):
            x[i] = x[i - p]
    return x


@pytest.mark.parametrize("places", [60, 1000, periodic_runs.PLACES])
def test_runs_of_numbers(places, monkeypatch):
    monkeypatch.setattr(periodic_runs, "PLACES", places)
    rng = random.Random(places)
    for _ in range(80):
        texts = [repeated(rng, rng.choice([0, 1, 12, 30, 100, 300]), rng.choice([1, 2, 3, 10, 50])) for _ in range(rng.randrange(6))]
        of, start, length, period = periodic_runs.find_runs([np.array(t, np.int64) for t in texts])
        got = list(zip(of.tolist(), start.tolist(), length.tolist(), period.tolist(), strict=True))
        assert got == [(k, *r) for k, t in enumerate(texts) for r in sorted(brute.runs(t), key=lambda r: (r[0], r[2]))]


def test_extensions_of_all_places():
    rng = random.Random(8)
    for n, k in ((40, 1), (200, 2), (150, 5)):
        w = np.array([*repeated(rng, n, k), k], np.int64)
        i, j = np.triu_indices(n, 1)
        want = periodic_runs.agree(w, i, j, n)
        far = want >= periodic_runs.COVER
        assert far.any() and (periodic_runs.Extensions(w)(i[far], j[far]) == want[far]).all()


def test_every_difference_is_covered():
    assert {(a - b) % periodic_runs.COVER for a in periodic_runs.RESIDUES for b in periodic_runs.RESIDUES} == set(range(periodic_runs.COVER))


def odd_rows():
    rng = random.Random(4)
    word = lambda: rng.choice(VOCABULARY)
    part = [word() for _ in range(9)]
    rows = corpus(2) + [(1000 + i, " ".join(VOCABULARY[x] for x in repeated(rng, rng.randrange(20, 300), len(VOCABULARY)))) for i in range(60)]
    return rows + [(2000, "  a\tb\n" * 40), (2001, "x " * 11), (2002, "x " * 12), (2003, "\u3000é \x1c" * 30), (2004, " ".join(part * 3 + part[:4]).upper()), (2005, ("a a b " * 6 + "c ") * 5)]


def test_query_equals_the_plain_version(spark, tmp_path):
    rows = odd_rows()
    frame(spark, rows).select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in periodic_runs.op11_periodic_runs(spark, str(tmp_path)).collect()}
    want = {i: brute.run_row(brute.planted(i, t)) for i, t in rows}
    assert got == want and sum(w[0] > 0 for w in want.values()) > 30 and max(w[0] for w in want.values()) > 3


def test_query_on_the_smallest_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in periodic_runs.op11_periodic_runs(spark, sf).collect()}
    assert got == {i: brute.run_row(brute.planted(i, t)) for i, t in docs.items()}


def test_operator_gives_runs_and_texts_row_by_row(spark):
    text, long = "one two " * 8, " ".join(["lorem", *map(str, range(150_000)), *map(str, range(150_000))])
    rows = [(None, text), (None, text), (3, text), (3, None), (4, ""), (5, " \n"), (6, long)]
    got = sorted((r.doc_id or -1, r.n_words, [tuple(x) for x in r.runs], len(r.kept_text)) for r in periodic_runs.collapse_runs(frame(spark, rows)).collect())
    run = [(0, 16, 2)]
    assert got == [(-1, 16, run, 7), (-1, 16, run, 7), (3, 0, [], 0), (3, 16, run, 7), (4, 0, [], 0), (5, 0, [], 0), (6, 300_001, [(1, 300_000, 150_000)], len(long) - len(" ".join(map(str, range(150_000)))) - 1)]
    assert periodic_runs.collapse_runs(frame(spark, []).limit(0)).count() == 0
