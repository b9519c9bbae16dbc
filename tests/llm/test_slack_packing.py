"""Packing by minimum bin slack: pieces by their definition, windows against all subsets, and odd tables."""

import itertools
import random
import zlib

import numpy as np
import pytest

pytest.importorskip("voxlake.llm.common")
import public_tokenizers  # noqa: E402

from tests.llm.test_llm import VOCABULARY, corpus, frame  # noqa: E402
from voxlake.llm import slack_packing  # noqa: E402


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def held(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def check(got, rows, tokenizer, capacity):
    """Every id of every row lies in one piece; sequences have no gaps and need no padding; few more pieces than windows."""
    want = sorted((-1 if i is None else i, held(tokenizer, t).tobytes()) for i, t in rows)
    texts = {}
    for i, ids in want:
        texts.setdefault((i, len(ids) // 4), []).append(ids)
    for (i, n), own in texts.items():
        found = sorted((r.start, r.length, r.ids_crc32) for r in got if (-1 if r.doc_id is None else r.doc_id) == i and r.doc_tokens == n)
        assert sum(f[1] for f in found) == n * len(own)
        if len(set(own)) == len(own) == 1:
            assert [f[0] for f in found] == [0, *np.cumsum([f[1] for f in found])[:-1]]
        for start, length, crc in found:
            assert crc in {zlib.crc32(ids[4 * start : 4 * (start + length)]) for ids in own}
    assert len({(i, n) for i, n in texts}) == len({(r.doc_id, r.doc_tokens) for r in got})
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1]]
        total = sum(n for _, n in own)
        assert total == capacity or total < capacity and total & (total - 1) == 0
    total = sum(len(ids) // 4 for _, ids in want)
    assert len(sequences) == total // capacity + (total % capacity).bit_count()


@pytest.mark.parametrize("capacity", [1024, 64])
def test_pieces_and_sequences(spark, tokenizer, capacity):
    docs = corpus(3)
    got = slack_packing.pack_tight(frame(spark, docs), capacity=capacity).collect()
    check(got, docs, tokenizer, capacity)
    whole = sum(-(-len(held(tokenizer, t)) // capacity) for _, t in docs)
    assert len(got) - whole <= len({r.sequence_id for r in got})


def test_null_ids_repeated_rows_long_and_empty_texts(spark, tokenizer):
    text = " ".join(VOCABULARY)
    rows = [(None, text)] * 3 + [(None, None), (4, text), (4, text), (4, "another text"), (5, ""), (6, text * 300), (7, "<|endoftext|> x"), (8, "a" * 70_000)]
    check(slack_packing.pack_tight(frame(spark, rows)).collect(), rows, tokenizer, 1024)
    assert slack_packing.pack_tight(frame(spark, []).limit(0)).count() == 0


def test_windows_are_closest_to_capacity():
    rng = random.Random(1)
    for _ in range(200):
        capacity = rng.choice([16, 20, 31])
        items = [rng.randrange(1, capacity) for _ in range(rng.randrange(1, 9))]
        counts = {x: items.count(x) for x in items}
        window = slack_packing.closest(counts, capacity)
        rest = sorted(items)[:-1]
        sums = [max(items) + sum(c) for k in range(len(rest) + 1) for c in itertools.combinations(rest, k)]
        assert sum(s * k for s, k in window.items()) == max(s for s in sums if s <= capacity)
        assert window[max(items)] >= 1 and all(counts[s] >= k > 0 for s, k in window.items())


def test_plan_places_each_rank_once():
    rng = random.Random(2)
    for counts in ({s: rng.randrange(0, 50) for s in range(1, 65)}, {64: 10**9}, {40: 10**9, 1: 3, 24: 10**8}, {63: 1}):
        runs, bins, line = slack_packing.plan(counts, 64)
        for s, n in counts.items():
            own = runs[runs["size"] == s].sort_values("lo")
            assert own["n"].sum() == n and own["lo"].tolist() == [0, *own["n"].cumsum()[:-1]][: len(own)]
        whole = runs[runs["take"] > 0]
        assert (whole["size"] * whole["n"]).sum() == 64 * bins
        assert (runs["size"] * runs["n"]).sum() == 64 * bins + line
        last = slack_packing.ends(line, 64)
        assert last[-1] == line and last[0] == line - line % 64 and all(int(x).bit_count() == 1 for x in np.diff(last))
