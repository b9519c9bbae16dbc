"""Encoder of unigram models and the quality score, held against their definitions."""

import random
import re

import numpy as np
import pytest

pytest.importorskip("voxlake.llm")
from voxlake.llm import common, pieces, quality_classifier  # noqa: E402


def unigram_file(path, rng):
    """A model file put together by hand: single letters and random strings with random scores, and bytes for all else."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.trainer_spec.model_type, model.trainer_spec.byte_fallback = 1, True
    spec = model.normalizer_spec
    spec.name, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces = "identity", True, False, True

    def add(piece, score, kind):
        model.pieces.add(piece=piece, score=score, type=kind)

    add("<unk>", 0.0, 2)
    for b in range(256):
        add(f"<0x{b:02X}>", 0.0, 6)
    letters = "abcdé▁"
    made = {x: 0 for x in letters} | {rng.choice(["", "▁"]) + "".join(rng.choice(letters[:-1]) for _ in range(rng.randrange(2, 7))): 0 for _ in range(150)}
    for piece in made:
        add(piece, -rng.uniform(2, 9) - 0.3 * len(piece), 1)
    path.write_bytes(model.SerializeToString())
    return {p.piece: (i, p.score) for i, p in enumerate(model.pieces) if p.type == 1}


def plain_viterbi(vocabulary, text):
    """Score of the best cut of a text into pieces; letters without a piece score 10 less than the worst piece."""
    text = "▁" + text.replace(" ", "▁")
    worst = min(s for _, s in vocabulary.values()) - 10
    best = [0.0]
    for end in range(1, len(text) + 1):
        ways = [best[k] + vocabulary[text[k:end]][1] for k in range(max(0, end - 8), end) if text[k:end] in vocabulary]
        best.append(max([*ways, *([best[end - 1] + worst] if text[end - 1] not in vocabulary else [])]))
    return best[-1]


@pytest.mark.parametrize("seed", range(4))
def test_unigram_ids_have_the_highest_sum_of_scores(tmp_path, seed):
    import sentencepiece

    rng = random.Random(seed)
    vocabulary = unigram_file(tmp_path / "unigram.model", rng)
    library, own = sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "unigram.model")), pieces.Pieces(str(tmp_path / "unigram.model"))
    texts = ["".join(rng.choice("aaabbbccddé   ") for _ in range(rng.randrange(1, 120))) for _ in range(120)] + ["a", "abczd", "  ", "xyz ab", "ab" * 400]
    score = {i: s for i, s in vocabulary.values()}
    differ = 0
    for text in texts:
        # one text a call with the space of its own, as the steps of a table lay them out
        one = np.frombuffer((text + " ").encode(), np.uint8)
        ids, _ = pieces.encode(own, one, np.array([0, len(one)]))
        expected = library.encode(text)
        assert library.decode([int(i) for i in ids]) == library.decode(expected)
        if not re.search("[xyz]", text):
            assert abs(sum(score[int(i)] for i in ids) - plain_viterbi(vocabulary, text)) < 1e-3
        # only where two cuts have equal sums: the library's depend on rounding to 32 bits
        if [int(i) for i in ids] != expected:
            differ += 1
            assert sorted(int(i) for i in ids) == sorted(expected)
    assert differ <= 3


def plain_quality(model, text):
    """The score by its definition: the mean of the numbers of all words, pairs of words and runs of bytes."""
    raw = (text or "").encode()
    number = lambda part: common.span_hash(common.byte_codes(np.frombuffer(part, np.uint8)), np.array([0]), np.array([len(part)]))
    found = [number(w) for w in re.findall(rb"[^\x20\x09-\x0D]+", raw)]
    ids = list(found)
    for a, b in zip(found, found[1:], strict=False):
        ids.append(np.array([0x5A5A5A5A5A5A5A5A], np.uint64) if a == b else common.mix(a + np.uint64(3) * b))
    for n in (2, 4):
        for k in range(len(raw) - n + 1):
            codes = common.byte_codes(np.frombuffer(raw[k : k + n], np.uint8))
            gram = codes[:1]
            for c in codes[1:]:
                gram = (gram * np.uint64(0x9E3779B97F4A7C15)) ^ c
            ids.append(common.mix(gram + np.uint64(n)))
    z = float(model["bias"])
    if ids:
        z += float(np.mean(model["feature"][[int(i[0]) >> (64 - quality_classifier.BITS) for i in ids]].astype(float)))
    return 1 / (1 + np.exp(-z))


def test_quality_score_by_definition(spark):
    rng = random.Random(2)
    texts = [None, "", "a", "a a a", "  two  words ", "ünï cödé 文字 text", "\n\nlines\n of\ttext\n"] + [" ".join(rng.choice(["red", "Blau", "vert", "x1"]) for _ in range(rng.randrange(1, 60))) for _ in range(40)]
    model = {"feature": np.random.default_rng(1).normal(0, 3, 1 << quality_classifier.BITS).astype(np.float32), "bias": np.array(0.25)}
    rows = spark.createDataFrame(list(enumerate(texts)) + [(0, texts[0]), (7, texts[7])], "doc_id long, text string")
    got = quality_classifier.score_quality(rows, model).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        assert abs(r.score - plain_quality(model, texts[r.doc_id])) < 1e-6
