"""Words built so that sums over their places are equal decide nothing."""

import numpy as np
import pytest

pytest.importorskip("voxlake.llm.common")
from voxlake.llm import common, minhash, pieces  # noqa: E402

from tests.llm.test_llm import frame  # noqa: E402


def pair(code_a: int, code_b: int, by: np.ndarray) -> tuple[str, str]:
    """Two words of "a" and "b" with equal sums of code times number of the place, modulo 2^64: sums of blocks, as differences of few values, are brought to meet."""
    step, places = np.uint64((code_b - code_a) % 2**64), 11
    digits = np.indices((3,) * places).reshape(places, -1).T.astype(np.int8) - 1  # -1, 0, 1: a and b, equal, b and a

    def block(first):
        weights = by[first : first + places] * step
        total = np.zeros(len(digits), np.uint64)
        for k in range(places):
            total += np.where(digits[:, k] == 1, weights[k], np.where(digits[:, k] == -1, -weights[k], np.uint64(0)))
        return total, digits

    def meet(x, y, low):
        """Pairs of x and y whose sums are 0 in the lowest bits."""
        mask = np.uint64((1 << low) - 1)
        a, b = x[0] & mask, (np.uint64(0) - y[0]) & mask
        order = np.argsort(b)
        lo, hi = np.searchsorted(b[order], a, "left"), np.searchsorted(b[order], a, "right")
        i = np.repeat(np.arange(len(a)), hi - lo)
        j = order[np.repeat(lo - (np.cumsum(hi - lo) - (hi - lo)), hi - lo) + np.arange(len(i))]
        keep = slice(0, 400_000)
        return x[0][i[keep]] + y[0][j[keep]], np.concatenate((x[1][i[keep]], y[1][j[keep]]), 1)

    level = [block(places * k) for k in range(8)]
    for low in (17, 35):
        level = [meet(level[k], level[k + 1], low) for k in range(0, len(level), 2)]
    total, choice = meet(*level, 64)
    found = next(c for t, c in zip(total, choice, strict=True) if t == 0 and c.any())
    return "".join("b" if d == 1 else "a" for d in found), "".join("b" if d == -1 else "a" for d in found)


@pytest.fixture(scope="module")
def built():
    code = common.byte_codes(np.frombuffer(b"ab", np.uint8))
    return pair(int(code[0]), int(code[1]), common.places(88))


def test_the_words_share_a_sum(built):
    a, b = built
    data = np.frombuffer(f"{a}{b}".encode(), np.uint8)
    h = common.span_hash(common.byte_codes(data), np.array([0, 88]), np.array([88, 176]))
    assert a != b and len(a) == len(b) == 88 and h[0] == h[1]


def test_no_link_between_them(spark, built):
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(spark, [(1, built[0]), (2, built[1]), (3, built[0].upper())])).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_each_has_its_own_ids():
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), pieces.load(path)
    code = [int(x) for x in pieces._codes(np.array([ord("a"), ord("b")], np.uint32))]
    mark = common.places(89)[1:]  # a word begins with the mark of the space before it
    texts = pair(*code, mark)
    points = [np.array([0x2581, *map(ord, t)], np.uint32) for t in texts]
    h = common.span_hash(pieces._codes(np.concatenate(points)), np.array([0, 89]), np.array([89, 178]))
    assert h[0] == h[1]
    data = np.frombuffer("".join(f"{t} " for t in texts).encode(), np.uint8)
    for _ in range(2):  # words that are new, and words met before
        ids, at = pieces.encode(own, data, np.array([0, 89, 178]))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [library.encode(t) for t in texts]
