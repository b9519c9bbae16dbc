"""SentencePiece encoding and decoding in numpy.

Texts are cut into words where no piece can span the cut; distinct words of equal length advance together, one character
at a time. The hashes of the substrings that end at a position probe the sorted hashes of the pieces, and the best candidate's length is
stored as the backpointer. For a unigram model the best is the highest sum of scores (Viterbi). For a model made by pair
merges the sum of scores is not what its encoder maximises; there a candidate counts only if merging would leave it
standing next to the last piece of the prefix before it, which holds for one candidate at a position, and the same maximum picks it.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm.common import mix, steps

SPACE_MARK = "▁"
#: Words longer than this are merged one at a time, by a heap.
LONG = 96
#: Words that a task remembers with their ids, at most.
KNOWN = 500_000
#: Ids that one vectorised step of decoding works on; a longer list is a step of its own.
STEP_IDS = 300_000
_models: dict = {}
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _codes(points: np.ndarray) -> np.ndarray:
    return mix(points.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class _Numbers(dict):
    """A number for each word, from 0 on, in the order in which words are met. Words are told apart by their characters, not by a hash of them."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Pieces:
    """The pieces of a model file, ready for probing."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        if model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces or not model.normalizer_spec.escape_whitespaces:
            raise ValueError("only models without normalisation are supported")
        self.prefix = model.normalizer_spec.add_dummy_prefix
        self.merges = model.trainer_spec.model_type == 2
        self.size = len(model.pieces)
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == 2)
        self.text = [p.piece for p in model.pieces]
        plain = [i for i, p in enumerate(model.pieces) if p.type in (1, 4)]
        self.id = {self.text[i]: i for i in plain}
        self.score = np.array([p.score for p in model.pieces], np.float64)
        byte = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == 6}
        self.byte = np.array([byte.get(b, self.unknown) for b in range(256)], np.int32)
        sizes = [len(x) for x in self.id]
        self.lengths = sorted(set(sizes) | {1}, key=sizes.count, reverse=True)
        points = np.array([ord(c) for c in "".join(self.id)], np.uint32)
        ends = np.cumsum([len(x) for x in self.id])
        # the hash of a piece as the sum that the substrings of a word are probed by; pieces are far too short for powers to cancel
        size = np.array(sizes)
        place = np.arange(len(points)) - np.repeat(ends - size, size)
        key = mix(np.add.reduceat(_codes(points) * _powers(_BASE, max(sizes))[place], ends - size) + size.astype(np.uint64))
        order = np.argsort(key)
        self.key, self.key_id = key[order], np.array(list(self.id.values()), np.int32)[order]
        self._some = np.zeros(1 << 20, bool)
        self._some[(self.key & np.uint64(0xFFFFF)).astype(np.int64)] = True
        pairs = sorted({ord(x[i]) << 32 | ord(x[i + 1]) for x in self.id for i in range(len(x) - 1)})
        self.inner = np.array(pairs, np.uint64)
        raw = [bytes([int(t[3:5], 16)]) if p.type == 6 else b"" if p.type == 3 else t.replace(SPACE_MARK, " ").encode() for t, p in zip(self.text, model.pieces, strict=True)]
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_end = np.cumsum([len(x) for x in raw])
        self.raw_len = np.array([len(x) for x in raw])
        if self.merges:
            self._splits()
        self.forget()
        self._seen = np.zeros(1 << 20, np.uint64)
        self._fits = np.zeros(1 << 20, bool)

    def forget(self) -> None:
        """No word has been met: a word's number by its characters, where its ids begin and how many they are, and the ids of all."""
        self.numbers, self.begin, self.count, self.ids = _Numbers(), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _splits(self) -> None:
        """For each piece the pair it is merged from, as its own text is merged, and its rank; pieces that merging doesn't reach are never candidates."""
        order = sorted(self.id.values(), key=lambda i: (-self.score[i], i))
        self.rank = np.full(self.size, self.size, np.int64)
        self.rank[order] = np.arange(len(order))
        self.left, self.right = np.arange(self.size), np.arange(self.size)
        self.reached = np.zeros(self.size, bool)
        for i in order:
            last: list = []
            self.reached[i] = merge(self, self.text[i], last) == [i]
            if self.reached[i] and last:
                self.left[i], self.right[i] = last

    def may(self, key: np.ndarray) -> np.ndarray:
        """False where a key is surely none of the sorted ones."""
        return self._some[(key & np.uint64(0xFFFFF)).astype(np.int64)]

    def probe(self, key: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.key_id[at], -1)

    def fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves the pieces a and b standing side by side; answers are kept in a table of fixed size."""
        pair = (a.astype(np.uint64) << np.uint64(32)) + b.astype(np.uint64) + np.uint64(1)
        slot = (mix(pair) >> np.uint64(44)).astype(np.int64)
        miss = self._seen[slot] != pair
        out = self._fits[slot]
        if miss.any():
            new = np.unique(pair[miss])
            x, y = (new - np.uint64(1)) >> np.uint64(32), (new - np.uint64(1)) & np.uint64(0xFFFFFFFF)
            answer = self._judge(x.astype(np.int64), y.astype(np.int64))
            out[miss] = answer[np.searchsorted(new, pair[miss])]
            at = (mix(new) >> np.uint64(44)).astype(np.int64)
            self._seen[at], self._fits[at] = new, answer
        return out

    def _joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the piece that a and b make, or a rank after all."""
        if not hasattr(self, "_pair_key"):
            pairs = {}
            for text, i in self.id.items():
                for k in range(1, len(text)):
                    if text[:k] in self.id and text[k:] in self.id:
                        pairs[self.id[text[:k]] << 32 | self.id[text[k:]]] = self.rank[i]
            self._pair_key = np.array(sorted(pairs), np.int64)
            self._pair_rank = np.array([pairs[k] for k in sorted(pairs)], np.int64)
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self._pair_key, key), len(self._pair_key) - 1)
        return np.where(self._pair_key[at] == key, self._pair_rank[at], self.size + 1)

    def _judge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Undoes the merges of both pieces, latest first; they stand side by side if at no time a merge across them would have come first."""
        out, live = np.ones(len(a), bool), np.arange(len(a))
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), self.size + 1, np.int64)
        while len(live):
            x, y = a[live], b[live]
            crossed = self._joined(x, y) < limit[live]
            out[live[crossed]] = False
            rx = np.where(self.left[x] == x, -1, self.rank[x])
            ry = np.where(self.left[y] == y, -1, self.rank[y])
            undo_x = rx > ry
            go = ~crossed & ((rx >= 0) | (ry >= 0))
            # of equal merges the left one comes first, so a merge across counts as earlier than an equal one on its right
            limit[live] = np.where(undo_x, rx, ry + 1)
            a[live] = np.where(undo_x & go, self.right[x], x)
            b[live] = np.where(~undo_x & go, self.left[y], y)
            live = live[go]
        return out


def merge(pieces: Pieces, word: str, last: list | None = None) -> list[int]:
    """The ids of a word by merging the neighbours that make the best piece, the leftmost first; a character that is no piece is given as -1 - its code point."""
    import heapq

    part = list(word)
    after, before, live = list(range(1, len(part) + 1)), list(range(-1, len(part) - 1)), [True] * len(part)
    heap: list = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < len(part):
            both = part[i] + part[after[i]]
            if both in pieces.id:
                heapq.heappush(heap, (-pieces.score[pieces.id[both]], i, both))

    for i in range(len(part) - 1):
        offer(i)
    while heap:
        _, i, both = heapq.heappop(heap)
        if not live[i] or after[i] >= len(part) or part[i] + part[after[i]] != both:
            continue
        j = after[i]
        if last is not None:
            last[:] = pieces.id[part[i]] if part[i] in pieces.id else -1, pieces.id[part[j]] if part[j] in pieces.id else -1
        part[i], live[j], after[i] = both, False, after[j]
        if after[j] < len(part):
            before[after[j]] = i
        offer(before[i])
        offer(i)
    return [pieces.id.get(part[i], -1 - ord(part[i][0])) for i in range(len(part)) if live[i]]


def load(path: str) -> Pieces:
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def _encode_equal(pieces: Pieces, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words of one length, one in each row of `points`: (ids, how many of each word); unknown characters as -1 - code point."""
    n, size = points.shape
    powers, inverse = _powers(_BASE, size + 1), _powers(_BASE_INV, size + 1)
    sums = np.zeros((size + 1, n), np.uint64)
    np.cumsum(_codes(points.T) * powers[:size, None], axis=0, out=sums[1:])
    last = np.full((size + 1, n), -1, np.int64)
    step = np.zeros((size + 1, n), np.int8 if size < 128 else np.int64)
    score = np.full((size + 1, n), -np.inf)
    score[0] = 0
    for end in range(1, size + 1):
        open_ = np.arange(n)
        for length in pieces.lengths:
            start = end - length
            if start < 0 or not len(open_):
                continue
            rows = open_[score[start, open_] > -np.inf]
            key = mix((sums[end, rows] - sums[start, rows]) * inverse[start] + np.uint64(length))
            if length > 1:
                some = pieces.may(key)
                rows, key = rows[some], key[some]
            if not len(rows):
                continue
            found = pieces.probe(key)
            if length == 1:
                found = np.where(found < 0, pieces.size + points[rows, end - 1].astype(np.int64), found)
            ok = found >= 0
            rows, found = rows[ok], found[ok]
            if pieces.merges:
                prev = last[start, rows]
                both = (prev >= 0) & (prev < pieces.size) & (found < pieces.size)
                fit = (found >= pieces.size) | pieces.reached[np.minimum(found, pieces.size - 1)]
                both &= fit
                fit[both] = pieces.fits(prev[both], found[both])
                rows, found = rows[fit], found[fit]
                value = np.zeros(len(rows))
            else:
                value = score[start, rows] + np.where(found < pieces.size, pieces.score[np.minimum(found, pieces.size - 1)], pieces.score.min() - 10)
            better = value > score[end, rows]
            rows, found, value = rows[better], found[better], value[better]
            score[end, rows], last[end, rows], step[end, rows] = value, found, length
            if pieces.merges:  # one candidate stands at a position; the others need no look
                open_ = open_[score[end, open_] == -np.inf]
    out = np.zeros((n, size), np.int64)
    lost = score[size] == -np.inf
    count, at, live = np.zeros(n, np.int64), np.full(n, size), np.flatnonzero(~lost)
    while len(live):
        piece = last[at[live], live]
        out[live, size - 1 - count[live]] = np.where(piece >= pieces.size, pieces.size - 1 - piece, piece)
        count[live] += 1
        at[live] -= step[at[live], live]
        live = live[at[live] > 0]
    for k in np.flatnonzero(lost):
        got = merge(pieces, points[k].astype(np.uint32).tobytes().decode("utf-32-le"))
        count[k] = len(got)
        out[k, size - len(got) :] = got
    ids = out[np.arange(size)[None, :] >= size - count[:, None]]
    return ids, count


def encode(pieces: Pieces, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts that each end in a space: (ids, offsets)."""
    head = np.concatenate((np.frombuffer(b" ", np.uint8), data[:-1])) if pieces.prefix else data
    points = np.frombuffer(head.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    points = np.where(points == 32, np.uint32(ord(SPACE_MARK)), points)
    first = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets]
    if not pieces.prefix:
        keep = np.ones(len(points), bool)
        keep[first[1:] - 1] = False
        points, first = points[keep], first - np.arange(len(first))
    else:
        # the space before a text that is empty is no word
        empty = np.flatnonzero(np.diff(first) == 1)
        keep = np.ones(len(points), bool)
        keep[first[empty]] = False
        points, first = points[keep], first - np.concatenate(([0], np.cumsum(np.diff(first) == 1)))
    if not len(points):
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    pair = points[:-1].astype(np.uint64) << np.uint64(32) | points[1:].astype(np.uint64)
    spot = np.minimum(np.searchsorted(pieces.inner, pair), len(pieces.inner) - 1)
    cut = np.concatenate(([True], pieces.inner[spot] != pair))
    if pieces.merges:
        cut[1:] |= (points[1:] == ord(SPACE_MARK)) & (points[:-1] != ord(SPACE_MARK))
    cut[first[:-1][first[:-1] < len(points)]] = True
    start = np.flatnonzero(cut)
    end = np.append(start[1:], len(points))
    if len(pieces.numbers) > KNOWN:
        pieces.forget()
    before, raw = len(pieces.numbers), points.astype(np.uint32).tobytes()
    word = np.fromiter(map(pieces.numbers.__getitem__, [raw[i:j] for i, j in zip((4 * start).tolist(), (4 * end).tolist(), strict=True)]), np.int64, len(start))
    # words met for the first time, in the order of their numbers
    one = np.flatnonzero(word > np.maximum.accumulate(np.concatenate(([before - 1], word[:-1]))))
    start_1, size = start[one], (end - start)[one]
    begin, count = np.zeros(len(one), np.int64), np.zeros(len(one), np.int64)
    runs = np.zeros(len(one), bool)
    if pieces.merges and len(one):  # runs of spaces have pieces of equal scores
        double = np.concatenate(((points[1:] == ord(SPACE_MARK)) & (points[:-1] == ord(SPACE_MARK)), [False]))
        runs = np.add.reduceat(double, start)[one] > 0
    ids, places = [pieces.ids], []
    for n in np.unique(size):
        own = np.flatnonzero((size == n) & ~runs & (size <= LONG))
        if len(own):
            got, many = _encode_equal(pieces, points[start_1[own][:, None] + np.arange(n)])
            ids.append(got.astype(np.int32))
            count[own] = many
            places.append(own)
    for k in np.flatnonzero(runs | (size > LONG)):
        text = points[start_1[k] : start_1[k] + size[k]].astype(np.uint32).tobytes().decode("utf-32-le")
        got = np.array(merge(pieces, text), np.int64) if pieces.merges else _encode_equal(pieces, points[None, start_1[k] : start_1[k] + size[k]])[0]
        ids.append(got.astype(np.int32))
        count[k] = len(got)
        places.append(np.array([k]))
    if places:
        places = np.concatenate(places)
        begin[places] = len(pieces.ids) + np.cumsum(count[places]) - count[places]
        pieces.begin, pieces.count, pieces.ids = np.concatenate((pieces.begin, begin)), np.concatenate((pieces.count, count)), np.concatenate(ids)
    begin, ids, many = pieces.begin[word], pieces.ids, pieces.count[word]
    total = np.cumsum(many)
    flat = ids[np.repeat(begin - (total - many), many) + np.arange(total[-1])]
    at = np.concatenate(([0], total))[np.searchsorted(start, first)]
    odd = flat < 0
    if odd.any():
        width = np.ones(len(flat), np.int64)
        texts = [chr(-1 - x).encode("utf-8", "replace") for x in flat[odd]]
        width[odd] = [len(t) for t in texts]
        ends = np.cumsum(width)
        wide = np.empty(ends[-1], np.int64)
        wide[(ends - width)[~odd]] = flat[~odd]
        lens = width[odd]
        spots = np.repeat((ends - width)[odd] - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())
        wide[spots] = pieces.byte[np.frombuffer(b"".join(texts), np.uint8)]
        flat, at = wide, np.concatenate(([0], ends))[at]
    return flat.astype(np.int32), at


def decode(pieces: Pieces, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of lists of ids: (bytes, offsets); the space that encoding puts before a text is taken away."""
    size = pieces.raw_len[ids]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    raw = pieces.raw[np.repeat(pieces.raw_end[ids] - ends, size) + np.arange(total)]
    offsets = np.concatenate(([0], ends))[at]
    if pieces.prefix:
        full = np.flatnonzero(np.diff(offsets) > 0)
        lead = full[raw[offsets[full]] == 32]
        keep = np.ones(total, bool)
        keep[offsets[lead]] = False
        offsets = np.concatenate(([0], np.cumsum(keep)))[offsets]
        raw = raw[keep]
    return raw, offsets


def encode_texts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (array of int) of each row of `docs`, by the model file at `path`.

    A null or empty text has no ids. Null doc_ids and repeated rows stay. Other columns are not read.
    """
    path = path or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches):
        pieces = load(path)
        for batch in batches:
            for rows, data, offsets in steps(batch):
                ids, at = encode(pieces, data, offsets)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode_ids(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Adds text, decoded from ids, to the rows of `encoded`; null ids give a null text. Bytes that are no UTF-8 become the replacement character."""
    path = path or public_tokenizers.path("piece_bpe_32k.model")
    kept = encoded.drop("text").columns

    def run(batches):
        pieces = load(path)
        for batch in batches:
            lists = batch.column("ids")
            ids, valid = lists.flatten().to_numpy(), lists.is_valid().to_pylist()
            at = np.concatenate(([0], np.cumsum(np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False))))).astype(np.int64)
            first = 0
            while first < len(lists):
                to = max(first + 1, int(np.searchsorted(at, at[first] + STEP_IDS, "right")) - 1)
                raw, offsets = decode(pieces, ids[at[first] : at[to]].astype(np.int64), at[first : to + 1] - at[first])
                raw = raw.tobytes()
                text = [raw[a:b].decode("utf-8", "replace") if ok else None for a, b, ok in zip(offsets, offsets[1:], valid[first:to], strict=False)]
                part = batch.slice(first, to - first)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(text, pa.string())], names=[*kept, "text"])
                first = to

    return encoded.select(*kept).mapInArrow(run, ", ".join([*(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in kept), "text string"]))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    decoded = decode_ids(encode_texts(docs))
    return decoded.select("doc_id", F.size("ids").alias("n_ids"), "ids", F.sha2("text", 256).alias("decoded_sha256"))
