"""Exact substring dedup by prefix doubling over sampled positions.

Positions get ranks for prefixes of growing length; equal ranks are brought together, and a position whose rank is unique
drops out, since longer prefixes are unique too. A rank is a 64-bit name computed from the bytes, the same for equal
prefixes in every task, so the pair of ranks at a position and further on needs no join. For matches of 50 bytes:

1. Prefixes of 18 bytes, at sampled positions only: of the 33 prefixes that start in a 50-byte window the
   window's smallest name is taken, so equal windows have equal samples and no match is missed.
2. The samples are ranked again by the pairs of ranks 16 bytes apart, that is by 34 bytes from the sample on, and by the 34 bytes up to
   its end: one of the two lies in any 50-byte window that holds the sample. Samples that share neither with a different text drop out.
3. Around the samples left, the bytes of all windows that hold them travel to the bucket of the sample's name. There the positions
   are ranked by 25 bytes, then by the pair of ranks at a position and 25 bytes later, that is by 50 bytes, sorted, confirmed by their bytes, and each
   learns the smallest document with its rank.

Samples travel as packed arrays, in buckets of bounded size; equal ones of a block of texts are merged before they travel. A bucket that is too large all
the same, as what surrounds a sample in very many documents differs, is judged in parts; the windows that are left of these meet by their own ranks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm.common import byte_codes, fields, mix, span_hash, staged, steps

SAMPLE = 18
#: Bytes of text that a bucket of samples stands for, and samples that are merged before they travel, about.
BUCKET_BYTES = 8 << 20
BLOCK = 1_000_000
#: Surroundings that one task judges, and windows that meet in one group after that, about.
MOST_AROUND, MOST_WINDOWS = 600_000, 2_000_000


def _windows(codes: np.ndarray, length: int) -> np.ndarray:
    """64-bit names of the `length` bytes from each position, by doubling the prefix; the last length - 1 entries mean nothing."""
    name, have, out, done = codes.copy(), 1, None, 0
    rest = length
    while rest:
        if rest & 1:
            out = name.copy() if out is None else _joined(out, name, done)
            done += have
        rest >>= 1
        if rest:
            name = _joined(name, name, have)
            have *= 2
    return out


def _joined(a: np.ndarray, b: np.ndarray, at: int) -> np.ndarray:
    """The name of the pair (a[p], b[p + at]) at each p."""
    out = a * np.uint64(0xD6E8FEB86659FD93)
    out[: len(a) - at] += b[at:]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def _slide(x: np.ndarray, width: int, pick, back: bool = False) -> np.ndarray:
    """pick over x[p : p + width], or over x[p - width + 1 : p + 1] with `back`; windows are cut at the ends."""
    x = x[::-1] if back else x
    out, have = x.copy(), 1
    while have < width:
        step = min(have, width - have)
        out[: len(x) - step] = pick(out[: len(x) - step], out[step:])
        have += step
    return out[::-1] if back else out


def _sampled(data: np.ndarray, offsets: np.ndarray, length: int, span: int):
    """(names of `SAMPLE` bytes, smallest name of each window, whether a window lies in one text)."""
    n = len(data)
    whole = np.zeros(n, bool)
    for_row = np.repeat(offsets[1:], np.diff(offsets))
    whole = np.arange(n) + length <= for_row
    name = _windows(byte_codes(data), SAMPLE)
    name[np.arange(n) + SAMPLE > for_row] = np.uint64(0xFFFFFFFFFFFFFFFF)
    return name, _slide(name, span, np.minimum), whole


def _packed(bucket: np.ndarray, buckets: int, columns: dict[str, np.ndarray], direct: dict[str, np.ndarray]) -> pa.RecordBatch:
    """A row for each bucket: its entries of `columns` as packed bytes, and a share of `direct`, which no bucket needs to judge. Entries are in the order of `docs` and `spots`."""
    order = np.lexsort((columns["spots"], columns["docs"], bucket))
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    known = np.arange(buckets + 1) * len(next(iter(direct.values()))) // buckets
    some = [b for b in range(buckets) if cuts[b] < cuts[b + 1] or known[b] < known[b + 1]]
    own = [pa.array([_pack(x[order[cuts[b] : cuts[b + 1]]]) for b in some], pa.binary()) for x in columns.values()]
    own += [pa.array([_pack(x[known[b] : known[b + 1]]) for b in some], pa.binary()) for x in direct.values()]
    return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *own], names=["bucket", *columns, *direct])


def _pack(x: np.ndarray) -> bytes:
    """Bytes of an array: of signed ones the differences, compressed."""
    if x.dtype.kind == "i":
        x = np.diff(x, prepend=x.dtype.type(0))
    raw = x.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True) if raw else b""


def _column(rows: pd.Series, kind) -> np.ndarray:
    """The arrays that _pack made, one after the other."""
    out = [np.frombuffer(pa.decompress(x[8:], int.from_bytes(x[:8], "little"), "zstd"), kind) for x in rows if x]
    out = [np.cumsum(x, dtype=kind) for x in out] if np.dtype(kind).kind == "i" else out
    return np.concatenate(out) if out else np.zeros(0, kind)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin, in sorted arrays."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(new)


def _kinds(names: np.ndarray, ranks: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries by name (48 bits) and rank (16): (which of them are of a kind that two texts have, one entry of each such kind); rank 0 is none, text 0 differs from any."""
    at = np.flatnonzero(ranks)
    key = names[at] << np.uint64(16) | ranks[at]
    order = np.argsort(key)
    at, key = at[order], key[order]
    if not len(at):
        return at, at
    cut, own = _runs(key), texts[at]
    low = np.minimum.reduceat(own, cut)
    mixed = (low != np.maximum.reduceat(own, cut)) | (low == 0)
    return at[np.repeat(mixed, np.diff(np.append(cut, len(at))))], at[cut[mixed]]


def _samples(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    """The samples of all texts as packed arrays, in blocks. What two texts of a block share goes to its bucket once; the block's samples of that kind are known to be shared."""
    span, half = length - SAMPLE + 1, (length - SAMPLE) // 2

    def emit(held):
        name, left, right, text, doc, tag, spot = (np.concatenate(x) for x in zip(*held, strict=True))
        known = np.zeros(len(name), bool)
        tell = np.zeros(len(name), bool)  # speaks for the known ones of its kind
        for rank in (left, right):
            mine, one = _kinds(name >> np.uint64(16), rank, text)
            known[mine], tell[one] = True, True
        text = np.where(tell, np.uint64(0), text)
        ask = ~known | tell
        columns = {"names": (name[ask] >> np.uint64(24)).astype(np.uint32), "lefts": left[ask], "rights": right[ask], "texts": text[ask], "docs": doc[ask], "tags": tag[ask], "spots": spot[ask]}
        return _packed((name[ask] % np.uint64(buckets)).astype(np.int64), buckets, columns, {"known_docs": doc[known], "known_tags": tag[known], "known_spots": spot[known]})

    def sample(batches):
        held, size = [], 0
        for batch in batches:
            for rows, data, offsets in steps(batch, end=""):
                if len(data) < length:
                    continue
                name, least, whole = _sampled(data, offsets, length, span)
                least = np.where(whole, least, np.uint64(0))
                at = np.flatnonzero((_slide(least, span, np.maximum, back=True) == name) & (name < np.uint64(0xFFFFFFFFFFFFFFFF)))
                row = np.searchsorted(offsets, at, "right") - 1
                # a part of the rank of the pair (p, p + half) will do to tell what need not be looked at
                pair = lambda p: (mix(name[p] ^ mix(name[np.minimum(p + half, len(name) - 1)])) >> np.uint64(48)).astype(np.uint16) | np.uint16(1)  # noqa: B023, E731
                right = np.where(at + SAMPLE + half <= offsets[row + 1], pair(at), np.uint16(0))
                left = np.where(at - half >= offsets[row], pair(np.maximum(at - half, 0)), np.uint16(0))
                text = rows.column("mark").to_numpy().view(np.uint64)[row] | np.uint64(1)
                held.append((name[at], left, right, text, rows.column("doc_id").to_numpy()[row], rows.column("tag").to_numpy()[row], (at - offsets[row]).astype(np.int32)))
                size += len(at)
                if size >= BLOCK:
                    yield emit(held)
                    held, size = [], 0
        if size:
            yield emit(held)

    marked = docs.select("doc_id", "tag", F.xxhash64("text").alias("mark"), "text")
    return marked.mapInArrow(sample, "bucket int, names binary, lefts binary, rights binary, texts binary, docs binary, tags binary, spots binary, known_docs binary, known_tags binary, known_spots binary")


def _shared_samples(samples: DataFrame) -> DataFrame:
    """(doc_id, tag, spot) of samples that share with another text the bytes from them on, or up to them."""

    def keep(rows: pd.DataFrame) -> pd.DataFrame:
        name, text = _column(rows.names, np.uint32).astype(np.uint64), _column(rows.texts, np.uint64)
        mixed = np.zeros(len(name), bool)
        for rank in (rows.lefts, rows.rights):
            mixed[_kinds(name, _column(rank, np.uint16), text)[0]] = True
        at = np.flatnonzero(mixed & (text > 0))
        doc = np.concatenate((_column(rows.docs, np.int64)[at], _column(rows.known_docs, np.int64)))
        tag = np.concatenate((_column(rows.tags, np.int64)[at], _column(rows.known_tags, np.int64)))
        spot = np.concatenate((_column(rows.spots, np.int32)[at], _column(rows.known_spots, np.int32)))
        return pd.DataFrame({"doc_id": doc, "tag": tag, "spot": spot})

    return samples.groupBy("bucket").applyInPandas(keep, "doc_id long, tag long, spot int")


def _block(doc, blocks: int):
    """The block that a document's results are gathered in; the same for columns and arrays."""
    if isinstance(doc, np.ndarray):
        return ((doc ^ (doc >> 17)) % blocks).astype(np.int32)
    return F.pmod(doc.bitwiseXOR(F.shiftright(doc, 17)), F.lit(blocks)).cast("int")


_AROUND = "docs binary, tags binary, spots binary, lefts binary, rights binary, raws binary"
_KNOWN = "known_docs binary, known_tags binary, known_starts binary, known_counts binary"
_FOUND = "block int, docs binary, tags binary, starts binary, counts binary"


def _surroundings(suspects: DataFrame, length: int, buckets: int) -> DataFrame:
    """The bytes of all windows that hold a shared sample, packed. Of equal ones of a block, that of the smallest document goes to its bucket; the windows of the others are known to be repeats."""
    before = length - SAMPLE
    width = before + length

    def emit(held):
        name, doc, tag, spot, left, right, raw = (np.concatenate(x) for x in zip(*held, strict=True))
        padded = np.zeros((len(raw), -(-width // 8) * 8), np.uint8)
        padded[:, :width] = raw
        digest = left.astype(np.uint64) << np.uint64(8) | right
        for part in padded.view(np.uint64).T:
            digest = mix(digest ^ part)
        order = np.lexsort((doc, digest))
        cut = _runs(digest[order])
        first = order[np.repeat(cut, np.diff(np.append(cut, len(order))))]
        known = np.zeros(len(doc), bool)
        known[order] = (doc[order] > doc[first]) & (left[order] == left[first]) & (right[order] == right[first])
        at = np.flatnonzero(known[order])
        known[order[at]] = (raw[order[at]] == raw[first[at]]).all(1)
        ask = ~known
        columns = {"docs": doc[ask], "tags": tag[ask], "spots": spot[ask], "lefts": left[ask], "rights": right[ask], "raws": raw[ask]}
        direct = {"known_docs": doc[known], "known_tags": tag[known], "known_starts": (spot - left)[known].astype(np.int32), "known_counts": (left.astype(np.int32) + right + 1 - length)[known]}
        bucket = (name[ask] % np.uint64(buckets)).astype(np.int64)
        out = _packed(bucket, buckets, columns, direct)
        return out.append_column("n", pa.array(np.bincount(bucket, minlength=buckets)[out.column("bucket").to_numpy()].astype(np.int64)))

    def gather(batches):
        held, size = [], 0
        for batch in batches:
            for rows, data, offsets in steps(batch, end=""):
                spots = rows.column("spots")
                spot = spots.flatten().to_numpy()
                row = np.repeat(np.arange(rows.num_rows), np.diff(spots.offsets.to_numpy()))
                at = spot + offsets[row]
                left = np.minimum(before, spot).astype(np.uint8)
                right = np.minimum(length, offsets[row + 1] - at).astype(np.uint8)
                name = span_hash(byte_codes(data), at, at + SAMPLE)
                reach = np.arange(-before, length)
                raw = data[np.clip(at[:, None] + reach, 0, len(data) - 1)] if len(at) else np.zeros((0, width), np.uint8)
                raw[(reach < -left[:, None].astype(np.int64)) | (reach >= right[:, None])] = 0
                held.append((name, rows.column("doc_id").to_numpy()[row], rows.column("tag").to_numpy()[row], spot.astype(np.int32), left, right, raw))
                size += len(at)
                if size >= BLOCK // 4:
                    yield emit(held)
                    held, size = [], 0
        if size:
            yield emit(held)

    return suspects.mapInArrow(gather, f"bucket int, {_AROUND}, {_KNOWN}, n long")


def _again(value: np.ndarray, doc: np.ndarray, window) -> tuple[np.ndarray, np.ndarray]:
    """(which windows a smaller document holds too, which are the first of their kind): windows are sorted by rank, equal ranks are confirmed by window(places), the bytes."""
    again, lead = np.zeros(len(value), bool), np.zeros(len(value), bool)
    if not len(value):
        return again, lead
    order = np.argsort(value)
    cut, own = _runs(value[order]), doc[order]
    size = np.diff(np.append(cut, len(order)))
    smallest = np.flatnonzero(own == np.repeat(np.minimum.reduceat(own, cut), size))
    head = order[smallest[np.searchsorted(smallest, cut)]]
    first = np.repeat(head, size)
    lead[head] = True
    again[order] = own > doc[first]
    differ = []
    for a in range(0, len(order), 1 << 17):
        x, y = order[a : a + (1 << 17)], first[a : a + (1 << 17)]
        other = x != y
        differ.append(y[other][(window(x[other]) != window(y[other])).any(1)])
    for k in np.unique(np.concatenate(differ)):  # different bytes under one rank
        own = order[first == k]
        own = own[np.argsort(doc[own], kind="stable")]
        _, at, kind = np.unique(window(own), axis=0, return_index=True, return_inverse=True)
        lead[own] = False
        lead[own[at]] = True
        again[own] = doc[own] > doc[own[at]][kind.ravel()]
    return again, lead


def _ranked(rows: pd.DataFrame, length: int):
    """The windows of packed surroundings: (docs, tags, spots, bytes around, entry and place of each window, its rank)."""
    before, half = length - SAMPLE, length // 2
    doc, tag, spot = _column(rows.docs, np.int64), _column(rows.tags, np.int64), _column(rows.spots, np.int32)
    left, right = _column(rows.lefts, np.uint8), _column(rows.rights, np.uint8)
    raw = _column(rows.raws, np.uint8).reshape(-1, before + length)
    starts = np.arange(before + 1)
    rank = np.empty((len(doc), before + 1), np.uint64)
    for a in range(0, len(doc), 8192):
        flat = byte_codes(raw[a : a + 8192].ravel())
        some = _windows(flat, half)
        rest = _windows(flat, length - half) if length - half != half else some
        pick = (np.arange(len(flat) // (before + length)) * (before + length))[:, None] + starts
        rank[a : a + 8192] = mix(some[pick] ^ mix(rest[pick + half]))
    real = (starts >= before - left[:, None].astype(np.int64)) & (starts + length <= before + right[:, None].astype(np.int64))
    i, c = np.nonzero(real)
    return doc, tag, spot, raw, i, c, rank[i, c]


def _dealt(doc, tag, start, count, blocks: int) -> pd.DataFrame:
    """Runs of positions, packed by the block that their document's results are gathered in."""
    block = _block(doc ^ tag, blocks)
    order = np.lexsort((start, tag, doc, block))
    some, begin = np.unique(block[order], return_index=True)
    ends = np.append(begin[1:], len(doc))
    part = lambda x: [_pack(x[order[a:b]]) for a, b in zip(begin, ends, strict=False)]
    return pd.DataFrame({"block": some.astype(np.int32), "docs": part(doc), "tags": part(tag), "starts": part(start.astype(np.int32)), "counts": part(count.astype(np.int32))})


def _bytes_at(raw: np.ndarray, i: np.ndarray, c: np.ndarray, length: int):
    """A function from places among the windows to their bytes."""
    flat, width = raw.ravel(), raw.shape[1]
    every = np.lib.stride_tricks.sliding_window_view(flat, length) if len(flat) >= length else np.zeros((0, length), np.uint8)
    return lambda at: every[i[at] * width + c[at]]


def _covered(around: DataFrame, length: int, blocks: int) -> DataFrame:
    """(block, docs, tags, starts, counts): runs of positions whose first `length` bytes also start in a smaller document."""
    before = length - SAMPLE

    def runs_of(rows, judged, again):
        doc, tag, spot, raw, i, c, _ = judged
        gone = np.zeros(len(doc) * (before + 1) + 1, bool)
        gone[(i * (before + 1) + c)[again]] = True
        step = np.diff(np.pad(gone[:-1].reshape(-1, before + 1), ((0, 0), (1, 1))).astype(np.int8), axis=1)
        i, c = np.nonzero(step == 1)
        _, end = np.nonzero(step == -1)
        known = [_column(rows[k], np.int64 if k in ("known_docs", "known_tags") else np.int32) for k in ("known_docs", "known_tags", "known_starts", "known_counts")]
        return [np.concatenate(x) for x in zip((doc[i], tag[i], spot[i] - before + c, end - c), known, strict=True)]

    def judge(rows: pd.DataFrame) -> pd.DataFrame:
        judged = _ranked(rows, length)
        doc, _, _, raw, i, c, rank = judged
        again, _ = _again(rank, doc[i], _bytes_at(raw, i, c, length))
        return _dealt(*runs_of(rows, judged, again), blocks)

    staged_around = staged(around)
    sizes = staged_around.groupBy("bucket").agg(F.sum("n").alias("entries")).where(F.col("entries") > MOST_AROUND)
    # one row for each too large bucket, of which there are at most as many as MOST_AROUND goes into all entries
    large = staged(sizes.withColumn("parts", F.ceil(F.col("entries") / MOST_AROUND)))
    if large.isEmpty():
        return staged_around.groupBy("bucket").applyInPandas(judge, _FOUND)
    usual = staged_around.join(large, "bucket", "left_anti").groupBy("bucket").applyInPandas(judge, _FOUND)
    meets = max(1, -(-large.agg(F.sum("entries")).first()[0] * (before + 1) // MOST_WINDOWS))

    def thin(rows: pd.DataFrame) -> pd.DataFrame:
        judged = _ranked(rows, length)
        doc, tag, spot, raw, i, c, rank = judged
        again, lead = _again(rank, doc[i], _bytes_at(raw, i, c, length))
        found = _dealt(*runs_of(rows, judged, again), blocks).assign(meet=-1, raws=b"")
        lead = np.flatnonzero(lead)
        to = (rank[lead] % np.uint64(meets)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        some, begin = np.unique(to[order], return_index=True)
        of = [lead[order[a:b]] for a, b in zip(begin, np.append(begin[1:], len(order)), strict=False)]
        window = _bytes_at(raw, i, c, length)
        part = lambda f: [_pack(f(x)) for x in of]
        left = {"docs": part(lambda x: doc[i[x]]), "tags": part(lambda x: tag[i[x]]), "starts": part(lambda x: (spot[i[x]] - before + c[x]).astype(np.int32)), "counts": [b""] * len(of), "raws": part(window)}
        return pd.concat([found, pd.DataFrame({"block": -1, "meet": some.astype(np.int32), **left})], ignore_index=True)

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        doc, tag, start = _column(rows.docs, np.int64), _column(rows.tags, np.int64), _column(rows.starts, np.int32)
        raw = _column(rows.raws, np.uint8).reshape(-1, length)
        rank = np.zeros(len(raw), np.uint64)
        for k in range(0, length, 8):
            part = np.zeros((len(raw), 8), np.uint8)
            part[:, : length - k] = raw[:, k : k + 8]
            rank = mix(rank ^ part.view(np.uint64)[:, 0])
        again, _ = _again(rank, doc, lambda at: raw[at])
        at = np.flatnonzero(again)
        return _dealt(doc[at], tag[at], start[at], np.ones(len(at), np.int32), blocks)

    parts = staged_around.join(large.select("bucket", "parts"), "bucket").withColumn("part", F.pmod(F.xxhash64("docs", "spots", "known_docs", "known_starts"), "parts"))
    thinned = staged(parts.groupBy("bucket", "part").applyInPandas(thin, f"{_FOUND}, meet int, raws binary"))
    left = thinned.where("meet >= 0").groupBy("meet").applyInPandas(meet, _FOUND)
    return usual.unionByName(thinned.where("meet < 0").select("block", "docs", "tags", "starts", "counts")).unionByName(left)


def _by_document(found: DataFrame) -> DataFrame:
    """(doc_id, tag, starts, counts): the runs of each document, packed."""

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        doc, tag, start, count = _column(rows.docs, np.int64), _column(rows.tags, np.int64), _column(rows.starts, np.int32), _column(rows.counts, np.int32)
        order = np.lexsort((start, tag, doc))
        doc, tag, start, count = doc[order], tag[order], start[order], count[order]
        cut = _runs(doc, tag) if len(doc) else order
        ends = np.append(cut[1:], len(doc))
        part = lambda x: [_pack(x[a:b]) for a, b in zip(cut, ends, strict=False)]
        return pd.DataFrame({"doc_id": doc[cut], "tag": tag[cut], "starts": part(start), "counts": part(count)})

    return found.groupBy("block").applyInPandas(gather, "doc_id long, tag long, starts binary, counts binary")


def _cut(marked: DataFrame, length: int, others: list[str]) -> DataFrame:
    """The texts without what (copy, starts, counts) say is covered; `others` stay as they are."""

    def cut(batches):
        for batch in batches:
            rows = {c: batch.column(c).to_pylist() for c in ("text", "copy", "starts", "counts")}
            n_bytes, n_removed, spans, kept = [], [], [], []
            for text, copy, starts, counts in zip(*rows.values(), strict=True):
                raw = np.frombuffer(text.encode(), np.uint8)
                n = len(raw)
                if copy and n >= length:
                    edge, raw = np.array([0, n]), raw[:0]
                elif starts and not copy:
                    start, count = _column([starts], np.int32), _column([counts], np.int32)
                    step = np.bincount(np.minimum(start, n), minlength=n + 1) - np.bincount(np.minimum(start + count + length - 1, n), minlength=n + 1)
                    gone = np.cumsum(step[:-1]) > 0
                    edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
                    raw = raw[~gone]
                else:
                    edge = np.zeros(0, np.int64)
                n_bytes.append(n)
                n_removed.append(n - len(raw))
                spans.append(edge.tolist())
                kept.append(raw.tobytes())
            own = [batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([*own, *(batch.column(c) for c in others)], names=["doc_id", "n_bytes", "n_removed", "spans", "kept", *others])

    return marked.mapInArrow(cut, fields("doc_id long, n_bytes long, n_removed long, spans array<long>, kept binary", marked, others))


def remove_repeats(docs: DataFrame, length: int = 50, others: tuple[str, ...] = ()) -> DataFrame:
    """Removes from each text the bytes covered by a `length`-byte string that also starts in a document with a smaller doc_id.

    Texts are UTF-8 bytes; matches do not cross documents; strings are judged on the input. Reads doc_id and text of `docs`. Returns doc_id, n_bytes,
    n_removed, spans (array of alternating starts and ends of the maximal removed runs), kept (the remaining bytes), and the columns `others` of the row.

    A null or empty text has no bytes; a very long one is worked on whole. Rows repeating a doc_id are texts of one document: none removes bytes of
    another, each is judged by its own text, and each comes back. Rows with a null doc_id are one document, that of the smallest long. An empty table
    gives an empty result. A row is known by its doc_id and tag, a hash of the text; where no doc_id is repeated, tags are 0.
    """
    if not SAMPLE < length < 128:
        raise ValueError(f"length is between {SAMPLE + 1} and 127")
    null_id, row, others = -(1 << 63), ["doc_id", "tag"], list(others)
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(null_id)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *others)
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    repeated = not docs.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").isEmpty()
    docs = docs.withColumn("tag", F.xxhash64("text") if repeated else F.lit(0).cast("long"))
    buckets = max(4, -(-total // BUCKET_BYTES))
    shared = staged(_shared_samples(_samples(docs, length, buckets)))
    shared = shared.groupBy(*row).agg(F.collect_set("spot").alias("spots"))

    copies = docs.select(*row, F.sha2("text", 256).alias("digest"), F.octet_length("text").alias("n"))
    first = staged(copies.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")).where("rows > 1").drop("rows"))
    repeats = staged(copies.join(first, "digest").where("doc_id > first").groupBy(*row).agg(F.first("n").alias("n")))
    # both uses of the texts read the same exchange
    suspects = docs.join(shared.join(repeats, row, "left_anti"), row).select(*row, "text", "spots", *others)
    found = _by_document(_covered(_surroundings(suspects, length, buckets), length, buckets))
    marked = docs.join(found, row, "left").join(repeats, row, "left").select("doc_id", "text", F.col("n").isNotNull().alias("copy"), "starts", "counts", *others)
    return _cut(marked, length, others).withColumn("doc_id", F.nullif("doc_id", F.lit(null_id)))


def kept_text(cut: DataFrame, others: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text) and the columns `others` of what remove_repeats returns: the bytes kept as text; bytes of a character that lost some of them are left out."""

    def read(batches):
        for batch in batches:
            text = pa.array([(x.as_py() or b"").decode("utf-8", "ignore") for x in batch.column("kept")], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), text, *(batch.column(c) for c in others)], names=["doc_id", "text", *others])

    return cut.select("doc_id", "kept", *others).mapInArrow(read, fields("doc_id long, text string", cut, list(others)))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", (F.size("spans") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
y AS (SELECT doc_id, c, x[2000 * c + 1 : 2000 * c + 2098] AS y FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2000 + 1)) AS c FROM d)),
w AS (SELECT doc_id, 1000 * c + j AS i, y[2 * j + 1 : 2 * j + 100] AS s FROM (SELECT doc_id, c, y, unnest(range(0, len(y) // 2 - 49)) AS j FROM y WHERE len(y) >= 100)),
m AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
g AS (SELECT doc_id, i FROM w JOIN m USING (s) WHERE doc_id > first),
e AS (SELECT *, max(i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM g),
t AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM e),
r AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM t GROUP BY doc_id, run),
c AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS f, a AS u FROM r
  UNION ALL SELECT doc_id, max(b), 1000000000 FROM r GROUP BY doc_id),
k AS (SELECT doc_id, string_agg(x[2 * f + 1 : 2 * u], '' ORDER BY f) AS kept FROM c JOIN d USING (doc_id) GROUP BY doc_id),
n AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM r GROUP BY doc_id)
SELECT doc_id, len(x) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
"""
