"""Plain versions of the operators, for small tables: rows (doc_id, text)."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
GAPS = " \t\n\x0b\x0c\r"


def lines(docs):
    held = {}
    keys = {i: [x.strip(GAPS).translate(LOWER) for x in (t or "").split("\n")] for i, t in docs}
    for i, ks in keys.items():
        for k in ks:
            if len(k) >= 20:
                held.setdefault(k, set()).add(i)
    gone = {k: max(v) for k, v in held.items() if len(v) >= 3}
    out = {}
    for i, t in docs:
        own = (t or "").split("\n")
        kept = [x for x, k in zip(own, keys[i], strict=True) if gone.get(k, i) == i]
        out[i] = len(own), len(own) - len(kept), "\n".join(kept)
    return out


def shingles(text, width=5):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def near(docs, percent):
    sets = {i: shingles(t) for i, t in docs}
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def repeats(docs, length=50):
    first = {}
    raw = {i: (t or "").encode() for i, t in docs}
    for i in sorted(raw):
        for p in range(len(raw[i]) - length + 1):
            first.setdefault(raw[i][p : p + length], i)
    out = {}
    for i, b in raw.items():
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = True
        edge = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0]))))
        out[i] = len(b), int(gone.sum()), edge.tolist(), bytes(x for x, g in zip(b, gone, strict=True) if not g)
    return out


def rules(text):
    t = text or ""
    w = WORD.findall(t)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    covered = {p + k for p, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    some = [x for x in t.split("\n") if WORD.search(x)]
    n, chars = len(w), sum(map(len, w))
    symbols = sum(t.count(c) for c in "#*$%&|<>")
    dup = len(some) - len(set(some))
    failed = n < 50 or 100 * len(covered) > 50 * n
    capitals = sum(t.count(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ")
    bad = 10 * symbols > n or not 2 * n <= chars <= 14 * n or 3 * dup > len(t.split("\n")) or 10 * capitals > 3 * chars or 5 * t.count("!") > n
    return n, chars, symbols, dup, len(covered), failed, not failed and not bad


def pieces(text, tokenizer, capacity=2048):
    ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
    first = (len(ids) - 1) % capacity + 1
    cuts = [0, *range(first, len(ids) + 1, capacity)]
    return [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]


def importance(docs, target):
    """rows (n_features, weight, score, rank) by place in docs"""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def own(text):
        w = word.findall((text or "").translate(LOWER))
        return len(w), [zlib.crc32(f.encode()) % 10000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]]

    held = [own(t) for _, t in docs]
    s, t = Counter(b for _, f in held for b in f), Counter(b for x in target for b in own(x)[1])
    s_all, t_all = sum(s.values()) + 10000.0, sum(t.values()) + 10000.0
    out = []
    for (i, _), (_, f) in zip(docs, held, strict=True):
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((-out[k][2], docs[k][0] is not None, docs[k][0] or 0, k) for k, (n, _) in enumerate(held) if n >= 20)
    for rank, (*_, k) in enumerate(able[: 25 * len(able) // 100], 1):
        out[k][3] = rank
    return [tuple(x) for x in out]


def planted(doc_id, text):
    """The words of a text, repeated from some place on in one document of ten."""
    w = WORD.findall(text or "")
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [*w[:a], *(w[a + (i - a) % p] for i in range(a, len(w)))]
    return w


def runs(w, least=12):
    """(start, length, period) of all runs of a list, by comparing all places of all periods."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            begin = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > begin and i + q - begin >= max(least, 2 * q):
                found.setdefault((begin, i + q), q)
            i += i == begin
    return sorted((a, b - a, q) for (a, b), q in found.items())


def collapsed(w, found):
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def run_row(w):
    """n_runs to collapsed_sha256 of op11"""
    found = runs(w)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], digest("".join(f"{a},{n},{q}\n" for a, n, q in sorted(found, key=lambda r: (r[0], r[2])))), digest(collapsed(w, found))
