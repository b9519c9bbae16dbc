"""The operators for training text against plain versions, an exact round trip, or labels held out, and on odd tables."""

import random

import numpy as np
import pytest

pytest.importorskip("voxlake.llm.common")
from pyspark.sql import functions as F  # noqa: E402

from tests.llm import brute  # noqa: E402
from voxlake.llm import components, fingerprints, html_text, labelled, line_dedup, minhash, packing, pieces, quality_classifier, quality_rules, suffix_dedup, toxicity  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, line int, id long, block int, spots int, score double, salt int, n long, c long"
VOCABULARY = [f"{a}{b}" for a in ("an", "bel", "cor", "du", "eß", "fi", "ñu") for b in ("tor", "mi", "la", "ve", "", "st")]


def corpus(seed=0, groups=6, copies=7):
    """Texts with exact copies, a drifting group of near copies, shared lines and passages, and odd ones."""
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice(VOCABULARY) for _ in range(n))
    shared, passage = text(9).title(), text(40)
    out = []
    for g in range(groups):
        base = text(rng.randrange(60, 160)).split(" ")
        for _ in range(copies):
            if rng.random() < 0.7:
                base = list(base)
                base[rng.randrange(len(base))] = "x" + rng.choice(VOCABULARY)
            body = " ".join(base)
            out.append(body if g % 2 else f"{shared}\n{body}\n{text(3)}\n  {shared.upper()}\t")
    out += [f"{text(20)} {passage} {text(20)}" for _ in range(5)] + [out[0], out[0], text(3), "a", "", " \n\t", None, "no-space" * 4000, "é" * 70, "日本語" * 40, "!! " * 80, "A\n" * 60, text(4), text(4)]
    rng.shuffle(out)
    return list(enumerate(out, 3))


@pytest.fixture(scope="module")
def docs():
    return corpus()


def frame(spark, rows):
    filler = [None] * 12
    return spark.createDataFrame([(i, t, *filler) for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def table(spark, docs):
    return frame(spark, docs).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_line_dedup(table, docs, empty):
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in line_dedup.dedup_lines(table).collect()}
    assert got == brute.lines(docs)
    assert sum(r[1] for r in got.values()) > 10
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_dedup_null_id_and_repeated_rows(spark):
    line = "a line that is long enough"
    got = sorted(tuple(r) for r in line_dedup.dedup_lines(frame(spark, [(1, line), (1, line), (2, line)])).collect())
    assert got == [(1, 1, 0, line), (1, 1, 0, line), (2, 1, 0, line)]  # two documents only
    got = {r.doc_id: r.kept_text for r in line_dedup.dedup_lines(frame(spark, [(None, line), (5, line), (9, line)])).collect()}
    assert got == {None: "", 5: "", 9: line}


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates(table, docs, empty, percent):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(table, percent=percent).collect()}
    want = brute.near(docs, percent)
    assert got == want
    assert len({c for _, c in want.values()}) < len(want) - 10
    assert minhash.near_duplicates(empty).count() == 0


def test_near_duplicates_null_id_and_repeated_rows(spark):
    text = " ".join(VOCABULARY)
    got = sorted((r.doc_id or -1, r.component_id, r.kept) for r in minhash.near_duplicates(frame(spark, [(None, text), (4, text), (4, text), (6, "other words here")])).collect())
    assert got == [(-1, None, True), (4, None, False), (4, None, False), (6, 6, True)]


def test_blocks_find_every_link():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 300, 200).astype(np.int64)) for _ in range(6)]
    sets += [np.sort(np.append(s[: int(len(s) * 0.95)], 1000 + k)) for k, s in enumerate(sets)]
    got = minhash._links_between(sets[:6], sets[6:], 85, columns=64)
    want = [[100 * len(set(a) & set(b)) >= 85 * len(set(a) | set(b)) for b in sets[6:]] for a in sets[:6]]
    assert got.tolist() == want and got.any()


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(200, x) for x in range(201, 260)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(7, 7)]
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    links = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components.components(links).collect()}
    assert got == {x: c for x, c in root.items() if any(x in e and e[0] != e[1] for e in edges)}


@pytest.mark.parametrize(("block", "most"), [(suffix_dedup.BLOCK, suffix_dedup.MOST_AROUND), (40, 20)])
def test_suffix_dedup(table, docs, empty, block, most, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    monkeypatch.setattr(suffix_dedup, "MOST_AROUND", most)  # too large buckets are judged in parts
    monkeypatch.setattr(suffix_dedup, "MOST_WINDOWS", 50 * most)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(table).collect()}
    assert got == brute.repeats(docs)
    assert sum(r[1] for r in got.values()) > 1000
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_equal_ranks_are_confirmed_by_bytes():
    rng = np.random.default_rng(2)
    raw, doc = rng.integers(0, 2, (300, 6)).astype(np.uint8), rng.integers(0, 40, 300)
    first = {}
    for d, r in sorted(zip(doc.tolist(), map(bytes, raw), strict=True)):
        first.setdefault(r, d)
    for rank in (np.zeros(300, np.uint64), raw[:, 0].astype(np.uint64), np.packbits(raw, axis=1)[:, 0].astype(np.uint64)):
        again, lead = suffix_dedup._again(rank, doc, lambda at: raw[at])
        assert again.tolist() == [first[bytes(r)] < d for d, r in zip(doc.tolist(), raw, strict=True)]
        assert lead.sum() == len(first) and {bytes(r): d for r, d in zip(raw[lead], doc[lead].tolist(), strict=True)} == first


def test_suffix_dedup_of_a_long_text_and_hot_edges(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MOST_AROUND", 60)
    rng = random.Random(21)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = text(90)
    rows = [(i, f"{text(40)}{passage}{text(40)}") for i in range(60)] + [(60, text(200_000) + passage), (61, None)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(frame(spark, rows)).collect()}
    assert got == brute.repeats(rows) and sum(r[1] for r in got.values()) >= 60 * 90


def test_suffix_dedup_null_id_and_repeated_rows(spark):
    text = " ".join(VOCABULARY)
    got = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(frame(spark, [(None, text), (2, text), (2, text), (3, "short")])).collect()}
    assert got == {None: 0, 2: len(text.encode()), 3: 0}


def test_suffix_dedup_different_texts_under_one_id(spark):
    rng = random.Random(8)
    text = lambda n: " ".join(rng.choice(VOCABULARY) + str(rng.randrange(999)) for _ in range(n))
    a, b, c, d, e = (text(30) for _ in range(5))
    rows = [(None, a), (None, "short"), (None, f"{b} {a}"), (2, f"{text(4)} {c} {text(90)}"), (5, f"{text(9)} {a}"), (5, c), (5, text(50)), (5, d), (7, d), (7, e), (7, e), (9, f"{e}{b}")]
    raw = [(-1 if i is None else i, t.encode()) for i, t in rows]
    first = {}
    for i, t in sorted(raw):
        for p in range(len(t) - 49):
            first.setdefault(t[p : p + 50], i)
    want = []
    for i, t in raw:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - 49):
            gone[p : p + 50] |= first[t[p : p + 50]] < i
        want.append((i, bytes(np.frombuffer(t, np.uint8)[~gone])))
    got = [(-1 if r.doc_id is None else r.doc_id, bytes(r.kept)) for r in suffix_dedup.remove_repeats(frame(spark, rows)).collect()]
    assert sorted(got) == sorted(want) and sum(len(t) for _, t in raw) > sum(len(k) for _, k in want) + 400


def test_suffix_stage_keeps_rows_of_one_id_apart(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    rows = [(None, "first text", "a"), (None, "second, longer text", "b"), (3, "third", "c"), (3, "fourth", "d")]
    docs = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = pipeline.suffix_dedup(spark, docs, "")
    assert out.schema.simpleString() == docs.schema.simpleString()
    assert sorted((r.text, r.source, r.n_chars) for r in out.collect()) == sorted((t, s, len(t)) for _, t, s in rows)


def test_suffix_dedup_text_of_cut_characters(spark):
    rows = spark.createDataFrame([(1, "aé".encode()[:2] + b"b")], "doc_id long, kept binary")
    assert suffix_dedup.kept_text(rows).first()["text"] == "ab"


def test_quality_rules(table, docs, empty):
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in quality_rules.measure(table).collect()}
    assert got == {i: brute.rules(t) for i, t in docs}
    kept = quality_rules.filter_documents(table)
    assert kept.columns == table.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r[-1]}
    assert quality_rules.measure(empty).count() == 0 == quality_rules.filter_documents(empty).count()


def test_quality_rules_plan_orders_by_rejections_per_cost(table):
    plan = quality_rules.plan_cascade(table, quality_rules.DEFAULT_RULES)
    value = [p["share"] / p["cost"] for p in plan]
    assert value == sorted(value, reverse=True) and {p["name"] for p in plan} == set(quality_rules.DEFAULT_RULES)


def plain_anchors(text):
    """[(place, hash)] by definition."""
    import struct

    import regex
    import xxhash

    def h(items):
        seed = 42
        for x in items:
            seed = xxhash.xxh64_intdigest(x.encode() if isinstance(x, str) else struct.pack("<q", x), seed)
        return seed - (1 << 64) if seed >> 63 else seed

    units = regex.findall(r"(?V1)[[\p{L}\p{M}\p{N}]--[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}]]+|[^\x20\x09-\x0D]", text or "")
    k, s = fingerprints.K, fingerprints.S
    if not units:
        return []
    units = [""] * (k - 1) + units + ["\n"] * (k - 1)
    g = [h(units[p : p + s]) for p in range(len(units) - s + 1)]
    out = {}
    for p in range(len(g) - k + s):
        if min(g[p], g[p + k - s]) <= min(g[p + 1 : p + k - s]):
            out.setdefault(h([g[p + i] for i in (0, 2, 4)]) & 0x7FFFFFFF, p)
    return sorted((p, x) for x, p in out.items())


def plain_likeness(a, b):
    place = {x: p for p, x in b}
    at = [place[x] for _, x in a if x in place]
    m = len(at) if len(at) < 2 else sum((i > 0 and at[i - 1] < p) or (i + 1 < len(at) and p < at[i + 1]) for i, p in enumerate(at))
    return 2 * m / (len(a) + len(b)) if a or b else 1.0


def test_fingerprints(table, docs, empty):
    got = {r.doc_id: [(x >> 32, x & 0x7FFFFFFF) for x in r.anchors] for r in fingerprints.fingerprint(table).collect()}
    assert got == {i: plain_anchors(t) for i, t in docs}
    assert all(bool(a) == bool(brute.WORD.search(dict(docs)[i] or "")) for i, a in got.items())
    assert fingerprints.fingerprint(empty).count() == 0


def test_fingerprints_query_against_a_plain_version(spark, docs, tmp_path):
    import hashlib

    rows = [*docs, (-(1 << 63), docs[0][1]), ((1 << 63) - 1, "far off " * 9), (1 << 40, "long text " * 100_000)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in fingerprints.op8_fingerprints(spark, str(tmp_path)).collect()}
    rows = sorted(((i, t or "") for i, t in rows), reverse=True)
    for (i, t), (_, n) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(t) // 2
        e = t[: len(t) - half] + n[:half]
        a, b, c = plain_anchors(t), plain_anchors(e), plain_anchors(n)
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert got[i].fingerprint == " ".join(f"{p}:{x}" for p, x in a) and got[i].edited_fingerprint == " ".join(f"{p}:{x}" for p, x in b)
        assert abs(got[i].near_edited - plain_likeness(a, b)) < 1e-12 and abs(got[i].near_next - plain_likeness(a, c)) < 1e-12
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert fingerprints.op8_fingerprints(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("n", [12, 62, 63, 64, 70, 300])
def test_likeness_of_near_copies_of_every_length(spark, n):
    rng = random.Random(n)
    texts = [" ".join(rng.choice(VOCABULARY) + str(rng.randrange(99)) for _ in range(n)) for _ in range(20)]
    turned = [" ".join(t.split(" ")[n // 2 :] + t.split(" ")[: n // 2]) for t in texts]
    pairs = spark.createDataFrame([(t, t + " more", o, u) for t, o, u in zip(texts, texts[1:] + texts[:1], turned, strict=True)], "a string, b string, c string, d string")
    mark = {c: fingerprints.anchors(F.col(c)) for c in "abcd"}
    got = pairs.select(*(fingerprints.likeness(mark[x], mark[y]).alias(name) for x, y, name in (("a", "b", "near"), ("c", "b", "far"), ("a", "a", "same"), ("a", "d", "turned")))).collect()
    lost = 5 / (0.4 * n)  # the k-mers that hold the end
    assert sum(r.near for r in got) / 20 > 1 - lost - 0.05 and max(r.far for r in got) < 0.2 and {r.same for r in got} == {1.0}
    assert sum(r.turned for r in got) / 20 > 0.5 - lost


@pytest.mark.parametrize("rows_a_block", [fingerprints.BLOCK_ROWS, 2])
def test_next_document_across_blocks(spark, rows_a_block, monkeypatch):
    monkeypatch.setattr(fingerprints, "BLOCK_ROWS", rows_a_block)
    ids = [1, 2, 511, 512, 513, 1024, 5000, 5001, 70000, None, -(1 << 63), (1 << 63) - 1]
    rows = spark.createDataFrame([(i, f"t{i}", 1) for i in ids] + [(5000, "t4999", 1)], "doc_id long, text string, block int")
    order = [(1 << 63) - 1, 70000, 5001, 4999, 5000, 1024, 513, 512, 511, 2, 1, -(1 << 63), None]
    got = {r.text: r.next_text for r in fingerprints.with_next(rows, ["text"]).collect()}
    assert got == {f"t{a}": f"t{b}" for a, b in zip(order, order[1:] + order[:1], strict=True)}
    assert fingerprints.with_next(rows.limit(0), ["text"]).count() == 0


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def best_fit(lengths, capacity):
    """How many sequences best fit needs that takes one document after the other, the longest first."""
    gaps = []
    for x in sorted(lengths, reverse=True):
        fit = min((k for k, g in enumerate(gaps) if g >= x), key=lambda k: gaps[k], default=None)
        if fit is None:
            gaps.append(capacity)
            fit = len(gaps) - 1
        gaps[fit] -= x
    return len(gaps)


def check_packing(rows, want, capacity):
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in seqs.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:], strict=False)) and own[-1][0] + own[-1][1] <= capacity
    return len(seqs)


def test_packing(table, docs, empty, tokenizer):
    odd = [*docs, (None, "nobody's <|endoftext|> text"), (3, docs[0][1])]
    rows = packing.pack_documents(frame(table.sparkSession, odd), capacity=256).collect()
    want = [(i or -1, *p) for i, t in odd for p in brute.pieces(t, tokenizer, 256)]
    n = check_packing(rows, want, 256)
    assert n <= best_fit([w[3] for w in want], 256) + 1
    assert packing.pack_documents(empty).count() == 0


@pytest.mark.parametrize("lengths", [[7] * 100, [2048] * 5 + [1] * 3, [1025] * 40 + [1023] * 40, list(range(1, 400)) * 3, [700, 690, 650] * 50])
def test_packing_of_ties(spark, lengths):
    rows = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(lengths)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    n = check_packing(packing.pack(rows).collect(), [(i, 0, 0, x, 0) for i, x in enumerate(lengths)], 2048)
    assert n <= best_fit(lengths, 2048) + 1


def test_sentencepiece(spark, table, docs, empty):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    odd = [*docs, (None, "  two  spaces   three "), (900, "emoji 😀\tand  tab"), (901, "def f(x):\n        return x  # 漢字")]
    encoded = pieces.encode_texts(frame(spark, odd))
    got = {r.doc_id: r.ids for r in encoded.collect()}
    assert got == {i: library.encode(t or "", num_threads=1) for i, t in odd}
    assert {r.doc_id: r.text for r in pieces.decode_ids(encoded).collect()} == {i: t or "" for i, t in odd}
    assert pieces.decode_ids(pieces.encode_texts(empty)).count() == 0
    assert pieces.decode_ids(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).first()["text"] is None


def test_labels(spark):
    docs = frame(spark, [(i, f"text {i}") for i in range(50)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 0), (2, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    got = labelled.training_rows(docs, labels, "toxic", 30).collect()
    assert 29 <= len(got) <= 30  # of the 30 labels chosen one may be of no document
    every = {r.text: r.y for r in labelled.training_rows(docs, labels, "toxic", 100).collect()}
    assert len(every) == 40 and every["text 1"] == 1 and every["text 2"] == 0
    assert spark.range(3).select(labelled.remainder(F.col("id"), 5)).collect()[1][0] == __import__("zlib").crc32(b"1") % 5


def held_out(scores, labels, name):
    rows = scores.join(labels, "doc_id").where("held_out").select("predicted", name).collect()
    hit = sum(r[name] and r.predicted for r in rows)
    return hit / max(1, sum(r[name] for r in rows)), hit / max(1, sum(r.predicted for r in rows))


@pytest.mark.parametrize(("query", "label", "recall", "precision"), [(toxicity.op3_toxicity, "toxic", 0.8, 0.95), (quality_classifier.op9_quality_classifier, "quality", 0.98, 0.97)])
def test_classifiers_on_labels_held_out(spark, query, label, recall, precision):
    sf = "/root/testdata/sf0.1"
    got = query(spark, sf).persist()
    assert got.count() == 10_000 and got.where("score < 0 or score > 1 or score is null").count() == 0
    r, p = held_out(got, spark.read.parquet(f"{sf}/labels.parquet"), label)
    assert r >= recall and p >= precision


@pytest.mark.parametrize("module", [toxicity, quality_classifier])
def test_classifiers_on_odd_tables(spark, table, docs, empty, module):
    score = module.score_toxicity if module is toxicity else module.score_quality
    for rows in ([], [("only this", 1)], [("words of one kind", 1)] * 20 + [("some other kind", 0)] * 20):
        model = module.fit(spark.createDataFrame(rows, "text string, y int"))
        got = score(table, model).collect()
        assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if not dict(docs)[r.doc_id]}) == 1
        assert score(empty, model).count() == 0


def plain_toxicity(model, text):
    """The machine's score by its definition: all pairs of the terms that it knows."""
    data = np.frombuffer(((text or "") + " ").encode(), np.uint8)
    place = {int(h): k for k, h in enumerate(model["ids"])}
    own = [place[int(h)] for h in toxicity.terms(data, np.array([0, len(data)]))[0] if int(h) in place]
    x = toxicity.SCALE / max(1, len(own)) ** 0.5
    z = float(model["bias"]) + sum(model["w"][i] * x for i in own)
    z += sum(float(model["v"][i] @ model["v"][j]) * x * x for k, i in enumerate(own) for j in own[k + 1 :])
    return 1 / (1 + np.exp(-z))


@pytest.fixture(scope="module")
def meetings():
    """Texts whose label depends on two words together: both or neither. No word tells anything alone."""
    rng = random.Random(4)
    out = []
    for _ in range(4000):
        words, a, b = [f"filler{rng.randrange(40)}" for _ in range(12)], rng.random() < 0.5, rng.random() < 0.5
        words += [f"left{rng.randrange(3)}"] * a + [f"right{rng.randrange(3)}"] * b
        rng.shuffle(words)
        out.append((" ".join(words), int(a == b)))
    return out


def test_toxicity_learns_meetings_of_terms(spark, meetings, docs):
    model = toxicity.fit(spark.createDataFrame(meetings[:3200], "text string, y int"), epochs=10)
    rest = meetings[3200:]
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(frame(spark, [(i, t) for i, (t, _) in enumerate(rest)]), model).collect()}
    assert sum((got[i] >= 0.5) == y for i, (_, y) in enumerate(rest)) > 0.85 * len(rest)
    odd = [*rest[:20], *((t, 0) for _, t in docs), (None, 0), ("left1 right2 " * 200_000, 0)]
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(frame(spark, [(i, t) for i, (t, _) in enumerate(odd)]), model).collect()}
    assert all(abs(got[i] - plain_toxicity(model, t)) < 1e-9 for i, (t, _) in enumerate(odd))


def test_toxicity_of_long_documents_stays_finite(spark):
    rng = random.Random(6)
    rows = [(" ".join(f"w{rng.randrange(4000)}" for _ in range(rng.choice((20, 3000)))) + " scum" * (k % 3 == 0), int(k % 3 == 0)) for k in range(400)]
    model = toxicity.fit(spark.createDataFrame(rows, "text string, y int"))
    assert all(np.isfinite(x).all() for x in model.values())


def test_training_rows_within_their_bytes(spark):
    docs = frame(spark, [(i, "x" * 1000) for i in range(20)] + [(20, None), (21, "y" * 5000)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(22)], "doc_id long, toxic int")
    every = labelled.training_rows(docs, labels, "toxic", 100, 100_000)
    assert every.count() == 22
    some = [r.text for r in labelled.training_rows(docs, labels, "toxic", 100, 5500).collect()]
    assert some and sum(len(t or "") for t in some) <= 5500


PAGE = """<html><head><title>T</title><script>if (a < b) { x("<p>no</p>") }</script></head><body><header><a href=/>Home</a> Site name</header><nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav>
<div class="cookie-notice">We use cookies, dear reader, and hope that you will agree to all of them at once.</div><article class=post><h1>A &amp; B&nbsp;title</h1><p>First <b>para</b>graph,<br>with a <a href=x>link</a> in it.
<p>Second<!-- <p>hidden</p> --> one. <div class="ad">Buy this thing now, it is cheap and it is good and you need it.</div><style>p {}</style><p>Third &lt;one&gt; &#8212; end.</p></article>
<aside>Related: <a href=3>Three</a></aside><section id="comments"><p>Reader says that this is a long and thoughtful comment on the article above.</p></section><form>Name <input></form><footer>&copy; all of us</footer></body></html>"""


def test_html(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, None), (3, "u", "", "y"), (3, "u", "", "y"), (4, "u", "<p>just " + "words and " * 30 + "<p", "z")], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert got[1] == "A & B title First paragraph, with a link in it. Second one. Third <one> — end."
    assert got[2] == got[3] == "" and got[4].startswith("just words and words")
    assert html_text.extract(pages).columns == ["page_id", "url", "text"] and html_text.extract(pages.limit(0)).count() == 0


WHOLE = "The first paragraph of an article has a good many words, so that nobody could take it for a menu. " * 2


@pytest.mark.parametrize("wrapper", ["div class='content with-sidebar'", "div class='has-sidebar'", "div class='page no-sidebar'", "div id='page' class='more'", "form id=f", "div class='sidebar-left'"])
@pytest.mark.parametrize("inner", ["article", "main"])
def test_html_article_in_a_layout_wrapper(wrapper, inner):
    if "sidebar-left" in wrapper and inner == "article":
        inner = "main"
    page = f"<body><{wrapper}><nav><a href=1>One</a></nav><{inner}><h1>A title</h1><p>{WHOLE}<p class=share>Share this with all of your friends today<p>{WHOLE}</{inner}><aside><article><p>{WHOLE}</article></aside></{wrapper.split()[0]}>"
    assert html_text.main_text(page, html_text.default_tree()) == f"A title {WHOLE}{WHOLE}".strip()


@pytest.mark.parametrize("wrapper", ["div class='with-sidebar'", "div class='page no-ads'", "div class='site_has_nav'"])
def test_html_text_in_a_wrapper_named_for_its_layout(wrapper):
    assert html_text.main_text(f"<body><{wrapper}><p>{WHOLE}<p>{WHOLE}</div>", html_text.default_tree()) == f"{WHOLE}{WHOLE}".strip()


@pytest.mark.parametrize("wrapper", ["section id=comments", "div class=related", "footer", "div hidden", "nav"])
def test_html_articles_of_side_lists_stay_out(wrapper):
    page = f"<body><article><p>{WHOLE}</article><{wrapper}><article class=comment><p>Other words. {WHOLE}</article></{wrapper.split()[0]}>"
    assert html_text.main_text(page, html_text.default_tree()) == WHOLE.strip()


@pytest.mark.parametrize("wrapper", ["form id=f", "div id='page' class='more'", "div class='widget text'", "div title='not hidden'", "div title=hidden data-x='class=ad'", "div class=loads"])
def test_html_long_text_in_an_odd_wrapper_without_article(wrapper):
    page = f"<body><{wrapper}><nav><a href=1>One</a></nav><h1>A title of it</h1><p>{WHOLE}<p>{WHOLE}<footer>all of us</footer></{wrapper.split()[0]}>"
    assert html_text.main_text(page, html_text.default_tree()) == f"A title of it {WHOLE}{WHOLE}".strip()
    assert html_text.main_text(f"<body><article><p>{WHOLE}</article><form>Your name <input> and a word or two</form>", html_text.default_tree()) == WHOLE.strip()


@pytest.mark.parametrize("aside", ["<span class='ad'>Buy <span>this</span> thing</span>", "<b hidden>not seen</b>", "<a class='sponsored promo' href=x>Buy</a>", "<span style='display: none'>no</span>"])
def test_html_adverts_in_a_line(aside):
    assert html_text.main_text(f"<article><p>{WHOLE}{aside}{WHOLE}<p>{WHOLE}</article>", html_text.default_tree()) == f"{WHOLE}{WHOLE}{WHOLE}".strip()
    assert html_text.main_text(f"<article><p>{WHOLE}<span>and <i>so</i></span> <b>on</b>{WHOLE}</article>", html_text.default_tree()) == f"{WHOLE}and so on{WHOLE}".strip()


def test_html_of_the_given_pages(spark):
    """Every page of the smallest table against what a parser of the standard library finds in its article element."""
    from html.parser import HTMLParser

    class Article(HTMLParser):
        def __init__(self):
            super().__init__()
            self.inside, self.parts = False, []

        def handle_starttag(self, tag, attrs):
            self.inside |= tag == "article"
            self.parts.append("" if tag in ("b", "i", "a") else " ")

        def handle_endtag(self, tag):
            self.inside &= tag != "article"
            self.parts.append("" if tag in ("b", "i", "a") else " ")

        def handle_data(self, data):
            self.parts += [data] if self.inside else []

    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    pages = {r.page_id: r.html for r in rows.collect()}
    for r in html_text.extract(rows).collect():
        plain = Article()
        plain.feed(pages[r.page_id])
        assert r.text == " ".join("".join(plain.parts).split())


@pytest.mark.parametrize("wrapper", ["div class='social-science'", "div class='promotion-of-health'", "div class='related-works'", "article><p class='share-price'", "div id='commentary'", "section class='footerless'", "div class='adaptive'"])
def test_html_names_that_only_sound_like_side_elements(wrapper):
    page = f"<body><nav><a href=/>Home</a></nav><{wrapper}>{WHOLE}</div></article><footer>&copy; us</footer>"
    assert html_text.main_text(page, html_text.default_tree()) == WHOLE.strip()


@pytest.mark.parametrize(
    "wrapper", ["ol class='commentlist'", "div id='userComments'", "div class='user-feedback'", "div class='siteFooter'", "div class='cookieBanner'", "section class='more-stories'", "div id='comment-17'", "div class='article__comments js-x'", "div class=SideBar", "ul class='related-posts-list'"]
)
def test_html_names_of_side_elements_in_any_spelling(wrapper):
    page = f"<body><article><p>{WHOLE}</article><{wrapper}><p>{WHOLE}</{wrapper.split()[0]}></body>"
    assert html_text.main_text(page, html_text.default_tree()) == WHOLE.strip()


def test_html_short_sentences_and_a_word_in_a_line():
    tree = html_text.default_tree()
    assert html_text.main_text("<div><p>He said yes.</p><p>She said no.</p></div>", tree) == "He said yes. She said no."
    assert html_text.main_text("<body><ul><li><a href=1>One</a></ul><p>All rights reserved.</p><a href=2>Two</a></body>", tree) == ""
    assert html_text.main_text(f"<article><p>{WHOLE}the <span class='social'>social</span> one</article>", tree) == f"{WHOLE}the social one".strip()


def test_html_rows_without_an_id_and_repeated_ones(spark):
    rows = [(None, None, f"<article><p>{WHOLE}</article>")] * 2 + [(7, None, None)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert sorted((r.page_id or 0, r.text) for r in got.collect()) == [(0, WHOLE.strip())] * 2 + [(7, "")]


def test_html_tree_learns_its_table():
    table = html_text.labelled()
    tree = html_text.default_tree()
    assert all(html_text.classify(tree, r[:-1]) == r[-1] for r in table)


def test_html_of_long_and_broken_pages():
    tree = html_text.default_tree()
    assert html_text.main_text("<article>" + "<p>word " * 20000 + "</article>", tree).count("word") == 20000
    for page in ("<" * 5000, '<a href="' * 3000, "<!--" * 3000, "</div>" * 3000, "<div " + "a='" * 5000):
        html_text.main_text(page, tree)


def test_pipeline_against_a_plain_version(spark, docs, tmp_path, tokenizer):
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(5)
    rows = corpus(11, groups=5, copies=6) + [(500 + i, " ".join(rng.choice(VOCABULARY) for _ in range(80))) for i in range(4)]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    kept = [(i, t) for i, t in rows if brute.rules(t)[-1]]
    kept = [(i, r[2]) for i, r in brute.lines(kept).items()]
    alone = brute.near(kept, 80)
    kept = [(i, t) for i, t in kept if alone[i][1] == i]
    kept = [(i, r[3].decode("utf-8", "ignore")) for i, r in brute.repeats(kept).items()]
    want = [(i, *p) for i, t in kept for p in brute.pieces(t, tokenizer)]
    got = pipeline.run(spark, str(tmp_path)).collect()
    assert 4 < len(kept) < len(rows) - 10
    check_packing(got, want, 2048)
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "suffix_dedup", "packing"]


def test_pipeline_stages_on_odd_tables(spark):
    """Null and repeated ids, equal rows, extra columns with clashing names, an empty table: no stage multiplies or mixes rows, or loses a column."""
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(9)
    text = lambda n: " ".join(rng.choice(VOCABULARY) + str(rng.randrange(999)) for _ in range(n))
    a, b, c, line = text(90), text(80), text(70), text(9)
    texts = [(0, a), (0, a), (0, b), (None, f"{line}\n{c}"), (None, f"{line}\n{text(60)}"), (4, f"{line}\n{text(60)}"), (5, f"{line}\n{b}"), (6, c), (7, None), (7, ""), (None, None), (8, f"{text(40)} {a[:200]} {text(40)}")]
    names = ("of", "before", "rank", "salt", "tag", "row", "lines", "kept", "text ", "i", "t")
    schema = "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"`{n}` int" for n in names)
    docs = spark.createDataFrame([(i, t, "en", f"source {k}", len(t or ""), *range(k, k + len(names))) for k, (i, t) in enumerate(texts)], schema)
    own = {f"source {k}": (i, t) for k, (i, t) in enumerate(texts)}
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, "").collect()
        assert stage(spark, docs.limit(0), "").count() == 0
        assert stage(spark, docs, "").schema.simpleString() == docs.schema.simpleString()
        assert len({r.source for r in out}) == len(out) and all(own[r.source][0] == r.doc_id for r in out)
        assert all(r["of"] == int(r.source.split()[1]) and r["t"] == r["of"] + len(names) - 1 for r in out)
        kept = {r.source: r.text for r in out}
        if name == "quality_rules":
            assert kept == {s: t for s, (_, t) in own.items() if t}
        if name == "line_dedup":
            assert kept == {s: (t or "").replace(f"{line}\n", "") if i != 5 else t for s, (i, t) in own.items()}
        if name == "near_dedup":
            assert sorted(t or "" for t in kept.values()) == sorted([a, b, "", "", "", texts[3][1], texts[4][1], texts[5][1], texts[11][1]])
        if name == "suffix_dedup":
            assert kept["source 0"] == kept["source 1"] == a and kept["source 2"] == b and kept["source 7"] == "" and kept["source 3"] == texts[3][1]
    packed = pipeline.packing(spark, docs, "").collect()
    assert len(packed) == len(texts) and pipeline.packing(spark, docs.limit(0), "").count() == 0


def test_near_duplicates_of_different_texts_under_one_id(spark):
    rng = random.Random(12)
    text = lambda: " ".join(rng.choice(VOCABULARY) + str(rng.randrange(99)) for _ in range(60))
    a, b = text(), text()
    got = sorted((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(frame(spark, [(9, a), (9, b), (3, a), (12, b), (20, text())])).select("doc_id", "component_id", "kept").collect())
    assert got == [(3, 3, True), (9, 3, False), (9, 9, True), (12, 9, False), (20, 20, True)]
    twisted = "".join("ab"[bin(k).count("1") & 1] for k in range(2048))
    other = twisted.translate(str.maketrans("ab", "ba"))  # sums of powers can't tell these apart
    assert {r.component_id for r in minhash.near_duplicates(frame(spark, [(1, twisted), (2, other)])).collect()} == {1, 2}


def test_sql_of_the_queries(spark):
    import duckdb

    from voxlake.llm.queries import oracle_sql, queries

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    for name, sql in oracle_sql().items():
        ours, theirs = queries()[name](spark, sf).toPandas(), con.sql(sql).df()
        columns = sorted(theirs.columns)
        assert sorted(ours.columns) == columns
        a, b = (d[columns].astype(str).sort_values(columns).reset_index(drop=True) for d in (ours, theirs))
        assert a.equals(b), name

