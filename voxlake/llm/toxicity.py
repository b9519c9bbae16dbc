"""Toxicity by a factorization machine over hashed terms.

Besides a weight, each term has a short vector; the product of two terms' vectors is the weight of their meeting in
one document, so an insult near a group's name can count for more than both weigh alone.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm.common import LOWER, byte_codes, span_hash, words
from voxlake.llm.labelled import collect_features, remainder, scored, sigmoid, sums, telling, training_rows

#: At most so many labelled documents, with so many bytes of text between them, are learned from.
MOST_ROWS, MOST_BYTES = 16000, 128 << 20
#: Terms take part that LEAST_DOCS of these documents have and whose presence depends on the label (chi-squared of LEAST_CHI2, a chance of 0.001), and
#: for each FREQUENT documents the next most frequent term, whatever it tells alone.
LEAST_DOCS, LEAST_CHI2, FREQUENT = 6, 10.83, 8
#: A term's value in a document with n known terms is SCALE / sqrt(n), so that neither a long text nor many known terms let a step overshoot.
FACTORS, EPOCHS, STEP, SCALE, SHRINK = 8, 8, 0.2, 2.0, 1e-3
PREFIXES = (6, 8)
_MARKS = np.zeros(256, bool)
_MARKS[[ord(c) for c in ".,;:!?\"'()[]{}<>*#$%&|/\\-_=+~`^@"]] = True


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct terms of each text, text by text: (hashes, offsets). Terms are lower-cased words, punctuation apart, and the first PREFIXES bytes of longer ones."""
    plain = np.where(_MARKS[data], np.uint8(32), data)
    starts, ends, row, h = words(plain, offsets)
    codes, all_rows, all_h = byte_codes(LOWER[plain]), [row], [h]
    for n in PREFIXES:
        long = ends - starts > n
        all_h.append(span_hash(codes, starts[long], starts[long] + n) ^ np.uint64(n))
        all_rows.append(row[long])
    row, h = np.concatenate(all_rows), np.concatenate(all_h)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return h, np.searchsorted(row, np.arange(len(offsets)))


def fit(rows: DataFrame, factors: int = FACTORS, epochs: int = EPOCHS, step: float = STEP) -> dict[str, np.ndarray]:
    """The machine learned from (text, y) rows: bias, and sorted term hashes with weights and vectors. Without rows of both labels the bias is all there is.

    Stochastic gradient descent, document by document; each number's steps shrink with the gradients it has met.
    """
    ids = telling(rows, terms, LEAST_DOCS, LEAST_CHI2, rows.count() // FREQUENT)
    found, y = collect_features(rows, terms, ids)
    rng = np.random.default_rng(7)
    share = (y.sum() + 0.5) / (len(y) + 1)
    bias, w, v = np.log(share / (1 - share)), np.zeros(len(ids)), rng.normal(0, 0.1, (len(ids), factors))
    met_w, met_v = np.full(len(ids), 1e-2), np.full((len(ids), factors), 1e-2)
    own = [i.astype(np.int64) for i, _ in found]
    for _ in range(epochs if len(ids) else 0):
        for k in rng.permutation(len(own)):
            at = own[k]
            if not len(at):
                continue
            x, va = SCALE / np.sqrt(len(at)), v[at]
            s = va.sum(0) * x
            g = sigmoid(bias + w[at].sum() * x + 0.5 * ((s * s).sum() - (va * va).sum() * x * x)) - y[k]
            slope = g * x + 1e-5 * w[at]
            met_w[at] += slope * slope
            w[at] -= step * slope / np.sqrt(met_w[at])
            slope = g * x * (s - va * x) + SHRINK * va
            met_v[at] += slope * slope
            v[at] -= 0.5 * step * slope / np.sqrt(met_v[at])
            bias -= 0.01 * g
    return {"bias": np.array(bias), "ids": ids, "w": w, "v": v}


def score_toxicity(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, score (0 to 1, higher: toxicity likelier) of each row of `docs` (doc_id, text; other columns aren't read).

    Null and empty texts have the score of the bias; a very long text is scored whole, as a step of its own; null doc_ids and repeated rows stay, equal
    texts have equal scores; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(data, offsets):
        m = shared.value
        h, at = terms(data, offsets)
        if not len(m["ids"]):
            return np.full(len(offsets) - 1, sigmoid(m["bias"]))
        spot = np.minimum(np.searchsorted(m["ids"], h), len(m["ids"]) - 1)
        hit = m["ids"][spot] == h
        at = np.concatenate(([0], np.cumsum(hit)))[at]
        spot, x = spot[hit], SCALE / np.sqrt(np.maximum(np.diff(at), 1))
        s = sums(m["v"][spot], at)
        return sigmoid(m["bias"] + x * sums(m["w"][spot], at) + 0.5 * x * x * ((s * s).sum(1) - sums((m["v"] ** 2).sum(1)[spot], at)))

    return scored(docs, score)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held_out = remainder(F.col("doc_id"), 5) == 0
    model = fit(training_rows(docs, labels.where(~held_out), "toxic", MOST_ROWS, MOST_BYTES))
    return score_toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
