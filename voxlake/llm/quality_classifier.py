"""Quality by supervised subword embeddings.

Hashed word n-grams and character n-grams have learned vectors; a document is the average of its vectors, followed by
a softmax over the two labels; both are trained by stochastic gradient descent. As the output is linear in the
average, each feature's vector is folded into one number for scoring.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm.common import byte_codes, mix, span_hash, words
from voxlake.llm.labelled import collect_features, remainder, scored, sigmoid, sums, training_rows

#: At most so many labelled documents are learned from.
MOST_ROWS, BITS, SIZE, EPOCHS, RATE = 4000, 17, 12, 6, 4.0
NGRAMS = (2, 4)
_SAME = np.uint64(0x5A5A5A5A5A5A5A5A)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of each text, text by text: words, pairs of neighbouring words (a word and itself is a pair of its own kind), and byte n-grams. (ids, offsets)"""
    *_, row, h = words(data, offsets, lower=False)
    pair = row[1:] == row[:-1]
    both = np.where(h[1:] == h[:-1], _SAME, mix(h[:-1] + np.uint64(3) * h[1:]))[pair]
    ids, rows = [h, both], [row, row[1:][pair]]
    own = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    codes = byte_codes(data)
    for n in NGRAMS:
        start = np.arange(max(0, len(data) - n))
        start = start[own[start] == own[start + n]]  # within a text and the space that ends it
        gram = codes[start]
        for k in range(1, n):
            gram = (gram * np.uint64(0x9E3779B97F4A7C15)) ^ codes[start + k]
        ids.append(mix(gram + np.uint64(n)))
        rows.append(own[start])
    ids, rows = np.concatenate(ids) >> np.uint64(64 - BITS), np.concatenate(rows)
    order = np.argsort(rows, kind="stable")
    return ids[order], np.searchsorted(rows[order], np.arange(len(offsets)))


def fit(rows: DataFrame, size: int = SIZE, epochs: int = EPOCHS, rate: float = RATE) -> dict[str, np.ndarray]:
    """The classifier learned from (text, y) rows, folded: a number for each feature and a bias. Without rows it is 0 everywhere."""
    found, y = collect_features(rows, features)
    rng = np.random.default_rng(11)
    e, out, bias = rng.uniform(-1, 1, (1 << BITS, size)) / size, np.zeros((2, size)), np.zeros(2)
    own = [(i.astype(np.int64), (c / c.sum())[:, None]) for i, c in found]
    total = epochs * len(own)
    for t in range(epochs):
        for n, k in enumerate(rng.permutation(len(own))):
            at, share = own[k]
            if not len(at):
                continue
            lr = rate * (1 - (t * len(own) + n) / total)
            hidden = (e[at] * share).sum(0)
            z = out @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[int(y[k] > 0)] -= 1
            back = p @ out
            out -= lr * np.outer(p, hidden)
            bias -= 0.02 * lr * p
            e[at] -= lr * np.minimum(share * len(at), 3.0) / len(at) ** 0.5 * back
    return {"feature": (e @ (out[1] - out[0])).astype(np.float32), "bias": np.array(bias[1] - bias[0])}


def score_quality(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, score (0 to 1, higher: good quality likelier) of each row of `docs`. Null and empty texts have the score of the bias; null doc_ids and repeated rows stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(data, offsets):
        ids, at = features(data, offsets)
        return sigmoid(shared.value["bias"] + sums(shared.value["feature"][ids], at) / np.maximum(np.diff(at), 1))

    return scored(docs, score)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = fit(training_rows(docs, labels.where(~held_out), "quality", MOST_ROWS))
    return score_quality(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
