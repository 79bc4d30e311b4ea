"""Toxicity: a factorization machine over hashed terms.

Terms are the distinct words of a text and the words' beginnings of 4 and 6
bytes, so inflected forms share evidence.  The linear weights are learned with
an L1 term that leaves common words at zero.  Every term of the sample has
FACTORS latent factors, whose products score pairs of terms, such as an insult
with a group mention, also where each term alone tells nothing.  A text's sum of
pairs is divided by the root of its number of terms, so the many pairs of a long
text do not drown the rest.  The mean of several machines is no machine (their factors turn
freely), so one task trains on the whole bounded sample.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import ALNUM, lower_ascii, mix, rows_of, word_hashes, word_spans
from .training import held_out, labelled_sample, score, train

BITS = 18
FACTORS = 4
MAX_ROWS = 12_000                    # labelled documents that train the model, in one task
PREFIXES = (4, 6)
FOLDS, FOLD = 5, 0


def terms(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    buf = lower_ascii(buf)
    starts, ends, bounds = word_spans(buf, offs, ALNUM)
    row = rows_of(bounds)
    found = [word_hashes(buf, starts, ends)]
    for n in PREFIXES:
        found.append(mix(word_hashes(buf, starts, np.minimum(ends, starts + n)) + np.uint64(n)))
    index = np.stack(found, axis=1).reshape(-1) >> np.uint64(64 - BITS)
    return np.repeat(row, len(found)), index.astype(np.int64)


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 3, alpha: float = 4.0, beta: float = 1.0,
        l1: float = 2.5, rate: float = 0.05, decay: float = 1e-3) -> list[np.ndarray]:
    """Follow-the-regularised-leader steps for the linear weights, adaptive
    gradient steps for the factors of all terms, shrunk by ``decay``.

    The bias is the sample's log odds.  A weight stays zero until the sum of its
    gradients exceeds ``l1`` times their root sum of squares (once at least), so
    a common word needs as much evidence as a rare one."""
    size = 1 << BITS
    z, n = np.zeros(size), np.zeros(size)
    positive = sum(y for y, _, _ in rows)
    bias = float(np.log((positive + 0.5) / (len(rows) - positive + 0.5)))
    factors = np.random.default_rng(7).normal(0, 0.01, (size, FACTORS))
    squares = np.full((size, FACTORS), 1e-2)

    def weights(i: np.ndarray) -> np.ndarray:
        root = np.sqrt(n[i])
        limit = l1 * np.maximum(1.0, root)
        return np.where(np.abs(z[i]) <= limit, 0.0, -(z[i] - np.sign(z[i]) * limit) / ((beta + root) / alpha))

    for _ in range(epochs):
        for y, index, _ in rows:
            w = weights(index)
            v = factors[index]
            scale = 1 / np.sqrt(max(1, len(index)))
            total = v.sum(axis=0)
            logit = bias + w.sum() + 0.5 * scale * (total @ total - (v * v).sum())
            g = 1 / (1 + np.exp(-np.clip(logit, -35, 35))) - y
            z[index] += g - (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / alpha * w
            n[index] += g * g
            step = scale * g * (total - v) + decay * v
            grown = squares[index] + step * step
            squares[index] = grown
            factors[index] = v - rate * step / np.sqrt(grown)
    factors[n == 0] = 0.0                                        # terms that the sample does not hold
    return [np.append(weights(np.arange(size)), bias), factors.reshape(-1)]


def _logits(model: list[np.ndarray], row: np.ndarray, index: np.ndarray, texts: int) -> np.ndarray:
    w, factors = model[0], model[1].reshape(-1, FACTORS)
    pairs = np.unique(row * (1 << BITS) + index)
    row, index = pairs >> BITS, pairs & ((1 << BITS) - 1)
    scale = 1 / np.sqrt(np.maximum(1, np.bincount(row, minlength=texts)))
    out = w[-1] + np.bincount(row, weights=w[index], minlength=texts)
    for f in range(FACTORS):
        v = factors[index, f]
        total = np.bincount(row, weights=v, minlength=texts)
        out += 0.5 * scale * (total * total - np.bincount(row, weights=v * v, minlength=texts))
    return out


def score_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text);
    ``labels`` has doc_id and toxic (0/1).

    Null and empty texts get the score of a text without terms.  Repeated rows
    are scored each; a null doc_id is not held out and never labelled.  Without
    labelled rows every score is 0.5.  Only the named columns are read.
    """
    model = train(labelled_sample(docs, labels, "toxic", FOLDS, FOLD, max_rows), terms, fit, shards=1)
    return (docs.select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"),
                        score(docs.sparkSession, F.col("text"), model, terms, _logits).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
