"""Quality classifier: logistic regression over hashed word n-grams, trained with
follow-the-regularised-leader updates and scored as sparse dot products.

Terms are words, word pairs, and pairs and triples of word shapes (lower, Title,
UPPER, digits, same word again; a run of punctuation stands for itself), which
tell shouting, stutter, menus and symbol noise apart from prose in any language.  A term's value is its
share of the text's terms.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kernels import ALNUM, DIGIT, NON_SPACE, UPPER, class_runs, counts_within, gram_hashes, lower_ascii, mix, rows_of, word_hashes
from .training import MAX_ROWS, held_out, labelled_sample, score, train

BITS = 18
SCALE = 20.0
THRESHOLD = 0.7
FOLDS, FOLD = 4, 2
_CLASSES = np.where(ALNUM, 1, np.where(NON_SPACE, 2, 0)).astype(np.uint8)
_SHAPE_SEED = mix(np.arange(1, 7, dtype=np.uint64))


def terms(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hashed term) of every term, by text."""
    starts, ends, bounds, kind = class_runs(buf, offs, _CLASSES)
    words = word_hashes(lower_ascii(buf), starts, ends)
    row = rows_of(bounds)
    if not len(words):
        return row, words.astype(np.int64)
    upper = counts_within(UPPER[buf], starts, ends)
    digit = counts_within(DIGIT[buf], starts, ends)
    shape = np.select([digit == ends - starts, (upper > 1) & (2 * upper >= ends - starts), UPPER[buf[starts]], upper == 0], [0, 1, 2, 3], 4)
    shape[1:][(words[1:] == words[:-1]) & (row[1:] == row[:-1])] = 5
    shapes = np.where(kind == 1, _SHAPE_SEED[shape], words)
    rows, found = [row], [words]
    for family, (sequence, n) in enumerate(((words, 2), (shapes, 2), (shapes, 3)), 1):
        gram = gram_hashes(sequence, n) + np.uint64(family)
        whole = row[:len(gram)] == row[n - 1:]
        rows.append(row[:len(gram)][whole])
        found.append(mix(gram[whole]))
    row, found = np.concatenate(rows), np.concatenate(found)
    order = np.argsort(row, kind="stable")
    return row[order], (found[order] >> np.uint64(64 - BITS)).astype(np.int64)


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 3, alpha: float = 0.3, beta: float = 1.0,
        l1: float = 0.05, l2: float = 0.1) -> list[np.ndarray]:
    """FTRL-proximal, one row at a time; the last coordinate is the bias."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(i: np.ndarray) -> np.ndarray:
        w = -(z[i] - np.sign(z[i]) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)
        return np.where(np.abs(z[i]) <= l1, 0.0, w)

    for _ in range(epochs):
        for y, index, count in rows:
            i = np.append(index, size)
            x = np.append(count * (SCALE / max(1, count.sum())), 1.0)
            w = weights(i)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha * w
            n[i] += g * g
    return [weights(np.arange(size + 1))]


def _logits(model: list[np.ndarray], row: np.ndarray, index: np.ndarray, texts: int) -> np.ndarray:
    w = model[0]
    total = np.bincount(row, weights=w[index], minlength=texts)
    count = np.bincount(row, minlength=texts)
    return w[-1] + SCALE * total / np.maximum(count, 1)


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> list[np.ndarray] | None:
    """A model from at most ``max_rows`` labelled documents outside the held-out fold."""
    return train(labelled_sample(docs, labels, "quality", FOLDS, FOLD, max_rows), terms, fit)


def quality_score(spark, text: Column, model: list[np.ndarray] | None) -> Column:
    return score(spark, text, model, terms, _logits)


def score_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text);
    ``labels`` has doc_id and quality (0/1).

    Null and empty texts get the score of a text without terms.  Repeated rows
    are scored each; a null doc_id is not held out and never labelled.  Without
    labelled rows every score is 0.5.  Only the named columns are read.
    """
    model = fit_quality(docs, labels, max_rows)
    return (docs.select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"),
                        quality_score(docs.sparkSession, F.col("text"), model).alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def keep_good(docs: DataFrame, all_docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows of ``docs`` that a model fitted on ``all_docs`` accepts, with all
    their columns whatever their names; every row if there is nothing to learn from."""
    model = fit_quality(all_docs, labels, max_rows)
    if model is None:
        return docs
    return docs.where(quality_score(docs.sparkSession, F.col("text"), model) >= THRESHOLD)
