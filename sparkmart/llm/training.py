"""What both text classifiers share: the bounded labelled sample, training in
shards whose models are averaged, and scoring of whole texts by a broadcast model.

The sample holds at most ``max_rows`` documents that are there and labelled, a
row each, those with the least hash of their doc_id, so it does not depend on partitions or their order.  It is
dealt to SHARDS tasks; each returns one model of a fixed size, and the driver
only ever holds SHARDS models.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kernels import text_chunks

SHARDS = 4
MAX_ROWS = 20_000

# (bytes, offsets) of a run of texts -> (text number of every term, hashed term)
Terms = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls in the fold that training never sees;
    false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, max_rows: int) -> DataFrame:
    """(doc_id, y, text) of the training rows; repeated labels of a document count
    once (the greatest), null ids and labels never.  Of the rows that repeat a
    doc_id, the one whose text has the least hash counts."""
    chosen = (labels.select(F.col("doc_id"), F.col(label).cast("int").alias("y"))
              .where("doc_id IS NOT NULL AND y IS NOT NULL").where(~held_out(F.col("doc_id"), folds, fold))
              .groupBy("doc_id").agg(F.max("y").alias("y"))
              .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    return (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y")
            .agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text")))


def train(sample: DataFrame, terms: Terms, fit: Callable[[list[tuple[int, np.ndarray, np.ndarray]]], list[np.ndarray]],
          shards: int = SHARDS) -> list[np.ndarray] | None:
    """The mean of the shards' models (each a list of float arrays); None
    without labelled rows.  ``fit`` gets (label, distinct terms, their counts) of
    a shard's documents in the order of their ids' hashes."""

    def run(table: pa.Table) -> pa.Table:
        rows = []
        for batch in table.to_batches():
            order, ys = batch.column("place").to_pylist(), batch.column("y").to_pylist()
            for lo, hi, buf, offs in text_chunks(batch.column("text")):
                row, index = terms(buf, offs)
                cut = np.searchsorted(row, np.arange(hi - lo + 1))
                for r in range(hi - lo):
                    rows.append((order[lo + r], ys[lo + r], *np.unique(index[cut[r]:cut[r + 1]], return_counts=True)))
        rows.sort(key=lambda x: (x[0], x[1], len(x[2])))
        model = [a.astype(np.float32).tobytes() for a in fit([x[1:] for x in rows])]
        return pa.table({"model": pa.array([model], pa.list_(pa.binary())), "n": pa.array([len(rows)], pa.int64())})

    # by a shard number, so that there are ``shards`` models however many partitions a shuffle has
    place = F.xxhash64("doc_id")
    models = (sample.select(F.pmod(place, F.lit(shards)).alias("shard"), place.alias("place"), "y", "text")
              .groupBy("shard").applyInArrow(run, "model array<binary>, n bigint").collect())
    if not models:
        return None
    models.sort(key=lambda m: (m.n, m.model))       # sorting in Spark would fit the models twice
    weight = np.array([m.n for m in models], float) / sum(m.n for m in models)
    return [sum(w * np.frombuffer(m.model[i], np.float32).astype(float) for w, m in zip(weight, models, strict=True))
            for i in range(len(models[0].model))]


def score(spark, text: Column, model: list[np.ndarray] | None, terms: Terms,
          logits: Callable[[list[np.ndarray], np.ndarray, np.ndarray, int], np.ndarray]) -> Column:
    """Probability of label 1 for whole texts (null: empty); 0.5 for an untrained model."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for texts in batches:
            out = np.zeros(len(texts))
            if model is not None:
                for lo, hi, buf, offs in text_chunks(texts):
                    out[lo:hi] = logits(model, *terms(buf, offs), hi - lo)
            yield pa.array(1 / (1 + np.exp(-np.clip(out, -35, 35))))
    # Spark may otherwise repeat the call in a filter and in a column above it
    return compute.asNondeterministic()(text)
