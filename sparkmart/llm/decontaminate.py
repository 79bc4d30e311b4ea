"""Benchmark decontamination by winnowing.

A text's fingerprints are the hashes of its 7-word grams that are least in some
run of 7 successive grams.  Such a run spans 13 words, so two texts that share
13 consecutive words always share a fingerprint inside them.  Document and
benchmark fingerprints are joined and every hit is extended word by word; only
spans that really are equal count, so the result is exact.

Items of fewer than 13 words are one window as a whole; for each of their (at
most twelve) lengths every document gram of that length is a fingerprint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.session import reliable_checkpoint

from .kernels import ALNUM, gram_hashes, lower_ascii, mix, rows_of, text_chunks, word_hashes, word_spans
from .names import fresh

WINDOW = 13
GRAM = 7
REACH = WINDOW - GRAM                # words of context kept on either side of a gram
FILTER_WORDS = 1 << 16               # 64-bit words of the prefilter, whatever the benchmark's size

_HIT = "array<struct<gram: bigint, size: int, pos: int, first: int, context: array<string>>>"


def _selected(grams: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Flags of the grams that are least (ties included) in one of the runs of
    grams that a 13-word window of their text covers."""
    windows = len(row) - WINDOW + 1
    chosen = np.zeros(len(grams), bool)
    if windows <= 0:
        return chosen
    least = grams[:windows].copy()
    for j in range(1, REACH + 1):
        np.minimum(least, grams[j:j + windows], out=least)
    whole = row[:windows] == row[WINDOW - 1:]
    for j in range(REACH + 1):
        chosen[j:j + windows] |= whole & (grams[j:j + windows] == least)
    return chosen


def _in_filter(bits: np.ndarray, grams: np.ndarray) -> np.ndarray:
    word, mask = _filter_place(grams)
    return (bits[word] & mask) == mask


def _filter_place(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = mix(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    one = np.uint64(1)
    mask = (one << (h & np.uint64(63))) | (one << ((h >> np.uint64(6)) & np.uint64(63)))
    return (h >> np.uint64(48)).astype(np.int64) % FILTER_WORDS, mask


def _fingerprints(lengths: tuple[int, ...], whole_short: bool, bits: np.ndarray | None) -> Callable:
    """mapInArrow function: (keys..., text) -> (keys..., n_words, hits), where a
    hit's size is GRAM, or minus its words if it is a whole short window.

    ``lengths``: short item lengths whose every gram is taken from a document;
    ``whole_short``: an item's view, where a text under 13 words is one gram.
    ``bits``: keep only grams that may be in this prefilter."""

    def grams_of(words: np.ndarray, row: np.ndarray, count: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        g = gram_hashes(words, GRAM)
        at = np.flatnonzero(_selected(g, row))
        yield GRAM, at, g[at]
        for n in (range(1, WINDOW) if whole_short else lengths):
            if whole_short and not (count == n).any():
                continue
            g = gram_hashes(words, n)
            fits = row[:len(g)] == row[n - 1:] if len(g) else np.zeros(0, bool)
            if whole_short:
                fits = fits & (count[row[:len(g)]] == n)
            at = np.flatnonzero(fits)
            yield -n, at, g[at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hit_type = pa.list_(pa.struct([("gram", pa.int64()), ("size", pa.int32()), ("pos", pa.int32()),
                                       ("first", pa.int32()), ("context", pa.list_(pa.string()))]))
        for batch in batches:
            n_words = np.zeros(batch.num_rows, np.int64)
            hits: list[list] = [[] for _ in range(batch.num_rows)]
            for lo, hi, buf, offs in text_chunks(batch.column(batch.num_columns - 1)):
                buf = lower_ascii(buf)
                starts, ends, bounds = word_spans(buf, offs, ALNUM)
                count = np.diff(bounds)
                n_words[lo:hi] = count
                row = rows_of(bounds)
                words = word_hashes(buf, starts, ends)
                for size, at, g in grams_of(words, row, count):
                    if bits is not None:
                        may = _in_filter(bits, g)
                        at, g = at[may], g[may]
                    for i, h in zip(at.tolist(), g.view(np.int64).tolist(), strict=True):
                        r = int(row[i])
                        a, z = int(bounds[r]), int(bounds[r + 1])
                        reach = REACH if size > 0 else 0
                        first, last = max(a, i - reach), min(z, i + abs(size) + reach)
                        context = [buf[s:e].tobytes().decode() for s, e in zip(starts[first:last], ends[first:last], strict=True)]
                        hits[lo + r].append({"gram": h, "size": size, "pos": i - a, "first": first - a, "context": context})
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(n_words), pa.array(hits, hit_type)],
                names=[*batch.schema.names[:-1], "n_words", "hits"])
    return run


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grows each hit to the longest run of equal words around the gram and
    keeps the runs that hold a whole window."""
    for batch in batches:
        cols = {k: batch.column(k).to_pylist() for k in ("size", "pos", "first", "context", "item_at", "item_context")}
        keep, begin, end = [], [], []
        for i, (size, pos, first, ours, at, theirs) in enumerate(zip(*cols.values(), strict=True)):
            a, whole, size = pos - first, size < 0, abs(size)
            if ours[a:a + size] != theirs[at:at + size]:
                continue
            left = 0
            while left < min(a, at) and ours[a - left - 1] == theirs[at - left - 1]:
                left += 1
            right, ra, rb = 0, a + size, at + size
            while ra + right < len(ours) and rb + right < len(theirs) and ours[ra + right] == theirs[rb + right]:
                right += 1
            if not whole and left + size + right < WINDOW:
                continue
            keep.append(i)
            begin.append(pos - left)
            end.append(pos + size + right)
        yield pa.RecordBatch.from_arrays(
            [batch.column(k).take(pa.array(keep, pa.int64())) for k in ("doc_id", "text_key", "pos", "context_id")]
            + [pa.array(begin, pa.int32()), pa.array(end, pa.int32())],
            names=["doc_id", "text_key", "pos", "context_id", "begin", "finish"])


def _prefilter(prints: DataFrame) -> np.ndarray:
    """A Bloom filter of FILTER_WORDS 64-bit words (half a megabyte), whatever the
    benchmark's size: a larger benchmark only lets more grams through to the join."""
    spark = prints.sparkSession

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, mask = _filter_place(batch.column(0).to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(mask.view(np.int64))], names=["word", "mask"])

    bits = np.zeros(FILTER_WORDS, np.uint64)
    rows = (prints.select("gram").mapInArrow(places, "word bigint, mask bigint")
            .groupBy("word").agg(F.expr("bit_or(mask)").alias("mask")).toArrow())
    bits[rows.column("word").to_numpy()] = rows.column("mask").to_numpy().view(np.uint64)
    return bits


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows (doc_id, n_words, n_hit, n_items, items, begin/end spans) of every row of ``docs``.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns
    are ignored whatever their names.  Words are lower-cased (A-Z) runs of ASCII
    letters, digits and non-ASCII characters.  ``items`` holds the sorted item
    ids (as strings) with an occurring window, ``spans`` the hit word ranges.

    A null or empty text has no words and no hits; a null doc_id is kept as it
    is; rows that repeat a doc_id and text each get that text's result; a null
    item_id still marks words but is not listed; benchmark rows with the same
    item_id are one item; an empty benchmark hits nothing.
    """
    docs = docs.select(F.col("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text"))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text"))
    prints = reliable_checkpoint(
        items.mapInArrow(_fingerprints((), True, None), f"item_id string, n_words bigint, hits {_HIT}")
        .select("item_id", F.inline("hits"))
        .select("item_id", "gram", "size", (F.col("pos") - F.col("first")).alias("item_at"), F.col("context").alias("item_context"))
        .withColumn("context_id", F.xxhash64("gram", "size", "item_at", "item_context")))
    lengths = tuple(sorted(-r[0] for r in prints.where("size < 0").select("size").distinct().collect()))
    bits = _prefilter(prints)

    found = reliable_checkpoint(
        docs.mapInArrow(_fingerprints(lengths, False, bits),
                        f"{_type_of(docs, 'doc_id')}, text_key bigint, n_words bigint, hits {_HIT}"))
    contexts = prints.select("gram", "size", "item_at", "item_context", "context_id").distinct()
    runs = (found.select("doc_id", "text_key", F.inline("hits"))
            .join(contexts, ["gram", "size"])
            .select("doc_id", "text_key", "size", "pos", "first", "context", "item_at", "item_context", "context_id")
            .mapInArrow(_extend, f"{_type_of(docs, 'doc_id')}, text_key bigint, pos int, context_id bigint, begin int, finish int"))
    runs = reliable_checkpoint(runs)

    key = ["doc_id", "text_key"]
    spans = (runs.groupBy(*key, "pos").agg(F.min("begin").alias("begin"), F.max("finish").alias("finish"))
             .groupBy(*key).agg(F.sort_array(F.collect_set(F.struct("begin", "finish"))).alias("spans"))
             .select(*key, "spans", F.expr("""
                 aggregate(spans, struct(0L AS hit, 0 AS upto),
                           (a, s) -> struct(a.hit + greatest(s.finish - greatest(s.begin, a.upto), 0) AS hit,
                                            greatest(a.upto, s.finish) AS upto), a -> a.hit)""").alias("n_hit")))
    listed = (runs.select(*key, "context_id").distinct()
              .join(prints.select("context_id", "item_id").distinct(), "context_id")
              .where("item_id IS NOT NULL").groupBy(*key)
              .agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    hit = spans.join(listed.withColumnsRenamed({k: f"_{k}" for k in key}),
                     F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_key") == F.col("_text_key")), "left")
    hit = hit.select(F.col("doc_id").alias("_doc_id"), F.col("text_key").alias("_text_key"), "spans", "n_hit", "items")
    return (found.select("doc_id", "text_key", "n_words")
            .join(hit, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_key") == F.col("_text_key")), "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    F.coalesce("spans", F.array().cast("array<struct<begin:int,finish:int>>")).alias("spans"),
                    F.col("text_key")))


def is_contaminated() -> Column:
    """The contract's rule: some word is hit, and a twentieth of all words at least."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text is contaminated; all columns stay, whatever
    their names.  The list of those rows is a written table, so Spark knows its size:
    a short one is broadcast, for a long one the texts are shuffled once by its keys."""
    id_, key = fresh(docs, "_bad_id", "_bad_key")
    bad = reliable_checkpoint(find_contamination(docs, benchmark).where(is_contaminated())
                              .select(F.col("doc_id").alias(id_), F.col("text_key").alias(key)).distinct())
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(key)), "left_anti")


def _type_of(df: DataFrame, name: str) -> str:
    return f"{name} {df.schema[name].dataType.simpleString()}"
