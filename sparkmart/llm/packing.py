"""Sequence packing by power-of-two decomposition.

A document of n ids (its text's ids and one closing id) is cut into the powers
of two that add up to n: as many pieces of the longest length as fit, then one
piece for every binary digit of the rest, longest first.  A piece is a sequence
of its own, so no sequence crosses documents and none needs padding; pieces of
equal length form a bucket, from which batches of one shape are drawn.

Tokenization: a match of the byte-level pre-tokenizer never runs from a
character that is no white space into white space, nor from a letter or digit
into punctuation (an apostrophe aside), and it looks at nothing before itself.
A text cut at such places encodes part by part, so every distinct part (usually
a word with the space before it) is encoded once for a run of texts and
remembered for the next ones.  The ids are those of the whole text.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.session import reliable_checkpoint

from .kernels import byte_class, text_chunks

LONGEST = 2048
CLOSING_ID = 1
REMEMBERED = 1 << 19                 # distinct parts a worker remembers (about 100 MB); beyond it, it starts anew
TEXT_BYTES = 1 << 22                 # bytes of texts whose parts are encoded together
ENCODED = 1 << 13                    # parts in one call of the tokenizer

_BLANK = byte_class((0x20, 0x20), (0x0A, 0x0A))
_INK = byte_class((0x21, 0x7E))      # ASCII characters that no pattern takes for white space
_ALNUM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))
_MARK = _INK & ~_ALNUM & ~byte_class((0x27, 0x27))
_TAIL = byte_class((0x80, 0xBF))
_LEAD = byte_class((0xC3, 0xDF))     # first bytes of U+00C0 to U+07FF, none of which is white space


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    """The tokenizer of a local file, loaded once in each Python worker, and the parts it has seen."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer, {}


def _part_starts(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Where parts begin: at every text's first byte, at a space or line feed after
    a character that is surely no white space, and at ASCII punctuation after an
    ASCII letter or digit."""
    if not len(buf):
        return np.zeros(0, np.int64)
    ink = _INK[buf]
    ink[1:] |= _TAIL[buf[1:]] & _LEAD[buf[:-1]]
    begins = np.zeros(len(buf), bool)
    begins[1:] = (_BLANK[buf[1:]] & ink[:-1]) | (_MARK[buf[1:]] & _ALNUM[buf[:-1]])
    begins[offs[:-1][offs[:-1] < len(buf)]] = True
    return np.flatnonzero(begins)


def encode_texts(path: str, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after another, number of ids of each text)."""
    tokenizer, known = _tokenizer(path)
    starts = _part_starts(buf, offs)
    if not len(starts):
        return np.zeros(0, np.uint32), np.zeros(len(offs) - 1, np.int64)
    borders = pa.py_buffer(np.append(starts, len(buf)).astype(np.int64))
    parts = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, borders, pa.py_buffer(np.ascontiguousarray(buf))])
    coded = parts.dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    if len(known) + len(distinct) > REMEMBERED:
        known.clear()
    new = [p for p in distinct if p not in known]
    for i in range(0, len(new), ENCODED):
        run = new[i:i + ENCODED]
        for part, made in zip(run, tokenizer.encode_batch([p.decode() for p in run], add_special_tokens=False), strict=True):
            known[part] = np.array(made.ids, np.uint32).tobytes()
    ids_of = [known[p] for p in distinct]
    size = np.array([len(i) // 4 for i in ids_of], np.int64)
    first = np.cumsum(size) - size
    index = coded.indices.to_numpy().astype(np.int64)
    n = size[index]
    total = np.concatenate(([0], np.cumsum(n)))
    ids = np.frombuffer(b"".join(ids_of), np.uint32)[np.repeat(first[index] - total[:-1], n) + np.arange(total[-1])]
    return ids, np.diff(total[np.searchsorted(starts, offs)])


def power_pieces(lengths: np.ndarray, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document number, start, length) of all pieces, in the order of the documents and starts."""
    top = longest.bit_length() - 1
    whole = lengths >> top
    doc = np.repeat(np.arange(len(lengths)), whole)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(whole) - whole, whole)) << top
    docs, begins, sizes = [doc], [start], [np.full(len(doc), longest, np.int64)]
    for bit in range(top - 1, -1, -1):
        doc = np.flatnonzero((lengths >> bit) & 1)
        docs.append(doc)
        begins.append((lengths[doc] >> (bit + 1)) << (bit + 1))
        sizes.append(np.full(len(doc), 1 << bit, np.int64))
    doc, start, length = map(np.concatenate, (docs, begins, sizes))
    order = np.lexsort((start, doc))
    return doc[order], start[order], length[order]


def pack_documents(docs: DataFrame, tokenizer_file: str, longest: int = LONGEST, closing_id: int = CLOSING_ID,
                   with_ids: bool = True) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket[, ids])
    of every piece of every row of ``docs`` (doc_id, text).

    ``longest`` is a power of two.  A piece is the whole of its sequence, so
    ``offset`` is 0; ``bucket`` is the length's binary logarithm.  Sequences are
    numbered from 0 without gaps, shorter buckets first.  ``ids_crc32`` is that of
    the ids as little-endian unsigned 32-bit numbers.

    A null or empty text has the closing id only: one piece of length 1.  Rows that
    repeat an id or have none are documents of their own; strings of special
    tokens are ordinary text; other columns are ignored; no rows give none."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest length must be a power of two")
    kept = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}"
    ends = np.array([closing_id], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        made = np.zeros(longest.bit_length(), np.int64)
        for batch in batches:
            for lo, hi, buf, offs in text_chunks(batch.column(1), TEXT_BYTES):
                ids, n = encode_texts(tokenizer_file, buf, offs)
                ids = np.insert(ids, np.cumsum(n), ends)
                n = n + 1
                doc, start, length = power_pieces(n, longest)
                at = (np.cumsum(n) - n)[doc] + start
                raw = memoryview(ids.astype("<u4").view(np.uint8))
                crc = [zlib.crc32(raw[4 * a:4 * z]) for a, z in zip(at.tolist(), (at + length).tolist(), strict=True)]
                bucket = np.log2(length).astype(np.int64)
                place = np.empty(len(doc), np.int64)
                for b in np.unique(bucket):
                    here = np.flatnonzero(bucket == b)
                    place[here] = made[b] + np.arange(len(here))
                    made[b] += len(here)
                columns = [batch.column(0).take(pa.array(lo + doc)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                           pa.array(n[doc]), pa.array(bucket.astype(np.int32)), pa.array(np.full(len(doc), task, np.int32)), pa.array(place)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "bucket", "task", "place"]
                if with_ids:        # pieces cover the ids in order
                    borders = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(borders), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    pieces = reliable_checkpoint(docs.select("doc_id", "text").mapInArrow(
        run, f"{kept}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, bucket int, task int, place bigint"
             + ", ids array<int>" * with_ids))
    # A task numbered its own pieces of each bucket; the counts before it, a row for each task and
    # bucket, make the numbers dense.  They are a written table, so Spark knows their size when it joins.
    counts = pieces.groupBy("bucket", "task").agg(F.count("*").alias("n"))
    buckets = counts.groupBy("bucket").agg(F.sum("n").alias("n")).withColumn(
        "shorter", F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n"))
    before = F.sum("n").over(Window.partitionBy("bucket").orderBy("task").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    bases = reliable_checkpoint(counts.withColumn("before", before - F.col("n")).join(buckets.select("bucket", "shorter"), "bucket")
                                .select("bucket", "task", (F.col("before") + F.col("shorter")).alias("base")))
    return pieces.join(bases, ["bucket", "task"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("place")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), "bucket", *["ids"] * with_ids)


def write_buckets(sequences: DataFrame, path: str) -> None:
    """Store packed sequences (with ids) in a folder for each bucket; large buckets
    are split over tasks, small ones merged."""
    sequences.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)
