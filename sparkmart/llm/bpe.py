"""Byte-level BPE encoding and decoding with the tiktoken library and a rank file.

Long texts are cut before they are encoded, at places where a match of the
splitting pattern always ends: between an ASCII letter or digit and a following
space or line feed.  The ids are those of the whole text.  Ids decode to raw
bytes, so any run of ids decodes, also one that ends inside a character.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from .kernels import text_chunks

PIECE = 1 << 16                      # characters after which a safe boundary is sought
_SAFE = re.compile(r"(?<=[0-9A-Za-z])(?=[ \n])")


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """The tokenizer of a local rank file, loaded once in each Python worker."""
    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in parts of about ``size`` characters that encode independently."""
    at = 0
    while len(text) - at > size:
        cut = _SAFE.search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def encode(tokenizer: tiktoken.Encoding, text: str) -> list[int]:
    if len(text) <= PIECE:
        return tokenizer.encode_ordinary(text)
    return [i for part in pieces(text) for i in tokenizer.encode_ordinary(part)]


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) of every row of ``docs``
    (doc_id, text): the ids, a digest of them as decimals joined by commas,
    and a digest of the bytes that they decode to.

    A null text is empty: no ids and the digests of nothing.  Special tokens are
    never produced; their strings are ordinary text.  Repeated rows and null ids
    are kept as they are; other columns are ignored.
    """
    kept = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoding(rank_file, pattern)
        decimal = [str(i) for i in range(tokenizer.n_vocab)]
        for batch in batches:
            for lo, hi, buf, offs in text_chunks(batch.column(1)):
                n, of_ids, of_bytes, flat = [], [], [], []
                for a, z in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
                    ids = encode(tokenizer, buf[a:z].tobytes().decode())
                    n.append(len(ids))
                    of_ids.append(hashlib.sha256(",".join([decimal[i] for i in ids]).encode()).hexdigest())
                    of_bytes.append(hashlib.sha256(tokenizer.decode_bytes(ids)).hexdigest())
                    if with_ids:
                        flat.append(np.array(ids, np.int32))
                columns = [batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(of_ids), pa.array(of_bytes)]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    ends = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flat))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
    return docs.select("doc_id", "text").mapInArrow(
        run, f"{kept}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)


def decode_ids(frame: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """(doc_id, decoded binary) of every row of ``frame`` (doc_id, ids array<int>);
    null ids decode to no bytes."""
    kept = f"doc_id {frame.schema['doc_id'].dataType.simpleString()}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoding(rank_file, pattern)
        for batch in batches:
            decoded = [tokenizer.decode_bytes(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(decoded, pa.binary())], names=["doc_id", "decoded"])
    return frame.select("doc_id", "ids").mapInArrow(run, f"{kept}, decoded binary")
