"""Language-model scoring: an interpolated modified Kneser-Ney model of any order.

Counting.  Tasks reduce their texts to distinct words (64-bit hashes) and then
to distinct grams before anything is shuffled; Spark deals the packed, compressed
runs to shards by hash, so a frequent word or gram costs each task one entry.  A
shard's task merges its runs into sorted arrays and writes them to the shared
folder.  A gram of m words is the place of its first m - 1 words among the grams
of that length and the number of its last word, one 64-bit key; words are counted
first, then pairs, and so on.

Model.  Sorted hash arrays: the vocabulary's word hashes with counts (a word's
place is its number); the grams' mixed keys (the mixing is a bijection, so keys
never collide), of the highest order split into single ones and others with counts.
Below that order a gram counts the distinct words before it, and grams at a text's
beginning, which none precede, their occurrences.  As a history a word or gram
has the sum of what follows it and how many follow once, twice and more often.

Scoring.  Workers map the arrays into memory and look words and grams up with
binary searches, a run of texts at a time.  A shared folder that is no file
system of the machine is first copied to the worker's scratch folder, file by
file as needed.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.session import ensure_checkpoint_dir, reliable_checkpoint

from .kernels import NON_SPACE, lower_ascii, mix, text_chunks, word_hashes, word_spans

FOLDS, FOLD = 7, 2
RUN_BYTES = 8 << 20                  # text handled at once
HELD_KEYS = 4 << 20                  # distinct keys a task holds before it hands them on
SHARD_TOKENS = 4 << 20
ORDER = 2
END = np.uint64(0x5E0F_E2D5_0A11_C0DE)


# ---- packed runs and model files ------------------------------------------------

def pack(keys: np.ndarray, *columns: np.ndarray) -> bytes:
    """Sorted keys (as differences) and columns of small numbers, byte planes compressed."""
    planes = [np.diff(keys, prepend=np.uint64(0)), *columns]
    raw = b"".join(np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes() for c in planes)
    return np.array([len(keys), len(planes)], "<u8").tobytes() + zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(data: bytes) -> list[np.ndarray]:
    n, k = np.frombuffer(data[:16], "<u8").astype(int).tolist()
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[16:], max_output_size=max(1, n * k * 8)), np.uint8)
    planes = [np.ascontiguousarray(raw[i * 8 * n:(i + 1) * 8 * n].reshape(8, n).T).reshape(-1).view("<u8") for i in range(k)]
    return [np.cumsum(planes[0], dtype=np.uint64), *planes[1:]]


def merge(keys: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct keys and the sums of their columns."""
    if not len(keys):
        return [keys, *columns]
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return [keys[first], *[np.add.reduceat(c[order], first) for c in columns]]


class Store:
    """Array files in a folder that all machines share."""

    def __init__(self, root: str):
        self.root = root

    def _place(self, name: str) -> tuple[fs.FileSystem, str]:
        root = self.root
        if root.startswith("file:") and not root.startswith("file://"):
            root = "file://" + root[len("file:"):]
        system, path = fs.FileSystem.from_uri(root)
        return system, f"{path}/{name}"

    def save(self, name: str, array: np.ndarray) -> None:
        """Written under another name first, so a task that is run twice leaves one whole file."""
        system, path = self._place(name)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        own = f"{path}.{uuid.uuid4().hex}"
        with system.open_output_stream(own) as out:
            out.write(np.ascontiguousarray(array))
        system.move(own, path)

    def load(self, name: str, kind: str) -> np.ndarray:
        """The array in mapped memory; a shard that got no rows has no file and is empty."""
        system, path = self._place(name)
        if system.get_file_info(path).type != fs.FileType.File:
            return np.zeros(0, kind)
        if not isinstance(system, fs.LocalFileSystem):
            copy = os.path.join(_scratch(), f"{zlib.crc32(self.root.encode())}-{name.replace('/', '-')}")
            if not os.path.exists(copy):
                fs.copy_files(path, f"{copy}.{os.getpid()}", source_filesystem=system, destination_filesystem=fs.LocalFileSystem())
                os.replace(f"{copy}.{os.getpid()}", copy)
            path = copy
        if not os.path.getsize(path):
            return np.zeros(0, kind)
        return np.memmap(path, kind, "r")


@lru_cache(maxsize=1)
def _scratch() -> str:
    return tempfile.mkdtemp(prefix="ngram-")


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards are equal ranges of the hash space (``shards`` is a power of two)."""
    bits = shards.bit_length() - 1
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def _power(n: float) -> int:
    return 1 << max(0, int(np.ceil(np.log2(max(1.0, n)))))


def _cuts(sorted_hashes: np.ndarray, shards: int) -> np.ndarray:
    return np.searchsorted(_shard_of(sorted_hashes, shards), np.arange(shards + 1))


# ---- texts as token runs --------------------------------------------------------

def _token_runs(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, token hashes, bounds): words, then one end for each text."""
    for lo, hi, buf, offs in text_chunks(texts, RUN_BYTES):
        buf = lower_ascii(buf)
        starts, ends, bounds = word_spans(buf, offs, NON_SPACE)
        bounds = bounds + np.arange(hi - lo + 1)
        tokens = np.empty(len(starts) + hi - lo, np.uint64)
        is_end = np.zeros(len(tokens), bool)
        is_end[bounds[1:] - 1] = True
        tokens[is_end] = END
        tokens[~is_end] = word_hashes(buf, starts, ends)
        yield lo, hi, tokens, bounds


def _counted(runs: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Distinct keys and counts of a task's key runs, a bounded number at a time."""
    held: list[list[np.ndarray]] = []
    size = 0
    for keys in runs:
        held.append(list(np.unique(keys, return_counts=True)))
        size += len(held[-1][0])
        if size > 2 * HELD_KEYS:
            held = [merge(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))]
            size = len(held[0][0])
            if size > HELD_KEYS:
                yield held[0]
                held, size = [], 0
    if held:
        yield merge(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))


_RUN = "shard int, data binary"


def _run_batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([s for s, _ in rows], pa.int32()), pa.array([d for _, d in rows], pa.binary())],
                                      names=["shard", "data"])


def _unpacked(table: pa.Table) -> list[np.ndarray]:
    runs = [unpack(d) for d in table.column("data").to_pylist()]
    return merge(*[np.concatenate(c) for c in zip(*runs, strict=True)])


# ---- the model ------------------------------------------------------------------

class Vocabulary:
    def __init__(self, store: Store, sizes: list[int]):
        self.store, self.sizes = store, sizes
        self.base = np.concatenate(([0], np.cumsum(sizes)))
        self.shards = [store.load(f"words/{i}", "<u8") for i in range(len(sizes))]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers; the vocabulary's size for a word it lacks."""
        distinct, back = np.unique(hashes, return_inverse=True)
        out = np.full(len(distinct), self.base[-1])
        cuts = _cuts(distinct, len(self.shards))
        for i, shard in enumerate(self.shards):
            part = distinct[cuts[i]:cuts[i + 1]]
            if len(part) and len(shard):
                at = np.minimum(np.searchsorted(shard, part), len(shard) - 1)
                out[cuts[i]:cuts[i + 1]] = np.where(shard[at] == part, at + self.base[i], self.base[-1])
        return out[back]


_UNDO = [np.uint64(pow(f, -1, 1 << 64)) for f in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def unmix(h: np.ndarray) -> np.ndarray:
    """The value that ``mix`` turned into h."""
    h = h ^ (h >> np.uint64(31)) ^ (h >> np.uint64(62))
    h = h * _UNDO[1]
    h = h ^ (h >> np.uint64(27)) ^ (h >> np.uint64(54))
    h = h * _UNDO[0]
    return h ^ (h >> np.uint64(30)) ^ (h >> np.uint64(60))


def _pairs(numbers: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(history number, pair key): the word before, or size + 1 at a text's start."""
    history = np.empty_like(numbers)
    history[1:] = numbers[:-1]
    history[bounds[:-1]] = size + 1
    return history, history.astype(np.uint64) * np.uint64(size + 2) + numbers.astype(np.uint64)


def _longer(places: np.ndarray, numbers: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(history place, key) of the grams one word longer than those that end at every token
    with ``places``; the place is -1 where the text has no such gram or it is unknown."""
    history = np.empty_like(places)
    history[1:] = places[:-1]
    history[bounds[:-1]] = -1
    return history, np.maximum(history, 0).astype(np.uint64) * np.uint64(size + 2) + numbers.astype(np.uint64)


class Grams:
    """The grams of one length below the order: ``sizes`` of their shards."""

    def __init__(self, store: Store, length: int, sizes: list[int]):
        self.base = np.concatenate(([0], np.cumsum(sizes)))
        self.shards = [store.load(f"grams{length}/{i}", "<u8") for i in range(len(sizes))]
        if [len(x) for x in self.shards] != list(sizes):
            raise OSError(f"the model's files in {store.root} are not whole")

    def places(self, keys: np.ndarray) -> np.ndarray:
        """-1 for keys that no gram has."""
        distinct, back = np.unique(mix(keys), return_inverse=True)
        out = np.full(len(distinct), -1, np.int64)
        cuts = _cuts(distinct, len(self.shards))
        for i, shard in enumerate(self.shards):
            part = distinct[cuts[i]:cuts[i + 1]]
            if len(part) and len(shard):
                at = np.minimum(np.searchsorted(shard, part), len(shard) - 1)
                out[cuts[i]:cuts[i + 1]] = np.where(shard[at] == part, at + self.base[i], -1)
        return out[back]

    def keys_at(self, places: np.ndarray) -> np.ndarray:
        out = np.empty(len(places), np.uint64)
        of = np.searchsorted(self.base, places, "right") - 1
        for i, shard in enumerate(self.shards):
            mine = of == i
            if mine.any():
                out[mine] = unmix(shard[places[mine] - self.base[i]])
        return out


def _suffixes(levels: dict[int, Grams], length: int, keys: np.ndarray, span: np.uint64) -> np.ndarray:
    """Place of the gram that a gram leaves without its first word (a word's number for pairs)."""
    if length == 2:
        return keys % span
    lower = levels[length - 1]
    before = _suffixes(levels, length - 1, lower.keys_at((keys // span).astype(np.int64)), span)
    return lower.places(before * span + keys % span).astype(np.uint64)


def _at_start(levels: dict[int, Grams], length: int, keys: np.ndarray, span: np.uint64) -> np.ndarray:
    """Whether a gram's first word is a text's start."""
    if length == 2:
        return keys // span == span - np.uint64(1)
    return _at_start(levels, length - 1, levels[length - 1].keys_at((keys // span).astype(np.int64)), span)


def discounts(n: np.ndarray) -> np.ndarray:
    """Discounts of counts 0, 1, 2, and 3 or more from the numbers of types with
    counts 1 to 4; the usual fixed ones where a number is zero."""
    n1, n2, n3, n4 = n.astype(float)
    if min(n1, n2, n3) <= 0:
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    d = np.array([0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(d, 0.0, [0.0, 1.0, 2.0, 3.0])


def _count_classes(c: np.ndarray) -> np.ndarray:
    return np.array([(c == i).sum() for i in (1, 2, 3, 4)], np.int64)


class Model:
    """What scoring needs besides the arrays: sizes and discounts.  ``classes[m]`` are the
    numbers of grams of m words with counts 1 to 4."""

    def __init__(self, root: str, tokens: int, sizes: list[int], gram_sizes: dict[int, list[int]], top_shards: int, top_types: int,
                 pair_types: int, classes: dict[int, np.ndarray], next_classes: np.ndarray, next_mass: np.ndarray):
        self.root, self.tokens, self.sizes, self.gram_sizes, self.top_shards = root, tokens, sizes, gram_sizes, top_shards
        self.top_types, self.pair_types, self.order = top_types, pair_types, max(classes)
        self.words = sum(sizes)
        self.gram_discounts = {m: discounts(c) for m, c in classes.items()}
        self.next_discounts = discounts(next_classes)
        self.next_mass = next_mass               # words that follow 1, 2, and 3 or more distinct words

    def open(self) -> "Model":
        store = Store(self.root)
        self.vocabulary = Vocabulary(store, self.sizes)
        n = range(len(self.sizes))
        self.counts = [store.load(f"counts/{i}", "<u8") for i in n]
        self.unigrams = [store.load(f"unigrams/{i}", "<u8").reshape(-1, 5) for i in n]
        self.starts = store.load("starts", "<u8")
        self.grams = {m: Grams(store, m, sizes) for m, sizes in self.gram_sizes.items()}
        self.about = {m: [store.load(f"about{m}/{i}", "<u4").reshape(-1, 5) for i in range(len(sizes))] for m, sizes in self.gram_sizes.items()}
        self.single = [store.load(f"single/{i}", "<u8") for i in range(self.top_shards)]
        self.multiple = [store.load(f"multiple/{i}", "<u8") for i in range(self.top_shards)]
        self.times = [store.load(f"times/{i}", "<u4") for i in range(self.top_shards)]
        if sum(map(len, self.single + self.multiple)) != self.top_types or sum(map(len, self.counts)) != self.words:
            raise OSError(f"the model's files in {self.root} are not whole")
        return self

    def _rows(self, shards: list[np.ndarray], base: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Rows of arrays that are split by ranges of places; zeros for places that none has."""
        distinct, back = np.unique(places, return_inverse=True)
        out = np.zeros((len(distinct), *shards[0].shape[1:]), np.uint64)
        cuts = np.searchsorted(distinct, base)
        for i, shard in enumerate(shards):
            out[cuts[i]:cuts[i + 1]] = shard[distinct[cuts[i]:cuts[i + 1]] - base[i]]
        return out[back]

    def top_counts(self, keys: np.ndarray) -> np.ndarray:
        distinct, back = np.unique(mix(keys), return_inverse=True)
        out = np.zeros(len(distinct), np.int64)
        cuts = _cuts(distinct, self.top_shards)
        for i in range(self.top_shards):
            part = distinct[cuts[i]:cuts[i + 1]]
            for array, times in ((self.single[i], None), (self.multiple[i], self.times[i])):
                if len(part) and len(array):
                    at = np.minimum(np.searchsorted(array, part), len(array) - 1)
                    found = np.flatnonzero(array[at] == part)
                    out[cuts[i] + found] = 1 if times is None else times[at[found]]
        return out[back]

    def score(self, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per text: tokens, known tokens, base score, model score."""
        numbers = self.vocabulary.numbers(hashes)
        words = self.vocabulary.base
        count = self._rows(self.counts, words, numbers).astype(float)
        base = np.log10((count + 1) / (self.tokens + self.words + 1))

        following = self._rows(self.unigrams, words, numbers)[:, 0].astype(np.int64)      # distinct words before it
        spare = self.next_discounts
        if self.pair_types:
            left = (self.next_mass @ spare[1:]) / self.pair_types
            p = (following - spare[np.minimum(following, 3)]) / self.pair_types + left / (self.words + 1)
        else:
            p = np.full(len(numbers), 1.0 / (self.words + 1))
        history, keys = _pairs(numbers, bounds, self.words)
        about = self._rows(self.unigrams, words, history)[:, 1:].astype(float)
        if len(self.starts):
            about[history == self.words + 1] = self.starts.astype(float)
        for m in range(2, self.order + 1):
            if m < self.order:
                places = np.where(history >= 0, self.grams[m].places(keys), -1)
                times = self._rows(self.about[m], self.grams[m].base, places)[:, 0].astype(np.int64)
            else:
                times = self.top_counts(keys)
            total = about[:, 0]
            d = self.gram_discounts[m]
            with np.errstate(divide="ignore", invalid="ignore"):
                longer = (times - d[np.minimum(times, 3)]) / total + (about[:, 1:] @ d[1:]) / total * p
            p = np.where(total > 0, longer, p)
            if m < self.order:
                history, keys = _longer(places, numbers, bounds, self.words)
                about = self._rows(self.about[m], self.grams[m].base, history)[:, 1:].astype(float)
        sums = lambda x: np.add.reduceat(x, bounds[:-1])  # noqa: E731  every text has an end token
        return np.diff(bounds), sums((count > 0).astype(np.int64)), sums(base), sums(np.log10(p))


def _held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == FOLD, F.lit(False))


def train(docs: DataFrame, order: int = ORDER) -> Model:
    """Counts every text of ``docs`` (column text) that is not in the held-out fold.

    A gram's key is a place times the words: (grams of order - 1) * (words + 2) must stay below 2^64."""
    if order < 2:
        raise ValueError("the order is two at least")
    spark = docs.sparkSession
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ngram-{uuid.uuid4().hex}"
    store = Store(root)
    texts = docs.where(~_held_out(F.col("doc_id"))).select("text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    word_shards = _power(size / (64 << 20))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n in _counted(run[2] for b in batches for run in _token_runs(b.column(0))):
            cuts = _cuts(keys, word_shards)
            yield _run_batch([(i, pack(keys[a:z], n[a:z])) for i, (a, z) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if z > a])

    def save_words(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        keys, n = _unpacked(table)
        store.save(f"words/{shard}", keys)
        store.save(f"counts/{shard}", n)
        return pa.table({"shard": pa.array([shard], pa.int32()), "words": pa.array([len(keys)], pa.int64()), "tokens": pa.array([int(n.sum())], pa.int64())})

    found = texts.mapInArrow(words, _RUN).groupBy("shard").applyInArrow(save_words, "shard int, words bigint, tokens bigint").collect()
    sizes = [0] * word_shards
    for r in found:
        sizes[r.shard] = r.words
    tokens, n_words = sum(r.tokens for r in found), sum(sizes)
    base = np.concatenate(([0], np.cumsum(sizes)))
    span = np.uint64(n_words + 2)
    shards = _power(tokens / SHARD_TOKENS)
    levels: dict[int, list[int]] = {}           # lengths below the order: sizes of their shards

    def opened(length: int) -> dict[int, Grams]:
        return {m: Grams(store, m, levels[m]) for m in range(2, length)}

    def counted(length: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocabulary, lower = Vocabulary(store, sizes), opened(length)

            def keys_of(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
                numbers = vocabulary.numbers(hashes)
                history, keys = _pairs(numbers, bounds, n_words)
                for m in range(2, length):
                    history, keys = _longer(np.where(history >= 0, lower[m].places(keys), -1), numbers, bounds, n_words)
                return keys[history >= 0]
            for keys, n in _counted(keys_of(tokens, bounds) for b in batches for _, _, tokens, bounds in _token_runs(b.column(0))):
                shard = _shard_of(mix(keys), shards)
                order_ = np.argsort(shard, kind="stable")
                cuts = np.searchsorted(shard[order_], np.arange(shards + 1))
                for i in range(shards):
                    if cuts[i + 1] > cuts[i]:
                        own = order_[cuts[i]:cuts[i + 1]]
                        yield _run_batch([(i, pack(keys[own], n[own]))])
        return texts.mapInArrow(run, _RUN).groupBy("shard")

    def adds(length: int, keys: np.ndarray, n: np.ndarray) -> pa.Table:
        """What grams of a length with counts ``n`` add to the totals of those one shorter, by
        their shards: as the last words, and as the history.  With it the numbers of grams by count."""
        base_ = base if length == 2 else np.concatenate(([0], np.cumsum(levels[length - 1])))
        out: list[tuple[int, bytes]] = []

        def hand_on(places: np.ndarray, columns: list[np.ndarray], before: int, after: int) -> None:
            """Runs by shard of the merged places, with columns of zeros around theirs."""
            places, *columns = merge(places, *columns)
            cuts = np.append(np.searchsorted(places, base_.astype(np.uint64)), len(places))
            for i, (a, z) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):      # the last run: the start of texts, a history only
                if z > a:
                    zero = np.zeros(z - a, np.uint64)
                    out.append((i, pack(places[a:z], *[zero] * before, *[c[a:z] for c in columns], *[zero] * after)))
        # one after the other, so that only one set of columns is held
        hand_on(_suffixes(opened(length), length, keys, span), [np.ones(len(keys), np.uint64)], 0, 4)
        hand_on(keys // span, [n, *((n == k).astype(np.uint64) for k in (1, 2)), (n >= 3).astype(np.uint64)], 1, 0)
        if not out:
            out.append((0, pack(*[np.zeros(0, np.uint64)] * 6)))
        found = _count_classes(n)
        return pa.table({"shard": pa.array([i for i, _ in out], pa.int32()), "data": pa.array([d for _, d in out], pa.binary()),
                         **{f"n{j + 1}": pa.array([int(v)] + [0] * (len(out) - 1), pa.int64()) for j, v in enumerate(found)},
                         "types": pa.array([len(keys)] + [0] * (len(out) - 1), pa.int64())})
    added_schema = "shard int, data binary, n1 bigint, n2 bigint, n3 bigint, n4 bigint, types bigint"

    def save_grams(length: int):
        def save(table: pa.Table) -> pa.Table:
            shard = table.column("shard")[0].as_py()
            keys, n = _unpacked(table)
            mixed = mix(keys)
            order_ = np.argsort(mixed)
            store.save(f"grams{length}/{shard}", mixed[order_])
            store.save(f"occurrences{length}/{shard}", n[order_].astype("<u4"))
            return pa.table({"shard": pa.array([shard], pa.int32()), "n": pa.array([len(keys)], pa.int64())})
        return save

    def save_top(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        keys, n = _unpacked(table)
        mixed = mix(keys)
        order_ = np.argsort(mixed)
        ordered, times = mixed[order_], n[order_]
        store.save(f"single/{shard}", ordered[times == 1])
        store.save(f"multiple/{shard}", ordered[times > 1])
        store.save(f"times/{shard}", times[times > 1].astype("<u4"))
        return adds(order, keys, n)

    def save_about(length: int):
        """A lower length's counts and totals: (count, sum of what follows, how many follow once, twice, more often)."""
        def save(table: pa.Table) -> pa.Table:
            shard = table.column("shard")[0].as_py()
            places, *columns = _unpacked(table)
            first = sum(levels[length][:shard])
            rows = np.zeros((levels[length][shard], 5), np.uint64)
            rows[places.astype(np.int64) - first] = np.stack(columns, axis=1)
            keys = unmix(np.array(store.load(f"grams{length}/{shard}", "<u8")))
            begins = _at_start(opened(length), length, keys, span)
            rows[begins, 0] = store.load(f"occurrences{length}/{shard}", "<u4")[begins]
            store.save(f"about{length}/{shard}", rows.astype("<u4"))
            return adds(length, keys, rows[:, 0])
        return save

    for length in range(2, order):
        found = counted(length).applyInArrow(save_grams(length), "shard int, n bigint").collect()      # a row for each shard
        levels[length] = [0] * shards
        for r in found:
            levels[length][r.shard] = r.n
    added = reliable_checkpoint(counted(order).applyInArrow(save_top, added_schema))
    names = ("n1", "n2", "n3", "n4", "types")
    of_grams = {order: added.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]).first()}
    for length in range(order - 1, 1, -1):
        # a shard to which nothing was added is written too
        empty = pack(*[np.zeros(0, np.uint64)] * 6)
        every = spark.createDataFrame([(i, bytearray(empty)) for i, n in enumerate(levels[length]) if n] or [(0, bytearray(empty))], _RUN)
        added = reliable_checkpoint(added.select("shard", "data").unionByName(every).groupBy("shard").applyInArrow(save_about(length), added_schema))
        of_grams[length] = added.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]).first()

    def save_unigrams(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        keys, *columns = _unpacked(table)
        if shard == word_shards:
            store.save("starts", np.stack([c[-1:] for c in columns[1:]], axis=1))
            n, mass = np.zeros(4, np.int64), np.zeros(3, np.int64)
        else:
            rows = np.zeros((sizes[shard], 5), "<u8")
            rows[keys.astype(np.int64) - base[shard]] = np.stack(columns, axis=1)
            store.save(f"unigrams/{shard}", rows)
            n = _count_classes(rows[:, 0])
            mass = np.array([n[0], n[1], (rows[:, 0] >= 3).sum()])
        return pa.table({**{f"n{j + 1}": pa.array([int(v)], pa.int64()) for j, v in enumerate(n)},
                         **{f"m{j + 1}": pa.array([int(v)], pa.int64()) for j, v in enumerate(mass)}})

    of_words = (added.select("shard", "data").groupBy("shard")
                .applyInArrow(save_unigrams, "n1 bigint, n2 bigint, n3 bigint, n4 bigint, m1 bigint, m2 bigint, m3 bigint")
                .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n1", "n2", "n3", "n4", "m1", "m2", "m3")]).first())
    return Model(root, tokens, sizes, levels, shards, of_grams[order].types, of_grams[2].types,
                 {m: np.array(r[:4]) for m, r in of_grams.items()}, np.array(of_words[:4]), np.array(of_words[4:], float))


def score_documents(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of
    every row of ``docs`` (doc_id, text); training leaves out the held-out fold.

    Tokens are the lower-cased (A-Z) runs of anything but ASCII white space and
    one end.  A null text is empty: the end alone.  Repeated rows are counted
    and scored each; a null doc_id is not held out.  Without training texts every
    word has the same probability of 1.  Only the named columns are read.
    """
    docs = docs.select("doc_id", "text")
    model = train(docs, order)
    kept = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = model.open()
        for batch in batches:
            for lo, hi, tokens, bounds in _token_runs(batch.column(2)):
                n, known, base, total = opened.score(tokens, bounds)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                     pa.array(np.full(hi - lo, model.tokens), pa.int64()), pa.array(base), pa.array(total)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return (docs.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), "text")
            .mapInArrow(run, f"{kept}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"))
