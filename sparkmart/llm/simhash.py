"""SimHash near-duplicates by pivot distance tables.

Equal fingerprints are one node, however many rows share it.  Four differing
bits leave at least two of six bit blocks untouched, so every linked pair meets
in one of the 15 cells "two blocks have these bits"; a cell is the unit of work.
Every fingerprint carries its row of the pivot table, the Hamming distances to
eight reference fingerprints.  Pairs of a cell are discarded where any
coordinate differs by more than the threshold; survivors are verified by their
own distance.

Cells of over SMALL_CELL rows hold groups of near copies.  There the references
are chosen among the cell's own fingerprints until each is within the threshold
of one; a reference's ball is linked to it straight from its column, and only
pairs between balls not yet connected are sought, through the same table.
A large cell returns a spanning forest of its links, never its pairs.  Cells above
CELL_ROWS are dealt out as pairs of salted blocks, so no task holds more than
two blocks, and every pair of the cell still meets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.session import reliable_checkpoint

from .graph import components
from .kernels import mix
from .names import fresh

SEED = 42
BLOCKS = 6
CELL_ROWS = 4096
SMALL_CELL = 32
# Reference fingerprints of the pivot table that every fingerprint carries.
REFERENCES = [int(v) for v in mix(np.arange(1, 9, dtype=np.uint64)).view(np.int64)]


def _shingle_bits(text: bytes, size: int) -> int:
    """Fingerprint of one text: words joined by single spaces, each run of
    ``size`` words hashed, a bit set where over half of the hashes have it."""
    words = text.lower().split()                # of bytes: A-Z, and the six ASCII white-space characters
    if not words:
        return 0
    k = min(size, len(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b - 1], SEED) for a, b in zip([0, *ends[:-k]], ends[k - 1:], strict=True)], np.uint64)
    votes = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 14):
        block = hashes[a:a + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big")


def fingerprint(text: Column, shingle_words: int = 4) -> Column:
    """64-bit SimHash (as a signed long) of a whole text; 0 without words or for null."""

    @F.arrow_udf("long")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            values = (_shingle_bits(t.as_buffer().to_pybytes(), shingle_words) if t.is_valid else 0
                      for t in texts.cast(pa.large_binary()))
            yield pa.array(np.fromiter(values, np.uint64, len(texts)).view(np.int64))
    return compute(text)


def _forest(prints: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Edges (positions in ``prints``) of a spanning forest of the links among one
    cell's distinct fingerprints, found through the pivot table."""
    n = len(prints)
    owner = np.full(n, -1)
    pivots, table = [], []
    for i in range(n):
        if owner[i] >= 0:
            continue
        distance = np.bitwise_count(prints ^ prints[i])
        owner[(distance <= most) & (owner < 0)] = len(pivots)
        pivots.append(i)
        table.append(distance)
    edges = [(i, pivots[p]) for i, p in enumerate(owner.tolist()) if i != pivots[p]]
    leader = np.arange(len(pivots))                              # component of each ball

    def find(p: int) -> int:
        while leader[p] != p:
            leader[p] = leader[leader[p]]
            p = leader[p]
        return int(p)

    distances = np.stack(table, axis=1) if n else np.zeros((0, 0), np.uint8)
    for p in range(len(pivots)):
        members = np.flatnonzero(owner == p)
        # a link between x and a member of this ball needs d(x, pivot) <= 2 * most
        for x in np.flatnonzero((distances[:, p] <= 2 * most) & (owner != p)).tolist():
            if find(owner[x]) == find(p):
                continue
            gap = np.abs(distances[members].astype(np.int16) - distances[x].astype(np.int16)).max(axis=1)
            close = members[gap <= most]
            close = close[np.bitwise_count(prints[close] ^ prints[x]) <= most]
            if len(close):
                edges.append((int(x), int(close[0])))
                leader[find(owner[x])] = find(p)
    return edges


def _cells(most: int) -> list[int]:
    """Masks of the cells: with ``most`` differing bits, BLOCKS - most blocks agree."""
    border = np.linspace(0, 64, max(BLOCKS, most + 2) + 1).round().astype(int)
    blocks = [((1 << int(hi)) - 1) ^ ((1 << int(lo)) - 1) for lo, hi in zip(border[:-1], border[1:], strict=True)]
    return [sum(c) for c in combinations(blocks, len(blocks) - most)]


def _signed(v: int) -> int:
    return v - (1 << 64) if v >> 63 else v


def _coordinates() -> Column:
    """The row of the pivot table: Hamming distances to REFERENCES, a byte each."""
    parts = [F.shiftleft(F.bit_count(F.col("fp").bitwiseXOR(F.lit(r))).cast("long"), 8 * i) for i, r in enumerate(REFERENCES)]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def _small_cells(fp: np.ndarray, table: np.ndarray, cell: np.ndarray, most: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal ``cell`` numbers of at most ``width`` rows:
    pairs that no pivot coordinate discards, then verified."""
    coordinates = table.view(np.uint8).reshape(-1, 8).astype(np.int8)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for step in range(1, width):
        i = np.flatnonzero(cell[:-step] == cell[step:])
        if not len(i):
            break
        i = i[np.abs(coordinates[i] - coordinates[i + step]).max(axis=1) <= most]
        i = i[np.bitwise_count(fp[i] ^ fp[i + step]) <= most]
        a.append(i)
        b.append(i + step)
    return np.concatenate(a), np.concatenate(b)


def _solve(most: int):
    """mapInArrow function over rows sorted by cell: edges of every cell."""
    keys = ["cell", "bits", "low", "high"]

    def edges(fp: np.ndarray, table: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
        sizes = np.diff(np.append(starts, len(fp)))
        cell = np.repeat(np.arange(len(starts)), sizes)
        small = (sizes <= SMALL_CELL)[cell]
        u = fp.view(np.uint64)
        a, b = _small_cells(u[small], table[small], cell[small], most, SMALL_CELL)
        ends_a, ends_b = [fp[small][a]], [fp[small][b]]
        for c in np.flatnonzero(sizes > SMALL_CELL).tolist():
            rows = np.sort(u[starts[c]:starts[c] + sizes[c]])
            pairs = np.array(_forest(rows, most), np.int64).reshape(-1, 2)
            ends_a.append(rows[pairs[:, 0]].view(np.int64))
            ends_b.append(rows[pairs[:, 1]].view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(ends_a)), pa.array(np.concatenate(ends_b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None                # the rows of the cell that may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            new = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in (*keys, "fp", "table")}
            held = new if held is None else {k: np.concatenate((held[k], new[k])) for k in new}
            changed = np.zeros(len(held["fp"]) - 1, bool)
            for k in keys:
                changed |= held[k][1:] != held[k][:-1]
            starts = np.concatenate(([0], np.flatnonzero(changed) + 1))
            last = int(starts[-1])
            if last:
                yield edges(held["fp"][:last], held["table"][:last], starts[:-1])
                held = {k: v[last:] for k, v in held.items()}
        if held is not None:
            yield edges(held["fp"], held["table"], np.zeros(1, np.int64))
    return run


def links(prints: DataFrame, most: int = 4, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(a, b): edges that connect exactly the distinct fingerprints (column fp,
    long) that a chain of pairs with at most ``most`` differing bits connects."""
    masks = F.array(*[F.struct(F.lit(i).alias("cell"), F.lit(_signed(m)).alias("mask")) for i, m in enumerate(_cells(most))])
    dealt = (prints.select("fp", _coordinates().alias("table"), F.explode(masks).alias("c"))
             .select("fp", "table", "c.cell", F.col("fp").bitwiseAND(F.col("c.mask")).alias("bits")))
    large = reliable_checkpoint(dealt.groupBy("cell", "bits").agg(F.count("*").alias("n")).where(F.col("n") > cell_rows)
                                .select("cell", "bits", F.ceil(F.col("n") / cell_rows).cast("int").alias("k")))
    dealt = (dealt.join(large, ["cell", "bits"], "left")
             .withColumn("own", F.coalesce(F.pmod(F.xxhash64("fp"), F.col("k")).cast("int"), F.lit(0)))
             # a large cell: every pair of blocks that holds the row's own one
             .withColumn("other", F.explode(F.expr("if(k IS NULL, array(0), filter(sequence(0, k - 1), j -> j <> own))")))
             .select("cell", "bits", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp", "table"))
    keys = ["cell", "bits", "low", "high"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_solve(most), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, shingle_words: int = 4, most: int = 4) -> DataFrame:
    """(doc_id, fp, component_id, component) of every row of ``docs`` (doc_id, text).

    Fingerprints of at most ``most`` differing bits link; component_id is the
    smallest doc_id that links reach, the row's own included; component is the
    least fingerprint they reach, which no two components share.  Null and empty
    texts have fingerprint 0 and link like any other.  Repeated rows are kept as
    they are.  A null doc_id is never the smallest; a component without any
    doc_id has a null component_id.  Extra columns are ignored.
    """
    rows = reliable_checkpoint(docs.select("doc_id", fingerprint(F.col("text"), shingle_words).alias("fp")))
    prints = reliable_checkpoint(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    linked = components(links(prints.select("fp"), most))
    of = (prints.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
          .select("fp", "least", F.coalesce("component", "fp").alias("component")))
    # a written table: where it is small Spark broadcasts it, and a large component is not sent to one task
    least = reliable_checkpoint(of.groupBy("component").agg(F.min("least").alias("component_id")))
    named = reliable_checkpoint(of.join(least, "component").select("fp", "component_id", "component"))
    return rows.join(named, "fp").select("doc_id", "fp", "component_id", "component")


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, shingle_words: int = 4, most: int = 4) -> DataFrame:
    """One row of each group of near-duplicates, with all columns whatever their
    names: the one with the smallest doc_id (any one of the rows that repeat it).
    Rows without a doc_id stay only if no row of their group has one, and then one
    of them.  The rows that go are told by doc_id, and by fingerprint where an id is
    null or repeated.  Their list is a written table, so Spark knows its size: a
    short one is broadcast, for a long one the texts are shuffled once by its keys."""
    own_id, own_fp, id_, fp = fresh(docs, "_gone", "_own", "_id", "_fp")
    found = reliable_checkpoint(near_duplicates(docs, shingle_words, most))
    unclear = found.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    if not unclear.limit(1).count():
        gone = reliable_checkpoint(found.where("doc_id <> component_id").select(F.col("doc_id").alias(own_id)))
        return docs.join(gone, F.col("doc_id") == F.col(own_id), "left_anti")
    # an id alone does not tell the rows apart: id and fingerprint do, but for copies
    rows = found.groupBy("doc_id", "fp", "component_id", "component").agg(F.count("*").alias("n"))
    kept = reliable_checkpoint(
        rows.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("component").agg(F.min(F.struct("fp", "doc_id", "n")).alias("k")).select(
            F.col("k.doc_id").alias(id_), F.col("k.fp").alias(fp), "k.n"))
    gone = reliable_checkpoint(rows.join(kept, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col("fp") == F.col(fp)), "left_anti").select(
        F.col("doc_id").alias(id_), F.col("fp").alias(fp)))
    copies = kept.where("n > 1").select(id_, fp)
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(own_fp) == F.col(fp))
    left = docs.withColumn(own_fp, fingerprint(F.col("text"), shingle_words)).join(gone, same, "left_anti")
    if copies.limit(1).count():
        left = left.join(copies, same, "left_anti").unionByName(
            left.join(copies, same, "left_semi").dropDuplicates(["doc_id", own_fp]))
    return left.drop(own_fp)
