"""Source divergence audit: how the term frequencies of a language's sources
differ from each other and from the language, by triangular discrimination.

A term's smoothed share p of a group is an integer (parts of 10^9, plus one), and
two shares differ by f = (p - q)^2 / (p + q), rounded down; all of it is exact.

The terms by which a group stands out most are found by dominance.  Among terms
with p > q, f never falls when the group's count rises or the language's count
falls, and ties go to the term that is earlier in UTF-8.  So a term that k others
beat or equal in all three cannot be among the first k.  Every partition keeps
its terms dominated by fewer than k others (its k-skyband); the skybands of a
group are merged into one, and only what is left is ranked by f.

Sums over pairs of sources read every term once: a term's counts by source become
one row of a dense block, and of each pair only terms that at least one source
holds are summed; the others all have the same f.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.session import reliable_checkpoint, shuffle_partitions

from .kernels import byte_class, lower_ascii, rows_of, text_chunks, word_spans

LETTER = byte_class((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
SCALE = 1_000_000_000
LEAST_DOCUMENTS = 10
TOP = 10
CELLS = 1 << 20                      # cells (terms x sources) of one dense block
HELD = 1 << 18                       # skyband rows a task holds before it hands them on

_TERM = "lang string, source string, term string, n bigint, lang_n bigint"


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) -> (lang, source, term, n, docs), a row for each term of
    each group in a run of texts."""
    for batch in batches:
        group = {}
        code = np.array([group.setdefault(k, len(group)) for k in zip(*(c.to_pylist() for c in batch.columns[:2]), strict=True)], np.int64)
        names = list(group)
        for lo, hi, buf, offs in text_chunks(batch.column(2), 1 << 22):
            starts, ends, bounds = word_spans(buf, offs, LETTER)
            if not len(starts):
                continue
            letters = lower_ascii(buf[LETTER[buf]])
            borders = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
            coded = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(borders), pa.py_buffer(letters)]).dictionary_encode()
            size = len(coded.dictionary)
            term = coded.indices.to_numpy().astype(np.int64)
            row = rows_of(bounds)
            of_doc, n = np.unique(row * size + term, return_counts=True)
            of_group, place = np.unique(code[lo + of_doc // size] * size + of_doc % size, return_inverse=True)
            at = (of_group // size).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[i][0] for i in at]), pa.array([names[i][1] for i in at]),
                 coded.dictionary.take(pa.array(of_group % size)).cast(pa.string()),
                 pa.array(np.bincount(place, n, len(of_group)).astype(np.int64)), pa.array(np.bincount(place, minlength=len(of_group)))],
                names=["lang", "source", "term", "n", "docs"])


def skyband(n: np.ndarray, lang_n: np.ndarray, term: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows that fewer than ``k`` others dominate; the terms (bytes) are distinct.

    Rows are taken so that whatever dominates a row comes before it.  The first k
    rows that dominate a row are in the skyband themselves, so it is enough to
    count among the rows kept so far."""
    order = np.lexsort((term, lang_n, -n))
    name = np.empty(len(term), np.int64)
    name[np.argsort(term, kind="stable")] = np.arange(len(term))
    held = np.empty((2, len(order)), np.int64)
    kept = []
    for i in order.tolist():
        m = len(kept)
        if m < k or np.count_nonzero((held[0, :m] <= lang_n[i]) & (held[1, :m] < name[i])) < k:
            held[:, m] = lang_n[i], name[i]
            kept.append(i)
    return np.array(kept, np.int64)


def _skybands(k: int):
    """mapInArrow function over ``_TERM`` rows: keeps the skyband of every group among
    the task's rows.  A task that holds too many rows hands them on and starts
    anew, which only leaves more rows for the next step."""

    def batch_of(rows: dict) -> Iterator[pa.RecordBatch]:
        if not rows:
            return
        size = [len(v[0]) for v in rows.values()]
        flat = [np.concatenate([v[j] for v in rows.values()]) for j in range(3)]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array([g[j] for g, m in zip(rows, size, strict=True) for _ in range(m)], pa.string()) for j in range(2)),
             pa.array(flat[2], pa.binary()).cast(pa.string()), pa.array(flat[0]), pa.array(flat[1])],
            names=["lang", "source", "term", "n", "lang_n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict = {}
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, object))
        for batch in batches:
            n, lang_n = (batch.column(j).to_numpy(zero_copy_only=False) for j in (3, 4))
            term = np.array(batch.column(2).cast(pa.binary()).to_pylist(), object)
            where: dict = {}
            for i, g in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                where.setdefault(g, []).append(i)
            for g, at in where.items():
                held = rows.get(g, none)
                merged = [np.concatenate((old, values[at])) for old, values in zip(held, (n, lang_n, term), strict=True)]
                best = skyband(*merged, k)
                rows[g] = tuple(values[best] for values in merged)
            if sum(len(v[0]) for v in rows.values()) > HELD:
                yield from batch_of(rows)
                rows = {}
        yield from batch_of(rows)
    return run


def share(count: np.ndarray | int, total: np.ndarray | int, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)) by long division, three
    decimal digits a step, so that nothing passes 64 bits below 9 * 10^15 tokens."""
    whole = np.asarray(total, np.int64) + 2 * terms
    left = np.asarray(count, np.int64) + 2
    out = left // whole
    left = left % whole
    for _ in range(3):
        left = left * 1000
        out = out * 1000 + left // whole
        left = left % whole
    return out + 1


def _differ(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _pair_sums(langs: dict):
    """mapInArrow function over (lang, counts: [(source, n)]), a row for each kept term:
    for every ordered pair of sources g, h the sums of f over the terms that g holds
    (``both``) and over those that only g holds (``only``), and how many of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        for batch in batches:
            lang_of = np.array(batch.column(0).to_pylist(), object)
            lists = batch.column(1)
            counts = lists.flatten()
            size = np.diff(lists.offsets.to_numpy())
            ends = np.cumsum(size)
            source, n = np.array(counts.field(0).to_pylist(), object), counts.field(1).to_numpy(zero_copy_only=False)
            for lang in dict.fromkeys(lang_of.tolist()):
                place, totals, terms = langs[lang]
                s = len(place)
                if lang not in total:
                    total[lang] = np.zeros((4, s, s), np.int64)
                rows = np.flatnonzero(lang_of == lang)
                step = max(1, CELLS // s)
                for i in range(0, len(rows), step):
                    part = rows[i:i + step]
                    cells = np.concatenate([np.arange(ends[r] - size[r], ends[r]) for r in part])
                    dense = np.zeros((len(part), s), np.int64)
                    dense[np.repeat(np.arange(len(part)), size[part]), [place[x] for x in source[cells]]] = n[cells]
                    p = share(dense, totals[None, :], terms)
                    for g in range(s):
                        held = np.flatnonzero(dense[:, g])
                        f = _differ(p[held, g][:, None], p[held])
                        alone = dense[held] == 0
                        total[lang][0, g] += f.sum(axis=0)
                        total[lang][1, g] += np.where(alone, f, 0).sum(axis=0)
                        total[lang][2, g] += len(held)
                        total[lang][3, g] += alone.sum(axis=0)
        for lang, sums in total.items():
            names = pa.array(list(langs[lang][0]), pa.string())
            s = len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (s * s), pa.string()), names.take(pa.array(np.repeat(np.arange(s), s))),
                 names.take(pa.array(np.tile(np.arange(s), s))), *(pa.array(sums[j].reshape(-1)) for j in range(4))],
                names=["lang", "source", "item", "both", "only", "n_held", "n_only"])
    return run


def _native_share(count: Column, total: Column, terms: Column) -> Column:
    """``share`` as a column, in exact decimals."""
    scaled = (F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")).cast("decimal(38,0)")
    return F.call_function("div", scaled, (total + 2 * terms).cast("decimal(38,0)")) + 1


def audit_sources(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) of ``docs``
    (text, lang, source).

    Part ``pair``: each other source of the lang and the sum of f over the lang's
    kept terms, those in at least ``least_documents`` of its rows.  Part ``term``:
    the ``top`` terms that the group uses more than the lang does.

    Null texts, langs and sources count as empty ones; repeated rows and rows
    without an id count as rows; a lang without kept terms has pairs of value 0 and
    no terms; a lang with one source has no pairs; no rows give none; other columns
    are ignored.  The pairs of a lang are the square of its sources, so the list
    of sources is held by the driver and by every task of the pair sums."""
    spark = docs.sparkSession
    texts = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    cells = reliable_checkpoint(
        texts.mapInArrow(_count_terms, "lang string, source string, term string, n bigint, docs bigint")
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    kept = (cells.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"),
                                              F.collect_list(F.struct("source", "n")).alias("counts"))
            .where(F.col("docs") >= least_documents).drop("docs"))
    kept = reliable_checkpoint(kept)
    by_term = kept.select("lang", "term", "lang_n", F.inline("counts"))

    of_lang = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    groups = (texts.select("lang", "source").distinct()
              .join(by_term.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
              .join(of_lang, "lang", "left").na.fill(0, ["total", "terms", "lang_total"]))
    groups = reliable_checkpoint(groups)

    langs: dict = {}
    for r in groups.orderBy("lang", "source").collect():
        place, totals, _ = langs.setdefault(r.lang, ({}, [], r.terms))
        place[r.source] = len(place)
        totals.append(r.total)
    langs = {k: (place, np.array(totals, np.int64), terms) for k, (place, totals, terms) in langs.items()}

    sums = (kept.select("lang", "counts").mapInArrow(
        _pair_sums(langs), "lang string, source string, item string, both bigint, only bigint, n_held bigint, n_only bigint")
        .groupBy("lang", "source", "item").agg(*(F.sum(c).alias(c) for c in ("both", "only", "n_held", "n_only"))))
    sums = reliable_checkpoint(sums)
    other = sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"),
                        F.col("only").alias("o_only"), F.col("n_only").alias("o_n_only"))
    mine = groups.select("lang", "source", "total", "terms")
    theirs = groups.select("lang", F.col("source").alias("item"), F.col("total").alias("o_total"))
    zero = F.lit(0).cast("long")
    p0, q0 = _native_share(zero, F.col("total"), F.col("terms")), _native_share(zero, F.col("o_total"), F.col("terms"))
    neither = F.col("terms") - F.coalesce("n_held", zero) - F.coalesce("o_n_only", zero)
    pairs = (mine.join(theirs, "lang").where("source <> item")
             .join(sums, ["lang", "source", "item"], "left").join(other, ["lang", "source", "item"], "left")
             .withColumn("same", F.when(F.col("terms") > 0, F.call_function("div", (p0 - q0) * (p0 - q0), p0 + q0)).otherwise(zero))
             .select("lang", "source", F.lit("pair").alias("part"), "item",
                     (F.coalesce("both", zero) + F.coalesce("o_only", zero) + neither * F.col("same")).alias("value")))

    local = by_term.select("lang", "source", "term", "n", "lang_n").mapInArrow(_skybands(top), _TERM)
    merged = local.repartition(shuffle_partitions(spark), "lang", "source").mapInArrow(_skybands(top), _TERM)
    p = _native_share(F.col("n"), F.col("total"), F.col("terms"))
    q = _native_share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    terms = (merged.join(groups, ["lang", "source"]).withColumn("p", p).withColumn("q", q).where("p > q")
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                     F.call_function("div", (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("p") + F.col("q")).alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .unionByName(pairs.withColumn("rank", F.row_number().over(order))))
