"""URL filter: a blocked Bloom filter in front of an exact hash join.

A list entry is a canonical URL prefix: a host and the beginning of a path.  It
fits a URL whose host is the entry's or a subdomain of it and whose path starts
with the entry's; the longest fitting entry decides.  A URL's possible entries
are its host suffixes, of as many labels as the longest listed host has at most,
joined with its path's beginnings of the lengths the list has.  The filter, of FILTER_BLOCKS blocks of four 64-bit lanes whatever the
list's size, lets possible hits through to the hash join with the list, which
removes the false positives.  Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTER_BLOCKS = 1 << 14
LANES = 4
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to /, ? or #, lower-cased (A-Z); else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ? or #; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _with_places(keys: DataFrame) -> DataFrame:
    """Adds each key's block and, per lane, the bit it sets there."""
    h = F.xxhash64("key")
    lanes = [F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64(key), {6 * i}) & 63L as int))").alias(f"bit{i}") for i in range(LANES)]
    return keys.select("*", F.shiftrightunsigned(h, 40).bitwiseAND(F.lit(FILTER_BLOCKS - 1)).alias("block"), *lanes)


def bloom_filter(keys: DataFrame) -> DataFrame:
    """(block, lane0..): the filter of the column ``key``, FILTER_BLOCKS rows at most."""
    return (_with_places(keys.select("key")).groupBy("block")
            .agg(*[F.bit_or(f"bit{i}").alias(f"lane{i}") for i in range(LANES)]))


def possible_hits(keys: DataFrame, bloom: DataFrame) -> DataFrame:
    """The rows of ``keys`` (column key) that the filter cannot rule out."""
    passes = [F.col(f"lane{i}").bitwiseAND(F.col(f"bit{i}")) == F.col(f"bit{i}") for i in range(LANES)]
    # the filter has FILTER_BLOCKS rows of five longs at most, under a megabyte
    hit = _with_places(keys).join(F.broadcast(bloom), "block")
    for p in passes:
        hit = hit.where(p)
    return hit.select(*keys.columns)


def _candidates(lengths: list[int], most_labels: int) -> Column:
    suffixes = f"transform(sequence(greatest(1, size(labels) - {most_labels - 1}), size(labels)), i -> array_join(slice(labels, i, size(labels)), '.'))"
    starts = f"transform(filter(array({', '.join(map(str, lengths))}), n -> n <= length(path)), n -> substring(path, 1, n))"
    return F.expr(f"flatten(transform({suffixes}, h -> transform({starts}, p -> concat(h, p))))")


def judge_urls(pages: DataFrame, listed: DataFrame, otherwise: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages`` (page_id, url).

    ``listed`` has host, path and verdict.  ``rule`` is the deciding entry's host
    and path; URLs that no entry fits have a null rule and the verdict
    ``otherwise``.  Null URLs and those without ``://`` have an empty host and
    path and fit nothing.  Of entries of one length the one with the longer host
    wins; of equal entries the greater verdict (block over allow).  List rows
    with a null host or verdict are ignored, a null path is empty.  Repeated
    rows and null ids are kept as they are; other columns are ignored.
    """
    listed = (listed.where("host IS NOT NULL AND host <> '' AND verdict IS NOT NULL")
              .select(F.translate("host", _UPPER, _UPPER.lower()).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
              .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
              .select(F.concat("host", "path").alias("key"), F.length("host").alias("host_length"), "verdict"))
    # as many values as the list has path lengths, so bounded by the longest URL
    found = listed.agg(F.collect_set(F.length("key") - F.col("host_length")).alias("lengths"),
                       F.max(F.size(F.split(F.substring("key", F.lit(1), F.col("host_length")), r"\."))).alias("labels")).first()
    lengths = sorted(found.lengths)
    pages = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if not lengths:
        return pages.select("*", F.lit(None).cast("string").alias("rule"), F.lit(otherwise).alias("verdict"))
    places = pages.where("host <> ''").select("host", "path").distinct()
    keys = places.withColumn("labels", F.split("host", r"\.")).select("host", "path", F.explode(_candidates(lengths, found.labels)).alias("key"))
    best = (possible_hits(keys, bloom_filter(listed)).join(listed, "key")
            .groupBy("host", "path")
            .agg(F.max(F.struct(F.length("key").alias("n"), "host_length", "key", "verdict")).alias("best"))
            .select("host", "path", F.col("best.key").alias("rule"), F.col("best.verdict").alias("ruled")))
    return (pages.join(best, ["host", "path"], "left")
            .select("page_id", "host", "path", "rule", F.coalesce("ruled", F.lit(otherwise)).alias("verdict")))
