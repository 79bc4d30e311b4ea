"""Ordered-sequence primitives that never put one group in one task.

``Window.partitionBy(key).orderBy(...)`` sends every row of a key to one task;
with a hot key (a customer owning a third of all invoices) that task holds a
third of the data.  Instead we

1. range-partition on the full sort key (so a hot key is *split* across many
   partitions), sort inside each partition, and checkpoint the result so the
   partition contents are fixed even if executors are lost;
2. turn (partition id, position) into a dense global index using the
   per-partition row counts (one small row per partition, broadcast);
3. look up neighbours inside blocks of successive indexes, each block with the
   last rows of the one before it (one shuffle, no row sent more than twice).
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.session import reliable_checkpoint, shuffle_partitions

IDX = "_seq_idx"
BLOCK = 1 << 12                          # successive indexes that one window looks at


def dense_index(df: DataFrame, order_cols: list[str], idx_col: str = IDX,
                start: int = 0, num_partitions: int | None = None, exchanged: bool = False) -> DataFrame:
    """Attach a consecutive index (``start``, ``start+1``, ...) in the order of
    ``order_cols`` (which must be a total order for a reproducible result).

    No single-partition exchange: the order is realised by a range exchange
    with an explicit partition count (so AQE keeps partition ids stable) and
    the counts table has one row per partition.  ``exchanged``: ``df`` ends in
    an aggregate or the like, so that its lineage up to there is kept as shuffle files.
    """
    n = num_partitions or shuffle_partitions(df.sparkSession)
    # the range exchange first runs a sampling job over its input and then
    # the exchange itself: keep the input for those two passes only, so its
    # lineage is computed once; the written result no longer needs it.  Of an
    # exchanged input both passes read the one exchange, and a copy is only more disk
    src = df if exchanged else df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        ranged = (src.repartitionByRange(n, *order_cols)
                     .sortWithinPartitions(*order_cols)
                     .withColumn("_pid", F.spark_partition_id())
                     .withColumn("_pos", F.monotonically_increasing_id()))
        ranged = reliable_checkpoint(ranged)
    finally:
        if not exchanged:
            src.unpersist()
    # position inside the partition = id minus the partition's id base
    ranged = ranged.withColumn("_pos", F.col("_pos") - F.shiftleft(F.col("_pid").cast("long"), 33))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a global window over it is tiny by construction
    offsets = counts.select(
        "_pid",
        (F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                    F.lit(0)) + F.lit(start)).alias("_off"))
    return (ranged.join(F.broadcast(offsets), "_pid")
                  .withColumn(idx_col, F.col("_off") + F.col("_pos"))
                  .drop("_pid", "_pos", "_off"))


def running_total(df: DataFrame, order_cols: list[str], weight: str, total: str) -> DataFrame:
    """Adds ``total``: the sum of ``weight`` over all rows up to and with this one
    in the order of ``order_cols`` (a total order).  Rows are range-partitioned
    and summed up inside each partition; one row per partition carries the sums
    of the partitions before it."""
    ranged = reliable_checkpoint(
        df.repartitionByRange(shuffle_partitions(df.sparkSession), *order_cols).sortWithinPartitions(*order_cols)
          .withColumn("_pid", F.spark_partition_id()))
    offsets = ranged.groupBy("_pid").agg(F.sum(weight).alias("_n")).select(
        "_pid", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    inside = F.sum(weight).over(Window.partitionBy("_pid").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0))
    return (ranged.withColumn(total, inside).join(F.broadcast(offsets), "_pid")
                  .withColumn(total, F.col(total) + F.col("_off")).drop("_pid", "_off"))


def previous_rows(indexed: DataFrame, key_cols: list[str], value_cols: list[str], lags: list[int],
                  idx_col: str = IDX) -> DataFrame:
    """For each row add ``{col}_lag{k}``: the value ``k`` rows earlier in the
    index order, or NULL when that row belongs to another key (or is absent).

    One shuffle by blocks of ``BLOCK`` successive indexes, so a hot key is
    spread over its blocks; the last rows of a block, as many as the longest
    lag, are also sent to the next one, where they are only looked back at.
    """
    payload, reach = key_cols + value_cols, max(lags)
    own = F.expr(f"{idx_col} div {BLOCK}")
    both = F.when(F.pmod(F.col(idx_col), F.lit(BLOCK)) >= BLOCK - reach, F.array(own, own + 1)).otherwise(F.array(own))
    w = Window.partitionBy("_block").orderBy(idx_col)
    seen = (indexed.select(idx_col, *payload, F.explode(both).alias("_block"))
            .select("*", *[F.lag(F.struct(*payload), k).over(w).alias(f"_before{k}") for k in sorted(set(lags))])
            .where(F.col("_block") == own))
    out = [F.col(idx_col), *map(F.col, payload)]
    for k in sorted(set(lags)):
        same_key = reduce(lambda a, b: a & b, [F.col(f"_before{k}.{c}") == F.col(c) for c in key_cols], F.lit(True))
        out += [F.when(same_key, F.col(f"_before{k}.{c}")).alias(f"{c}_lag{k}") for c in value_cols]
    return seen.select(*out)
