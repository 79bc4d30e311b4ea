"""Market-basket analysis.

Baskets are ``array<string>`` per invoice (never a wide one-hot pivot):
quantities are summed per (invoice, item) first — a map-side-combined
aggregate, so each basket holds at most one entry per distinct product —
binarised (≥1 → present), and invoices with fewer than ``min_items`` present
items dropped.  Frequent itemsets come from Spark ML's distributed FPGrowth;
rules are every split of each frequent itemset into antecedent/consequent, grown a
consequent item a level by joins with the itemset supports (no per-basket pair
explosion anywhere, no list of all subsets).
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.columns import binarize
from sparkmart.operators.profile import NON_PRODUCT_CODES


def market_lines(fact: DataFrame, excluded_codes=NON_PRODUCT_CODES) -> DataFrame:
    """F8: product lines only (non-product codes removed) and no negative spend;
    lines with a NULL code or spend stay."""
    excluded = F.col("StockCode").isin(*excluded_codes)
    return fact.filter(~F.coalesce(excluded, F.lit(False)) & ~F.coalesce(F.col("total_spend") < 0, F.lit(False)))


def baskets(fact: DataFrame, item: str = "Description", basket: str = "InvoiceNo",
            min_items: int = 2) -> DataFrame:
    """One row per kept basket with its sorted item array."""
    per_item = (market_lines(fact).groupBy(basket, item)
                .agg(F.sum("Quantity").alias("_q"))
                .filter(binarize("_q") == 1))
    b = per_item.groupBy(basket).agg(F.array_sort(F.collect_set(item)).alias("items"))
    return b.filter(F.size("items") >= min_items)


def frequent_itemsets(baskets_df: DataFrame, min_support: float = 0.03) -> DataFrame:
    """(items, freq, support, n_items) for every itemset with support ≥ min_support."""
    from sparkmart.session import reliable_checkpoint
    baskets_df = reliable_checkpoint(baskets_df.select("items"))  # read by the count and the FP-tree passes
    n = baskets_df.agg(F.count(F.lit(1)).alias("_n"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=0.0).fit(baskets_df)
    fi = model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").cast("long"))
    # the mined itemsets are a lazy, uncached result: write them once so rule
    # generation (which reads them three times) does not mine three times
    return reliable_checkpoint(
        fi.crossJoin(F.broadcast(n))
          .select("items", "freq", (F.col("freq") / F.col("_n")).alias("support"), F.size("items").alias("n_items")))


def association_rules(itemsets: DataFrame, min_lift: float = 1.0, digits: int = 6, min_confidence: float = 0.0) -> DataFrame:
    """Every antecedent → consequent split of each frequent itemset
    (both sides non-empty), with support (of the union), confidence and lift;
    kept when lift ≥ min_lift and confidence ≥ min_confidence, sorted by lift.

    Level j moves one more item, greater than those moved before, from the antecedent
    to the consequent and joins the antecedent's support.  Confidence only falls on
    the way, so a split below ``min_confidence``, or whose antecedent is not among the
    itemsets, is not grown further.  A level is a written table; there are as many as
    the longest itemset has items, less one."""
    from sparkmart.session import reliable_checkpoint
    sup = itemsets.select("items", F.col("support").alias("_s"))
    a = sup.select(F.col("items").alias("antecedents"), F.col("_s").alias("antecedent_support"))
    c = sup.select(F.col("items").alias("consequents"), F.col("_s").alias("consequent_support"))
    conf = F.col("support") / F.col("antecedent_support")
    longest = itemsets.agg(F.max("n_items")).first()[0] or 0
    level = itemsets.filter(F.col("n_items") >= 2).select(F.col("items").alias("antecedents"), F.array().cast("array<string>").alias("consequents"), "support")
    levels = []
    for size in range(1, longest):
        moved = (level.filter(F.size("antecedents") >= 2)
                 .select("*", F.explode(F.filter("antecedents", lambda x: F.size("consequents").eqNullSafe(0) | (x > F.try_element_at("consequents", F.lit(-1))))).alias("x"))
                 .select(F.array_remove("antecedents", F.col("x")).alias("antecedents"), F.array_append("consequents", F.col("x")).alias("consequents"), "support"))
        level = reliable_checkpoint(moved.join(a, "antecedents").filter(conf >= min_confidence))
        levels.append(level)
        level = level.drop("antecedent_support")
        if size + 1 < longest and not level.limit(1).count():
            break
    if not levels:
        levels = [level.withColumn("antecedent_support", F.lit(1.0)).filter(F.lit(False))]
    r = levels[0]
    for more in levels[1:]:
        r = r.unionByName(more)
    r = r.join(c, "consequents")
    lift = conf / F.col("consequent_support")
    out = r.select("antecedents", "consequents",
                   F.round("support", digits).alias("support"),
                   F.round(conf, digits).alias("confidence"),
                   F.round(lift, digits).alias("lift"), lift.alias("_lift"))
    return out.filter(F.col("_lift") >= min_lift).orderBy(F.col("_lift").desc(), "antecedents", "consequents") \
              .drop("_lift")
