"""Market-basket queries.  The Spark side uses FPGrowth; the oracles count
itemsets by brute-force self-joins, an independent method."""

from __future__ import annotations

from sparkmart.operators import basket
from sparkmart.operators.profile import NON_PRODUCT_CODES
from sparkmart.plans.registry import register
from sparkmart.plans.sqltext import with_fact
from sparkmart.sources.tables import transaction_fact

# Support threshold chosen for the generated catalogue (64 products, ~3 items
# per basket): at the published 0.03 only single items are frequent.
MIN_SUPPORT = 0.002
_CODES = ", ".join(f"'{c}'" for c in NON_PRODUCT_CODES)

_BASKET_CTES = f"""
items AS (
  SELECT InvoiceNo, Description AS item FROM fact
  WHERE coalesce(StockCode NOT IN ({_CODES}), TRUE) AND NOT coalesce(total_spend < 0, FALSE)
  GROUP BY InvoiceNo, Description HAVING sum(Quantity) >= 1),
keep AS (SELECT InvoiceNo FROM items GROUP BY InvoiceNo HAVING count(*) >= 2),
bi AS (SELECT i.* FROM items i JOIN keep USING (InvoiceNo)),
nb AS (SELECT count(*) AS n FROM keep),
s1 AS (SELECT [item] AS items, count(*) AS freq FROM bi GROUP BY item),
s2 AS (SELECT [a.item, b.item] AS items, count(*) AS freq FROM bi a JOIN bi b
       ON a.InvoiceNo = b.InvoiceNo AND a.item < b.item GROUP BY a.item, b.item),
s3 AS (SELECT [a.item, b.item, c.item] AS items, count(*) AS freq FROM bi a
       JOIN bi b ON a.InvoiceNo = b.InvoiceNo AND a.item < b.item
       JOIN bi c ON a.InvoiceNo = c.InvoiceNo AND b.item < c.item GROUP BY a.item, b.item, c.item),
fi AS (
  SELECT items, CAST(freq AS BIGINT) AS freq, freq / (SELECT n FROM nb) AS support,
         CAST(len(items) AS INTEGER) AS n_items
  FROM (SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3)
  WHERE freq / (SELECT n FROM nb) >= {MIN_SUPPORT})"""

_BASKETS_SQL = with_fact(extra_ctes=_BASKET_CTES, body="""
SELECT InvoiceNo, list_sort(list(item)) AS items FROM bi GROUP BY InvoiceNo""")

_FI_SQL = with_fact(extra_ctes=_BASKET_CTES, body="SELECT * FROM fi")

_RULES_SQL = with_fact(extra_ctes=_BASKET_CTES + """,
pairs AS (
  SELECT [x.items[1]] AS antecedents, [x.items[2]] AS consequents, x.support FROM fi x WHERE x.n_items = 2
  UNION ALL
  SELECT [x.items[2]], [x.items[1]], x.support FROM fi x WHERE x.n_items = 2
  UNION ALL
  SELECT [x.items[i]], list_filter(x.items, lambda y: y <> x.items[i]), x.support FROM fi x, range(1, 4) t(i) WHERE x.n_items = 3
  UNION ALL
  SELECT list_filter(x.items, lambda y: y <> x.items[i]), [x.items[i]], x.support FROM fi x, range(1, 4) t(i) WHERE x.n_items = 3),
r AS (
  SELECT p.antecedents, p.consequents, p.support, p.support / a.support AS conf,
         p.support / a.support / c.support AS lift
  FROM pairs p JOIN fi a ON a.items = p.antecedents JOIN fi c ON c.items = p.consequents)""", body="""
SELECT antecedents, consequents, round(support, 6) AS support, round(conf, 6) AS confidence,
       round(lift, 6) AS lift FROM r WHERE lift >= 1""")


def _baskets(spark, sf_dir):
    return basket.baskets(transaction_fact(spark, sf_dir))


@register("market_baskets", oracle=_BASKETS_SQL, covers=("A13", "F8", "X14", "X16"))
def market_baskets(spark, sf_dir):
    return _baskets(spark, sf_dir)


@register("frequent_itemsets", oracle=_FI_SQL, covers=("M19", "J8"))
def frequent_itemsets(spark, sf_dir):
    return basket.frequent_itemsets(_baskets(spark, sf_dir), MIN_SUPPORT)


@register("association_rules", oracle=_RULES_SQL, covers=("M20", "T5"))
def association_rules(spark, sf_dir):
    return basket.association_rules(basket.frequent_itemsets(_baskets(spark, sf_dir), MIN_SUPPORT))
