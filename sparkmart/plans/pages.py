"""Stored-page extraction and JSON queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.operators import pages as pg
from sparkmart.plans.registry import register
from sparkmart.sources.tables import table

_STRIP = ("trim(regexp_replace(regexp_replace(regexp_replace({x}, '(?s)<script[^>]*>.*?</script>', '', 'g'), "
          "'(?s)<style[^>]*>.*?</style>', '', 'g'), '<[^>]+>', '', 'g'))")
_PATH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^?#]*)?', 1)"
_SEGS = f"string_split(regexp_replace({_PATH}, '^/+|/+$', '', 'g'), '/')"

_RECORDS_SQL = f"""
SELECT page_id, url,
       regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)', 1) AS host,
       coalesce({_SEGS}[1], '') AS level_1, coalesce({_SEGS}[2], '') AS level_2,
       coalesce({_SEGS}[3], '') AS level_3,
       regexp_extract(url, '(?:-i).(\\d*).(\\d*)', 1) AS shop_id,
       regexp_extract(url, '(?:-i).(\\d*).(\\d*)', 2) AS product_id,
       regexp_extract(html, '<html[^>]*\\blang="([^"]*)"', 1) AS lang,
       trim(regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)) AS title,
       replace(lower(trim(regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1))), ' ', '-') AS title_slug,
       {_STRIP.format(x="regexp_extract(html, '(?s)<h1(?:\\s[^>]*)?>(.*?)</h1>', 1)")} AS h1,
       CAST(len(regexp_extract_all(html, 'href\\s*=\\s*("[^"]*"|''[^'']*'')', 1)) AS INTEGER) AS n_links,
       CAST(length({_STRIP.format(x="html")}) AS INTEGER) AS text_chars
FROM pages"""


@register("page_records", oracle=_RECORDS_SQL, covers=("C2", "C3", "X4", "X5", "X6"))
def page_records(spark, sf_dir):
    return pg.page_records(table(spark, sf_dir, "pages"))


_LINKS_SQL = r"""
WITH l AS (
  SELECT page_id, url, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1) AS base,
         regexp_extract_all(html, 'href\s*=\s*("[^"]*"|''[^'']*'')', 1) AS links FROM pages),
x AS (SELECT page_id, base, string_split(url, '#')[1] AS page, string_split(string_split(url, '#')[1], '?')[1] AS place,
             CAST(i - 1 AS INTEGER) AS pos, links[i][2:-2] AS link
      FROM l, LATERAL (SELECT unnest(range(1, len(links) + 1)) AS i))
SELECT page_id, pos, link,
       CASE WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN link
            WHEN starts_with(link, '//') THEN regexp_extract(base, '^([^:]+:)', 1) || link
            WHEN starts_with(link, '/') THEN base || link
            WHEN starts_with(link, '#') THEN page || link
            WHEN starts_with(link, '?') THEN place || link
            WHEN place = base THEN base || '/' || link
            ELSE base || regexp_replace(substr(place, length(base) + 1), '[^/]*$', '') || link END AS absolute_url
FROM x"""


@register("page_links", oracle=_LINKS_SQL, covers=("C5",))
def page_links(spark, sf_dir):
    return pg.page_links(table(spark, sf_dir, "pages"))


# An independent way: every start tag becomes one mark character, every end of a
# paragraph another, and the pieces between them are matched.
_PARAS_SQL = r"""
WITH l AS (
  SELECT page_id, regexp_extract_all(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
           html, '(?s)<script[^>]*>.*?</script>', '', 'g'), '(?s)<style[^>]*>.*?</style>', '', 'g'),
           '(?i)<p(\s[^>]*)?>', chr(1), 'g'),
           '(?i)</?(p|div|body|html|main|section|article|header|footer|nav|aside|table|tr|td|th|ul|ol|li|dl|form|blockquote|pre|hr|h[1-6])(\s[^>]*)?/?>', chr(2), 'g'),
           '\x01([^\x01\x02]*)', 1) AS ps FROM pages),
x AS (SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, trim(regexp_replace(ps[i], '<[^>]+>', '', 'g')) AS text
      FROM l, LATERAL (SELECT unnest(range(1, len(ps) + 1)) AS i))
SELECT page_id, pos, text, CAST(length(text) AS INTEGER) AS n_chars FROM x"""


@register("page_paragraphs", oracle=_PARAS_SQL, covers=("C4", "X13"))
def page_paragraphs(spark, sf_dir):
    return pg.page_paragraphs(table(spark, sf_dir, "pages"))


BASE_URL = "https://shop.example.com"


def _part_tree(spark, sf_dir):
    """A category tree from the part table: a category per part type (id =
    its smallest part key), children = the brands sold in it (id = brand no.)."""
    p = table(spark, sf_dir, "part")
    brand_id = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("bigint")
    return p.groupBy(F.col("p_type").alias("name")).agg(
        F.min("p_partkey").alias("catid"),
        F.array_sort(F.collect_set(F.struct(brand_id.alias("catid")))).alias("children"))


_FRONTIER_SQL = f"""
WITH b AS (SELECT p_type AS name, min(p_partkey) OVER (PARTITION BY p_type) AS catid,
                  CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS BIGINT) AS child_id FROM part),
cats AS (SELECT DISTINCT name, catid FROM b),
kids AS (SELECT DISTINCT name, catid, child_id FROM b)
SELECT catid, CAST(NULL AS BIGINT) AS child_id, CAST(NULL AS INTEGER) AS page,
       '{BASE_URL}/' || replace(name, ' ', '-') || '-cat.' || CAST(catid AS VARCHAR) AS url FROM cats
UNION ALL
SELECT catid, child_id, CAST(pg AS INTEGER) AS page,
       '{BASE_URL}/' || replace(name, ' ', '-') || '-cat.' || CAST(catid AS VARCHAR) || '.' ||
       CAST(child_id AS VARCHAR) || '?page=' || CAST(pg AS VARCHAR)
FROM kids, range(0, 5) t(pg)"""


@register("category_frontier", oracle=_FRONTIER_SQL, covers=("C1", "S8", "X17"))
def category_frontier(spark, sf_dir):
    # the tree goes through its JSON document form (one document per
    # category, so no single row carries the whole tree)
    docs = _part_tree(spark, sf_dir).select(F.to_json(F.struct(F.struct(F.array(
        F.struct("catid", "name", "children")).alias("category_list")).alias("data"))).alias("value"))
    return pg.url_frontier(pg.parse_category_tree(docs), BASE_URL, 5)


@register("event_props", oracle="""
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k_text FROM events""", covers=("X17",))
def event_props(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "event_type", F.from_json("props", "k int")["k"].alias("k"),
                     F.get_json_object("props", "$.k").alias("k_text"))
