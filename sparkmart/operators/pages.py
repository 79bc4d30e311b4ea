"""Stored-page data work (C1-C5, X4-X6, X15, X17), re-aimed from scraping.

No fetching or browser automation: the input is a table of stored pages
``(page_id, url, html)`` and every field is a built-in regex / string /
array expression evaluated per row inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Extraction patterns.
URL_ID_PATTERN = r"(?:-i).(\d*).(\d*)"          # shop id and product id in product URLs
HOST_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)"
PATH_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^?#]*)?"
TITLE_PATTERN = r"(?s)<title[^>]*>(.*?)</title>"
H1_PATTERN = r"(?s)<h1(?:\s[^>]*)?>(.*?)</h1>"
LANG_PATTERN = r"<html[^>]*\blang=\"([^\"]*)\""
HREF_PATTERN = r"""href\s*=\s*(?:"([^"]*)"|'([^']*)')"""
PARAGRAPH_START = r"(?i)<p(?:\s[^>]*)?>"
# What ends an open paragraph: its end tag, or any tag of a block around or after it.
PARAGRAPH_END = (r"(?i)</?(?:p|div|body|html|main|section|article|header|footer|nav|aside|table|tr|td|th|ul|ol|li|dl|form|"
                 r"blockquote|pre|hr|h[1-6])(?:\s[^>]*)?/?>")
TAG_PATTERN = r"<[^>]+>"
SCRIPT_PATTERN = r"(?s)<script[^>]*>.*?</script>"
STYLE_PATTERN = r"(?s)<style[^>]*>.*?</style>"


def _lit(p: str) -> Column:
    return F.lit(p)


def strip_tags(c: Column) -> Column:
    """Visible text: drop script/style blocks, then every tag; trim."""
    no_code = F.regexp_replace(F.regexp_replace(c, SCRIPT_PATTERN, ""), STYLE_PATTERN, "")
    return F.trim(F.regexp_replace(no_code, TAG_PATTERN, ""))


def path_levels(url: Column, n: int = 3) -> list[Column]:
    """The first n path segments, '' when the path is shorter."""
    path = F.regexp_extract(url, PATH_PATTERN, 1)
    segs = F.split(F.regexp_replace(path, "^/+|/+$", ""), "/")
    return [F.coalesce(F.try_element_at(segs, F.lit(i + 1)), F.lit("")).alias(f"level_{i + 1}") for i in range(n)]


def slug(c: Column) -> Column:
    """Text → URL slug (spaces become dashes)."""
    return F.replace(c, F.lit(" "), F.lit("-"))


def hrefs(html: Column) -> Column:
    """The values of all href attributes, in double or single quotes."""
    both = F.arrays_zip(F.regexp_extract_all(html, _lit(HREF_PATTERN), 1).alias("a"), F.regexp_extract_all(html, _lit(HREF_PATTERN), 2).alias("b"))
    return F.transform(both, lambda x: F.concat(F.coalesce(x["a"], F.lit("")), F.coalesce(x["b"], F.lit(""))))


def page_records(pages: DataFrame) -> DataFrame:
    """One record per page."""
    html, url = F.col("html"), F.col("url")
    title = F.trim(F.regexp_extract(html, TITLE_PATTERN, 1))
    return pages.select(
        "page_id", "url",
        F.regexp_extract(url, HOST_PATTERN, 1).alias("host"),
        *path_levels(url),
        F.regexp_extract(url, URL_ID_PATTERN, 1).alias("shop_id"),
        F.regexp_extract(url, URL_ID_PATTERN, 2).alias("product_id"),
        F.regexp_extract(html, LANG_PATTERN, 1).alias("lang"),
        title.alias("title"),
        slug(F.lower(title)).alias("title_slug"),
        strip_tags(F.regexp_extract(html, H1_PATTERN, 1)).alias("h1"),
        F.regexp_count(html, _lit(HREF_PATTERN)).alias("n_links"),
        F.length(strip_tags(html)).alias("text_chars"),
    )


def page_links(pages: DataFrame) -> DataFrame:
    """Every href with its ordinal and the absolute URL it points to.  A link
    with a scheme of its own (``mailto:`` too) is absolute, ``#...`` and ``?...``
    belong to the page, other relative links to the page's folder."""
    page = F.regexp_extract(F.col("url"), r"^([^#]*)", 1)
    place = F.regexp_extract(F.col("url"), r"^([^?#]*)", 1)
    base = F.regexp_extract(F.col("url"), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)
    folder = F.regexp_extract(place, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/(?:.*/)?)", 1)
    links = pages.select("page_id", base.alias("_base"), page.alias("_page"), place.alias("_place"),
                         F.when(folder != "", folder).otherwise(F.concat(base, F.lit("/"))).alias("_folder"),
                         F.posexplode(hrefs(F.col("html"))).alias("pos", "link"))
    link = F.col("link")
    absolute = (F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), link)
                 .when(link.startswith("//"), F.concat(F.regexp_extract(F.col("_base"), "^([^:]+:)", 1), link))
                 .when(link.startswith("/"), F.concat(F.col("_base"), link))
                 .when(link.startswith("#"), F.concat(F.col("_page"), link))
                 .when(link.startswith("?"), F.concat(F.col("_place"), link))
                 .otherwise(F.concat(F.col("_folder"), link)))
    return links.select("page_id", F.col("pos").cast("int").alias("pos"), "link", absolute.alias("absolute_url"))


def page_paragraphs(pages: DataFrame) -> DataFrame:
    """Paragraph list → rows (ordinal, text, length).  Scripts and styles
    are removed, the rest is cut at every paragraph's start tag, and a paragraph
    reaches to its end tag, the next block tag or the end of the page."""
    html = F.regexp_replace(F.regexp_replace("html", SCRIPT_PATTERN, ""), STYLE_PATTERN, "")
    parts = F.split(html, PARAGRAPH_START)
    paras = pages.where("html IS NOT NULL").select(
        "page_id", F.posexplode(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))).alias("pos", "raw"))
    text = F.trim(F.regexp_replace(F.split("raw", PARAGRAPH_END, 2)[0], TAG_PATTERN, ""))
    return paras.select("page_id", F.col("pos").cast("int").alias("pos"), text.alias("text"),
                        F.length(text).alias("n_chars"))


def zip_reviews(df: DataFrame, comments: str = "comments", likes: str = "likes") -> DataFrame:
    """Parallel comment / like lists → rows (idx, comment, likes)."""
    z = df.select("*", F.posexplode(F.arrays_zip(F.col(comments), F.col(likes))).alias("idx", "_z"))
    return z.select(*[c for c in df.columns if c not in (comments, likes)], F.col("idx").cast("int").alias("idx"),
                    F.col(f"_z.{comments}").alias("comment"), F.col(f"_z.{likes}").alias("likes"))


TREE_SCHEMA = ("data struct<category_list: array<struct<catid: bigint, name: string, "
               "children: array<struct<catid: bigint>>>>>")


def parse_category_tree(docs: DataFrame, col: str = "value") -> DataFrame:
    """Nested JSON tree documents → (catid, name, children)."""
    parsed = docs.select(F.from_json(F.col(col), TREE_SCHEMA).alias("t"))
    return parsed.select(F.explode("t.data.category_list").alias("c")).select("c.catid", "c.name", "c.children")


def url_frontier(tree: DataFrame, base: str, pages_per_child: int = 5) -> DataFrame:
    """The root URL of every category plus, for every child category,
    ``pages_per_child`` listing pages — one row per URL."""
    name = slug(F.col("name"))
    root = tree.select("catid", F.lit(None).cast("bigint").alias("child_id"), F.lit(None).cast("int").alias("page"),
                       F.concat(F.lit(base.rstrip("/") + "/"), name, F.lit("-cat."), F.col("catid").cast("string"))
                       .alias("url"))
    kids = (tree.select("catid", name.alias("_slug"), F.explode("children").alias("ch"))
                .select("catid", "_slug", F.col("ch.catid").alias("child_id"),
                        F.explode(F.sequence(F.lit(0), F.lit(pages_per_child - 1))).alias("page")))
    kids = kids.select("catid", "child_id", F.col("page").cast("int").alias("page"),
                       F.concat(F.lit(base.rstrip("/") + "/"), F.col("_slug"), F.lit("-cat."),
                                F.col("catid").cast("string"), F.lit("."), F.col("child_id").cast("string"),
                                F.lit("?page="), F.col("page").cast("string")).alias("url"))
    return root.unionByName(kids)
