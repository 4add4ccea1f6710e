"""Line deduplication by site-relative frequency, in DataFrame functions only.

Pages are cut into lines of text (markup ends lines at block elements and is removed). For each
host the pages that hold a line are counted and divided by the host's pages; lines above the
boilerplate ratio that occur on enough pages are dropped from all the host's pages.

Counts combine before the shuffle, so a host with a third of all pages sends one row a task
and line. The lines of one host that pass the ratio are few: their page counts add up to at most the
host's lines, so there are at most (lines on a mean page) / ratio of them, and they travel to
the pages as one array a host, in a join that Spark broadcasts if it is small and splits if a
host is large.

Defined results: a null or empty ``html`` has no lines; a page without a host (null or malformed
``url``) keeps all its lines; rows that repeat are pages of their own; a line that repeats in a
page counts once there and is dropped wherever it stands; an empty table gives no rows. Input
columns other than ``page_id, url, html`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylattice.llm.common import BLANK, stage

#: Share of a host's pages above which a line is boilerplate, and the fewest pages that show it.
RATIO, PAGES = 0.3, 2
#: Elements that end a line.
BLOCKS = (
    "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|"
    "h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|select|table|tbody|td|tfoot|th|"
    "thead|title|tr|ul"
)
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
BLOCK = rf"(?i)</?(?:{BLOCKS})\b[^>]*>"
HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
#: Entities that are turned into their character; ``&amp;`` comes last, so nothing is read twice.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def host(url: str = "url") -> Column:
    """The host in lower case without user and port; null where there is none."""
    found = F.lower(F.regexp_extract(F.col(url), HOST, 1))
    return F.when(found != "", found)


def lines(html: str = "html") -> Column:
    """The lines of text of a page, blanks at both ends removed, empty lines left out."""
    text = F.regexp_replace(F.coalesce(F.col(html), F.lit("")), HIDDEN, "")
    text = F.regexp_replace(text, BLOCK, "\n")
    text = F.regexp_replace(text, r"<[^>]*>", "")
    for entity, character in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    rows = F.split(text, rf"[{BLANK}]*[\x0A\x0D][{BLANK}]*")
    return F.filter(F.transform(rows, lambda x: F.trim(x)), lambda x: x != "")


def _key(line: Column) -> Column:
    """128 bits that stand for a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(7), line).alias("b"))


def boilerplate(pages: DataFrame, ratio: float = RATIO, least: int = PAGES) -> DataFrame:
    """``host, line`` key and counts of the lines to drop, from ``pages (host, lines)``."""
    sited = pages.where(F.col("host").isNotNull())
    totals = sited.groupBy("host").agg(F.count("*").alias("host_pages"))
    each = sited.select("host", F.explode(F.array_distinct("lines")).alias("line"))
    shown = each.groupBy("host", _key(F.col("line")).alias("key")).agg(F.count("*").alias("shown"))
    shown = shown.where(F.col("shown") >= least).join(totals, "host")
    return shown.where(F.col("shown") > ratio * F.col("host_pages"))


def drop_lines(pages: DataFrame, ratio: float = RATIO, least: int = PAGES) -> DataFrame:
    """``page_id, host, text`` (kept lines), ``n_lines`` and ``n_dropped``, a row for each page."""
    cut = stage(pages.select("page_id", host().alias("host"), lines().alias("lines")), "lines")
    drop = boilerplate(cut, ratio, least).groupBy("host").agg(F.collect_list("key").alias("drop"))
    marked = cut.join(stage(drop, "boilerplate"), "host", "left")
    kept = F.when(F.col("drop").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x: ~F.array_contains("drop", _key(x)))
    )
    marked = marked.withColumn("kept", kept)
    return marked.select(
        "page_id",
        "host",
        F.array_join("kept", "\n").alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
    )
