"""Boilerplate lines by their frequency within a site.

Pages are grouped by host; for each line, the pages of the host that contain it are divided by
all pages of the host, and lines over a ratio are dropped from the host's pages. Only DataFrame
functions are used. Texts move once, for the join with their host's lines: the lines that pass
the ratio are at most (mean distinct lines of a page / ratio), so a host's list is bounded
however many pages it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import stage

#: A line is boilerplate if it is on more than this share of its host's pages.
RATIO = 0.05
#: Below so many pages the share means less: with `small` a higher one is asked for, which rises smoothly, else such hosts keep all.
MIN_PAGES = 20
#: Tags that end a line of a web page.
BREAKS = r"(?i)\n|</?(?:p|div|li|ul|ol|h[1-6]|br|tr|table|td|th|article|section|nav|header|footer|aside|title|head|body|pre|blockquote|figure|form|main)\b[^>]*>"
#: What a page doesn't show.
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
WORD = r"[^\x20\x09-\x0D]"


def url_host(url: Column) -> Column:
    """Lower-case host of a URL without user and port; null for what has none."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def html_lines(html: Column) -> Column:
    """Text lines of a page: without comments, scripts and styles, broken at block tags, without other tags, not blank.

    A null page has no lines.
    """
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, "")
    lines = F.transform(F.split(bare, BREAKS), lambda x: F.when(F.contains(x, F.lit("<")), F.regexp_replace(x, "<[^>]*>", "")).otherwise(x))
    return F.filter(F.transform(lines, lambda x: F.trim(x)), lambda x: x.rlike(WORD))


def text_lines(text: Column) -> Column:
    return F.split(text, "\n")


def boilerplate(lined: DataFrame, host: str = "host", lines: str = "lines", ratio: float = RATIO, min_pages: int = MIN_PAGES, once: bool = False, small: bool = False, classes: DataFrame | None = None, page_id: str = "doc_id") -> DataFrame:
    """One row (host, drop) per host that has boilerplate: the sorted 64-bit hashes of its lines over the ratio.

    Counts each page once a line, sums within tasks before the shuffle by (host, line), and
    leaves blank lines out. Pages with a null host have no site and take no part. once: pages of
    a host with the same lines count as one, in a line's pages and in the host's, so that copies
    don't make a text its own boilerplate. small: hosts of n < min_pages pages take part with a
    higher ratio, which falls as n grows: lines on over ratio * min_pages² / n of their pages, or
    on all of them where that is fewer, and on two at least. classes: (page_id, class_id), one row a
    page_id: a host's pages of one class count as one, each of their lines once, so that near copies keep their text
    too; pages without a class are told apart by their lines.
    """
    keys = F.transform(F.array_distinct(F.filter(F.col(lines), lambda x: x.rlike(WORD))), lambda x: F.xxhash64(x))
    named = [F.xxhash64(lines).alias("__tw_page")] if once or classes is not None else []
    pages = lined.where(F.col(host).isNotNull()).select(F.col(host).alias("__tw_host"), keys.alias("__tw_keys"), *named, *([F.col(page_id).alias("__tw_id")] if classes is not None else []))
    of = []
    if classes is not None:
        known = classes.select(F.col(page_id).alias("__tw_id"), F.col("class_id").alias("__tw_class"))
        # Only the lines' hashes go through this join, no text.
        pages = pages.join(known, "__tw_id", "left").withColumn("__tw_page", F.when(F.col("__tw_class").isNull(), F.col("__tw_page")))
        of = ["__tw_class", "__tw_page"]
    elif once:
        pages = pages.dropDuplicates(["__tw_host", "__tw_page"])
    # The row with a null key, one a page, counts the host's pages in the same pass.
    keyed = pages.select("__tw_host", *of, F.explode(F.concat(F.coalesce("__tw_keys", F.array().cast("array<bigint>")), F.array(F.lit(None).cast("bigint")))).alias("__tw_key"))
    keyed = keyed.distinct() if of else keyed
    counts = stage(keyed.groupBy("__tw_host", "__tw_key").agg(F.count(F.lit(1)).alias("__tw_n")).where(F.col("__tw_n") > 1), "lines")
    totals = counts.where(F.col("__tw_key").isNull() & (F.col("__tw_n") >= (2 if small else min_pages))).select(F.col("__tw_host").alias("__tw_site"), F.col("__tw_n").alias("__tw_pages"))
    n = F.col("__tw_pages")
    limit = F.when(n < min_pages, F.least(F.lit(ratio * min_pages**2) / n, n - 1)).otherwise(ratio * n)
    common = counts.where(F.col("__tw_key").isNotNull()).join(totals, F.col("__tw_host") == F.col("__tw_site")).where(F.col("__tw_n") > limit)
    return common.groupBy(F.col("__tw_host").alias("host")).agg(F.sort_array(F.collect_list("__tw_key")).alias("drop"))


def line_dedup(lined: DataFrame, host: str = "host", lines: str = "lines", ratio: float = RATIO, min_pages: int = MIN_PAGES, once: bool = False, small: bool = False, classes: DataFrame | None = None, page_id: str = "doc_id") -> DataFrame:
    """lined with kept_lines (its lines without boilerplate, in order) and n_dropped (long).

    lined: pages with their host and an array of lines. Every occurrence of a boilerplate line
    goes; blank lines stay. Null lines give null and 0, a null host keeps all. Repeated rows count
    as pages of their own unless once or classes are given (see boilerplate()). Columns named kept_lines or n_dropped are replaced.
    """
    drops = stage(boilerplate(lined, host, lines, ratio, min_pages, once, small, classes, page_id), "boilerplate").withColumnsRenamed({"host": "__tw_host", "drop": "__tw_drop"})
    joined = lined.drop("kept_lines", "n_dropped").join(drops, F.col(host) == F.col("__tw_host"), "left")
    kept = F.when(F.col("__tw_drop").isNull(), F.col(lines)).otherwise(F.filter(F.col(lines), lambda x: ~F.array_contains("__tw_drop", F.xxhash64(x))))
    joined = joined.withColumn("kept_lines", kept)
    return joined.withColumn("n_dropped", F.coalesce(F.size(lines) - F.size("kept_lines"), F.lit(0)).cast("bigint")).drop("__tw_host", "__tw_drop")


def dedup_texts(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES, once: bool = False, small: bool = False, null_site: bool = False, classes: DataFrame | None = None, doc_id: str = "doc_id") -> DataFrame:
    """docs with boilerplate lines cut out of text; all rows and columns stay, a null text stays null.

    null_site: documents with a null host are one site, not none. classes: see boilerplate(); very long texts are split whole.
    """
    own = docs.columns
    # No host but null becomes '' and no other one is taken for it.
    site = F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("")) if null_site else F.col(host)
    lined = docs.select(*own, site.alias("__tw_site_name"), text_lines(F.col(text)).alias("__tw_split"))
    done = line_dedup(lined.withColumnsRenamed({c: f"__tw_own_{c}" for c in ("kept_lines", "n_dropped") if c in own}), "__tw_site_name", "__tw_split", ratio, min_pages, once, small, classes, doc_id)
    new = F.when(F.col("n_dropped") > 0, F.array_join("kept_lines", "\n")).otherwise(F.col(text))
    columns = [F.col(f"__tw_own_{c}").alias(c) if c in ("kept_lines", "n_dropped") else F.col(c) for c in own]
    return done.withColumn(text, new).select(*columns)
