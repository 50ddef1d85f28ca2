"""Line dedup by site-relative frequency.

For every host, a line's share is the number of the host's pages that hold it
divided by the host's pages; lines above the boilerplate ratio are dropped from
all pages of that host.

Texts never move with the counts: pages send one 64-bit hash per distinct line,
counted map-side, and a line on a single page of its host never meets the host
totals.  Dropped line hashes come back as one short list per page.

Defined results
---------------
* Lines are compared after trimming; blank lines are neither counted nor kept.
* A null or empty page has no lines and an empty text; it counts as a page of
  its host.  A null URL, or one without a host, belongs to the host ''.
* Rows with equal page id and content are one page.  A page id that occurs
  with several contents keeps each of them as a page.
* A line on fewer than ``min_pages`` pages of its host is never boilerplate.
* Other columns of the input play no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

# Markup that ends a line, and parts of a page without text.
BLOCK = r"(?i)</?(p|div|br|li|ul|ol|h[1-6]|tr|td|th|table|nav|header|footer|article|section|title|body|head|html|blockquote|pre)\b[^>]*>"
SILENT = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"


def host_of(url):
    """Lower-cased authority of a URL without user, port and leading www."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.coalesce(F.regexp_replace(host, r"^www\.", ""), F.lit(""))


def text_lines(html):
    """Trimmed non-blank lines of a page's text, in order."""
    text = F.regexp_replace(html, SILENT, " ")
    text = F.regexp_replace(F.regexp_replace(text, BLOCK, "\n"), r"<[^>]*>", " ")
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "[\r\n]+"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")))
    return F.filter(lines, lambda x: x != "")


def line_counts(pages: DataFrame) -> DataFrame:
    """(host, hashes) -> host, hash, pages: pages of the host that hold the line."""
    return (pages.select("host", F.explode(F.array_distinct("hashes")).alias("hash"))
            .groupBy("host", "hash").agg(F.count("*").alias("pages")))


def boilerplate(pages: DataFrame, ratio: float, min_pages: int) -> DataFrame:
    totals = pages.groupBy("host").agg(F.count("*").alias("host_pages"))
    return (line_counts(pages).where(F.col("pages") >= min_pages).join(totals, "host")
            .where(F.col("pages") > ratio * F.col("host_pages")).select("host", "hash"))


def drop_boilerplate(pages: DataFrame, ratio: float = 0.2, min_pages: int = 3,
                     id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """page_id, host, n_lines, n_dropped, text (the kept lines)."""
    own = materialize(
        pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"),
                     text_lines(F.col(html_col)).alias("lines"))
        .withColumn("hashes", F.transform("lines", lambda x: F.xxhash64(x)))
        .withColumn("content", F.xxhash64("page_id", "host", "hashes"))
        .dropDuplicates(["page_id", "host", "content"]), "line-pages")
    drop = materialize(boilerplate(own.select("host", "hashes"), ratio, min_pages), "line-boilerplate")
    hits = (own.select("page_id", "host", "content", F.explode(F.array_distinct("hashes")).alias("hash"))
            .join(drop, ["host", "hash"], "left_semi")
            .groupBy(F.col("page_id").alias("__p"), F.col("content").alias("__c"))
            .agg(F.collect_list("hash").alias("gone")))  # at most the distinct lines of one page
    joined = own.join(hits, F.col("page_id").eqNullSafe(F.col("__p")) & (F.col("content") == F.col("__c")), "left")
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.transform(
        F.filter(F.arrays_zip("lines", "hashes"), lambda x: ~F.array_contains(F.col("gone"), x["hashes"])),
        lambda x: x["lines"]))
    return (joined.withColumn("kept", kept)
            .select("page_id", "host", F.size("lines").alias("n_lines"),
                    (F.size("lines") - F.size("kept")).alias("n_dropped"),
                    F.array_join("kept", "\n").alias("text")))
