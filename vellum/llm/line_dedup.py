"""Operator 2, line dedup [native]: lines that stand on a large share of a site's pages are dropped.

DataFrame functions only. Every page gives each of its distinct lines once, as a 16-byte
digest with its host; pages are counted by (host, line) with map-side combine, so a host
with a third of all pages is spread over its lines. A line is boilerplate if its pages
exceed ``ratio`` of the host's pages. A host has at most (lines per page) / ratio such
lines, whatever its size, so they fit one row per host. These rows are written and the
pages join them: below the session's broadcast threshold, which Spark checks against the
table's size, no page moves; above it both sides are plain shuffles, and adaptive
execution splits the partition of a hot host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.storage import materialize

#: A line on one page alone repeats nothing, however few pages its site has.
RATIO, MIN_PAGES = 0.3, 2
#: Elements whose contents aren't text, and tags that end a line.
HIDDEN = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
BREAKS = r"(?i)</?(?:p|br|div|li|ul|ol|h[1-6]|tr|td|th|table|title|head|body|html|nav|article|section|header|footer|aside|main|pre|blockquote)(?:[ \t\r\n/][^>]*)?>"


def html_lines(html: Column) -> Column:
    """Lines of text of a page, in order: block tags end lines, other tags go; lines are trimmed, empty ones dropped."""
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, " "), BREAKS, "\n"), "<[^>]*>", "")
    lines = F.transform(F.split(text, "\n"), lambda x: F.trim(F.regexp_replace(x, "[ \t\r\x0b\x0c]+", " ")))
    return F.filter(lines, lambda x: x != "")


def host_of(url: Column) -> Column:
    """The lower-cased host of a URL; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


def boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """host, bad (digests of lines on more than ``ratio`` of the host's pages and on at least ``min_pages``).

    ``pages`` has host and lines.
    """
    totals = pages.groupBy("host").agg(F.count("*").alias("total"))
    each = pages.select("host", F.explode(F.array_distinct(F.transform("lines", digest))).alias("line"))
    counts = each.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    bad = counts.join(totals, "host").where(F.col("n") > F.lit(ratio) * F.col("total"))
    return bad.groupBy("host").agg(F.collect_list("line").alias("bad"))


def line_dedup(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, host, lines (all), kept (lines that aren't boilerplate), in page order.

    Null html has no lines; a null or odd URL belongs to the host ''. A line that a page
    repeats counts once for it, and is kept or dropped in all its places; one that stands on
    exactly ``ratio`` of the pages is kept. Lines are compared whole, however long. Ids may
    repeat or be null: every row is a page, a repeated one too. An empty table gives an empty result; other columns are
    ignored.
    """
    named = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col).cast("string")).alias("host"), html_lines(F.col(html_col).cast("string")).alias("lines"))
    bad, _ = materialize(boilerplate(named.select("host", "lines"), ratio, min_pages), "boilerplate")
    joined = named.join(bad, "host", "left")
    kept = F.filter("lines", lambda x: ~F.array_contains(F.col("bad"), digest(x)))
    return joined.select("page_id", "host", "lines", F.when(F.col("bad").isNull(), F.col("lines")).otherwise(kept).alias("kept"))


def line_dedup_digest(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, host, n_lines, n_kept, kept_sha256 (of the kept lines, newline-joined)."""
    out = line_dedup(pages, ratio, min_pages)
    return out.select("page_id", "host", F.size("lines").cast("bigint").alias("n_lines"), F.size("kept").cast("bigint").alias("n_kept"), F.sha2(F.array_join("kept", "\n"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH named AS (
  SELECT page_id,
    lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
    list_filter(list_transform(string_split(
      regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
        '%s', ' ', 'g'), '%s', chr(10), 'g'), '<[^>]*>', '', 'g'), chr(10)),
      lambda x: trim(regexp_replace(x, '[ \t\r\x0b\x0c]+', ' ', 'g'), ' ')), lambda x: x <> '') AS lines
  FROM pages),
totals AS (SELECT host, count(*) AS total FROM named GROUP BY host),
counts AS (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM named) GROUP BY host, line),
bad AS (SELECT host, list(line) AS bad FROM counts JOIN totals USING (host) WHERE n > CAST(%s AS DOUBLE) * total AND n >= %d GROUP BY host),
kept AS (SELECT page_id, host, lines, CASE WHEN bad IS NULL THEN lines ELSE list_filter(lines, lambda x: NOT list_contains(bad, x)) END AS kept
  FROM named LEFT JOIN bad USING (host))
SELECT page_id, host, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(kept) AS BIGINT) AS n_kept,
  sha256(array_to_string(kept, chr(10))) AS kept_sha256 FROM kept
""" % (HIDDEN, BREAKS, RATIO, MIN_PAGES)
