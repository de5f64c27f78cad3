"""Boilerplate lines by their frequency relative to the site.

A line is boilerplate on a host if it stands on more than ``max_ratio`` of the host's pages
and on at least ``min_pages`` of them. The counts travel as (host, 64-bit hash of the line);
texts are never shuffled for them. What is left after the ratio is at most
``average distinct lines per page / max_ratio`` lines per host. It is kept as one array per
host, measured, and looked up by broadcast or, beyond the bound, by a join salted with the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitrank.llm.common import SMALL_BYTES
from traitrank.operators.joins import Size, lookup_join
from traitrank.sources.staging import Staging

MAX_RATIO = 0.1
MIN_PAGES = 10

# Parts of a page that are not shown, and tags that end a line; fixed by HTML.
HIDDEN = r"(?is)<(?:!--.*?-->|script\b.*?</script>|style\b.*?</style>|head\b.*?</head>)"
BREAKS = (
    r"(?i)</?(?:p|div|li|ul|ol|h[1-6]|br|hr|tr|td|th|table|article|section|nav|header|footer"
    r"|main|aside|body|html|title|blockquote|pre)\b[^>]*>"
)
TAG = r"<[^>]*>"
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"

_BLANK = " \t\r"


def url_host(url: Column) -> Column:
    """Host of a URL in lower case, null if there is none."""
    host = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(host != "", host)


def html_text(html: Column) -> Column:
    """Shown text of a page, a line per block element; entities stay as they are."""
    shown = F.regexp_replace(html, HIDDEN, "")
    return F.regexp_replace(F.regexp_replace(shown, BREAKS, "\n"), TAG, "")


def _key(line: Column) -> Column:
    return F.trim(line, F.lit(_BLANK))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(
    pages: DataFrame, *, text: str, host: str, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """(host, line_hash, n_pages, host_pages) of the lines above the ratio.

    A row counts as a page. Blanks around a line do not matter, blank lines never count, a line
    that a page repeats counts once there. Rows without host belong to no site.
    """
    of_site = pages.select(F.col(host).alias("host"), F.col(text).alias("text")).filter("host IS NOT NULL")
    sites = of_site.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    keys = F.filter(F.transform(_lines(F.col("text")), _key), lambda line: line != "")
    line_hash = F.explode(F.array_distinct(F.transform(keys, lambda line: F.xxhash64(line))))
    counted = (
        of_site.select("host", line_hash.alias("line_hash"))
        .groupBy("host", "line_hash").agg(F.count(F.lit(1)).alias("n_pages"))
        .filter(F.col("n_pages") >= min_pages)
    )
    return counted.join(sites, "host").filter(F.col("n_pages") > max_ratio * F.col("host_pages"))


def drop_boilerplate(
    pages: DataFrame,
    *,
    text: str,
    host: str,
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
    counts: tuple[str, str] | None = None,
) -> DataFrame:
    """``pages`` with the boilerplate lines taken out of ``text``; all rows and columns stay.

    With ``counts`` two LONG columns follow: non-blank lines before, and lines dropped. A text of
    boilerplate only becomes '', null stays null (0 lines). Rows without host are left alone.
    Column names of ``pages`` beginning with ``__`` are the operator's own.
    """
    staging = Staging.of(pages)
    found = boilerplate(pages, text=text, host=host, max_ratio=max_ratio, min_pages=min_pages)
    per_host = staging.write(
        found.groupBy(F.col("host").alias("__host")).agg(F.collect_set("line_hash").alias("__drop")), "boilerplate"
    )
    measured = per_host.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(64 + F.octet_length("__host") + 8 * F.size("__drop")), F.lit(0))
    ).first()
    size = Size(rows=measured[0], bytes=measured[1] if measured[1] <= SMALL_BYTES else 1 << 62)
    met = lookup_join(
        pages.withColumn("__host", F.col(host)), per_host, ["__host"], how="left", spread=[text], size=size
    )
    lines = _lines(F.col(text))
    known = F.coalesce("__drop", F.array().cast("array<bigint>"))
    kept = F.filter(lines, lambda line: ~F.array_contains(known, F.xxhash64(_key(line))))
    cleaned = F.when(F.size(known) == 0, F.col(text)).otherwise(F.array_join(kept, "\n"))
    out = [F.col(c) if c != text else cleaned.alias(text) for c in pages.columns]
    if counts:
        filled = F.filter(lines, lambda line: _key(line) != "")
        dropped = F.filter(filled, lambda line: F.array_contains(known, F.xxhash64(_key(line))))
        out += [F.coalesce(F.size(a), F.lit(0)).cast("long").alias(c) for a, c in zip((filled, dropped), counts)]
    return met.select(*out)


# DuckDB's RE2 reads the same patterns.
ORACLE = rf"""
WITH shown AS (
  SELECT page_id, nullif(lower(regexp_extract(url, '{HOST}', 1)), '') AS host,
    string_split(regexp_replace(regexp_replace(regexp_replace(
      html, '{HIDDEN}', '', 'g'), '{BREAKS}', chr(10), 'g'), '{TAG}', '', 'g'), chr(10)) AS lines
  FROM pages
), lines AS (
  SELECT page_id, host, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM shown
), keyed AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS key FROM lines
), dropped AS (
  SELECT host, key FROM keyed JOIN (SELECT host, count(*) AS host_pages FROM shown GROUP BY host) USING (host)
  WHERE key <> '' GROUP BY host, key, host_pages
  HAVING count(DISTINCT page_id) >= {MIN_PAGES} AND count(DISTINCT page_id) > {MAX_RATIO}::DOUBLE * host_pages
), judged AS (
  SELECT k.*, d.key IS NOT NULL AS gone FROM keyed k LEFT JOIN dropped d ON k.host = d.host AND k.key = d.key
)
SELECT page_id, host, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text,
  count(*) FILTER (key <> '') AS n_lines, count(*) FILTER (gone) AS n_dropped
FROM judged GROUP BY page_id, host
"""
