"""Line dedup by site-relative frequency.

Pages are grouped by host.  A line's frequency is the number of the host's
pages that contain it (once or often) over the host's pages; a line above
``ratio``, on at least ``min_pages`` pages, is boilerplate of that host and
is dropped wherever it stands on the host's pages.  With two as ``min_pages``
the ratio alone decides on every line that is on more than one page.

Every row is a page.  With ``once_a_text`` pages of a host with the same text
count as one, above and below the fraction, so a page does not become
boilerplate by being mirrored (for corpora whose copies are still there).

Defined cases: lines end at ``\\n`` and are compared as they are; lines that are
empty or all spaces are never counted nor dropped.  Null and empty texts are
pages without lines and come back as they are; pages of a null host form a
host of their own; a text that loses all its lines becomes the empty text.
Rows are never dropped and repeated rows are treated alike.  Other columns
pass through; one named like an added column is replaced.

At scale: a page's distinct lines leave it as hashes (48 bytes a line), pages
are counted with map-side partial sums by (host, line), so a hot host spreads
over its lines, and what returns to the pages is one row per host with at most
(lines per page) / ratio hashes, however large the host is.  That table is
broadcast if its measured size is small and otherwise joined by host, where
AQE may split the hot host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, text_key, with_columns_kept, written


def _line_id(line: Column) -> Column:
    """128 bits that stand for a line."""
    return F.struct(F.xxhash64(line).alias("h"), F.xxhash64(F.lit(7), line).alias("g"))


def boilerplate(pages: DataFrame, ratio: float, min_pages: int, once_a_text: bool = True) -> DataFrame:
    """(host, boiler): per host with any, the hashes of its boilerplate lines.
    ``pages`` has the columns host and text."""
    own_lines = F.explode(F.array_distinct(F.split("text", "\n"))).alias("line")
    if once_a_text:
        seen = pages.select("host", text_key(F.col("text")).alias("page"), "text")
        counted, lines = seen.select("host", "page").distinct(), seen.select("host", "page", own_lines)
    else:
        counted, lines = pages.select("host"), pages.select("host", own_lines)
    total = counted.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    lines = lines.where(F.trim("line") != "").withColumn("line", _line_id(F.col("line")))
    held = ((lines.distinct() if once_a_text else lines).groupBy("host", "line").agg(F.count(F.lit(1)).alias("held"))
            .where(F.col("held") >= min_pages))
    return (held.alias("l").join(total.alias("t"), F.col("l.host").eqNullSafe(F.col("t.host")))
            .where(F.col("held") > F.lit(ratio) * F.col("pages"))
            .groupBy("l.host").agg(F.collect_list("line").alias("boiler")))


def drop_boilerplate(docs: DataFrame, host: Column, text_col: str = "text", ratio: float = 0.06,
                     min_pages: int = 2, once_a_text: bool = True) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text_col``, and the
    columns n_lines (before) and n_dropped."""
    text = F.col(f"`{text_col}`").cast("string")
    found = written(boilerplate(docs.select(host.alias("host"), text.alias("text")), ratio, min_pages, once_a_text), "boilerplate")
    found = small(found.withColumnRenamed("host", "_host"), 64 + F.length(F.coalesce("_host", F.lit("")))
                  + 24 * F.size("boiler"))
    kept = with_columns_kept(docs, "n_lines", "n_dropped", "_host", "boiler", "_lines", "_left", "_of")
    lines = kept.select("*", host.alias("_of"), F.split(text, "\n").alias("_lines"))
    joined = lines.join(found, F.col("_of").eqNullSafe(F.col("_host")), "left")
    left = F.when(F.col("boiler").isNull(), F.col("_lines")).otherwise(
        F.filter("_lines", lambda x: ~F.array_contains(F.col("boiler"), _line_id(x))))
    out = joined.withColumn("_left", left)
    whole = F.when(F.size("_left") == F.size("_lines"), text).otherwise(F.array_join("_left", "\n"))
    order = [whole.alias(text_col) if c == text_col else F.col(f"`{c}`") for c in kept.columns]
    count = {c: F.when(F.col(c).isNull(), 0).otherwise(F.size(c)).cast("long") for c in ("_lines", "_left")}
    return out.select(*order, count["_lines"].alias("n_lines"),
                      (count["_lines"] - count["_left"]).alias("n_dropped"))


def host_of(url: Column) -> Column:
    """Host of a URL, lower-cased; empty if it has none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


ORACLE_SQL = """
WITH page AS (SELECT row_number() OVER () AS page, source, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
share AS (
  SELECT source, line, count(DISTINCT page) AS held, any_value(pages) AS pages
  FROM (SELECT source, page, count(*) OVER (PARTITION BY source) AS pages, lines FROM page) p, unnest(p.lines) AS u(line)
  WHERE trim(line) <> '' GROUP BY source, line),
boiler AS (SELECT source, list(line) AS lines FROM share WHERE held > 1 AND held / pages > {ratio} GROUP BY source),
cut AS (
  SELECT d.doc_id, d.text, string_split(d.text, chr(10)) AS lines,
         list_filter(string_split(d.text, chr(10)), lambda x: NOT list_contains(coalesce(b.lines, []), x)) AS kept
  FROM documents d LEFT JOIN boiler b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, CASE WHEN len(kept) = len(lines) THEN text ELSE coalesce(array_to_string(kept, chr(10)), '') END AS text,
       CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(lines) - len(kept), 0) AS BIGINT) AS n_dropped
FROM cut
"""
