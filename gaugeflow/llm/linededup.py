"""Line de-duplication by site-relative frequency.

For each site, the pages that contain a line are divided by the site's pages;
lines over a boilerplate ratio are dropped from all pages of that site. A page
counts once per text, on both sides of the division: a page that was copied
many times is a duplicate for other operators, not boilerplate.

A site has few lines over the ratio: at most (lines per page) / ratio of them,
however many pages it has. They are gathered per site and joined to the pages;
the page texts are read twice and shuffled only if that table is too large for
Spark to broadcast.

Defined results:

* null text: stays null, no lines; empty text: one blank line, kept;
* blank lines are never dropped or counted as frequent;
* null site: one site of its own;
* sites under ``min_pages`` different pages: nothing is dropped;
* a page all of whose lines are dropped stays, with an empty text;
* repeated rows: each gets the same result; other columns pass unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import stage

RATIO = 0.10
MIN_PAGES = 10
BLANK = " \t\n\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _is_blank(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANK)) == ""


def boilerplate(documents: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(site, lines)``: the MD5 of each line over the ratio, per site."""
    pages = documents.filter(F.col("text").isNotNull()).select(
        F.col("source").alias("site"), F.xxhash64("text").alias("page"), F.col("text"))
    sites = stage(pages.groupBy("site").agg(F.countDistinct("page").alias("pages")).filter(
        F.col("pages") >= min_pages), "sites")
    ids = F.array_distinct(F.transform(F.filter(_lines(F.col("text")), lambda x: ~_is_blank(x)), F.md5))
    found = pages.select("site", "page", F.explode(ids).alias("line")).groupBy("site", "line").agg(
        F.countDistinct("page").alias("on")).filter(F.col("on") > 1)
    over = found.join(sites, found["site"].eqNullSafe(sites["site"])).filter(F.col("on") > ratio * F.col("pages"))
    return over.groupBy(found["site"].alias("site")).agg(F.collect_list("line").alias("lines"))


def _cleaned(documents: DataFrame, ratio: float, min_pages: int) -> DataFrame:
    """``_doc`` (the row), ``all`` and ``kept`` (arrays of its lines)."""
    bad = stage(boilerplate(documents, ratio, min_pages), "boilerplate")
    own = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_doc"))
    both = own.join(bad, F.col("_doc.source").eqNullSafe(bad["site"]), "left")
    kept = F.when(F.col("lines").isNull(), F.col("all")).otherwise(
        F.filter("all", lambda x: _is_blank(x) | ~F.array_contains("lines", F.md5(x))))
    return both.withColumn("all", _lines(F.col("_doc.text"))).withColumn("kept", kept).select("_doc", "all", "kept")


def line_dedup(documents: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """A row per document: ``doc_id``, ``n_lines``, ``n_dropped``, ``text``."""
    out = _cleaned(documents.select("doc_id", "source", "text"), ratio, min_pages)
    return out.select(
        F.col("_doc.doc_id").alias("doc_id"), F.coalesce(F.size("all"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("all") - F.size("kept"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join("kept", "\n").alias("text"))


def without_boilerplate(documents: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``documents`` with the lines over the ratio taken out of ``text`` and,
    where that changed it, ``n_chars`` counted anew."""
    text = F.array_join("kept", "\n")
    new = {"text": text, "n_chars": F.when(F.size("kept") < F.size("all"), F.char_length(text).cast("long")).otherwise(
        F.col("_doc.n_chars") if "n_chars" in documents.columns else F.lit(None))}
    return _cleaned(documents, ratio, min_pages).select(
        *[new[c].alias(c) if c in new else F.col(f"_doc.`{c}`") for c in documents.columns])


ORACLE_SQL = f"""
WITH lines AS (
  SELECT source, md5(text) AS page, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL),
sites AS (SELECT source, count(DISTINCT md5(text)) AS pages FROM documents WHERE text IS NOT NULL GROUP BY source),
bad AS (
  SELECT l.source, list(l.line) AS bad FROM (
    SELECT source, line, count(DISTINCT page) AS n FROM lines
    WHERE regexp_matches(line, '[^ \\t\\n\\x0b\\x0c\\r]') GROUP BY source, line) l
  JOIN sites s ON s.source IS NOT DISTINCT FROM l.source
  WHERE l.n > 1 AND s.pages >= {MIN_PAGES} AND l.n > {RATIO} * s.pages GROUP BY l.source),
kept AS (
  SELECT d.doc_id, string_split(d.text, chr(10)) AS a,
         list_filter(string_split(d.text, chr(10)), lambda x: NOT list_contains(coalesce(b.bad, []), x)) AS k
  FROM documents d LEFT JOIN bad b ON b.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, coalesce(len(a), 0)::BIGINT AS n_lines, coalesce(len(a) - len(k), 0)::BIGINT AS n_dropped,
       sha256(coalesce(array_to_string(k, chr(10)), '')) AS kept_sha256
FROM kept
"""
