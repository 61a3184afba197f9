"""Line dedup by site-relative frequency (DataFrame functions only).

A line is boilerplate of a site when the pages of that site that contain it,
divided by all pages of the site, exceed ``ratio`` and at least ``min_pages``
pages contain it.  Pages are counted once per line whatever the repetitions
inside them; lines are compared trimmed of blanks, by md5.  The counting
shuffle carries (site, 16-byte digest) pairs, combined before it.  A site has
at most (mean lines per page / ratio) boilerplate lines, so its digest list
is bounded; the sites' table is broadcast only after a count of all its
digests, else joined by shuffle (a site with a third of all pages is then
split by AQE's skew join, as only its small list is replicated).

The bar.  What an author writes for one page stands on that page, and on a
second one when the page is copied; a line on a third page comes from the
site, be it a menu, a licence, an advert or a passage.  A site need not show
it on all pages: templates belong to sections, so one page in a thousand
is enough on sites of more than 3,000 pages.  Copies count as pages, so a
page that stands three times in one site loses its lines there.

Defined results: a null text stays null with 0 lines; blank lines are never
counted or dropped; a text all of whose lines go becomes empty, its row
stays; a null site is a site of its own; repeated rows are pages of their
own; an empty table gives no rows; all other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import fresh, quoted, store

RATIO = 0.001
MIN_PAGES = 3
#: Digests of 16 bytes, of all sites, up to which their lists may be broadcast (6.4 MB).
BROADCAST_DIGESTS = 400_000


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(F.trim(line)))


def _site(site_col: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(site_col).cast("string")), F.lit("null"))


def boilerplate(docs: DataFrame, site_col: str = "source", text_col: str = "text",
                ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(site key, digest, pages, site_pages) of every boilerplate line."""
    pages = docs.select(_site(site_col).alias("__site"), F.col(text_col).alias("__text"))
    totals = pages.groupBy("__site").agg(F.count(F.lit(1)).alias("__total"))
    kept = F.filter(F.split("__text", "\n"), lambda l: F.trim(l) != "")
    lines = pages.select("__site", F.explode(F.array_distinct(F.transform(kept, _digest))).alias("__line"))
    counts = lines.groupBy("__site", "__line").agg(F.count(F.lit(1)).alias("__pages"))
    return (counts.filter(F.col("__pages") >= min_pages).join(totals, "__site")
            .filter(F.col("__pages") > F.col("__total") * ratio))


def _cleaned(docs: DataFrame, site_col: str, text_col: str, ratio: float, min_pages: int) -> tuple[DataFrame, str]:
    """``docs`` and a struct column (n_lines, n_dropped, text) of a name of its own."""
    site, bad, out = fresh(docs, "__site"), fresh(docs, "__bad"), fresh(docs, "__cleaned")
    found = store(boilerplate(docs, site_col, text_col, ratio, min_pages)
                  .groupBy(F.col("__site").alias(site)).agg(F.collect_list("__line").alias(bad)), "lines")
    digests = found.agg(F.sum(F.size(bad))).first()[0] or 0
    marked = docs.withColumn(site, _site(site_col)).join(F.broadcast(found) if digests <= BROADCAST_DIGESTS else found, site, "left")
    lines = F.split(text_col, "\n")
    kept = F.when(F.col(bad).isNull(), lines).otherwise(
        F.filter(lines, lambda l: (F.trim(l) == "") | ~F.array_contains(bad, _digest(l))))
    n = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines))
    stays = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(kept))
    result = F.struct(n.alias("n_lines"), (n - stays).alias("n_dropped"), F.array_join(kept, "\n").alias("text"))
    return marked.withColumn(out, result).drop(site, bad), out


def drop_boilerplate(docs: DataFrame, site_col: str = "source", text_col: str = "text",
                     ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``docs`` with the boilerplate lines cut out of ``text_col``, and n_lines and n_dropped, which
    take the place of columns of these names."""
    out, c = _cleaned(docs, site_col, text_col, ratio, min_pages)
    return out.withColumns({"n_lines": F.col(c)["n_lines"], "n_dropped": F.col(c)["n_dropped"], text_col: F.col(c)["text"]}).drop(c)


def clean(docs: DataFrame, site_col: str = "source", text_col: str = "text", length_col: str = "n_chars",
          ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``docs`` with its own columns: cleaned texts, and their length in ``length_col`` if it has one."""
    out, c = _cleaned(docs, site_col, text_col, ratio, min_pages)
    new = {text_col: F.col(c)["text"]}
    if length_col in docs.columns:
        new[length_col] = (F.when(F.col(c)["n_dropped"] > 0, F.char_length(F.col(c)["text"])).otherwise(F.col(length_col))
                           .cast(docs.schema[length_col].dataType))
    return out.withColumns(new).select([quoted(x) for x in docs.columns])


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text, coalesce('=' || source, 'null') AS site FROM documents),
l AS (SELECT r, doc_id, site, unnest(string_split(text, chr(10))) AS line,
             unnest(range(1, len(string_split(text, chr(10))) + 1)) AS pos FROM d WHERE text IS NOT NULL),
totals AS (SELECT site, count(*) AS total FROM d GROUP BY site),
bad AS (SELECT l.site, trim(line) AS line FROM l JOIN totals USING (site) WHERE trim(line) <> ''
        GROUP BY l.site, trim(line), total
        HAVING count(DISTINCT r) >= {MIN_PAGES} AND count(DISTINCT r) > total * {RATIO}),
kept AS (SELECT l.r, count(*) AS n_lines, count(*) FILTER (bad.line IS NOT NULL) AS n_dropped,
                coalesce(string_agg(l.line, chr(10) ORDER BY pos) FILTER (bad.line IS NULL), '') AS text
         FROM l LEFT JOIN bad ON l.site = bad.site AND trim(l.line) = bad.line GROUP BY l.r)
SELECT d.doc_id, d.source, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
       CASE WHEN d.text IS NULL THEN NULL ELSE kept.text END AS text
FROM d LEFT JOIN kept USING (r)"""
