"""Operator 8: line dedup by site-relative frequency, in DataFrame operations only.

Documents are grouped by host.  The pages of a host that contain a line, divided by the host's
pages, is the line's ratio; lines above the boilerplate ratio are dropped from that host's pages.

Lines are counted by their MD5 digest (16 bytes instead of the line), once per page, with partial
aggregation before the shuffle, so neither a hot host nor a hot line meets in one task.  A
host's boilerplate lines number at most (lines of a page) / ratio, because their pages add up to
the host's lines; they are kept as one array per host and joined to the documents by host: as a
broadcast where the planner finds the table small, else by a shuffle join that AQE splits for a hot host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import fresh, stored

RATIO = 0.08  # boilerplate: on more than this share of a host's pages ...
MIN_PAGES = 4  # ... and on at least this many of them


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _key(line: Column) -> Column:
    """Digest of the line without surrounding white space; null for a blank line."""
    clean = F.regexp_replace(line, r"^\s+|\s+$", "")
    return F.when(clean != "", F.unhex(F.md5(clean)))


def boilerplate_lines(docs: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES,
                      copies: bool = True) -> DataFrame:
    """``host``, ``line_md5``, ``pages`` with the line, ``host_pages`` and their ``ratio``, for
    every line above ``ratio`` that at least ``min_pages`` pages of its host hold.  Without
    ``copies``, rows of a host with equal texts are one page."""
    pages = docs.select(F.col(f"`{host}`").cast("string").alias("host"), "text")
    page = [] if copies else ["page"]
    if not copies:
        pages = pages.withColumn("page", F.unhex(F.md5("text")))
    totals = pages.select("host", *page)
    lines = pages.select("host", *page, F.explode(F.array_distinct(F.transform(_lines(F.col("text")), _key))).alias("line_md5"))
    lines = lines.where("line_md5 IS NOT NULL")
    if not copies:  # copies meet in partial aggregation; a hot line or host spreads over its pages
        totals, lines = totals.distinct(), lines.distinct()
    totals = totals.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    counts = lines.groupBy("host", "line_md5").agg(F.count(F.lit(1)).alias("pages"))
    counts = counts.where(F.col("pages") >= min_pages)
    of_host = counts["host"].eqNullSafe(totals["host"])
    return (counts.join(totals, of_host).withColumn("ratio", F.col("pages") / F.col("host_pages"))
            .where(F.col("ratio") > ratio)
            .select(counts["host"], "line_md5", "pages", "host_pages", "ratio"))


def drop_boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES,
                     dropped: str | None = None, copies: bool = True) -> DataFrame:
    """``docs``, all columns and rows, with boilerplate lines taken out of ``text``.

    Lines are separated by "\\n" and compared without surrounding white space; blank lines are
    never boilerplate.  A line that a page repeats counts one page and goes from every place.
    The other lines keep their order and bytes.  A null text stays null; a document with only
    boilerplate lines keeps an empty text; a null host is a host of its own; repeated rows are
    pages of their own, or without ``copies`` one page of their host (a null text is a page like
    any other); an empty table gives no rows.  ``n_chars``, if there is one, follows the
    new text.  ``dropped`` names an extra column for the number of dropped lines.
    """
    found = boilerplate_lines(docs, host, ratio, min_pages, copies)
    bad, of, left = fresh(docs, "__boilerplate", "__host", "__kept")
    of_host = stored(found.groupBy("host").agg(F.collect_list("line_md5").alias(bad)).withColumnRenamed("host", of), "boilerplate")
    rows = docs.join(of_host, F.col(f"`{host}`").cast("string").eqNullSafe(F.col(of)), "left")
    drop = F.coalesce(F.col(bad), F.array())
    lines = _lines(F.col("text"))
    kept = F.filter(lines, lambda line: ~F.coalesce(F.array_contains(drop, _key(line)), F.lit(False)))
    rows = rows.withColumn(left, kept)
    text = F.when(F.col("text").isNotNull(), F.array_join(left, "\n"))
    columns = {c: F.col(f"`{c}`") for c in docs.columns} | {"text": text}
    if "n_chars" in columns:
        columns["n_chars"] = F.char_length(text).cast(docs.schema["n_chars"].dataType)
    if dropped:
        columns[dropped] = F.coalesce(F.size(lines) - F.size(left), F.lit(0)).cast("long")
    return rows.select(*[v.alias(k) for k, v in columns.items()])
