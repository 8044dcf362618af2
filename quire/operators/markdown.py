"""Plain text to Markdown (A4) with table-of-contents detection.

A document is one row.  Paragraphs, headers and the TOC range are all computed
inside that row with array functions, so converting a corpus is a single narrow
stage: no shuffle, no per-row Python.  ``toc_range`` is the same rule as a
window operator for tables that already hold one paragraph per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.rows import explode_with_pos

TOC_HEADING_MD = "## Table of Contents\n"
TOC_NOTE_MD = "*[TOC content omitted in conversion]*\n"
# How many paragraphs after the TOC heading are scanned for the TOC's end.
TOC_WINDOW = 50
# Consecutive TOC entries needed before a non-entry closes the TOC.
TOC_MIN_ENTRIES = 3


def _scan_range(start: Column, n: Column) -> Column:
    """Indices that may close the TOC: start+4 .. min(start+50, n)-1 (empty if none)."""
    lo = start + 1 + TOC_MIN_ENTRIES
    hi = F.least(start + TOC_WINDOW, n) - 1
    return F.when((start >= 0) & (hi >= lo), F.sequence(lo, hi)).otherwise(
        F.array().cast("array<int>"))


def _closes(entry: Column):
    def fn(i: Column) -> Column:
        cond = ~F.element_at(entry, i + 1)
        for k in range(1, TOC_MIN_ENTRIES + 1):
            cond = cond & F.element_at(entry, i + 1 - k)
        return cond
    return fn


def with_toc_bounds(df: DataFrame, paras: str = "_paras") -> DataFrame:
    """Add ``_toc_start`` and ``_toc_end`` (0-based, -1 when absent) for a paragraph array.

    Start is the first TOC heading.  End is one before the first non-entry that
    follows at least three consecutive entries, all within the 49 paragraphs
    after the heading; if the scan finds none, end stays -1.  Each step is its own
    column, so lambdas only read plain columns and nothing is re-evaluated per element.
    """
    p = F.col(paras)
    df = (df.withColumn("_toc_entry", F.transform(p, T.is_toc_entry))
            .withColumn("_toc_start",
                        F.array_position(F.transform(p, T.is_toc_heading), True).cast("int") - 1))
    cands = F.filter(_scan_range(F.col("_toc_start"), F.size(p)), _closes(F.col("_toc_entry")))
    return (df.withColumn("_toc_end", F.coalesce(F.try_element_at(cands, F.lit(1)) - 1, F.lit(-1)).cast("int"))
              .drop("_toc_entry"))


def _meta_header(title: Column | None, author: Column | None) -> Column:
    t_line = (F.when((title != ""), F.concat(F.lit("# "), title, F.lit("\n")))
              if title is not None else F.lit(None).cast("string"))
    a_line = (F.when((author != ""), F.concat(F.lit("*By "), author, F.lit("*\n")))
              if author is not None else F.lit(None).cast("string"))
    return F.array_join(F.array(t_line, a_line, F.lit("")), "\n")


def _render(e: Column) -> Column:
    p, lvl = e["p"], e["lvl"]
    line = F.when(lvl.isNotNull(), T.heading_markdown(lvl, p, stripped=True)).otherwise(p)
    return F.concat(F.lit("\n"), line, F.lit("\n\n"))


def _render_all(arr: Column) -> Column:
    """Paragraphs (already stripped by P3) to Markdown lines, one header test each."""
    typed = F.transform(arr, lambda p: F.struct(
        p.alias("p"), T.header_level(p, stripped=True).alias("lvl")))
    return F.array_join(F.transform(typed, _render), "")


def text_to_markdown(df: DataFrame, text: str = "text", title: str | None = "title",
                     author: str | None = "author", out: str = "md") -> DataFrame:
    """A4: add a Markdown column for each document row.

    Title and author lines, then each paragraph (or header) followed by a blank
    line; a detected table of contents is replaced by a heading and a note.
    """
    t = F.col(title) if title and title in df.columns else None
    a = F.col(author) if author and author in df.columns else None
    df = with_toc_bounds(df.withColumn("_paras", T.split_paragraphs(text)))
    paras, start, end = F.col("_paras"), F.col("_toc_start"), F.col("_toc_end")
    cut = (start >= 0) & (end >= 0)
    body = F.when(cut, F.concat(
        _render_all(F.slice(paras, 1, start)),
        F.lit("\n" + TOC_HEADING_MD + "\n" + TOC_NOTE_MD),
        _render_all(F.slice(paras, end + 2, F.greatest(F.size(paras) - end - 1, F.lit(0)))),
    )).otherwise(_render_all(paras))
    return (df.withColumn(out, F.concat(_meta_header(t, a), body))
              .drop("_paras", "_toc_start", "_toc_end"))


def explode_paragraphs(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per paragraph with its kind and Markdown level.

    kind is 'toc' inside a removed table of contents, 'header' or 'paragraph'.
    """
    with_toc = with_toc_bounds(df.select(key, T.split_paragraphs(text).alias("_paras")))
    rows = explode_with_pos(with_toc, [key, "_toc_start", "_toc_end"], "_paras", "i", "text")
    lvl = T.header_level("text", stripped=True)
    in_toc = ((F.col("_toc_start") >= 0) & (F.col("_toc_end") >= 0)
              & F.col("i").between(F.col("_toc_start"), F.col("_toc_end")))
    return rows.select(
        key, F.col("i").cast("int").alias("i"), "text",
        F.when(in_toc, "toc").when(lvl.isNotNull(), "header").otherwise("paragraph").alias("kind"),
        F.when(~in_toc & lvl.isNotNull(), F.least(lvl + 1, F.lit(6))).cast("int").alias("md_level"))


def toc_range(paragraphs: DataFrame, key: str = "doc_id", pos: str = "i",
              text: str = "text") -> DataFrame:
    """W1 over a paragraph table: one row per document with toc_start, toc_end.

    Positions must be dense (0..n-1) per document, as ``posexplode`` gives them.
    All windows share the partitioning by document, so Spark sorts once.
    """
    whole = Window.partitionBy(key)
    ordered = Window.partitionBy(key).orderBy(pos)
    head = T.is_toc_heading(text)
    entry = T.is_toc_entry(text)
    df = (paragraphs
          .withColumn("_entry", entry)
          .withColumn("_start", F.min(F.when(head, F.col(pos))).over(whole)))
    run = F.lit(True)
    for k in range(1, TOC_MIN_ENTRIES + 1):
        run = run & F.coalesce(F.lag("_entry", k).over(ordered), F.lit(False))
    closes = (~F.col("_entry") & run & (F.col(pos) - TOC_MIN_ENTRIES > F.col("_start"))
              & (F.col(pos) < F.col("_start") + TOC_WINDOW))
    df = df.withColumn("_close", F.when(closes, F.col(pos)))
    return (df.groupBy(key)
            .agg(F.coalesce(F.min("_start"), F.lit(-1)).cast("int").alias("toc_start"),
                 F.coalesce(F.min("_close") - 1, F.lit(-1)).cast("int").alias("toc_end")))
