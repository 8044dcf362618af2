"""HTML entries to books: archive entries to text (A3), manifest items to Markdown (A5),
with the Markdown clean-up (P7) and line reflow (W2).

``reflow_text`` reflows a whole entry inside its row.  The only state the line loop
carries is "inside a list or code block", which holds from a line that opens a
list/code block up to the next blank line; those stretches are found with one
regular expression, marked, and every line is then decided from itself and the
line before it.  ``reflow_lines`` is the same rule for tables that hold one line per
row, as a scan over blocks of lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import patterns as RX
from ..functions import text as T
from ..sources.tables import select_content_entries
from .assemble import PARAGRAPH_SEP, name_blocks, ordered_join, with_name_block

BLOCK_MARK = "\u0001"
# Items per first-level block when assembling a book from its manifest.
ITEM_BLOCK = 4096
# Lines per block when reflowing a table of lines.
LINE_BLOCK = 4096


def _is_blank(c: Column) -> Column:
    return ~c.rlike(RX.NON_WS)


def _ends_clause(c: Column) -> Column:
    return c.rlike(f"[{RX.LINE_END_PUNCT}]\\z")


def _emit(line: Column, i: Column, in_block: Column, prev: Column) -> Column:
    """Text a line adds to the output, given the raw line before it (NULL for the first)."""
    prev_blank = _is_blank(prev)
    joins = (~in_block & (i > 0) & ~_is_blank(line) & ~line.startswith("#")
             & ~prev_blank & ~_ends_clause(prev))
    gap = ~in_block & (i > 0) & ~prev_blank
    return (F.when(i == 0, line)
            .when(in_block, F.concat(F.lit("\n"), line))
            .when(joins, F.concat(F.lit(" "), T.strip_ws(line)))
            .when(gap, F.concat(F.lit("\n\n"), line))
            .otherwise(F.concat(F.lit("\n"), line)))


def mark_blocks(c: Column) -> Column:
    """Prefix every line inside a list/code block with U+0001."""
    region = RX.block_region("spark")
    others = F.split(c, region, -1)
    regions = F.transform(F.regexp_extract_all(c, F.lit(region), 0),
                          lambda r: F.concat(F.lit(BLOCK_MARK), F.replace(r, F.lit("\n"),
                                                                          F.lit("\n" + BLOCK_MARK))))
    return F.array_join(F.zip_with(others, F.concat(regions, F.array(F.lit(""))),
                                   lambda a, b: F.concat(a, b)), "")


def with_reflow(df: DataFrame, md: str, out: str) -> DataFrame:
    """W2 inside the row: add ``out`` = reflowed ``md``.

    U+0001 and U+0002 of the text are escaped while U+0001 marks lines, and restored at the end.
    """
    free = F.replace(F.replace(F.col(md), F.lit("\u0002"), F.lit("\u0002b")), F.lit(BLOCK_MARK), F.lit("\u0002a"))
    df = df.withColumn("_free", free)
    df = df.withColumn("_lines", F.split(mark_blocks(F.col("_free")), "\n", -1))
    lines = F.col("_lines")

    def raw(x: Column) -> Column:
        return F.regexp_replace(x, "\\A" + BLOCK_MARK, "")

    # stage 1: each line once without its mark, with its block flag and the line
    # before it; stage 2 decides the output from those plain fields
    staged = F.transform(lines, lambda x, i: F.struct(
        raw(x).alias("line"), i.alias("i"), x.startswith(BLOCK_MARK).alias("blk"),
        F.when(i > 0, raw(F.try_element_at(lines, i))).alias("prev")))
    emitted = F.transform(staged, lambda e: _emit(e["line"], e["i"], e["blk"], e["prev"]))
    whole = F.array_join(emitted, "")
    back = F.replace(F.replace(whole, F.lit("\u0002a"), F.lit(BLOCK_MARK)), F.lit("\u0002b"), F.lit("\u0002"))
    return df.withColumn(out, back).drop("_lines", "_free")


def clean_markdown(df: DataFrame, md: str = "md", out: str = "md") -> DataFrame:
    """P7 then W2, the Markdown clean-up applied to each converted entry."""
    return with_reflow(df.withColumn("_sq", T.md_squeeze(md)), "_sq", out).drop("_sq")


def reflow_line_parts(lines: DataFrame, key: str = "doc_id", pos: str = "i", line: str = "line",
                      block_lines: int = LINE_BLOCK) -> DataFrame:
    """W2 over a line table (key, pos, line), block by block: (key, block, text).

    The state of the line loop is whether a list or code block is open.  A line sets it
    (an opener), clears it (a blank line) or keeps it, and so does a run of lines: its last setting or
    clearing line decides.  Every block of ``block_lines`` positions is reduced to that and
    its last line, a scan over the blocks of a document gives each the state
    it begins in, and the lines of a block are then decided on their own.  A document of any
    length is spread over its blocks; its parts in ``block`` order are its text.
    """
    opener = F.col(line).rlike(RX.list_or_code_line("spark").replace("(?md)^", "\\A"))
    event = F.when(opener, F.lit(True)).when(_is_blank(F.col(line)), F.lit(False))
    rows = lines.select(key, pos, line, F.floor(F.col(pos) / block_lines).alias("block"), event.alias("_ev"))
    before = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    begin = (rows.groupBy(F.col(key).alias("_k"), F.col("block").alias("_b"))
             .agg(F.max_by("_ev", F.when(F.col("_ev").isNotNull(), F.col(pos))).alias("_last_ev"),
                  F.max_by(line, pos).alias("_last_line"))
             .select("_k", "_b", F.last("_last_ev", ignorenulls=True).over(before).alias("_open"),
                     F.lag("_last_line").over(Window.partitionBy("_k").orderBy("_b")).alias("_line0")))
    rows = rows.join(begin, F.col(key).eqNullSafe(F.col("_k")) & (F.col("block") == F.col("_b")))
    w = Window.partitionBy(key, "block").orderBy(pos)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = (rows.withColumn("_in", F.coalesce(F.last("_ev", ignorenulls=True).over(upto), "_open", F.lit(False)))
            .withColumn("_prev", F.when(F.row_number().over(w) == 1, F.col("_line0")).otherwise(F.lag(line, 1).over(w))))
    rows = rows.withColumn("_piece", _emit(F.col(line), F.col(pos), F.col("_in"), F.col("_prev")))
    return ordered_join(rows, [key, "block"], pos, "_piece", "", "text")


def reflow_lines(lines: DataFrame, key: str = "doc_id", pos: str = "i", line: str = "line",
                 out: str = "md", block_lines: int = LINE_BLOCK) -> DataFrame:
    """W2 over a line table (key, pos, line) -> (key, md): the parts of ``reflow_line_parts`` as one string."""
    return ordered_join(reflow_line_parts(lines, key, pos, line, block_lines), key, "block", "text", "", out)


# A3
def _entry_pieces(entries: DataFrame, book: str, path: str, html: str, cuts: DataFrame | None,
                  blocks: int | None) -> DataFrame:
    """(book, path, _nb, _t): text and name block of every HTML entry."""
    chosen = select_content_entries(entries, path)
    if cuts is None:
        cuts = name_blocks(chosen, book, path, blocks)
    return with_name_block(chosen.select(book, path, html), book, path, cuts).select(
        book, path, F.col("_blk").alias("_nb"), H.html_to_text(F.col(html)).alias("_t"))


def entries_to_text(entries: DataFrame, book: str = "book_id", path: str = "entry_path",
                    html: str = "html", cuts: DataFrame | None = None, blocks: int | None = None) -> DataFrame:
    """(book, text): text of each HTML entry, empty ones dropped, entry-path order,
    joined by a blank line.

    Large archives are joined in name blocks first (``name_blocks``, read off the two key columns
    when this is called unless ``cuts`` are given).
    """
    pieces = _entry_pieces(entries, book, path, html, cuts, blocks)
    return ordered_join(pieces, book, path, "_t", PARAGRAPH_SEP, "text", block=F.col("_nb"), drop_empty=True)


def entries_to_text_parts(entries: DataFrame, book: str = "book_id", path: str = "entry_path",
                          html: str = "html", cuts: DataFrame | None = None, blocks: int | None = None) -> DataFrame:
    """First level of A3: (book, block, text); the non-empty parts in order, joined by a blank line, are its text."""
    pieces = _entry_pieces(entries, book, path, html, cuts, blocks).withColumnRenamed("_nb", "block")
    return ordered_join(pieces, [book, "block"], path, "_t", PARAGRAPH_SEP, "text", drop_empty=True)


def item_markdown(items: DataFrame, html: str = "html", item_id: str = "item_id") -> DataFrame:
    """Per item: converted Markdown (P9, P7, W2) and its title."""
    df = clean_markdown(items.withColumn("_md0", H.html_to_markdown(html)), "_md0", "item_md")
    return df.drop("_md0").withColumn("item_title", T.item_title("item_md", item_id))


# A5
def items_to_markdown(items: DataFrame, book: str = "book_id", title: str = "book_title",
                      seq: str = "item_seq", html: str = "html",
                      item_id: str = "item_id") -> DataFrame:
    """(book, md): ``# title``, then per item ``## item title``, its Markdown and a blank line."""
    df = item_markdown(items, html, item_id)
    df = df.withColumn("_piece", F.concat(F.lit("## "), F.col("item_title"), F.lit("\n\n"),
                                          F.col("item_md"), F.lit("\n\n")))
    body = ordered_join(df, [book, title], seq, "_piece", "", "_body",
                        block=F.floor(F.col(seq) / ITEM_BLOCK))
    return body.select(book, F.concat(F.lit("# "), F.col(title), F.lit("\n\n"), F.col("_body"))
                       .alias("md"))
