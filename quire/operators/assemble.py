"""Row generators (E3, E4) and ordered text assembly.

Assembly keeps order as a column and never relies on row position after a
shuffle.  Large groups are assembled in two levels: pieces are first joined per
(group, block of the order key) in parallel, then the few block strings of a
group are joined; a group that holds a third of all rows is therefore spread
over many tasks up to its final concatenation, and pre-aggregated before that
shuffle.  ``*_parts`` variants stop after the first level and return ordered
parts for sinks that write a group without building one string.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.rows import explode_with_pos

PARAGRAPH_SEP = "\n\n"
# Pages per first-level block when assembling page-numbered documents.
PAGE_BLOCK = 4096
# Sampled names per block of a group that is assembled by name.
CUT_SAMPLE = 32


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def ordered_join(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str],
                 piece: str, sep: str = "", out: str = "text",
                 block: Column | None = None, drop_empty: bool = False) -> DataFrame:
    """Join ``piece`` strings per group in ``order``, separated by ``sep``.

    NULL pieces (and empty ones with ``drop_empty``) are skipped.  The skip happens
    on the collected array, not as a row filter: a filter on a computed column
    would be pushed below the projections that build it and re-evaluate them.
    With ``block`` (an expression over the row, e.g. ``floor(page_no / 4096)``)
    the join runs in two levels as described above.
    """
    keys = _keys(keys)
    order = _keys(order)
    item = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], F.col(piece).alias("_p"))

    def keep(x: Column) -> Column:
        return (x["_p"].isNotNull() & (x["_p"] != "")) if drop_empty else x["_p"].isNotNull()

    def joined(items: Column, field: str) -> Column:
        return F.array_join(F.transform(F.filter(F.sort_array(items), keep if field == "_p" else
                                                 (lambda x: x[field] != "") if drop_empty else
                                                 (lambda x: x[field].isNotNull())),
                                        lambda x: x[field]), sep)

    if block is None:
        return df.groupBy(*keys).agg(joined(F.collect_list(item), "_p").alias(out))
    first = (df.withColumn("_blk", block)
             .groupBy(*keys, "_blk")
             .agg(joined(F.collect_list(item), "_p").alias("_bp")))
    return (first.groupBy(*keys)
            .agg(joined(F.collect_list(F.struct("_blk", "_bp")), "_bp").alias(out)))


def name_blocks(df: DataFrame, group: str | Sequence[str], order: str, blocks: int | None = None,
                seed: int = 11) -> DataFrame:
    """(group..., _cuts): for groups with a large share of all rows, names that cut them in blocks.

    A first pass over the key columns alone samples rows (a quantile sketch: about ``CUT_SAMPLE``
    rows per block, so its size is set by ``blocks`` and not by the data) and takes every
    ``CUT_SAMPLE``-th name of a group as a cut.  Groups of under two blocks have none.
    ``blocks`` (default: four per shuffle partition) is about the number of blocks the whole table
    would have.  Cuts come as an array of arrays, for a two-step search.
    """
    spark, keys = df.sparkSession, _keys(group)
    blocks = blocks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(*keys, F.col(order).alias("_name")).where(F.col("_name").isNotNull())
    total = rows.count()
    some = rows.where(F.rand(seed) < min(1.0, CUT_SAMPLE * blocks / max(total, 1))).toArrow().to_pylist()
    by_group: dict[tuple, list] = {}
    for r in some:
        by_group.setdefault(tuple(r[k] for k in keys), []).append(r["_name"])
    out = []
    for g, names in by_group.items():
        # distinct cuts; equal names never part
        cuts = sorted(set(sorted(names)[CUT_SAMPLE::CUT_SAMPLE])) if len(names) >= 2 * CUT_SAMPLE else []
        if cuts:
            wide = max(1, int(len(cuts) ** 0.5))
            out.append((*g, [cuts[i:i + wide] for i in range(0, len(cuts), wide)]))
    fields = [f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys]
    kind = df.schema[order].dataType.simpleString()
    return spark.createDataFrame(out, f"{', '.join(fields)}, _cuts array<array<{kind}>>")


def with_name_block(df: DataFrame, group: str | Sequence[str], order: str, cuts: DataFrame) -> DataFrame:
    """Add ``_blk``: the number of the group's cuts at or before the row's name (0 without cuts).

    At most as many cuts as blocks were asked for, so the broadcast has a set bound.  Names are
    compared as ``sort_array`` does; a NULL name sorts first and is in block 0.
    """
    keys = _keys(group)
    cuts = cuts.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], "_cuts")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_g{i}"))
    rows, name = df.join(F.broadcast(cuts), same, "left"), F.col(order)
    wide = F.size(F.element_at("_cuts", 1))
    row = F.size(F.filter("_cuts", lambda x: F.element_at(x, 1) <= name))
    inner = F.size(F.filter(F.element_at("_cuts", F.greatest(F.col("_row"), F.lit(1))), lambda x: x <= name))
    return (rows.withColumn("_row", F.coalesce(row, F.lit(0)))
            .withColumn("_blk", F.when(F.col("_cuts").isNull() | (F.col("_row") <= 0), F.lit(0))
                        .otherwise((F.col("_row") - 1) * wide + inner))
            .drop("_row", "_cuts", *[f"_g{i}" for i in range(len(keys))]))


# A1
def concat_docs(df: DataFrame, group: str | Sequence[str] = "group", order: str = "name",
                text: str = "text", out: str = "text", cuts: DataFrame | None = None) -> DataFrame:
    """Contents in order with a blank line after each one (the last one too).

    With ``cuts`` (``name_blocks``) a large group is joined block by block on many tasks first.
    """
    pieces = df.withColumn("_piece", F.concat(F.col(text), F.lit(PARAGRAPH_SEP)))
    if cuts is None:
        return ordered_join(pieces, group, order, "_piece", "", out)
    return ordered_join(with_name_block(pieces, group, order, cuts).withColumnRenamed("_blk", "_nb"),
                        group, order, "_piece", "", out, block=F.col("_nb"))


def concat_docs_parts(df: DataFrame, group: str | Sequence[str] = "group", order: str = "name",
                      text: str = "text", cuts: DataFrame | None = None) -> DataFrame:
    """First level of A1: (group, block, text); the parts of a group in ``block`` order, each followed by
    a blank line (as ``write_ordered_parts`` writes them), are its A1 text."""
    keys = _keys(group)
    pieces = df.withColumn("_piece", F.concat(F.col(text), F.lit(PARAGRAPH_SEP)))
    rows = with_name_block(pieces, keys, order, cuts if cuts is not None else name_blocks(df, keys, order))
    parts = ordered_join(rows, [*keys, "_blk"], order, "_piece", "", "_t").where(F.col("_t") != "")
    return parts.select(*keys, F.col("_blk").alias("block"),
                        F.substr("_t", F.lit(1), F.length("_t") - len(PARAGRAPH_SEP)).alias("text"))


# A6
def corpus_counts(df: DataFrame, group: str | Sequence[str], out: str = "n") -> DataFrame:
    """Rows per group (pages per document, files per directory)."""
    return df.groupBy(*_keys(group)).agg(F.count(F.lit(1)).cast("bigint").alias(out))


def _page_block(page: str, block_pages: int) -> Column:
    """Block of a page number; pages without a number come before all others."""
    return F.coalesce(F.floor(F.col(page) / block_pages), F.lit(-(1 << 62)))


# W4
def page_position(doc_pages: DataFrame, book: str = "book_id", page: str = "page_no",
                  block_pages: int = PAGE_BLOCK) -> DataFrame:
    """Add ``position``: 1-based rank of each page within its book (selected range).

    Pages with a NULL number come first.  Rank = pages in earlier blocks + rank inside
    the block.  Windows run per (book, block), bounded by ``block_pages`` rows, and over
    the small table of block counts, so a book of any size never lands in one window partition.
    """
    pages = doc_pages.withColumn("_blk", _page_block(page, block_pages))
    local = F.row_number().over(Window.partitionBy(book, "_blk").orderBy(page))
    return (_with_offsets(pages.withColumn("_local", local), pages, book)
            .withColumn("position", (F.col("_off") + F.col("_local")).cast("int"))
            .drop("_blk", "_local", "_off"))


def _with_offsets(blocks: DataFrame, pages: DataFrame, book: str) -> DataFrame:
    """``blocks`` with ``_off``, the pages of the book before the row's block."""
    counts = pages.groupBy(book, "_blk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(book).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col(book).alias("_ob"), F.col("_blk").alias("_oblk"),
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    same = F.col(book).eqNullSafe(F.col("_ob")) & (F.col("_blk") == F.col("_oblk"))
    return blocks.join(offsets, same).drop("_ob", "_oblk")


def _page_pieces(items: Column, off: Column) -> Column:
    """Texts of ordered pages, an error placeholder numbered by its position, blanks dropped."""
    pieces = F.transform(items, lambda x, i: F.when(
        x["error"].isNotNull(), F.concat(F.lit("[ERROR ON PAGE "), (off + i + 1).cast("string"), F.lit("]"))
    ).otherwise(x["text"]))
    return F.filter(pieces, lambda s: s.isNotNull() & (s != ""))


def _page_blocks(doc_pages: DataFrame, book: str, page: str, text: str, error: str,
                 block_pages: int) -> DataFrame:
    """(book, _blk, _items, _n): ordered pages of each block."""
    item = F.struct(F.col(page).alias("p"), F.col(text).alias("text"), F.col(error).alias("error"))
    return (doc_pages.withColumn("_blk", _page_block(page, block_pages))
            .groupBy(book, "_blk")
            .agg(F.sort_array(F.collect_list(item)).alias("_items"), F.count(F.lit(1)).alias("_n")))


# A2 (+ X1 page errors as text, W4 positions), for books too large for one string
def pages_to_text_parts(doc_pages: DataFrame, book: str = "book_id", page: str = "page_no",
                        text: str = "text", error: str = "error",
                        block_pages: int = PAGE_BLOCK) -> DataFrame:
    """First level of A2: (book, block, n_pages, text) with global page positions.

    The non-empty parts of a book in ``block`` order, joined by a blank line, are its A2
    text (``write_ordered_parts`` writes them so).
    """
    first = _page_blocks(doc_pages, book, page, text, error, block_pages)
    pages = doc_pages.select(book, _page_block(page, block_pages).alias("_blk"))
    pieces = _page_pieces(F.col("_items"), F.col("_off"))
    return _with_offsets(first, pages, book).select(
        book, F.col("_blk").alias("block"), F.col("_n").alias("n_pages"),
        F.array_join(pieces, PARAGRAPH_SEP).alias("text"))


def pages_to_text(doc_pages: DataFrame, book: str = "book_id", page: str = "page_no",
                  text: str = "text", error: str = "error",
                  block_pages: int = PAGE_BLOCK, first: str | None = None) -> DataFrame:
    """A2: one row per book: (book, text, n_pages[, first]).

    Pages in order (a NULL page number first); a failed page becomes ``[ERROR ON PAGE k]``
    with k its position in the selected range; NULL and empty pages are dropped; pages are
    joined by a blank line.  The input is read once: a running count over the blocks of a book
    numbers its pages, each block becomes one string, and the strings of a book are joined.  ``first``
    names a column for the text of the first page (empty for NULL).
    """
    blocks = _page_blocks(doc_pages, book, page, text, error, block_pages)
    before = Window.partitionBy(book).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    lead = [F.coalesce(F.element_at("_items", 1)["text"], F.lit("")).alias("_first")] if first else []
    strings = blocks.select(book, "_blk", "_n", *lead, F.array_join(
        _page_pieces(F.col("_items"), F.col("_off")), PARAGRAPH_SEP).alias("_bt"))
    joined = F.array_join(F.filter(F.sort_array(F.collect_list(F.struct("_blk", "_bt")))["_bt"],
                                   lambda s: s != ""), PARAGRAPH_SEP)
    return strings.groupBy(book).agg(joined.alias("text"), F.sum("_n").cast("bigint").alias("n_pages"),
                                     *([F.min_by("_first", "_blk").alias(first)] if first else []))


# A2b
def page_markdown(text: Column) -> Column:
    """One page as Markdown: cleaned text split in paragraphs; a short title becomes
    ``\\n## t\\n\\n``, other paragraphs ``p\\n\\n`` (sentences rejoined by one space)."""
    paras = T.split_paragraphs_strict(T.clean_page_text(F.coalesce(text, F.lit(""))))
    return F.array_join(F.transform(paras, lambda p: F.when(
        T.is_short_title(p), F.concat(F.lit("\n## "), p, F.lit("\n\n"))
    ).otherwise(F.concat(T.format_paragraph(p), F.lit("\n\n")))), "")


def pages_to_markdown(doc_pages: DataFrame, name: Column, book: str = "book_id",
                      page: str = "page_no", text: str = "text",
                      block_pages: int = PAGE_BLOCK) -> DataFrame:
    """(book, md) = ``# name`` and a blank line, then each page's Markdown."""
    pieces = doc_pages.select(book, page, page_markdown(F.col(text)).alias("_piece"),
                              name.alias("_name"))
    # the name is a per-book attribute, so it rides along as a grouping key (no join)
    body = ordered_join(pieces, [book, "_name"], page, "_piece", "", "_body",
                        block=_page_block(page, block_pages))
    return body.select(
        book, F.concat(F.lit("# "), F.col("_name"), F.lit("\n\n"), F.col("_body")).alias("md"))


# E3
def explode_lines(df: DataFrame, key: str = "doc_id", text: str = "md") -> DataFrame:
    """(key, i, line) for every line, empty lines included."""
    return explode_with_pos(df, [key], F.split(F.col(text), "\n", -1), "i", "line").select(
        key, F.col("i").cast("int").alias("i"), "line")


# E4
def explode_sentences(df: DataFrame, keys: str | Sequence[str] = ("doc_id", "i"),
                      text: str = "text") -> DataFrame:
    """(keys..., s, sentence) for every sentence of every paragraph."""
    keys = _keys(keys)
    return explode_with_pos(df, keys, T.split_sentences(text), "s", "sentence").select(
        *keys, F.col("s").cast("int").alias("s"), "sentence")
