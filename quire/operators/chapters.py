"""Markdown to chapters (E2) with slugs (P11), unnamed chapters (W6), last slug wins
and document validation (H7).

A Markdown document is one row and its chapters are cut inside that row, so the
whole step is narrow: no shuffle, whatever the corpus size.  Ordering rules that
the reference gets from list positions (first equal chapter, later file of the
same name overwrites an earlier one) are array positions and an array sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as RX
from ..functions import text as T
from ..functions.rows import explode_with_pos

EMPTY_DOC = "document without text"
CHAPTER_FIELDS = ["seq", "title", "slug", "body", "rendered"]


def no_chapters(level: int) -> str:
    return f"no line starts a chapter with '{'#' * level} '"


def _chapter_parts(md: Column, level: int) -> Column:
    parts = F.split(md, RX.chapter_cut(level, "spark"), -1)
    return F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))


def with_first_equal(df: DataFrame, parts: str, out: str = "_first") -> DataFrame:
    """Add ``out``: ARRAY<INT>, for each part 1 + the position of the first equal part.

    O(n log n) inside the row: sort (text, position) pairs, find where runs of
    equal text start, give every member of a run its start's position, and sort
    back by position.  Each array is its own column, so no lambda re-evaluates
    another array.
    """
    df = df.withColumn("_pairs", F.sort_array(F.transform(
        parts, lambda p, k: F.struct(p.alias("raw"), k.alias("seq")))))
    pairs = F.col("_pairs")
    n = F.size(pairs)
    df = df.withColumn("_starts", F.filter(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: F.when(i > n, F.lit(False)).when(i == 1, F.lit(True))
        .otherwise(F.element_at(pairs, i)["raw"] != F.element_at(pairs, i - 1)["raw"])))
    starts = F.col("_starts")

    def members(st: Column, r: Column) -> Column:
        end = F.coalesce(F.try_element_at(starts, r + 2) - 1, n)
        first = F.element_at(pairs, st)["seq"]
        return F.transform(F.sequence(st, end), lambda j: F.struct(
            F.element_at(pairs, j)["seq"].alias("seq"), first.alias("first")))

    by_seq = F.sort_array(F.flatten(F.transform(starts, members)))
    return (df.withColumn(out, F.transform(by_seq, lambda m: (m["first"] + 1).cast("int")))
              .drop("_pairs", "_starts"))


def _chapters_of(parts: Column, first: Column) -> Column:
    """Chapter structs of the cut parts; each stage is its own ``transform`` so every
    value is computed once per chapter (lambdas get no common-subexpression reuse)."""
    st = F.transform(parts, lambda raw, k: F.struct(
        k.cast("int").alias("seq"), raw.alias("raw"), T.strip_ws(raw).alias("s")))
    st = F.transform(st, lambda c: F.struct(
        c["seq"].alias("seq"), c["raw"].alias("raw"), c["s"].alias("s"),
        F.instr(c["s"], "\n").alias("nl"),
        T.strip_ws(F.substring_index(c["s"], "\n", 1)).alias("title")))
    st = F.transform(st, lambda c: F.struct(
        c["seq"].alias("seq"), c["raw"].alias("raw"), c["title"].alias("title"),
        T.strip_ws(F.when(c["nl"] > 0, F.substr(c["s"], c["nl"] + 1))
                   .otherwise(F.lit(""))).alias("body"),
        T.slugify(c["title"]).alias("slug")))
    st = F.filter(st, lambda c: c["title"] != "")
    # unnamed chapter: number of the first chapter with the same raw text
    return F.transform(st, lambda c: F.struct(
        c["seq"].alias("seq"), c["title"].alias("title"),
        F.when(c["slug"] == "", F.concat(F.lit("chapter_"),
                                         F.element_at(first, c["seq"] + 1).cast("string")))
        .otherwise(c["slug"]).alias("slug"),
        c["body"].alias("body")))


def with_chapters(df: DataFrame, md: str = "md", level: int = 1) -> DataFrame:
    """Add ``_chapters``: ARRAY<STRUCT<seq, title, slug, body>> (empty titles skipped)."""
    df = df.withColumn("_parts", _chapter_parts(F.col(md), level))
    df = with_first_equal(df, "_parts", "_first")
    # ``_first`` is read again outside the lambda, so it stays a column of its
    # own instead of being inlined (and recomputed) per chapter
    chapters = F.when(F.col("_first").isNotNull(), _chapters_of(F.col("_parts"), F.col("_first")))
    return df.withColumn("_chapters", chapters).drop("_parts", "_first")


def _rows(df: DataFrame, key: str) -> DataFrame:
    out = explode_with_pos(df, [key], "_chapters", "_k", "c")
    return out.select(key, "c.seq", "c.title", "c.slug", "c.body",
                      F.concat(F.lit("# "), F.col("c.title"), F.lit("\n\n"), F.col("c.body"))
                      .alias("rendered"))


def split_chapters(df: DataFrame, key: str = "doc_id", md: str = "md", level: int = 1) -> DataFrame:
    """One row per chapter: (key, seq, title, slug, body, rendered)."""
    return _rows(with_chapters(df, md, level), key)


def last_slug_wins(df: DataFrame, key: str = "doc_id", md: str = "md", level: int = 1) -> DataFrame:
    """Chapters as written to files: of chapters sharing a slug only the last stays.

    Done inside the document row: sort the chapters by (slug, seq), keep each slug's
    last entry, so no shuffle by slug is needed.
    """
    df = with_chapters(df, md, level)
    df = df.withColumn("_by_slug", F.sort_array(F.transform(
        "_chapters", lambda c: F.struct(c["slug"].alias("slug"), c["seq"].alias("seq"),
                                        c["title"].alias("title"), c["body"].alias("body")))))
    by_slug = F.col("_by_slug")
    kept = F.filter(by_slug, lambda c, i: F.coalesce(
        F.try_element_at(by_slug, i + 2)["slug"] != c["slug"], F.lit(True)))
    df = df.withColumn("_chapters", F.sort_array(F.transform(
        kept, lambda c: F.struct(c["seq"].alias("seq"), c["title"].alias("title"),
                                 c["slug"].alias("slug"), c["body"].alias("body")))))
    return _rows(df.drop("_by_slug"), key)


def first_equal_chapter(df: DataFrame, key: str = "doc_id", md: str = "md",
                        level: int = 1) -> DataFrame:
    """For every cut (empty titles included) the 1-based number of the first equal cut."""
    parts = df.select(key, _chapter_parts(F.col(md), level).alias("_parts"))
    firsts = with_first_equal(parts, "_parts", "_f")
    return explode_with_pos(firsts, [key], "_f", "seq", "first_equal").select(
        key, F.col("seq").cast("int").alias("seq"), "first_equal")


def _reject_reason(md: str, level: int) -> Column:
    n = F.size(_chapter_parts(F.col(md), level))
    return (F.when(F.col(md).isNull() | T.is_blank(md), F.lit(EMPTY_DOC))
            .when(n == 0, F.lit(no_chapters(level))))


def validate_markdown(df: DataFrame, key: str = "doc_id", md: str = "md", level: int = 1) -> DataFrame:
    """H7: (key, ok, reason); one bad document never fails the job."""
    reason = _reject_reason(md, level)
    keys = [key] if isinstance(key, str) else list(key)
    return df.select(*keys, reason.isNull().alias("ok"), reason.alias("reason"))
