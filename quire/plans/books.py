"""Composed flows (Q1-Q5) from input table to result.

Flows that identify languages (Q1) or summarize (Q5) run a job while they are built: language
profiles, and tokens that most sections hold, come first.  The others are lazy, but for
the names that cut large archives (Q2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import assemble as AS
from ..operators import chapters as CH
from ..operators import entries as EN
from ..operators import langid as LI
from ..operators import markdown as MD
from ..operators import summarize as SU
from ..sources import tables as TB


def pages_to_book(doc_pages: DataFrame, profiles: DataFrame | None = None,
                  pages: tuple[int, int] | None = None, language: str | None = None,
                  skip_markdown: bool = False, title: str | None = None,
                  author: str | None = None) -> DataFrame:
    """Q1: page range (S4) -> document language (W3) -> book text (A2) -> Markdown (A4).

    (book_id, lang, ocr_lang, n_pages, text[, md]).  A NULL book is a book like others.  Without ``profiles`` and
    ``language`` the language columns are ``eng``.
    """
    sel = TB.select_pages(doc_pages, *(pages or (None, None)))
    if profiles is not None and not language:
        # the first page rides along with the text, so pages are read once
        books = AS.pages_to_text(sel, first="_page1")
        out = LI.predict(books, profiles, "book_id", "_page1", "lang", keep=["n_pages", "text"])
        out = out.withColumn("ocr_lang", T.map_lang_code("lang"))
    else:
        known = F.lit(language or LI.DEFAULT_LANG)
        out = AS.pages_to_text(sel).withColumns({"lang": known, "ocr_lang": known})
    if skip_markdown:
        return out.select("book_id", "lang", "ocr_lang", "n_pages", "text")
    out = out.withColumn("_title", F.lit(title).cast("string")).withColumn("_author", F.lit(author).cast("string"))
    return MD.text_to_markdown(out, "text", "_title", "_author", "md").select(
        "book_id", "lang", "ocr_lang", "n_pages", "text", "md")


def archive_to_book(entries: DataFrame) -> DataFrame:
    """Q2: archive entries -> text (A3) -> Markdown (A4): (book_id, text, md)."""
    return MD.text_to_markdown(EN.entries_to_text(entries), "text", None, None, "md")


def manifest_to_book(items: DataFrame, type_col: str | None = "item_type") -> DataFrame:
    """Q3: document items of a manifest (S6) -> Markdown book (A5)."""
    return EN.items_to_markdown(TB.manifest_documents(items, type_col))


def direct_pages_to_book(doc_pages: DataFrame, name) -> DataFrame:
    """Q4: page text -> cleaned, titled Markdown."""
    return AS.pages_to_markdown(doc_pages, name)


def split_summarize_combine(markdown_docs: DataFrame, level: int = 1, k: int = SU.TOP_K) -> DataFrame:
    """Q5: chapters (E2, W5) -> extractive summaries (M2) -> one combined text per
    document (A1, summaries in output-file-name order)."""
    chapters = CH.last_slug_wins(markdown_docs, level=level)
    stored = SU.store_summaries(SU.extractive_summary(chapters, k=k), chapters)
    return AS.concat_docs(stored, "doc_id", "out_name", "text", "text")
