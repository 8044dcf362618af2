"""Registered queries: one per operator of the inventory, each over whole tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose columns
match the DuckDB oracle of the same name in ``oracles.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assemble as AS
from ..functions import html as H
from ..functions import text as T
from ..operators import chapters as CH
from ..operators import entries as EN
from ..operators import langid as LI
from ..operators import summarize as SU
from . import books as BK
from ..operators import markdown as MDOP
from ..sources import corpora as C
from ..sources import tables as TB

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


@query("A4_text_to_markdown")
def a4_text_to_markdown(spark, sf_dir):
    return MDOP.text_to_markdown(C.book_text(spark, sf_dir)).select("doc_id", "md")


@query("A4_documents_to_markdown")
def a4_documents_to_markdown(spark, sf_dir):
    return MDOP.text_to_markdown(TB.raw_documents(spark, sf_dir)).select("doc_id", "md")


@query("W1_toc_range")
def w1_toc_range(spark, sf_dir):
    paras = MDOP.explode_paragraphs(C.book_text(spark, sf_dir)).select("doc_id", "i", "text")
    return MDOP.toc_range(paras)


@query("E1_explode_paragraphs")
def e1_explode_paragraphs(spark, sf_dir):
    return MDOP.explode_paragraphs(C.book_text(spark, sf_dir))


@query("E2_split_chapters")
def e2_split_chapters(spark, sf_dir):
    return CH.split_chapters(C.md_raw(spark, sf_dir))


@query("W5_last_slug_wins")
def w5_last_slug_wins(spark, sf_dir):
    return CH.last_slug_wins(C.md_raw(spark, sf_dir))


@query("W6_first_equal_chapter")
def w6_first_equal_chapter(spark, sf_dir):
    return CH.first_equal_chapter(C.md_raw(spark, sf_dir))


@query("H7_validate_markdown")
def h7_validate_markdown(spark, sf_dir):
    md = C.md_raw(spark, sf_dir).select(F.lit("md_raw").alias("source"), "doc_id", "md")
    docs = TB.read_table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("source"), "doc_id", F.col("text").alias("md"))
    v = md.unionByName(docs)
    return CH.validate_markdown(v, key=["source", "doc_id"])


PAGE_RANGE = (3, 8)


@query("S4_select_pages")
def s4_select_pages(spark, sf_dir):
    return TB.select_pages(C.book_pages(spark, sf_dir), *PAGE_RANGE)


@query("A2_pages_to_text")
def a2_pages_to_text(spark, sf_dir):
    return AS.pages_to_text(C.book_pages(spark, sf_dir))


@query("A2_pages_to_text_range")
def a2_pages_to_text_range(spark, sf_dir):
    return AS.pages_to_text(TB.select_pages(C.book_pages(spark, sf_dir), *PAGE_RANGE))


@query("W4_page_position")
def w4_page_position(spark, sf_dir):
    return AS.page_position(TB.select_pages(C.book_pages(spark, sf_dir), *PAGE_RANGE))


@query("A6_corpus_counts")
def a6_corpus_counts(spark, sf_dir):
    return AS.corpus_counts(C.book_pages(spark, sf_dir), "book_id")


@query("A2b_pages_to_markdown")
def a2b_pages_to_markdown(spark, sf_dir):
    name = F.concat(F.lit("book_"), F.col("book_id").cast("string"))
    return AS.pages_to_markdown(C.book_pages(spark, sf_dir), name)


@query("E3_explode_lines")
def e3_explode_lines(spark, sf_dir):
    return AS.explode_lines(C.md_raw(spark, sf_dir))


@query("E4_explode_sentences")
def e4_explode_sentences(spark, sf_dir):
    paras = MDOP.explode_paragraphs(C.book_text(spark, sf_dir))
    return AS.explode_sentences(paras, ["doc_id", "i"], "text")


@query("P10_decode_entities")
def p10_decode_entities(spark, sf_dir):
    return TB.read_table(spark, sf_dir, "pages").select("page_id", H.decode_entities("html").alias("decoded"))


@query("P8_html_to_text")
def p8_html_to_text(spark, sf_dir):
    return TB.read_table(spark, sf_dir, "pages").select("page_id", H.html_to_text("html").alias("text"))


@query("P9_html_to_markdown")
def p9_html_to_markdown(spark, sf_dir):
    return TB.read_table(spark, sf_dir, "pages").select("page_id", H.html_to_markdown("html").alias("md"))


@query("S5_select_content_entries")
def s5_select_content_entries(spark, sf_dir):
    return TB.select_content_entries(C.content_entries(spark, sf_dir)).select("book_id", "entry_path")


@query("A3_entries_to_text")
def a3_entries_to_text(spark, sf_dir):
    return EN.entries_to_text(C.content_entries(spark, sf_dir))


@query("P7_md_squeeze")
def p7_md_squeeze(spark, sf_dir):
    return C.md_raw(spark, sf_dir).select("doc_id", T.md_squeeze("md").alias("md"))


@query("W2_reflow_lines")
def w2_reflow_lines(spark, sf_dir):
    squeezed = C.md_raw(spark, sf_dir).select("doc_id", T.md_squeeze("md").alias("md"))
    return EN.reflow_lines(AS.explode_lines(squeezed, "doc_id", "md"))


@query("W2_reflow_text")
def w2_reflow_text(spark, sf_dir):
    return EN.clean_markdown(C.md_raw(spark, sf_dir)).select("doc_id", "md")


@query("P12_item_title")
def p12_item_title(spark, sf_dir):
    return EN.item_markdown(C.manifest_items(spark, sf_dir)).select("book_id", "item_seq", "item_title")


@query("S6_manifest_documents")
def s6_manifest_documents(spark, sf_dir):
    return TB.manifest_documents(C.manifest_items(spark, sf_dir)).select("book_id", "item_seq", "item_id")


@query("A5_items_to_markdown")
def a5_items_to_markdown(spark, sf_dir):
    return EN.items_to_markdown(TB.manifest_documents(C.manifest_items(spark, sf_dir)))


HOLDOUT_MOD = 5


def language_profiles(spark, sf_dir):
    """Profiles trained on every labelled document."""
    return LI.train_profiles(TB.read_table(spark, sf_dir, "documents"))


@query("L1_train_profiles")
def l1_train_profiles(spark, sf_dir):
    return language_profiles(spark, sf_dir)


@query("L1_identify_language")
def l1_identify_language(spark, sf_dir):
    docs = TB.read_table(spark, sf_dir, "documents")
    pred = LI.predict(docs, language_profiles(spark, sf_dir))
    return LI.lang_map_join(pred, LI.lang_map_table(spark))


@query("L1_accuracy")
def l1_accuracy(spark, sf_dir):
    # held-out evaluation: profiles from the training part, scored on the rest
    docs = TB.read_table(spark, sf_dir, "documents")
    train, test = LI.holdout_split(docs.where(F.col("lang").isNotNull()), "doc_id", HOLDOUT_MOD)
    pred = LI.predict(test, LI.train_profiles(train))
    return LI.accuracy(pred, test)


@query("J1_lang_map_join")
def j1_lang_map_join(spark, sf_dir):
    counts = AS.corpus_counts(TB.read_table(spark, sf_dir, "documents"), "lang")
    return LI.lang_map_join(counts, LI.lang_map_table(spark), iso="lang").select("lang", "ocr_lang", "n")


@query("W3_document_language")
def w3_document_language(spark, sf_dir):
    return LI.document_language(C.book_pages(spark, sf_dir), language_profiles(spark, sf_dir))


def _chapters(spark, sf_dir):
    return CH.last_slug_wins(C.md_raw(spark, sf_dir))


@query("M1_summary_requests")
def m1_summary_requests(spark, sf_dir):
    return SU.summary_requests(_chapters(spark, sf_dir))


@query("M2_extractive_summary")
def m2_extractive_summary(spark, sf_dir):
    return SU.extractive_summary(_chapters(spark, sf_dir)).drop("slug")


@query("M3_store_summaries")
def m3_store_summaries(spark, sf_dir):
    ch = _chapters(spark, sf_dir)
    return SU.store_summaries(SU.extractive_summary(ch), ch)


@query("A1_concat_docs")
def a1_concat_docs(spark, sf_dir):
    ch = _chapters(spark, sf_dir).withColumn("name", F.concat("slug", F.lit(".md")))
    return AS.concat_docs(ch, "doc_id", "name", "rendered", "text")


@query("Q1_pages_to_book")
def q1_pages_to_book(spark, sf_dir):
    return BK.pages_to_book(C.book_pages(spark, sf_dir), language_profiles(spark, sf_dir))


@query("Q2_archive_to_book")
def q2_archive_to_book(spark, sf_dir):
    return BK.archive_to_book(C.content_entries(spark, sf_dir)).select("book_id", "md")


@query("Q3_manifest_to_book")
def q3_manifest_to_book(spark, sf_dir):
    return BK.manifest_to_book(C.manifest_items(spark, sf_dir))


@query("Q4_direct_pages_to_book")
def q4_direct_pages_to_book(spark, sf_dir):
    name = F.concat(F.lit("book_"), F.col("book_id").cast("string"))
    return BK.direct_pages_to_book(C.book_pages(spark, sf_dir), name)


@query("Q5_split_summarize_combine")
def q5_split_summarize_combine(spark, sf_dir):
    return BK.split_summarize_combine(C.md_raw(spark, sf_dir))


# Scalar column functions over whole tables (P*, H*).
def _docs(spark, sf_dir):
    return TB.read_table(spark, sf_dir, "documents")


@query("P1_collapse_ws")
def p1(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.collapse_ws("text").alias("text"))


@query("P2_join_broken_lines")
def p2(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.join_broken_lines("text").alias("text"))


@query("P4_split_paragraphs_strict")
def p4(spark, sf_dir):
    from ..functions.rows import explode_with_pos
    bt = C.book_text(spark, sf_dir)
    return explode_with_pos(bt, ["doc_id"], T.split_paragraphs_strict("text"), "i", "text").select(
        "doc_id", F.col("i").cast("int").alias("i"), "text")


@query("P5_split_sentences")
def p5(spark, sf_dir):
    return AS.explode_sentences(_docs(spark, sf_dir), ["doc_id"], "text")


@query("P6_clean_page_text")
def p6(spark, sf_dir):
    return C.book_pages(spark, sf_dir).select("book_id", "page_no", T.clean_page_text("text").alias("text"))


@query("P11_slugify")
def p11(spark, sf_dir):
    return CH.split_chapters(C.md_raw(spark, sf_dir)).select(
        "doc_id", "seq", T.slugify("title").alias("slug"))


@query("P13_heading_markdown")
def p13(spark, sf_dir):
    paras = MDOP.explode_paragraphs(C.book_text(spark, sf_dir))
    lvl = T.header_level("text")
    return paras.select("doc_id", "i", F.when(lvl.isNotNull(), T.heading_markdown(lvl, "text")).alias("heading"))


@query("P14_map_lang_code")
def p14(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.map_lang_code("lang").alias("ocr_lang"))


@query("P15_base_name")
def p15(spark, sf_dir):
    return TB.read_table(spark, sf_dir, "pages").select(
        "page_id", T.base_name("url").alias("base"), T.file_suffix("url").alias("suffix"))


@query("P16_preview")
def p16(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.preview("text").alias("preview"))


@query("P17_prompt_text")
def p17(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.prompt_text("text").alias("prompt"))


@query("H1_header_level")
def h1(spark, sf_dir):
    paras = MDOP.explode_paragraphs(C.book_text(spark, sf_dir))
    return paras.select("doc_id", "i", T.header_level("text").alias("level"))


@query("H2_is_short_title")
def h2(spark, sf_dir):
    bp = C.book_pages(spark, sf_dir).select("book_id", "page_no", T.clean_page_text("text").alias("t"))
    return bp.select("book_id", "page_no", T.is_short_title("t").alias("is_title"))


@query("H3_H4_toc_predicates")
def h34(spark, sf_dir):
    paras = MDOP.explode_paragraphs(C.book_text(spark, sf_dir))
    return paras.select("doc_id", "i", T.is_toc_heading("text").alias("toc_heading"),
                        T.is_toc_entry("text").alias("toc_entry"))


@query("H5_drop_blank")
def h5(spark, sf_dir):
    return C.book_pages(spark, sf_dir).where(T.non_blank("text")).select("book_id", "page_no")


@query("H6_route_by_format")
def h6(spark, sf_dir):
    pages = TB.read_table(spark, sf_dir, "pages")
    name = F.regexp_extract("url", r"://[^/]*(/[^?#]*)", 1)
    r = T.route_by_format(name)
    t = T.route_by_format(name, text_only=True)
    return pages.select("page_id", r["route"].alias("route"), r["reject_reason"].alias("reject_reason"),
                        t["route"].alias("text_route"))


@query("A2_conversations_to_text")
def a2_conversations_to_text(spark, sf_dir):
    """Conversation turns as pages of a document: turn order, ``role: text`` per turn."""
    conv = TB.read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("book_id"), F.col("turn").cast("int").alias("page_no"),
        F.concat_ws(": ", "role", "text").alias("text"), F.lit(None).cast("string").alias("error"))
    return AS.pages_to_text(conv)


@query("E2_chapters_of_converted_text")
def e2_chapters_of_converted_text(spark, sf_dir):
    """A4 output cut at ``## `` headers (its title level is 1, headers start at 2)."""
    md = MDOP.text_to_markdown(C.book_text(spark, sf_dir)).select("doc_id", "md")
    return CH.split_chapters(md, level=2)


# Corpora on which branches fire that the plain tables never reach.
def _md_odd(spark, sf_dir):
    return C.corpus(spark, "md_odd", sf_dir)


@query("E2_split_chapters_odd")
def e2_odd(spark, sf_dir):
    return CH.split_chapters(_md_odd(spark, sf_dir))


@query("W5_last_slug_wins_odd")
def w5_odd(spark, sf_dir):
    return CH.last_slug_wins(_md_odd(spark, sf_dir))


@query("W6_first_equal_chapter_odd")
def w6_odd(spark, sf_dir):
    return CH.first_equal_chapter(_md_odd(spark, sf_dir))


@query("H7_validate_markdown_odd")
def h7_odd(spark, sf_dir):
    return CH.validate_markdown(_md_odd(spark, sf_dir))


@query("M3_store_summaries_odd")
def m3_odd(spark, sf_dir):
    ch = CH.last_slug_wins(_md_odd(spark, sf_dir))
    return SU.store_summaries(SU.extractive_summary(ch), ch)


@query("P14_map_lang_code_odd")
def p14_odd(spark, sf_dir):
    return C.corpus(spark, "lang_odd", sf_dir).select("doc_id", T.map_lang_code("lang").alias("ocr_lang"))


@query("J1_lang_map_join_odd")
def j1_odd(spark, sf_dir):
    counts = AS.corpus_counts(C.corpus(spark, "lang_odd", sf_dir), "lang")
    return LI.lang_map_join(counts, LI.lang_map_table(spark), iso="lang").select("lang", "ocr_lang", "n")


@query("H6_route_by_format_odd")
def h6_odd(spark, sf_dir):
    r, t = T.route_by_format("name"), T.route_by_format("name", text_only=True)
    return C.corpus(spark, "file_names", sf_dir).select(
        "doc_id", r["route"].alias("route"), r["reject_reason"].alias("reject_reason"), t["route"].alias("text_route"))


@query("P12_item_title_odd")
def p12_odd(spark, sf_dir):
    return EN.item_markdown(C.corpus(spark, "items_odd", sf_dir)).select("book_id", "item_seq", "item_title")


@query("Q1_pages_to_book_odd")
def q1_odd(spark, sf_dir):
    return BK.pages_to_book(C.corpus(spark, "pages_odd", sf_dir), language_profiles(spark, sf_dir))
