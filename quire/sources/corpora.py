"""Derived corpora: structured inputs computed from the driver tables.

The raw ``documents`` text has no blank lines, headings, tables of contents or
lists, so the operators are also exercised on tables derived from it.  Each
corpus is one SQL text that Spark and DuckDB both run unchanged; every source
row is kept (the ``doc_id`` arithmetic only chooses which structure to inject).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import read_table

BOOK_PAGES_SQL = """
SELECT CAST(FLOOR(doc_id / 10) AS BIGINT) AS book_id,
       CAST(doc_id % 10 + 1 AS INT)       AS page_no,
       CASE WHEN doc_id % 97 = 13 THEN NULL
            WHEN doc_id % 89 = 7  THEN ''
            WHEN doc_id % 11 = 4  THEN substring(text, 1, 40)
            WHEN doc_id % 5 = 2   THEN replace(text, ' the ', concat(' inter-', chr(10), 'national thenCase', chr(12), ' '))
            ELSE text END                 AS text,
       CASE WHEN doc_id % 97 = 13 THEN 'decode failed' END AS error
FROM {documents}
"""

BOOK_TEXT_SQL = """
SELECT doc_id,
       concat(
         CASE doc_id % 8
           WHEN 0 THEN concat('Chapter ', CAST(doc_id AS VARCHAR(20)), ' Alpha', chr(10), chr(10))
           WHEN 1 THEN concat('SECTION HEADING', chr(10), chr(10))
           WHEN 2 THEN concat('1. Überblick', chr(10), chr(10))
           WHEN 3 THEN concat('Contents', chr(10), chr(10), 'Alpha .... 1', chr(10), chr(10), 'Beta .... 2', chr(10), chr(10), 'Gamma .... 3', chr(10), chr(10))
           WHEN 4 THEN concat('Contents', chr(10), chr(10), 'Alpha .... 1', chr(10), chr(10), 'Beta .... 2', chr(10), chr(10))
           WHEN 5 THEN concat('2.1 details', chr(10), ' ', chr(10))
           WHEN 6 THEN concat('12345678', chr(10), chr(10), 'ok', chr(10), chr(10))
           ELSE '' END,
         replace(text, chr(10), concat(chr(10), chr(10)))) AS text,
       CASE WHEN doc_id % 3 = 0 THEN concat('Title ', CAST(doc_id AS VARCHAR(20))) END AS title,
       CASE WHEN doc_id % 6 = 0 THEN 'A. Author' END AS author
FROM {documents}
"""

MD_RAW_SQL = """
SELECT doc_id,
       concat('preamble ', CAST(doc_id AS VARCHAR(20)), chr(10),
              '# Part One!', chr(10), chr(10),
              '![fig](x.png)lead', '   ', chr(10),
              replace(text, ', ', concat(',', chr(10))), chr(10), chr(10), chr(10), chr(10),
              '- item a', chr(10), '  item b', chr(10), chr(10),
              '## Nested', chr(10), 'glued body', chr(10),
              '# ', CASE WHEN doc_id % 4 = 0 THEN 'Part One!' WHEN doc_id % 4 = 1 THEN '???' ELSE 'Über-Teil 2' END,
              chr(10), 'tail of ', CAST(doc_id AS VARCHAR(20)), chr(10)) AS md
FROM {documents}
"""

# Web pages as archive entries and as manifest items: the host is the book.
CONTENT_ENTRIES_SQL = """
SELECT regexp_extract(url, '://([^/?#]+)', 1) AS book_id,
       url AS entry_path,
       html
FROM {pages}
"""

MANIFEST_ITEMS_SQL = """
SELECT regexp_extract(url, '://([^/?#]+)', 1) AS book_id,
       regexp_extract(url, '://([^/?#]+)', 1) AS book_title,
       CAST(row_number() OVER (PARTITION BY regexp_extract(url, '://([^/?#]+)', 1) ORDER BY page_id) AS INT) AS item_seq,
       CAST(page_id AS VARCHAR(20)) AS item_id,
       CASE WHEN page_id % 7 = 3 THEN 'style' WHEN page_id % 7 = 5 THEN 'image' ELSE 'document' END AS item_type,
       html
FROM {pages}
"""

# Markdown on which every branch of cutting, naming, validating and summarizing fires: repeated
# unnamed chapters, empty titles, empty bodies, texts without a chapter, blank and empty texts.
MD_ODD_SQL = """
SELECT doc_id,
       CASE doc_id % 7
         WHEN 0 THEN concat('# ???', chr(10), text, chr(10), '# ???', chr(10), text, chr(10), '# !!!', chr(10), 'x', chr(10),
                            '# ???', chr(10), text, chr(10))
         WHEN 1 THEN concat('#   ', chr(10), chr(10), '  ', chr(10), '# Named', chr(10), text, chr(10), '# ', chr(9), chr(10))
         WHEN 2 THEN concat('# Empty', chr(10), ' ', chr(10), '# Full', chr(10), text)
         WHEN 3 THEN concat('## Deeper', chr(10), text)
         WHEN 4 THEN concat(' ', chr(10), chr(9))
         WHEN 5 THEN ''
         ELSE concat('# Same', chr(10), 'early', chr(10), '# Same!', chr(10), text) END AS md
FROM {documents}
"""

LANG_ODD_SQL = """
SELECT doc_id, CASE doc_id % 9 WHEN 0 THEN 'zh' WHEN 1 THEN 'ja' WHEN 2 THEN 'ko' WHEN 3 THEN 'ru' WHEN 4 THEN 'ar'
                               WHEN 5 THEN 'hi' WHEN 6 THEN 'fa' ELSE lang END AS lang
FROM {documents}
"""

FILE_NAMES_SQL = """
SELECT doc_id, concat('shelf.v1/Book ', CAST(doc_id AS VARCHAR(20)),
                      CASE doc_id % 6 WHEN 0 THEN '.PDF' WHEN 1 THEN '.epub' WHEN 2 THEN '.TXT' WHEN 3 THEN ''
                                      WHEN 4 THEN '.tar.Epub' ELSE '.docx' END) AS name
FROM {documents}
"""

# Pages of which a third have lost their headings, so that their items have no title.
ITEMS_ODD_SQL = """
SELECT regexp_extract(url, '://([^/?#]+)', 1) AS book_id, regexp_extract(url, '://([^/?#]+)', 1) AS book_title,
       CAST(page_id AS INT) AS item_seq,
       CAST(page_id AS VARCHAR(20)) AS item_id,
       CASE WHEN page_id % 3 = 0 THEN concat('<p>', regexp_extract(html, '<p>([^<#]*)', 1), '</p>') ELSE html END AS html
FROM {pages}
"""

# One book in eleven has no number; some books have no first page text.
PAGES_ODD_SQL = """
SELECT CASE WHEN FLOOR(doc_id / 10) % 11 = 5 THEN NULL ELSE CAST(FLOOR(doc_id / 10) AS BIGINT) END AS book_id,
       CAST(doc_id + 1 AS INT) AS page_no,
       CASE WHEN doc_id % 30 = 0 THEN NULL ELSE text END AS text,
       CASE WHEN doc_id % 30 = 0 THEN 'decode failed' END AS error
FROM {documents}
"""

CORPORA = {
    "md_odd": (MD_ODD_SQL, "documents"),
    "lang_odd": (LANG_ODD_SQL, "documents"),
    "file_names": (FILE_NAMES_SQL, "documents"),
    "items_odd": (ITEMS_ODD_SQL, "pages"),
    "pages_odd": (PAGES_ODD_SQL, "documents"),
    "book_pages": (BOOK_PAGES_SQL, "documents"),
    "book_text": (BOOK_TEXT_SQL, "documents"),
    "md_raw": (MD_RAW_SQL, "documents"),
    "content_entries": (CONTENT_ENTRIES_SQL, "pages"),
    "manifest_items": (MANIFEST_ITEMS_SQL, "pages"),
}


def corpus(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    sql, source = CORPORA[name]
    return spark.sql(sql, **{source: read_table(spark, sf_dir, source)})


def corpus_sql(name: str) -> str:
    """The same corpus as a SQL text over the DuckDB views."""
    sql, source = CORPORA[name]
    return sql.replace("{" + source + "}", source)


def book_pages(spark, sf_dir):
    return corpus(spark, "book_pages", sf_dir)


def book_text(spark, sf_dir):
    return corpus(spark, "book_text", sf_dir)


def md_raw(spark, sf_dir):
    return corpus(spark, "md_raw", sf_dir)


def content_entries(spark, sf_dir):
    return corpus(spark, "content_entries", sf_dir)


def manifest_items(spark, sf_dir):
    return corpus(spark, "manifest_items", sf_dir)
