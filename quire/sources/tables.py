"""Table sources: the driver's Parquet tables and the logical input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Row key of each driver table, used to spread a scan that yields too few tasks.
TABLE_KEYS = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id",
              "labels": "doc_id", "benchmark": "item_id"}


# Session setting by which a caller (the bench) asks for spread scans; off unless set.
SPREAD_CONF = "quire.spread.scans"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    key = TABLE_KEYS.get(name)
    asked = spark.conf.get(SPREAD_CONF, "false") == "true"
    return spread_rows(df, key) if asked and key else df


def spread_rows(df: DataFrame, key: str) -> DataFrame:
    """Hash-spread the rows of a small input that is read by fewer tasks than cores.

    Text operators are CPU-bound per row; a file written as one row group is read
    by one task.  A full shuffle, so only for callers that know their input is
    such a file.  Hashing on the key keeps retries deterministic, and filters and
    column pruning still reach the scan below the exchange.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as ``raw_text`` (doc_id, text, title, author)."""
    return (read_table(spark, sf_dir, "documents")
            .select("doc_id", "text",
                    F.lit(None).cast("string").alias("title"),
                    F.lit(None).cast("string").alias("author")))


# S4
def select_pages(doc_pages: DataFrame, start: int | None = None, end: int | None = None,
                 page_col: str = "page_no") -> DataFrame:
    """Pages in the 1-based inclusive range; a plain filter, pushed to the Parquet scan."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(page_col) >= start)
    if end is not None:
        cond = cond & (F.col(page_col) <= end)
    return doc_pages.where(cond)


# S5
CONTENT_SUFFIXES = (".html", ".xhtml", ".htm")


def select_content_entries(entries: DataFrame, path_col: str = "entry_path") -> DataFrame:
    """Entries whose path ends with an HTML suffix (case sensitive)."""
    p = F.col(path_col)
    cond = p.endswith(CONTENT_SUFFIXES[0])
    for s in CONTENT_SUFFIXES[1:]:
        cond = cond | p.endswith(s)
    return entries.where(cond)


# S6
def manifest_documents(items: DataFrame, type_col: str | None = "item_type",
                       doc_type: str = "document") -> DataFrame:
    """Document items of a manifest; ``type_col=None`` takes every item (a manifest without types)."""
    return items if type_col is None else items.where(F.col(type_col) == doc_type)
