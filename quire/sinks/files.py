"""Sinks (K1, K2, K4) and writing assembled output without building one string.

Spark writes one directory per value of the partition column, each holding the
text of that group (the text writer ends every row with a newline); with the rows range-partitioned and sorted by (group, order)
the part files of a group are written in order, so a group larger than one row
(a huge book) is written from its ordered parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keys(k: str | Sequence[str]) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


# K1
def write_one_per_doc(df: DataFrame, out: str, name_col: str, text_col: str = "text",
                      mode: str = "overwrite") -> None:
    """One text file per document under ``out/<name_col>=<name>/``."""
    (df.select(name_col, text_col)
       .repartition(name_col)
       .write.mode(mode).partitionBy(name_col).text(out))


# K2
def write_chapters(chapters: DataFrame, out: str, doc_col: str = "doc_id",
                   mode: str = "overwrite") -> None:
    """Chapter files under ``out/<doc>/<slug>/`` holding the rendered chapter (after W5)."""
    (chapters.select(doc_col, "slug", "rendered")
       .repartition(doc_col, "slug")
       .write.mode(mode).partitionBy(doc_col, "slug").text(out))


# K4
def write_combined(df: DataFrame, out: str, text_col: str = "text", mode: str = "overwrite") -> None:
    """One combined output per row group (A1 result), written outside the input folder."""
    df.select(text_col).write.mode(mode).text(out)


def write_ordered_parts(parts: DataFrame, out: str, keys: str | Sequence[str], order: str,
                        text_col: str = "text", mode: str = "overwrite", sep: str = "\n\n",
                        drop_empty: bool = True) -> None:
    """Write ordered parts of each group without joining them into one string.

    Range partitioning on (keys, order) keeps each task's rows contiguous in order, so
    a group's part files read in name order give its text: every part is followed by
    ``sep``.  For ``pages_to_text_parts`` that is the A2 text and a last ``sep``; the
    documents of a directory (``order="name"``, ``drop_empty=False``) give the A1 text itself.
    """
    keys = _keys(keys)
    if drop_empty:
        parts = parts.where(F.col(text_col) != "")
    (parts.repartitionByRange(*keys, order)
          .sortWithinPartitions(*keys, order)
          .select(*keys, F.col(text_col))
          .write.mode(mode).option("lineSep", sep).partitionBy(*keys).text(out))


# M3 output files
def write_summaries(stored: DataFrame, out: str, doc_col: str = "doc_id",
                    mode: str = "overwrite") -> None:
    """Stored summaries (``store_summaries``) under ``out/<doc>/<out_name>/``."""
    (stored.select(doc_col, "out_name", "text")
       .repartition(doc_col, "out_name")
       .write.mode(mode).partitionBy(doc_col, "out_name").text(out))
