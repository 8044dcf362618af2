"""Exact deduplication by progressive refinement: length, prefix hash, full hash.

Two scans.  The first reads each text once for (length, prefix hash); both refinement
levels then work on those narrow rows.  The second hashes a whole text only when its
(length, prefix hash) group has other rows.  Which groups survive is carried to the
second scan as a bitmap of a fixed number of bits over a hash of the group: its size is
a parameter, not a property of the data, so it may be broadcast at any scale.  Two groups
that share a bit cost an extra hash and change no result, since only the full hash
(and the length) decides equality.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, marked_by, numbered, rank_of, skew_join, written


def normalised(text: str) -> Column:
    """Null as empty; each run of U+0020, U+0009-U+000D as one space."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), f"{SPACE}+", " ")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 prefix_chars: int = 256, bits: int = 1 << 22, hash_all: bool = False) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their normalised forms are; null counts as empty.  Of equal
    texts the least id stays; a group whose ids are all null keeps all its rows with
    a null keep_id.  Rows that repeat an id are copies of one document and share its
    fate (``kept``), each counting in ``group_size``.  ``text_sha256`` is null for rows
    that were alone after the prefix level, unless ``hash_all`` asks for every digest.
    Other columns are ignored, so their names cannot clash.
    """
    text = F.col("q_norm")
    src = docs.select(F.col(id_col).alias("q_id"), normalised(text_col).alias("q_norm"))
    sized = src.select("q_id", F.octet_length(text).alias("q_len"),
                       F.xxhash64(F.substring(text, 1, prefix_chars)).alias("q_prefix"))
    first = written(sized)
    # level 1: lengths that occur more than once; level 2: prefixes within them
    lengths = first.groupBy("q_len").agg(F.count("*").alias("n")).where("n > 1")
    level1 = marked_by(first, ["q_len"], lengths, bits, "q_hit").where("q_hit")
    prefixes = level1.groupBy("q_len", "q_prefix").agg(F.count("*").alias("n")).where("n > 1")
    # level 3: the whole text, of survivors only
    again = src.select("q_id", "q_norm", F.octet_length(text).alias("q_len"),
                       F.xxhash64(F.substring(text, 1, prefix_chars)).alias("q_prefix"))
    found = marked_by(again, ["q_len", "q_prefix"], prefixes, bits, "q_hit")
    digest = F.sha2(text.cast("binary"), 256)
    full = written(found.select(
        "q_id", "q_len", "q_hit",
        (digest if hash_all else F.when(F.col("q_hit"), digest)).alias("text_sha256")))
    groups = (full.where("q_hit").groupBy("q_len", "text_sha256")
              .agg(F.min("q_id").alias("keep_id"), F.count("*").alias("group_size")))
    alone = full.where(~F.col("q_hit")).select(
        "q_id", "text_sha256", F.col("q_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    joined = (skew_join(full.where("q_hit"), groups, ["q_len", "text_sha256"])
              .select("q_id", "text_sha256", "keep_id", "group_size"))
    out = joined.unionByName(alone)
    return out.select(
        F.col("q_id").alias(id_col), "keep_id", "group_size",
        F.coalesce(F.col("q_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of equal texts; columns unchanged.

    The row of least id stays, null ids last; rows are told apart by a number, so a row whose id
    also occurs with another text is judged by its own text, and of rows that repeat id and text one stays.
    """
    rows = numbered(docs)
    found = exact_groups(rows.select(rank_of(id_col).alias("q_rank"), F.col(text_col).alias("q_text")),
                         "q_rank", "q_text", **options)
    gone = found.where(~F.col("kept")).select(F.col("q_rank.r").alias("q_row"))
    # whole texts are not sorted for this: the numbers are hashed
    return rows.join(gone.hint("shuffle_hash"), "q_row", "left_anti").select(*docs.columns)
