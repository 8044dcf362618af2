"""SimHash near-duplicates: positional-byte inverted index, count filter, verification.

A fingerprint of 64 bits is eight positional bytes.  Fingerprints at most ``max_bits``
bits apart differ in at most ``max_bits`` bytes, so of 8 bytes they share at least
8 - max_bits, the guaranteed minimum.  The index posts fingerprints under positional
bytes; a list of one byte would hold 1/256 of all rows, so lists are intersected
``width`` bytes at a time: of the first max_bits + width positions any linked pair shares at
least ``width``, hence it meets in one of C(max_bits + width, width) posting lists (35 for 3
bits and 4 bytes, each about 2^-32 of the rows).  For every pair that meets, the shared
positional bytes are tallied, pairs below the minimum dropped, and the rest verified by
their Hamming distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cell_pairs, components, forest, numbered, pair_cells, rank_of, skew_join, written

CHUNK = 1 << 16      # shingles hashed at a time: bounds memory for very long texts


def fingerprint(text: str | None, width: int = 3) -> int:
    """64-bit SimHash of the word shingles, as a signed long; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    if len(words) < width:
        words, width = [b" ".join(words)], 1
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, CHUNK):
        part = words[at:at + CHUNK + width - 1]
        grams = map(b" ".join, zip(*(part[k:] for k in range(width))))
        h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = 3) -> DataFrame:
    """(id, q_fp): one row per input row; null and empty texts have fingerprint 0."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"q_key": pdf["q_key"], "q_fp": np.array(
                [fingerprint(t, shingle_words) for t in pdf["q_text"]], dtype=np.int64)})

    # ids travel as text so that nulls and large ids stay exact in pandas
    kind = docs.schema[id_col].dataType
    src = docs.select(F.col(id_col).cast("string").alias("q_key"), F.col(text_col).alias("q_text"))
    return (src.mapInPandas(run, "q_key string, q_fp long")
            .select(F.col("q_key").cast(kind).alias(id_col), "q_fp"))


def links(fps: DataFrame, max_bits: int = 3, width: int = 4) -> DataFrame:
    """(a, b) fingerprint pairs whose closure equals that of all pairs within ``max_bits`` bits.

    Every linked pair is found and verified; of the pairs found together only a star per
    connected set is returned, so a group of s near copies yields rows in proportion to s.
    """
    if not 0 <= max_bits <= 8 - width:
        raise ValueError("max_bits must lie between 0 and 8 - width")
    shared = 8 - max_bits
    lists = []
    for n, places in enumerate(combinations(range(max_bits + width), width)):
        mask = sum(0xFF << 8 * p for p in places)
        mask -= (mask >> 63) << 64
        lists.append(F.struct(F.lit(n).cast("byte").alias("n"),
                              F.col("q_fp").bitwiseAND(F.lit(mask)).alias("part")))
    posted = fps.select("q_fp", F.explode(F.array(*lists)).alias("l")).select(
        "q_fp", F.col("l.n").alias("q_list"), F.col("l.part").alias("q_part"))

    def judge(pdf: pd.DataFrame, ids: np.ndarray) -> Iterator[pd.DataFrame]:
        fp = pdf["q_fp"].to_numpy(dtype=np.int64).view(np.uint64)
        octets = fp.view(np.uint8).reshape(-1, 8)
        for i, j in cell_pairs(pdf, ids):
            tally = (octets[i] == octets[j]).sum(axis=1)
            i, j = i[tally >= shared], j[tally >= shared]
            near = np.bitwise_count(fp[i] ^ fp[j]) <= max_bits
            if near.any():
                a, b = forest(fp[i[near]].view(np.int64), fp[j[near]].view(np.int64))
                yield pd.DataFrame({"a": a, "b": b})

    return pair_cells(posted, ["q_list", "q_part"], "q_fp", judge, "a long, b long")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle_words: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id (least id reachable).

    Documents without words share fingerprint zero and link like any others.  Null ids
    count in no minimum; a component of null ids only has a null component_id.
    """
    own = written(fingerprints(docs, id_col, text_col, shingle_words)
                  .withColumnRenamed(id_col, "q_id"))
    nodes = written(own.groupBy("q_fp").agg(F.min("q_id").alias("q_low")))
    roots = components(links(nodes.select("q_fp"), max_bits)).withColumnRenamed("node", "q_fp")
    # rows of which the files say too little (sorted numbers compress well) are not to be broadcast
    placed = nodes.join(roots.hint("merge"), "q_fp", "left").select(
        "q_fp", "q_low", F.coalesce("root", "q_fp").alias("q_root"))
    low = placed.groupBy("q_root").agg(F.min("q_low").alias("component_id"))
    named = skew_join(placed, low, ["q_root"]).select("q_fp", "component_id")
    return own.join(named.hint("merge"), "q_fp").select(
        F.col("q_id").alias(id_col), F.lower(F.lpad(F.hex("q_fp"), 16, "0")).alias("fingerprint"),
        "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     **options) -> DataFrame:
    """``docs`` with one row of each component; columns unchanged.

    The row of least id stays, null ids last; rows are told apart by a number, so a row is judged
    by its own text whatever its id, and of rows that repeat id and text one stays.
    """
    rows = numbered(docs)
    found = near_groups(rows.select("q_row", F.col(text_col).alias("q_text")), "q_row", "q_text", **options)
    stays = (found.join(rows.select("q_row", F.col(id_col).alias("q_id")).hint("merge"), "q_row")
             .groupBy("component_id").agg(F.min(rank_of("q_id"))["r"].alias("q_row")).select("q_row"))
    # whole texts are not sorted for this: the numbers are hashed
    return rows.join(stays.hint("shuffle_hash"), "q_row", "left_semi").select(*docs.columns)
