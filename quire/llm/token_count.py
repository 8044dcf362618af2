"""Token counts from flat, unindexed token files by a separator scan.

A token file is a plain run of little-endian unsigned 16- or 32-bit ids in which every document ends
with an end-of-document id; no index says where.  Files are read in blocks of a fixed
number of ids that know nothing of document boundaries.  Each block is searched for the
separator at once (numpy) and summed up in a few numbers; a prefix scan over the blocks of
a file (within runs of ``SCAN_RUN`` blocks, then over the runs) gives every block the
documents and ids before it, which stitches the documents that cross block borders.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bpe import Encoder, Vocabulary
from .common import written

SCAN_RUN = 4096


def flat_files(docs: DataFrame, vocabulary: Vocabulary, end_id: int, id_col: str = "doc_id",
               text_col: str = "text", block_ids: int = 1 << 15) -> DataFrame:
    """Encode documents into flat token files, one per input partition: q_file, q_block, q_data.

    Rows with q_data are blocks of ``block_ids`` ids (the last of a file may be shorter).  Rows
    with q_names list the document ids of the file in writing order from number ``q_block``
    on; they serve the caller to name the counts and are not read by ``count_tokens``.
    """
    wide = "<u2" if max(end_id, len(vocabulary.ranks)) < 1 << 16 else "<u4"
    unit = np.dtype(wide).itemsize

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Encoder(vocabulary)
        end = np.array([end_id], dtype=wide).tobytes()
        held, size, block, ordinal = [], 0, 0, 0
        file = None
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                part = pdf.iloc[at:at + 500]
                file = int(part["q_file"].iloc[0])
                for text in part["q_text"]:
                    ids = np.frombuffer(coder.encode(text or ""), dtype="<u4").astype(wide).tobytes()
                    held += [ids, end]
                    size += len(ids) + unit
                full = size // (block_ids * unit)
                blocks = []
                if full:
                    data = b"".join(held)
                    step = block_ids * unit
                    blocks = [data[k * step:(k + 1) * step] for k in range(full)]
                    held, size = [data[full * step:]], size - full * step
                names = part["q_key"].tolist()
                yield pd.DataFrame({"q_file": file, "q_block": [ordinal, *range(block, block + full)],
                                    "q_data": [None, *blocks], "q_names": [names, *[None] * full]})
                ordinal += len(names)
                block += full
        if size:
            yield pd.DataFrame({"q_file": [file], "q_block": [block], "q_data": [b"".join(held)],
                                "q_names": [None]})

    src = docs.select(F.spark_partition_id().alias("q_file"), F.col(id_col).cast("string").alias("q_key"),
                      F.col(text_col).alias("q_text"))
    return src.mapInPandas(run, "q_file int, q_block long, q_data binary, q_names array<string>")


def read_flat_files(spark: SparkSession, path: str, block_bytes: int = 1 << 16) -> DataFrame:
    """Blocks (q_file, q_block, q_data) of raw token files under ``path``.

    Spark's binaryFile source reads a file as one value, so a file may have up to 2 GB.
    """
    files = spark.read.format("binaryFile").load(path)
    n = F.ceil(F.length("content") / F.lit(block_bytes)).cast("int")
    at = F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1)))
    return (files.select(F.col("path").alias("q_file"), "content", at.alias("q_at"))
            .select("q_file", F.col("q_at").cast("long").alias("q_block"),
                    F.substring("content", F.col("q_at") * block_bytes + 1, F.lit(block_bytes)).alias("q_data")))


def count_tokens(blocks: DataFrame, end_id: int, id_bytes: int = 2) -> DataFrame:
    """(q_file, ordinal, n_tokens, ended): ids of each document, the separator not counted.

    ``ordinal`` counts documents of a file from 0.  Ids after the last separator of a file form a
    document with ``ended`` false; a file that ends with a separator has none.
    """
    kind = blocks.schema["q_file"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for file, block, data in zip(pdf["q_file"], pdf["q_block"], pdf["q_data"]):
                ids = np.frombuffer(data, dtype=f"<u{id_bytes}")
                at = np.flatnonzero(ids == end_id)
                out.append((file, block, len(ids), len(at), at[0] if len(at) else len(ids),
                            len(ids) - 1 - at[-1] if len(at) else len(ids), np.diff(at) - 1))
            yield pd.DataFrame(out, columns=["q_file", "q_block", "n", "ends", "head", "tail", "inner"])

    found = written(blocks.mapInPandas(run, f"q_file {kind}, q_block long, n long, ends long, head long, "
                                            "tail long, inner array<long>"))
    narrow = found.drop("inner").withColumn("run", F.expr(f"q_block div {SCAN_RUN}"))
    inside = Window.partitionBy("q_file", "run").orderBy("q_block")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    # ids since the last separator, as a sum that a block with a separator resets
    start = F.coalesce(F.sum("n").over(before), F.lit(0))
    local = (narrow.withColumn("ids_before", start)
             .withColumn("ends_before", F.coalesce(F.sum("ends").over(before), F.lit(0)))
             .withColumn("mark", F.when(F.col("ends") > 0, F.col("ids_before") + F.col("n") - F.col("tail")))
             .withColumn("last_mark", F.max("mark").over(before)))
    runs = (local.groupBy("q_file", "run")
            .agg(F.sum("n").alias("run_n"), F.sum("ends").alias("run_ends"), F.max("mark").alias("run_mark")))
    over = Window.partitionBy("q_file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = (runs.withColumn("n0", F.coalesce(F.sum("run_n").over(over), F.lit(0)))
            .withColumn("ends0", F.coalesce(F.sum("run_ends").over(over), F.lit(0)))
            .withColumn("mark0", F.coalesce(F.max(F.col("n0") + F.col("run_mark")).over(over), F.lit(0)))
            .select("q_file", "run", "n0", "ends0", "mark0"))
    joined = local.join(runs, ["q_file", "run"]).select(
        "q_file", "q_block", (F.col("ends0") + F.col("ends_before")).alias("first"),
        (F.col("n0") + F.col("ids_before")
         - F.coalesce(F.col("n0") + F.col("last_mark"), F.col("mark0"))).alias("carry"))
    whole = (found.where("ends > 0").join(joined, ["q_file", "q_block"])
             .select("q_file", "first", F.concat(F.array(F.col("carry") + F.col("head")), "inner").alias("sizes"))
             .select("q_file", "first", F.posexplode("sizes").alias("at", "n_tokens"))
             .select("q_file", (F.col("first") + F.col("at")).alias("ordinal"), "n_tokens",
                     F.lit(True).alias("ended")))
    ends = (found.groupBy("q_file").agg(F.max("q_block").alias("q_block")))
    open_end = (found.drop("inner").join(ends, ["q_file", "q_block"]).join(joined, ["q_file", "q_block"])
                .select("q_file", (F.col("first") + F.col("ends")).alias("ordinal"),
                        F.when(F.col("ends") > 0, F.col("tail")).otherwise(F.col("carry") + F.col("n")).alias("n_tokens"),
                        F.lit(False).alias("ended")).where("n_tokens > 0"))
    return whole.unionByName(open_end)


def document_tokens(docs: DataFrame, vocabulary: Vocabulary, end_id: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, n_tokens) per input row, counted in the flat files written from the documents."""
    files = written(flat_files(docs, vocabulary, end_id, id_col, text_col))
    width = 2 if max(end_id, len(vocabulary.ranks)) < 1 << 16 else 4
    counts = count_tokens(files.where("q_data is not null").select("q_file", "q_block", "q_data"), end_id, width)
    names = (files.where("q_names is not null")
             .select("q_file", "q_block", F.posexplode("q_names").alias("at", "q_key"))
             .select("q_file", (F.col("q_block") + F.col("at")).alias("ordinal"), "q_key"))
    return names.join(counts, ["q_file", "ordinal"]).select(
        F.col("q_key").cast(docs.schema[id_col].dataType).alias(id_col), "n_tokens")
