"""Helpers shared by the operators: written tables, running totals, components, pair cells."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ensure_checkpoint_dir
from ..sources.tables import read_table

# White space of the contracts: U+0020 and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]"
MARK = "qc_"         # prefix of the columns that these helpers add on the way


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


_scopes: list[str] = []      # folders of the open workspaces, innermost last


@contextmanager
def workspace(spark: SparkSession) -> Iterator[str]:
    """Tables that ``written`` leaves inside the block go to a folder of their own, deleted at its end.

    Results that read them must be stored before, with ``written(..., outside=True)`` or elsewhere.
    """
    folder = f"{ensure_checkpoint_dir(spark)}/quire-{uuid.uuid4().hex}"
    _scopes.append(folder)
    try:
        yield folder
    finally:
        _scopes.remove(folder)
        delete_path(spark, folder)


def delete_path(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def written(df: DataFrame, outside: bool = False) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` (a lost executor costs a re-read, not a
    recomputation) and stores the rows once, compressed and by column.  In a ``workspace``
    the table goes with it, unless it is to stay ``outside``.
    """
    spark = df.sparkSession
    folder = _scopes[-1] if _scopes and not outside else ensure_checkpoint_dir(spark)
    path = f"{folder}/quire-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` stored with q_row, a number of its own for every row, however rows repeat."""
    return written(docs.withColumn("q_row", F.monotonically_increasing_id()))


def rank_of(id_col: str) -> Column:
    """Which of several rows stays: the least id, null ids last, then the least q_row."""
    c = F.col(id_col)
    return F.struct(c.isNull().alias("n"), c.alias("i"), F.col("q_row").alias("r"))


def drop_written(spark: SparkSession) -> None:
    """Delete all tables that ``written`` left in this session; call it once every result is stored."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        f"{ensure_checkpoint_dir(spark)}/quire-*")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.globStatus(path) or []:
        fs.delete(status.getPath(), True)


def _slot(keys: list[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits))


def _bitmap(groups: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """(q_bucket, q_bits): at most bits / 32768 rows of 4 KB."""
    slot = _slot(keys, bits) + 1
    return (groups.select(F.bitmap_bucket_number(slot).alias("q_bucket"),
                          F.bitmap_bit_position(slot).alias("q_pos"))
            .groupBy("q_bucket").agg(F.bitmap_construct_agg("q_pos").alias("q_bits")))


def marked_by(rows: DataFrame, keys: list[str], groups: DataFrame, bits: int, out: str) -> DataFrame:
    """Add ``out``: whether the row's group may be in ``groups``; never false for one that is.

    The groups travel as a broadcast bitmap of ``bits`` bits over a hash of ``keys``, so its
    size does not depend on the data; groups that share a bit are false positives.
    """
    slot = _slot(keys, bits) + 1
    pos = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(F.col("q_bits"), (pos / 8).cast("int") + 1, F.lit(1))), 16, 10)
    bit = F.getbit(byte.cast("int"), (pos % 8).cast("int"))
    rows = rows.withColumn("q_bucket", F.bitmap_bucket_number(slot))
    return (rows.join(F.broadcast(_bitmap(groups, keys, bits)), "q_bucket", "left")
            .withColumn(out, F.coalesce(bit == 1, F.lit(False)))
            .drop("q_bucket", "q_bits"))


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join rows with a table that was aggregated by the same keys, so that hot keys can be split.

    The aggregate is already dealt by ``keys`` and would be joined where it lies, which
    binds each key to one task.  One more key, a hash of the others, makes Spark deal
    both sides anew, and adaptive execution then splits the partitions of hot keys.
    Neither side is ever broadcast: the plan's size of rows that were exploded, and of what is
    counted from them, is that of the rows before, so millions of them would pass for a small table.
    """
    k = F.hash(*keys).alias(f"{MARK}k")
    return (left.select("*", k).join(right.select("*", k).hint("merge"), [*keys, f"{MARK}k"], how)
            .drop(f"{MARK}k"))


def running_total(df: DataFrame, group: str, order: list[str], amount: str | None = None,
                  out: str = "before") -> DataFrame:
    """Add ``out``: the sum of ``amount`` (1 when None) over earlier rows of the group.

    ``group`` must not hold nulls and ``order`` must order the rows of a group fully.
    A group of any size is spread over tasks: rows are range-partitioned by (group,
    order), summed inside each partition as a stream, and each partition's start is
    added from a table with one row per (partition, group).
    """
    src = df.withColumn(f"{MARK}amt", F.col(amount).cast("long") if amount else F.lit(1).cast("long"))
    rows = (src.repartitionByRange(F.col(group), *order)
            .sortWithinPartitions(group, *order)
            .withColumn(f"{MARK}pid", F.spark_partition_id())
            .withColumn(f"{MARK}in", F.lit(0).cast("long")))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, 0
        at = [src_cols.index(f"{MARK}{c}") for c in ("amt", "in")]
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(src_cols.index(group))
            g = keys.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            a = batch.column(at[0]).to_numpy(zero_copy_only=False)
            cum = np.cumsum(a) - a
            head = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
            base = cum[head].copy()
            if last is not None and keys[0].as_py() == last:
                base[0] -= total
            inside = cum - np.repeat(base, np.diff(np.r_[head, len(g)]))
            last, total = keys[-1].as_py(), int(inside[-1] + a[-1])
            yield batch.set_column(at[1], batch.schema.field(at[1]).name,
                                   pa.array(inside, type=pa.int64()))

    src_cols = rows.columns
    rows = written(rows.mapInArrow(scan, rows.schema))
    pid, part = f"{MARK}pid", f"{MARK}part"
    parts = (rows.groupBy(group, pid).agg(F.sum(f"{MARK}amt").alias(part))
             .withColumn(f"{MARK}off", F.coalesce(
                 F.sum(part).over(Window.partitionBy(group).orderBy(pid)
                                  .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .drop(part))
    return (rows.join(parts, [group, pid])
            .withColumn(out, F.col(f"{MARK}off") + F.col(f"{MARK}in"))
            .drop(pid, f"{MARK}in", f"{MARK}off", f"{MARK}amt"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of (a, b) long pairs: one row (node, root) per node, root = least node.

    Alternates the large-star and small-star steps of Kiveris et al. (2014).  Each
    step is a map-side combined minimum per node and one join; every round is written
    to the shared folder.  Edges never leave the executors.
    """
    a, b = F.col("a"), F.col("b")

    def star(both: DataFrame, large: bool) -> DataFrame:
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        out = skew_join(both, low, ["a"])
        if large:
            out = out.where(b > a).select(b.alias("a"), F.col("m").alias("b"))
        else:
            out = (out.select(F.explode(F.array(
                F.struct(b.alias("a"), F.col("m").alias("b")),
                F.struct(a.alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*"))
        return out.where(a != b).distinct()

    cur = written(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                  .distinct())
    seen = None
    for _ in range(max_rounds):
        big = star(cur.union(cur.select(b.alias("a"), a.alias("b"))), large=True)
        big = big.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        cur = written(star(big, large=False))
        state = cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 40))).first()
        if state == seen or not state[0]:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def pair_cells(rows: DataFrame, key: list[str], item: str, judge: Callable, schema: str,
               block_rows: int = 1500, late: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Compare the rows of each posting list (equal ``key``) with each other, in cells.

    A list of up to ``block_rows`` rows is one cell.  A longer list is cut into blocks
    by a hash of ``item`` and every two blocks meet in one cell, so no task holds more
    than about two blocks of a list and no pair is lost.  Lists of one row are dropped
    before their rows move a second time.  ``judge(batch, i, j)`` gets a pandas batch and the index
    arrays of the pairs to compare, as an iterator of chunks, and yields result frames.
    ``late`` may add wide columns to the rows that are left, before they move to their cells.
    """
    count = rows.groupBy(*key).agg(F.count("*").alias(f"{MARK}n")).where(F.col(f"{MARK}n") > 1)
    nb = F.ceil(F.col(f"{MARK}n") / F.lit(block_rows)).cast("int")
    own = F.pmod(F.xxhash64(F.col(item), F.lit(7)), F.col(f"{MARK}nb")).cast("int")
    cells = (skew_join(rows, count, key)
             .withColumn(f"{MARK}nb", nb)
             .withColumn(f"{MARK}b", own)
             .withColumn(f"{MARK}o", F.explode(F.sequence(F.lit(0), F.col(f"{MARK}nb") - 1)))
             .withColumn(f"{MARK}i", F.least(F.col(f"{MARK}b"), F.col(f"{MARK}o")))
             .withColumn(f"{MARK}j", F.greatest(F.col(f"{MARK}b"), F.col(f"{MARK}o")))
             .drop(f"{MARK}n", f"{MARK}nb", f"{MARK}o"))
    cell = [*key, f"{MARK}i", f"{MARK}j"]
    if late:
        cells = late(cells)
    cells = cells.repartition(*cell).sortWithinPartitions(*cell, f"{MARK}b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            ids = cell_ids(pdf, cell)
            cut = int(np.searchsorted(ids, ids[-1])) if len(ids) else 0
            rest = pdf.iloc[cut:].reset_index(drop=True)
            if cut:
                yield from judge(pdf.iloc[:cut].reset_index(drop=True), ids[:cut])
        if rest is not None and len(rest):
            yield from judge(rest, cell_ids(rest, cell))

    return cells.mapInPandas(run, schema)


def cell_ids(pdf: pd.DataFrame, cell: list[str]) -> np.ndarray:
    """0, 0, 1, ...: the number of each row's cell in a batch sorted by cell."""
    new = np.zeros(len(pdf), dtype=bool)
    for c in cell:
        v = pdf[c].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.cumsum(new)


def cell_pairs(pdf: pd.DataFrame, ids: np.ndarray, chunk: int = 1 << 20) -> Iterator[tuple]:
    """Index arrays (i, j) of the pairs of each cell: across its two blocks, or inside its one block."""
    own = pdf[f"{MARK}b"].to_numpy()
    cross = pdf[f"{MARK}i"].to_numpy() != pdf[f"{MARK}j"].to_numpy()
    i = np.arange(len(ids))
    held, size = [], 0
    step = 1
    while len(i):
        i = i[i + step < len(ids)]
        i = i[ids[i] == ids[i + step]]
        j = i + step
        use = ~cross[i] | (own[i] != own[j])
        held.append((i[use], j[use]))
        size += int(use.sum())
        step += 1
        if size >= chunk or not len(i):
            yield tuple(np.concatenate(x) for x in zip(*held))
            held, size = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, root) that join the same values as the pairs a-b; root is the least value."""
    values, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[: len(a)], inv[len(a):]
    root = np.arange(len(values))
    while True:
        low = np.minimum(root[x], root[y])
        nxt = root.copy()
        np.minimum.at(nxt, root[x], low)
        np.minimum.at(nxt, root[y], low)
        np.minimum.at(nxt, x, low)
        np.minimum.at(nxt, y, low)
        nxt = nxt[nxt]
        if np.array_equal(nxt, root):
            break
        root = nxt
    own = root != np.arange(len(values))
    return values[own], values[root[own]]
