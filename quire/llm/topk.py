"""Exact top-k inner-product search over an impact-ordered index, score at a time.

Vectors become integers, floor(scale * x).  They are dealt into blocks; a block's index
holds, for every dimension, the rows by descending quantised value (their impact), so
that equal levels form a posting segment.  A query adds up segments by descending
contribution (query weight times impact, rounded up): at any threshold the segments
above it are one run at one end of each dimension's list.  After a stage, a row's sum
plus what the unread segments could add at most is a proven bound of its score.  Reading
stops only when that bound excludes rows: with every positive contribution read, nothing
left can raise a sum, and rows whose sum stays below the k-th exact score found are out.
All others, the possible members, are rescored exactly in 64-bit integers.

Queries meet vectors in cells of one query block and one vector block, so each cell
returns at most k rows per query and a task holds two blocks, whatever the table's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cell_ids, written

LEVELS = 64             # quantised impacts on either side of zero
STAGES = (0.5, 0.25, 0.1, 0.0)      # thresholds, as shares of the largest contribution


def searchable(vec: str, scale: int) -> Column:
    """Not null, not empty, components finite, and integers whose sum of squares fits a long."""
    v = F.col(vec)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    most = F.sqrt(F.lit(float(1 << 62)) / F.size(v)) / scale - 1
    wide = F.exists(v, lambda x: F.abs(x.cast("double")) > most)
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & ~bad & ~wide, F.lit(False))


class ImpactIndex:
    """Impact-ordered posting segments of one block of integer vectors."""

    def __init__(self, vectors: np.ndarray, rows: np.ndarray):
        """``rows`` in the order of ties: of equal scores the smaller place wins."""
        self.vectors, self.rows = vectors, rows
        self.step = max(1, -(-int(np.abs(vectors).max()) // LEVELS))
        level = self.vectors // self.step
        order = np.argsort(-level, axis=0, kind="stable")
        self.postings = np.ascontiguousarray(order.T.astype(np.int32))
        # upper and lower edge of each posting's level, by descending level
        low = np.ascontiguousarray(np.take_along_axis(level, order, axis=0).T).astype(np.float64) * self.step
        self.high, self.low = low + (self.step - 1), low
        self.less_high, self.less_low = -self.high, -self.low      # ascending, for searches

    def top(self, query: np.ndarray, own_row: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and exact scores of the k best rows, the query's own left out."""
        n, dims = self.vectors.shape
        used = np.flatnonzero(query).tolist()
        weights = query.astype(np.float64).tolist()
        sums = np.zeros(n)
        read = [0] * dims
        best = max([max(weights[j] * self.high[j, 0], weights[j] * self.low[j, -1]) for j in used], default=0.0)
        possible = np.arange(n)
        for share in STAGES:
            limit = share * max(best, 0.0)
            lists, gains, left = [], [], 0.0
            for j in used:
                q = weights[j]
                # contributions descend along the list for positive weights, and against it for negative
                if q > 0:
                    edge = self.high[j]
                    stop = int(self.less_high[j].searchsorted(-limit / q, side="left"))
                    run, following = slice(read[j], stop), stop
                else:
                    edge = self.low[j]
                    stop = n - int(self.less_low[j].searchsorted(-limit / q, side="right"))
                    run, following = slice(n - stop, n - read[j]), n - stop - 1
                if stop > read[j]:
                    lists.append(self.postings[j, run])
                    gains.append(edge[run] * q)
                    read[j] = stop
                if stop < n:
                    left += max(q * edge[following], 0.0)
            if lists:
                sums += np.bincount(np.concatenate(lists), np.concatenate(gains), minlength=n)
            # the k-th exact score among the rows that look best so far is a proven lower bound
            lead = np.argpartition(-sums, min(4 * k, n - 1))[:4 * k + 1]
            lead = lead[self.rows[lead] != own_row]
            if len(lead) < k:
                continue
            floor = np.partition(self.vectors[lead] @ query, len(lead) - k)[len(lead) - k]
            # sums are rounded doubles: allow for it, so that no possible member is lost
            possible = np.flatnonzero(sums + left + 1.0 + np.abs(sums) * 1e-9 >= float(floor) - abs(float(floor)) * 1e-9)
            if len(possible) <= max(8 * k, n // 50):
                break
        possible = possible[self.rows[possible] != own_row]
        scores = self.vectors[possible] @ query
        first = np.lexsort((possible, -scores))[:k]
        return possible[first], scores[first]


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
                vec_col: str = "embedding", scale: int = 256, block_rows: int = 8192,
                query_rows: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best inner products of every query row with all other rows.

    Scores are of the integers floor(scale * x); equal scores go to the smaller id, null ids
    last.  A vector that is null, empty, holds a null or non-finite component, or is so long
    that scores could leave 64 bits, takes no part.  Only vectors of one length meet.  Every
    input row is a candidate, and a query, of its own: rows that repeat an id or a vector
    find each other.  A null condition is no query.  Extra columns are ignored once
    ``is_query`` is read, so their names cannot clash.
    """
    spark = vectors.sparkSession
    src = vectors.select(F.col(id_col).alias("q_id"), F.col(vec_col).cast("array<double>").alias("q_vec"),
                         F.coalesce(is_query, F.lit(False)).alias("q_ask"))
    rows = written(src.where(searchable("q_vec", scale)).withColumn("q_row", F.monotonically_increasing_id())
                   .withColumn("q_dim", F.size("q_vec")))
    total, asked = rows.agg(F.count("*"), F.count_if("q_ask")).first()
    width = max(spark.sparkContext.defaultParallelism, 1)
    # blocks of at most block_rows rows, smaller ones while there are too few to use the cluster
    blocks = max(-(-total // block_rows), min(2 * width, total // 256), 1)
    query_blocks = max(-(-asked // query_rows), 1)

    def block(of: str, n: int, seed: int) -> Column:
        return F.pmod(F.xxhash64(of, F.lit(seed)), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    cell = ["q_dim", "q_b", "q_c"]
    # ids travel without nulls: pandas would make them doubles
    rows = rows.withColumn("q_void", F.col("q_id").isNull()).withColumn("q_id", F.coalesce("q_id", F.lit(0)))
    keep = ["q_dim", "q_row", "q_id", "q_void", "q_vec"]
    stored = rows.select(*keep, F.lit(0).alias("q_side"), block("q_row", blocks, 1).alias("q_b"),
                         every(query_blocks).alias("q_c"))
    asking = rows.where("q_ask").select(*keep, F.lit(1).alias("q_side"), every(blocks).alias("q_b"),
                                        block("q_row", query_blocks, 2).alias("q_c"))
    tasks = min(blocks * query_blocks, 4 * max(width, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    cells = (stored.unionByName(asking).repartition(tasks, *cell)
             .sortWithinPartitions(*cell, "q_side"))

    def search(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        side = pdf["q_side"].to_numpy()
        if not (side == 0).any() or not (side == 1).any():
            return
        ints = np.floor(np.array(pdf["q_vec"].tolist()) * scale).astype(np.int64)
        row, ids, void = (pdf[c].to_numpy() for c in ("q_row", "q_id", "q_void"))
        data = np.flatnonzero(side == 0)
        data = data[np.lexsort((row[data], ids[data], void[data]))]
        index = ImpactIndex(ints[data], row[data])
        found = []
        for ask in np.flatnonzero(side == 1):
            at, scores = index.top(ints[ask], row[ask], k)
            found.append(pd.DataFrame({"q_ask": row[ask], "query_id": ids[ask], "q_row": row[data[at]],
                                       "vec_id": ids[data[at]], "q_void": void[data[at]], "score": scores}))
        yield pd.concat(found, ignore_index=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list = []
        for pdf in batches:
            at = cell_ids(pdf, cell) if len(pdf) else np.zeros(0, dtype=int)
            for n in np.unique(at):
                part = pdf[at == n]
                if rest and tuple(rest[0][cell].iloc[0]) != tuple(part[cell].iloc[0]):
                    yield from search(pd.concat(rest, ignore_index=True))
                    rest = []
                rest.append(part)
        if rest:
            yield from search(pd.concat(rest, ignore_index=True))

    near = cells.mapInPandas(run, "q_ask long, query_id long, q_row long, vec_id long, q_void boolean, score long")
    near = near.withColumn("vec_id", F.when(~F.col("q_void"), F.col("vec_id")))
    w = Window.partitionBy("q_ask").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "q_row")
    return (near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
