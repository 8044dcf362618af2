"""Resharding by minimum-cost flow.

Documents lie in old shards; new shards have capacities.  Texts are grouped in blocks by
a hash (equal texts fall in one block), block sizes are summed on the cluster and only those
sums, a fixed number, reach the driver.  A minimum-cost flow from old shard sizes to new
capacities, where a byte that stays costs 0 and a byte that moves costs 1, gives the
transfers that move the fewest bytes; blocks are dealt to fill them, large ones first, and
a last pass lets small blocks even out what whole blocks left over.  A text whose copies take
more than a small share of a shard is cut in pieces of its own; the rest of its block stays whole.
"""

from __future__ import annotations

import json
import uuid
from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import running_total, written

STAGE, JOURNAL = "_reshard-", "moves.json"
PIECES = 16                  # a text above this part of a shard is cut, in pieces of about that size


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Cheapest flow[i][j] that ships every supply within the capacities (successive shortest paths)."""
    n, m = len(supply), len(capacity)
    if sum(supply) > sum(capacity):
        raise ValueError("capacities are smaller than the sizes")
    flow = [[0] * m for _ in range(n)]
    left, room = list(supply), list(capacity)
    while any(left):
        # shortest path by reduced costs: sources -> targets, back over shipped amounts
        dist = [0 if x else None for x in left] + [None] * m
        come: list[int | None] = [None] * (n + m)
        queue = deque(i for i in range(n) if left[i])
        while queue:
            u = queue.popleft()
            if u < n:
                steps = [(n + j, cost[u][j]) for j in range(m)]
            else:
                steps = [(i, -cost[i][u - n]) for i in range(n) if flow[i][u - n]]
            for v, c in steps:
                if dist[v] is None or dist[u] + c < dist[v]:
                    dist[v], come[v] = dist[u] + c, u
                    queue.append(v)
        ends = [n + j for j in range(m) if room[j] and dist[n + j] is not None]
        v = min(ends, key=lambda e: dist[e])
        path, end = [v], v
        while come[path[-1]] is not None:
            path.append(come[path[-1]])
        path.reverse()
        amount = min(left[path[0]], room[end - n])
        for a, b in zip(path, path[1:]):
            if a >= n:
                amount = min(amount, flow[b][a - n])
        for a, b in zip(path, path[1:]):
            if a < n:
                flow[a][b - n] += amount
            else:
                flow[b][a - n] -= amount
        left[path[0]] -= amount
        room[end - n] -= amount
    return flow


def deal_blocks(blocks: list[tuple], flow: list[list[int]], capacity: list[int]) -> dict[tuple, int]:
    """Block key -> new shard, for blocks (key, old shard, bytes) and the flow between shards."""
    need = [list(row) for row in flow]
    load = [0] * len(capacity)
    placed: dict[tuple, int] = {}
    order = sorted(blocks, key=lambda b: (-b[2], b[0]))
    for key, old, size in order:
        j = max(range(len(capacity)), key=lambda j: (need[old][j], -j))
        need[old][j] -= size
        load[j] += size
        placed[key] = j
    for key, old, size in reversed(order):            # small ones first
        j = placed[key]
        to = min(range(len(capacity)), key=lambda t: load[t] - capacity[t])
        if load[j] - capacity[j] - (load[to] - capacity[to]) > size:
            placed[key] = to
            load[j] -= size
            load[to] += size
    return placed


def old_shard(block: Column, shards: int) -> Column:
    """The layout before resharding, where none is stored: blocks dealt round to the old shards."""
    return F.pmod(block, F.lit(shards)).cast("int")


def reshard(docs: DataFrame, new_shards: int = 8, old_shards: int = 5, blocks: int = 4096,
            id_col: str = "doc_id", text_col: str = "text", old_col: str | None = None) -> DataFrame:
    """One row per input row: id, size, text_crc32, old_shard, shard, slot.

    size is the UTF-8 bytes of the text plus 1 (null counts as empty).  New shards have equal
    capacities.  Equal texts lie together unless their rows take more than 1/16 of a shard; those
    are cut in equal pieces in order of id.  ``old_col`` names a column with the
    present shard (0 to old_shards - 1); without it blocks lie in shard block mod old_shards.
    Slots number the rows of a shard from 0 in order of id (nulls first); rows that repeat an id are in
    order of digest and size, and equal rows are interchangeable.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("q_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("q_text"),
        *([F.col(old_col).cast("int").alias("old_shard")] if old_col else []))
    block = F.pmod(F.col("q_text"), F.lit(blocks)).cast("int")
    rows = rows.withColumn("q_block", block)
    rows = written(rows if old_col else rows.withColumn("old_shard", old_shard(F.col("q_block"), old_shards)))
    total = rows.agg(F.sum("size")).first()[0] or 0
    capacity = [total // new_shards + (j < total % new_shards) for j in range(new_shards)]
    share = max(1, capacity[0] // PIECES)
    hot = (rows.groupBy("q_text").agg(F.sum("size").alias("s"), F.count("*").alias("n"))
           .where((F.col("s") > share) & (F.col("n") > 1)).orderBy("q_text").collect())   # about PIECES a shard at most
    spark = docs.sparkSession
    if hot:
        cuts, first = [], 1
        for r in hot:
            cuts.append((r["q_text"], first, min(r["n"], -(-r["s"] // share))))
            first += cuts[-1][2]
        table = F.broadcast(spark.createDataFrame(cuts, "q_text long, q_first long, q_cuts long"))
        copies = running_total(rows.join(table, "q_text"), "q_text", ["q_id", "old_shard"], out="q_nth")
        part = F.col("q_first") + F.col("q_nth") % F.col("q_cuts")
        copies = copies.select(*rows.columns, part.cast("int").alias("q_part"))
        rows = written(rows.join(table, "q_text", "left_anti").withColumn("q_part", F.lit(0)).unionByName(copies))
    else:
        rows = rows.withColumn("q_part", F.lit(0))
    keys = ["q_block", "old_shard", "q_part"]
    sums = rows.groupBy(*keys).agg(F.sum("size").alias("s")).collect()   # at most a fixed number
    pieces = [((r["q_block"], r["old_shard"], r["q_part"]), r["old_shard"], r["s"]) for r in sums]
    supply = [sum(s for _, old, s in pieces if old == i) for i in range(old_shards)]
    cost = [[int(i != j) for j in range(new_shards)] for i in range(old_shards)]
    placed = deal_blocks(pieces, min_cost_flow(supply, capacity, cost), capacity)
    table = spark.createDataFrame([(*k, j) for k, j in sorted(placed.items())],
                                  "q_block int, old_shard int, q_part int, shard int")
    dealt = rows.join(F.broadcast(table), keys).drop("q_block", "q_part", "q_text")
    return (running_total(dealt, "shard", ["q_id", "text_crc32", "size"], out="slot")
            .select(F.col("q_id").alias(id_col), "size", "text_crc32", "old_shard", "shard", "slot"))


def rewrite(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
            old_col: str | None = None) -> list[int]:
    """Write the shards that resharding changes under ``path``/shard=k; returns their numbers.

    A shard changes when rows leave it or enter it; the files of others are left as they are.
    The new files are written beside the old ones first, which ``docs`` may still be read from.  A journal then names
    the shards to replace: from that moment the rewrite counts, and ``finish_rewrite`` (which every rewrite calls
    first) ends one that died while it moved folders; a rewrite that died before is dropped.
    ``placed`` is what ``reshard`` gave for ``docs``, with the same ``old_col``.  Rows meet their places by id (nulls
    too), digest and size of the text, old shard, and a number among rows that agree in these, so each is written once.
    """
    spark = docs.sparkSession
    finish_rewrite(spark, path)
    moved = F.col("old_shard") != F.col("shard")
    touched = sorted({s for r in placed.where(moved).select("old_shard", "shard").distinct().collect() for s in r})
    if not touched:
        return touched
    text = F.coalesce(F.col(text_col), F.lit("")) if text_col in docs.columns else None
    own = {"q_id": F.col(id_col)}
    theirs = {"q_id": F.col(id_col)}
    if text is not None and {"size", "text_crc32"} <= set(placed.columns):
        own |= {"q_size": (F.octet_length(text) + 1).cast("long"), "q_crc": F.crc32(text.cast("binary"))}
        theirs |= {"q_size": F.col("size"), "q_crc": F.col("text_crc32")}
    if old_col:
        own["q_old"], theirs["q_old"] = F.col(old_col).cast("int"), F.col("old_shard")
    names = list(own)
    number = lambda *order: F.row_number().over(Window.partitionBy(*names).orderBy(*order))
    left = docs.withColumns(own).withColumn("q_nth", number(F.hash(*[
        c for c, t in docs.dtypes if "map<" not in t and "variant" not in t])))
    right = placed.select(*(c.alias(x) for x, c in theirs.items()), F.col("shard").alias("q_shard"))
    right = right.withColumn("q_nth", number("q_shard")).where(F.col("q_shard").isin(touched))
    right = right.select(*(F.col(x).alias(f"{x}_") for x in [*names, "q_nth"]), "q_shard")
    same = F.lit(True)
    for x in [*names, "q_nth"]:
        same = same & F.col(x).eqNullSafe(F.col(f"{x}_"))
    keep = [c for c in docs.columns if c != "shard"]
    new = f"{path}/{STAGE}{uuid.uuid4().hex}"
    (left.join(right, same).select(*keep, F.col("q_shard").alias("shard"))
     .write.partitionBy("shard").parquet(new))
    at, fs = _files(spark, path)
    filled = [s for s in touched if fs.exists(at(f"{new}/shard={s}"))]
    out = fs.create(at(f"{new}/{JOURNAL}.part"))
    out.write(bytearray(json.dumps({"filled": filled, "emptied": sorted(set(touched) - set(filled))}).encode()))
    out.close()
    if not fs.rename(at(f"{new}/{JOURNAL}.part"), at(f"{new}/{JOURNAL}")):
        raise OSError(f"{new} has no journal")
    finish_rewrite(spark, path)
    return touched


def _files(spark: SparkSession, path: str) -> tuple:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return at, at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def finish_rewrite(spark: SparkSession, path: str) -> int:
    """End the rewrites of ``path`` that have a journal, drop those without; returns how many were ended.

    Every step can be done again: a shard's new folder is there until it has been moved.  One writer at a time.
    """
    at, fs = _files(spark, path)
    ended = 0
    for status in fs.globStatus(at(f"{path}/{STAGE}*")) or []:
        new = status.getPath().toString()
        if fs.exists(at(f"{new}/{JOURNAL}")):
            journal = json.loads(spark.read.text(f"{new}/{JOURNAL}", wholetext=True).first()[0])
            for s in journal["emptied"]:
                fs.delete(at(f"{path}/shard={s}"), True)
            for s in journal["filled"]:
                if fs.exists(at(f"{new}/shard={s}")):
                    fs.delete(at(f"{path}/shard={s}"), True)
                    if not fs.rename(at(f"{new}/shard={s}"), at(f"{path}/shard={s}")):
                        raise OSError(f"{new}/shard={s} was not moved to {path}")
            ended += 1
        fs.delete(at(new), True)
    spark.catalog.refreshByPath(path)
    return ended
