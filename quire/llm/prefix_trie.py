"""Conversation prefix trie from sorted neighbours.

Conversations are sorted by their turns; the longest common prefix (LCP) of sorted
neighbours, counted in turns, is an edge between them.  Every task takes a run of
sorted rows and unites neighbours by union-find, deepest edges first: what is united
at depth d shares d turns, so each merge of components is a branching node of the
trie, and the turns between two merges are its unary nodes.  All figures of a node are sums over the
rows and edges of its component: an edge of LCP p saves the text of p turns, and an
edge below its left row's end closes a leaf.

A run's forest is then contracted: only nodes on its two outer spines can go on in
the neighbouring runs.  These few are merged by their identity (depth and a 128-bit hash of the
turns); all others are final where they were made.

No conversation has to fit a row: turns are numbered by a range-partitioned scan and
cut in segments of ``SEGMENT`` turns.  A segment is sorted under the hash of all turns
before it, so later segments form tries of their own that hang below a node of
the segment before; what they save is carried back by sums over a conversation's segments.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import skew_join, written

SEGMENT = 64          # turns of a sorted row
ENDS = 512            # ids in one piece of an id list that crosses runs
TIE_CHARS = 32        # characters of role and text by which tied turns are dealt to tasks
NOTHING = hashlib.sha256(b"").hexdigest()
NODE = ["q_depth", "q_x1", "q_x2"]
PARENT = ["q_depth", "q_y1", "q_y2"]


# --- turns in order --------------------------------------------------------------------------------

def numbered(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Turns (q_conv, q_part, q_at, q_turn, q_chars) and their runs (q_conv, q_part, q_first, q_count, q_before).

    The position of a turn is ``q_at - q_first + q_before + 1`` of its run.  Turns go by (turn, role,
    text), nulls first.  A conversation of any size is spread over tasks; only its tied
    turns with equal beginnings of role and text share one.
    """
    src = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("q_conv"), F.col(turn).alias("q_no"),
        F.coalesce(F.col(role), F.lit("")).alias("q_role"), F.coalesce(F.col(text), F.lit("")).alias("q_text"))
    told = F.concat(F.length("q_role").cast("string"), F.lit(":"), "q_role", "q_text")
    rows = (src.repartitionByRange("q_conv", "q_no", F.substring("q_role", 1, TIE_CHARS),
                                   F.substring("q_text", 1, TIE_CHARS))
            .sortWithinPartitions("q_conv", "q_no", "q_role", "q_text")
            .select("q_conv", F.spark_partition_id().alias("q_part"),
                    F.monotonically_increasing_id().alias("q_at"),
                    F.unhex(F.md5(told.cast("binary"))).alias("q_turn"), F.length("q_text").cast("long").alias("q_chars")))
    rows = written(rows)
    earlier = Window.partitionBy("q_conv").orderBy("q_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = (rows.groupBy("q_conv", "q_part").agg(F.min("q_at").alias("q_first"), F.count("*").alias("q_count"))
            .withColumn("q_before", F.coalesce(F.sum("q_count").over(earlier), F.lit(0))))
    return rows, written(runs)


def _place() -> Column:
    return F.col("q_at") - F.col("q_first") + F.col("q_before") + 1


def rebuilt(rows: DataFrame, runs: DataFrame, group: int, most: int) -> DataFrame:
    """Turns (q_conv, q_pos, q_turn, q_chars, q_total) of the rebuilt conversations; a turnless one has q_pos 0.

    Conversation c begins with the first h original turns of conversation c - c % group
    (those it has) and goes on with its own turns after its first h, h = crc32(c) % most.
    """
    convs = (runs.groupBy("q_conv").agg(F.sum("q_count").alias("q_len"))
             .withColumn("q_h", (F.crc32(F.col("q_conv").cast("string").cast("binary")) % most).cast("long"))
             .withColumn("q_base", F.col("q_conv") - F.col("q_conv") % group))
    # at most most - 1 turns of a conversation are lent to others
    lent = (skew_join(rows.where(F.col("q_conv") % group == 0), runs, ["q_conv", "q_part"])
            .withColumn("q_pos", _place()).where(F.col("q_pos") < most)
            .groupBy(F.col("q_conv").alias("q_base"))
            .agg(F.sort_array(F.collect_list(F.struct("q_pos", "q_turn", "q_chars"))).alias("q_lent")))
    convs = (convs.join(lent, "q_base", "left")
             .withColumn("q_got", F.least("q_h", F.coalesce(F.size("q_lent"), F.lit(0))))
             .withColumn("q_got", F.greatest("q_got", F.lit(0)).cast("long"))
             .withColumn("q_total", F.col("q_got") + F.greatest(F.col("q_len") - F.col("q_h"), F.lit(0))))
    convs = written(convs)
    moved = runs.join(convs.select("q_conv", "q_h", "q_got", "q_total"), "q_conv")
    own = (skew_join(rows, moved, ["q_conv", "q_part"]).withColumn("q_pos", _place())
           .where(F.col("q_pos") > F.col("q_h"))
           .select("q_conv", (F.col("q_pos") - F.col("q_h") + F.col("q_got")).alias("q_pos"), "q_turn",
                   "q_chars", "q_total"))
    begun = (convs.select("q_conv", "q_total", F.explode(F.expr("slice(q_lent, 1, int(q_got))")).alias("t"))
             .select("q_conv", F.col("t.q_pos").alias("q_pos"), "t.q_turn", "t.q_chars", "q_total"))
    turnless = convs.where("q_total = 0").select(
        "q_conv", F.lit(0).cast("long").alias("q_pos"), F.lit(None).cast("binary").alias("q_turn"),
        F.lit(0).cast("long").alias("q_chars"), "q_total")
    return own.unionByName(begun).unionByName(turnless)


def segments(turns: DataFrame, length: int) -> DataFrame:
    """Rows (q_conv, q_seg, q_p1, q_p2, q_on, q_g1, q_g2, q_chars): up to ``length`` turns each.

    A turn is two hashes of its content and position, and a run of turns is their exclusive or.
    (q_p1, q_p2) stands for all turns before the segment; ``q_on`` tells that
    the conversation goes on after it.
    """
    real = F.col("q_pos") > 0
    turn = F.struct("q_pos", F.xxhash64(F.lit(1), "q_turn", "q_pos").alias("g1"),
                    F.xxhash64(F.lit(2), "q_pos", "q_turn").alias("g2"), F.col("q_chars").alias("c"))
    rows = (turns.withColumn("q_seg", F.floor((F.greatest(F.col("q_pos"), F.lit(1)) - 1) / length).cast("long"))
            .withColumn("q_t", F.when(real, turn))
            .groupBy("q_conv", "q_seg")
            .agg(F.sort_array(F.collect_list("q_t")).alias("q_t"), F.max("q_total").alias("q_total"),
                 F.bit_xor(F.col("q_t.g1")).alias("q_s1"), F.bit_xor(F.col("q_t.g2")).alias("q_s2")))
    rows = written(rows.select("q_conv", "q_seg", (F.col("q_total") > (F.col("q_seg") + 1) * length).alias("q_on"),
                               F.col("q_t.g1").alias("q_g1"), F.col("q_t.g2").alias("q_g2"),
                               F.col("q_t.c").alias("q_chars"), "q_s1", "q_s2",
                               (F.col("q_total") > length).alias("q_long")))
    before = Window.partitionBy("q_conv").orderBy("q_seg").rowsBetween(Window.unboundedPreceding, -1)
    long = rows.where("q_long")
    long = long.select(*long.columns, *[F.coalesce(F.bit_xor(f"q_s{k}").over(before), F.lit(0).cast("long"))
                                        .alias(f"q_p{k}") for k in (1, 2)])
    short = rows.where("not q_long").withColumns({f"q_p{k}": F.lit(0).cast("long") for k in (1, 2)})
    return short.unionByName(long).drop("q_s1", "q_s2")


# --- sorted neighbours -----------------------------------------------------------------------------

ROW = ["q_conv", "q_seg", "q_p1", "q_p2", "q_on", "q_g1", "q_g2", "q_chars", "q_te", "q_tf"]


def neighbours(rows: DataFrame) -> DataFrame:
    """Sorted rows in runs (q_run) by q_at, each run led by the last row of the run before (q_at = -1)."""
    key = ["q_p1", "q_p2", "q_g1", "q_on", "q_conv"]
    laid = written(rows.repartitionByRange(*key).sortWithinPartitions(*key)
                   .select(*ROW, F.spark_partition_id().cast("long").alias("q_run"),
                           F.monotonically_increasing_id().alias("q_at")))
    last = laid.groupBy("q_run").agg(F.max_by(F.struct(*ROW), "q_at").alias("r"))
    # one number per run, not per row
    runs = sorted(r[0] for r in laid.select("q_run").distinct().collect())
    follows = laid.sparkSession.createDataFrame(list(zip(runs, runs[1:])), "q_run long, q_next long")
    lead = (last.join(F.broadcast(follows), "q_run")
            .select("r.*", F.col("q_next").alias("q_run"), F.lit(-1).cast("long").alias("q_at")))
    return (laid.unionByName(lead).repartition(max(len(runs), 1), "q_run")
            .sortWithinPartitions("q_run", "q_at"))


class Run:
    """Arrays of consecutive sorted rows; row 0 may be the row before the run (``led``)."""

    def __init__(self, batch: pa.RecordBatch, led: bool):
        self.led = led
        col = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
        for n in ("q_conv", "q_seg", "q_p1", "q_p2", "q_on", "q_te", "q_tf"):
            setattr(self, n[2:], col[n].to_numpy(zero_copy_only=False))
        self.place = col["q_at"].to_numpy()
        offsets = col["q_g1"].offsets.to_numpy()
        self.off = offsets[:-1].astype(np.int64) - offsets[0]
        self.len = np.diff(offsets).astype(np.int64)
        g1, g2, chars = (col[n].flatten().to_numpy() for n in ("q_g1", "q_g2", "q_chars"))
        n = len(self.len)
        # hash and characters of every beginning of every row, in one flat array each
        self.x1, self.x2 = (self._begun(np.bitwise_xor.accumulate(g), p, np.bitwise_xor)
                            for g, p in ((g1, self.p1), (g2, self.p2)))
        self.c = self._begun(np.cumsum(chars), np.zeros(n, dtype=np.int64), np.add)
        self.lcp = np.full(n, -1, dtype=np.int64)
        near = np.flatnonzero((self.p1[1:] == self.p1[:-1]) & (self.p2[1:] == self.p2[:-1])
                              & (self.seg[1:] == self.seg[:-1])) + 1
        depth = 0
        while len(near):
            self.lcp[near] = depth
            near = near[np.minimum(self.len[near], self.len[near - 1]) > depth]
            a, b = self.off[near] + depth, self.off[near - 1] + depth
            near = near[(g1[a] == g1[b]) & (g2[a] == g2[b])]
            depth += 1
        # what the edge to the row before adds to every node that holds both rows
        linked = np.flatnonzero(self.lcp >= 0)
        self.saves = np.zeros(n, dtype=np.int64)
        self.saves[linked] = self.at("c", linked, self.lcp[linked])
        self.closes = np.zeros(n, dtype=np.int64)
        self.closes[linked] = self.lcp[linked] < self.len[linked - 1]

    def _begun(self, total: np.ndarray, start: np.ndarray, join: np.ufunc) -> np.ndarray:
        """Running totals that begin anew, from ``start``, at every row."""
        if not len(total):
            return total
        before = np.where(self.off > 0, total[np.maximum(self.off - 1, 0)], 0)
        undo = np.bitwise_xor if join is np.bitwise_xor else np.subtract
        return undo(total, np.repeat(undo(before, start), self.len))

    def at(self, name: str, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Value of the first ``depth`` turns of each row."""
        start = {"x1": self.p1, "x2": self.p2}.get(name)
        flat = getattr(self, name)
        out = start[row].copy() if start is not None else np.zeros(len(row), dtype=np.int64)
        some = depth > 0
        out[some] = flat[self.off[row[some]] + depth[some] - 1]
        return out


def unite(run: Run) -> dict[str, np.ndarray]:
    """The run's forest by union-find over its edges, deepest first.

    Node k < rows is row k; every merge of components at a new depth appends a branching
    node.  A row that ends where it is united is taken into the branching node (``into``).
    """
    lo, n = int(run.led), len(run.len)
    depth, first, last = run.len.tolist(), list(range(n)), list(range(n))
    count, least = [1] * n, run.conv.tolist()
    saves, closes = run.te.tolist(), run.tf.tolist()
    ends = [0 if on else 1 for on in run.on.tolist()]
    kids, parent, into = [0] * n, [-1] * n, [-1] * n
    root, node = list(range(n)), list(range(n))      # union-find over rows; a component's node
    lcp, edge_saves, edge_closes = run.lcp.tolist(), run.saves.tolist(), run.closes.tolist()
    known = lcp[lo] if n > lo else -1                 # depth down to which the run before holds the first row

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def child(v: int, d: int) -> int:
        """1 if the beginning of depth d + 1 that v goes on to is new in this run."""
        return 0 if first[v] == lo and d + 1 <= known else 1

    inner = np.arange(lo + 1, n)
    inner = inner[run.lcp[lo + 1:] >= 0]
    for i in inner[np.argsort(-run.lcp[inner], kind="stable")].tolist():
        d = lcp[i]
        left, right = find(i - 1), find(i)
        a, b = node[left], node[right]
        if depth[a] > d:
            v = len(depth)
            for column, value in ((depth, d), (first, first[a]), (last, last[a]), (count, count[a]),
                                  (least, least[a]), (saves, saves[a]), (closes, closes[a]), (ends, 0),
                                  (kids, child(a, d)), (parent, -1), (into, -1)):
                column.append(value)
            parent[a] = v
        else:
            v = a
        if depth[b] > d:
            parent[b] = v
            kids[v] += child(b, d)
        else:                                          # a single row that ends here
            into[b] = v
            ends[v] += ends[b]
        last[v] = last[b]
        count[v] += count[b]
        least[v] = min(least[v], least[b])
        saves[v] += saves[b] + edge_saves[i]
        closes[v] += closes[b] + edge_closes[i]
        root[right] = left
        node[left] = v
    out = {k: np.array(v, dtype=np.int64) for k, v in dict(
        depth=depth, first=first, last=last, count=count, least=least, saves=saves, closes=closes, ends=ends,
        kids=kids, parent=parent, into=into).items()}
    out["kept"] = np.flatnonzero((out["into"] < 0) & (out["first"] >= lo))
    return out


def _ragged(counts: np.ndarray) -> np.ndarray:
    """0..counts[0]-1, 0..counts[1]-1, ..."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


PIECES = pa.schema([("q_kind", pa.int8()), ("q_depth", pa.int64()), ("q_x1", pa.int64()), ("q_x2", pa.int64()),
                    ("q_y1", pa.int64()), ("q_y2", pa.int64()), ("q_least", pa.int64()), ("q_above", pa.int64()),
                    ("q_count", pa.int64()), ("q_kids", pa.int64()), ("q_closes", pa.int64()),
                    ("q_saves", pa.int64()), ("q_chars", pa.int64()), ("q_at", pa.int64()),
                    ("q_ends", pa.string())])
FINAL, WAITING, OPEN, LISTED = range(4)


def pieces(run: Run, length: int) -> Iterator[pa.RecordBatch]:
    """The nodes of a run: final ones, those whose parent is open, open ones, and id lists of open ones."""
    lo = int(run.led)
    if len(run.len) <= lo:
        return
    t = unite(run)
    v = t["kept"]
    up = t["parent"][v]
    top = np.where(up >= 0, t["depth"][up], -1)          # the chain of v begins below this depth
    counts = t["depth"][v] - top
    v, up, top = (np.repeat(x, counts) for x in (v, up, top))
    d = top + 1 + _ragged(counts)
    row, end = t["first"][v], d == t["depth"][v]
    known = int(run.lcp[lo])
    seg = run.seg[row]
    deepest = len(run.len) - 1

    def is_open(d: np.ndarray, node: np.ndarray) -> np.ndarray:
        first, last = t["first"][node], t["last"][node]
        return (((first == lo) & (d <= known)) | (last == deepest)
                | ((d == length) & run.on[last]) | ((d == 0) & (run.seg[first] > 0)))

    open_left = (row == lo) & (d <= known)
    opened = is_open(d, v)
    has_parent = (d > 0) | (seg > 0)
    over = np.where(d - 1 > top, v, np.where(up >= 0, up, v))
    above = np.maximum(d - 1, 0)
    above_open = has_parent & is_open(above, over)
    hung = (d == 0) & (seg > 0)                           # stands for a node of the segment before
    kids = np.where(end, t["kids"][v], np.where((row == lo) & (d + 1 <= known), 0, 1))
    saves = t["saves"][v] + np.where(open_left, run.saves[lo], 0)
    closes = t["closes"][v] + np.where(open_left, run.closes[lo], 0)
    ends = np.where(end, t["ends"][v], 0)
    depth = seg * length + d
    x1, x2 = run.at("x1", row, d), run.at("x2", row, d)
    some = np.flatnonzero(ends > 0)
    digest = np.full(len(v), NOTHING, dtype=object)
    lists = []
    for k in some.tolist():
        start, stop = int(row[k]), int(row[k] + ends[k])
        if opened[k]:
            lists += [(k, int(run.place[at]), ",".join(map(str, run.conv[at:min(at + ENDS, stop)].tolist())))
                      for at in range(start, stop, ENDS)]
        else:
            digest[k] = hashlib.sha256(",".join(map(str, run.conv[start:stop].tolist())).encode()).hexdigest()
    kind = np.where(opened, OPEN, np.where(above_open, WAITING, FINAL))
    blank = np.zeros(len(v), dtype=np.int64)

    def some_int(values: np.ndarray, valid: np.ndarray) -> pa.Array:
        return pa.array(values, type=pa.int64(), mask=~valid)

    yield pa.RecordBatch.from_arrays([
        pa.array(kind, type=pa.int8()), pa.array(depth), pa.array(x1), pa.array(x2),
        some_int(run.at("x1", row, above), d > 0), some_int(run.at("x2", row, above), d > 0),
        some_int(t["least"][v], ~hung), some_int(t["least"][over], has_parent & ~above_open),
        pa.array(np.where(hung, 0, t["count"][v])), pa.array(kids), pa.array(np.where(hung, 0, closes)),
        pa.array(np.where(hung, 0, saves)), pa.array(np.where(hung, 0, run.at("c", row, above))), pa.array(blank),
        pa.array([None if o else x for o, x in zip(opened.tolist(), digest.tolist())], type=pa.string())],
        schema=PIECES)
    if lists:
        at = np.array([k for k, _, _ in lists])
        none = pa.array([None] * len(lists), type=pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([LISTED] * len(lists), type=pa.int8()), pa.array(depth[at]), pa.array(x1[at]), pa.array(x2[at]),
             *[none] * 9, pa.array([p for _, p, _ in lists], type=pa.int64()),
             pa.array([s for _, _, s in lists], type=pa.string())], schema=PIECES)


def by_run(batches: Iterator[pa.RecordBatch]) -> Iterator[Run]:
    """Runs of at most a batch, each led by the sorted row before it if there is one."""
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        run_no = batch.column(batch.schema.get_field_index("q_run")).to_numpy()
        edges = np.r_[0, np.flatnonzero(run_no[1:] != run_no[:-1]) + 1, len(run_no)]
        for a, b in zip(edges[:-1], edges[1:]):
            part = batch.slice(a, b - a)
            led = part.column(part.schema.get_field_index("q_at"))[0].as_py() == -1
            if not led and before is not None and before[0] == run_no[a]:
                part = pa.Table.from_batches([before[1], part]).combine_chunks().to_batches()[0]
                led = True
            before = (run_no[a], part.slice(part.num_rows - 1, 1))
            yield Run(part, led)


def carried_back(rows: DataFrame) -> DataFrame:
    """``rows`` with q_te, q_tf: characters saved and leaves closed by the conversation's later segments."""
    zero = {k: F.lit(0).cast("long") for k in ("q_te", "q_tf")}
    short = rows.where("not q_long").withColumns(zero)
    long = rows.where("q_long")
    later = neighbours(long.where("q_seg > 0").withColumns(zero))

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in by_run(batches):
            lo = int(run.led)
            yield pa.RecordBatch.from_arrays([pa.array(x[lo:], type=pa.int64()) for x in
                                              (run.conv, run.seg, run.saves, run.closes)],
                                             names=["q_conv", "q_seg", "q_e", "q_f"])

    found = later.mapInArrow(edges, "q_conv long, q_seg long, q_e long, q_f long")
    after = Window.partitionBy("q_conv").orderBy(F.desc("q_seg")).rowsBetween(Window.unboundedPreceding, -1)
    long = long.join(found, ["q_conv", "q_seg"], "left")
    long = long.select(*rows.columns, F.coalesce(F.sum("q_e").over(after), F.lit(0)).alias("q_te"),
                       F.coalesce(F.sum("q_f").over(after), F.lit(0)).alias("q_tf"))
    return short.unionByName(long)


# --- merging across runs ---------------------------------------------------------------------------

def listed_digests(lists: DataFrame) -> DataFrame:
    """(NODE, q_digest): SHA-256 of each node's id list, hashed as a stream of its pieces in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, state.hexdigest())],
                                              names=[*NODE, "q_digest"])
        for batch in batches:
            for *node, text in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 4))):
                if node != now:
                    if now is not None:
                        yield done()
                    now, state = node, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
        if now is not None:
            yield done()

    return (lists.select(*NODE, "q_at", "q_ends").repartition(*NODE).sortWithinPartitions(*NODE, "q_at")
            .mapInArrow(run, "q_depth long, q_x1 long, q_x2 long, q_digest string"))


def trie(rows: DataFrame, length: int = SEGMENT) -> DataFrame:
    """One row per node of the trie over segment rows (see ``segments``)."""
    if rows.agg(F.coalesce(F.bool_or("q_long"), F.lit(False))).first()[0]:
        rows = carried_back(rows)
    else:
        rows = rows.withColumns({k: F.lit(0).cast("long") for k in ("q_te", "q_tf")})

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in by_run(batches):
            yield from pieces(run, length)

    schema = ", ".join(f"{f.name} {'byte' if f.type == pa.int8() else 'string' if f.type == pa.string() else 'long'}"
                       for f in PIECES)
    made = written(neighbours(rows).mapInArrow(grow, schema))
    opened = (made.where(F.col("q_kind") == OPEN).groupBy(*NODE)
              .agg(F.max("q_y1").alias("q_y1"), F.max("q_y2").alias("q_y2"), F.min("q_least").alias("q_least"),
                   *[F.sum(c).alias(c) for c in ("q_count", "q_kids", "q_closes", "q_saves")],
                   F.max("q_chars").alias("q_chars"), F.max("q_above").alias("q_above")))
    digests = listed_digests(made.where(F.col("q_kind") == LISTED))
    opened = written(opened.join(digests, NODE, "left")
                     .withColumn("q_ends", F.coalesce("q_digest", F.lit(NOTHING))).drop("q_digest"))
    cols = ["q_depth", "q_y1", "q_y2", "q_least", "q_count", "q_kids", "q_closes", "q_saves", "q_chars", "q_ends"]
    waiting = made.where(F.col("q_kind") == WAITING).select(*cols).unionByName(
        opened.where("q_depth > 0 and q_above is null").select(*cols))
    parents = opened.select((F.col("q_depth") + 1).alias("q_depth"), F.col("q_x1").alias("q_y1"),
                            F.col("q_x2").alias("q_y2"), F.col("q_least").alias("q_above"))
    found = skew_join(waiting, parents, PARENT)
    out = (made.where(F.col("q_kind") == FINAL).select(*cols, "q_above")
           .unionByName(found.select(*cols, "q_above"))
           .unionByName(opened.where("q_depth = 0 or q_above is not null").select(*cols, "q_above")))
    return out.select(F.col("q_least").alias("conv_id"), F.col("q_depth").alias("depth"),
                      F.col("q_above").alias("parent_conv_id"), F.col("q_count").alias("n_convs"),
                      F.col("q_kids").alias("n_children"), (F.col("q_closes") + 1).alias("n_leaves"),
                      (F.col("q_saves") - (F.col("q_count") - 1) * F.col("q_chars")).alias("saved_tokens"),
                      F.col("q_ends").alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", group: int = 100, most: int = 6, length: int = SEGMENT) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (``rebuilt``), root included.

    Columns, all long but the last: conv_id (least member), depth, parent_conv_id (the parent's
    conv_id, null at the root), n_convs, n_children, n_leaves and saved_tokens of the subtree (each
    node's members but one times the characters of its last text), ends_sha256 (of the ascending ids of the
    members that end at the node, joined by commas).

    A null role or text is empty; turns go by (turn, role, text), null turns first, repeated
    rows are turns of their own; rows without a conversation id belong to none and are left
    out.  Without any conversation there is no node.  Texts are compared whole, by a digest.  Extra columns
    are ignored, so their names cannot clash.
    """
    rows, runs = numbered(conversations, conv, turn, role, text)
    return trie(segments(rebuilt(rows, runs, group, most), length), length)
