"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are put in a hash order and their words read as one stream, cut in
blocks of one length for all sources.  Every epoch reads a source's blocks in a new hash order, until its
target is reached; the last block may be read in part, so targets are met to the word.
The mix has as many slots as blocks are read.  Slot k stands at the golden-ratio point
frac((k + 1/2) * 0.618...); the rank of that point among all is a place in the cumulative slot counts of
the sources and names the slot's source.  So counts are exact and every run of slots is
close to proportion.  Slots are then ranked per source, and the r-th slot of a source
joins the r-th of its shuffled blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import numbered, running_total, written

GOLDEN = 0.6180339887498949
BINS = 4096                  # equal parts of the places in which slots meet sources
RUN = 4096                   # blocks that one row unfolds to


def words(text: str) -> Column:
    """Number of words; null counts as none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Add target to sources(q_src, q_total): ``share`` of all words, split by weight.

    Sources in code-point order take the weights in turn.  A target stops at ``most`` times
    its source's size; the excess is shared again by weight until no target is above.
    Each round is one sum over the sources table.
    """
    n = len(weights)
    ranked = running_total(sources.withColumn("q_all", F.lit("")), "q_all", ["q_src"], out="q_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("q_rank") % n + 1).cast("int"))
    table = written(ranked.select("q_src", "q_total", weight.alias("q_weight")))
    goal = (table.agg(F.sum("q_total")).first()[0] or 0) * share
    stop = F.col("q_total") * F.lit(float(most))
    rate, capped = 0.0, None
    while True:
        full = F.col("q_weight") * F.lit(rate) >= stop
        known, open_weight, count = table.agg(
            F.sum(F.when(full, stop).otherwise(0.0)), F.sum(F.when(~full, F.col("q_weight")).otherwise(0.0)),
            F.count(F.when(full, 1))).first()
        if count == capped or not open_weight:
            break
        capped, rate = count if rate else None, (goal - known) / open_weight
    return table.withColumn("target", F.least(F.col("q_weight") * F.lit(rate), stop))


def block_order(sources: DataFrame, block_words: int, most: int, seed: int) -> DataFrame:
    """Reads (q_src, q_turn, q_epoch, q_block, q_take) of sources(q_src, q_total, target).

    The blocks of a source in the order they are read: epoch after epoch, shuffled by a hash in
    each, until round(target) words are reached; ``q_take`` words of a block are read, all but in the last.
    """
    goal = F.round("target").cast("long")
    table = (sources.where("q_total > 0").withColumn("q_goal", F.least(goal, F.col("q_total") * most)).where("q_goal > 0")
             .withColumn("q_blocks", F.expr(f"(q_total + {block_words - 1}) div {block_words}"))
             .withColumn("q_epochs", F.expr("(q_goal + q_total - 1) div q_total")))
    runs = table.select("q_src", "q_total", "q_goal", "q_blocks", F.explode(F.sequence(F.lit(0), F.col("q_epochs") - 1)).alias("q_epoch"))
    runs = runs.select("*", F.explode(F.sequence(F.lit(0), F.expr(f"(q_blocks - 1) div {RUN}"))).alias("q_run"))
    blocks = runs.select("q_src", "q_total", "q_goal", "q_blocks", "q_epoch", F.explode(F.sequence(
        F.col("q_run") * RUN, F.least((F.col("q_run") + 1) * RUN, F.col("q_blocks")) - 1)).alias("q_block"))
    blocks = (blocks.withColumn("q_mix", F.xxhash64("q_src", "q_epoch", "q_block", F.lit(seed)))
              .withColumn("q_len", F.least(F.lit(block_words), F.col("q_total") - F.col("q_block") * block_words).cast("long")))
    read = running_total(blocks, "q_src", ["q_epoch", "q_mix", "q_block"], "q_len", "q_read").where("q_read < q_goal")
    # every block but one of a source is full, so the words read before tell how many blocks were
    turn = F.col("q_epoch") * F.col("q_blocks") + F.expr(
        f"(q_read - q_epoch * q_total + {block_words - 1}) div {block_words}")
    return read.select("q_src", turn.cast("long").alias("q_turn"), F.col("q_epoch").cast("long").alias("q_epoch"), "q_block",
                       F.least("q_len", F.col("q_goal") - F.col("q_read")).alias("q_take"))


def schedule(counts: DataFrame, golden: float = GOLDEN) -> DataFrame:
    """Slots (slot, q_src, q_turn) of counts(q_src, q_slots): which source's next block each slot reads.

    Slot k has the source in whose span of the cumulative counts the rank of its point falls.
    """
    spark = counts.sparkSession
    table = written(running_total(counts.withColumn("q_all", F.lit("")), "q_all", ["q_src"], "q_slots", "q_low"))
    total = table.agg(F.sum("q_slots")).first()[0] or 0
    wide = max(1, -(-total // BINS))
    point = F.pmod((F.col("id") + F.lit(0.5)) * F.lit(golden), F.lit(1.0))
    at = running_total(spark.range(total).select(F.lit("").alias("q_all"), F.col("id").alias("slot"), point.alias("q_point")),
                       "q_all", ["q_point", "slot"], out="q_at")
    at = at.select("slot", "q_at", F.expr(f"q_at div {wide}").alias("q_bin"))
    spans = table.select("q_src", "q_low", (F.col("q_low") + F.col("q_slots")).alias("q_high"), F.explode(F.sequence(
        F.expr(f"q_low div {wide}"), F.expr(f"(q_low + q_slots - 1) div {wide}"))).alias("q_bin"))
    named = at.join(spans, "q_bin").where("q_at >= q_low and q_at < q_high").select("slot", "q_src")
    return running_total(named, "q_src", ["slot"], out="q_turn").select("slot", "q_src", "q_turn")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5,
        most: int = 2, seed: int = 17, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", block_words: int = 256, golden: float = GOLDEN,
        row_col: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, reads, pieces).

    rows: one per input row with q_row (``row_col`` if given), q_id, size, q_src, q_start (words
    of the source before it), source_size, target.  reads: one per slot of the mix with slot,
    q_src, q_turn, q_epoch, q_block, q_take.  pieces: (q_row, q_epoch, slot, words), the words of a row that a slot reads.
    No row is read more than ``most`` times over.  Documents without words are never read.  A null
    source is a source of its own, after all others.  Rows that repeat an id are read as documents of their own.
    """
    key = F.when(F.col(source_col).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source_col)))
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    sized = written(docs.select(row.alias("q_row"), F.col(id_col).alias("q_id"), words(text_col).alias("size"), key.alias("q_src"),
                                F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed)).alias("q_order")))
    sources = sized.groupBy("q_src").agg(F.sum("size").alias("q_total"))
    table = written(targets(sources, weights, share, most))
    # rows that tie here are equal in id and text
    stream = running_total(sized, "q_src", ["q_order", "q_id", "size"], "size", "q_start")
    rows = written(stream.join(table.select("q_src", F.col("q_total").alias("source_size"), "target"), "q_src").drop("q_order"))
    blocks = written(block_order(table, block_words, most, seed))
    slots = schedule(blocks.groupBy("q_src").agg(F.count("*").alias("q_slots")), golden)
    # a row per block: in order they compress so well that by their files they would pass for small tables
    reads = written(slots.join(blocks.hint("merge"), ["q_src", "q_turn"]))
    spans = rows.where("size > 0").select(
        "q_row", "q_src", "q_start", (F.col("q_start") + F.col("size")).alias("q_end"),
        F.explode(F.sequence(F.expr(f"q_start div {block_words}"), F.expr(f"(q_start + size - 1) div {block_words}"))).alias("q_block"))
    begin = F.col("q_block") * block_words
    part = F.least(F.col("q_end"), begin + F.col("q_take")) - F.greatest(F.col("q_start"), begin)
    pieces = (spans.join(reads.hint("merge"), ["q_src", "q_block"]).select("q_row", "q_epoch", "slot", part.alias("words"))
              .where("words > 0"))
    return rows, reads, pieces


def mix_table(docs: DataFrame, **options) -> DataFrame:
    """One row per input row: id, size, source_size, target, taken (words read, repeats counted), first_slot.

    ``first_slot`` is the first slot of the mix that reads the row, null for rows that none reads.
    """
    id_col = options.get("id_col", "doc_id")
    rows, _, pieces = mix(docs, **options)
    taken = pieces.groupBy("q_row").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    return (rows.join(taken.hint("merge"), "q_row", "left")
            .select(F.col("q_id").alias(id_col), "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slot_col: str | None = None,
                    block_words: int = 256, **options) -> DataFrame:
    """The mix as whole documents: a row per document and epoch that reads it; columns unchanged.

    A document comes with the block that its first word lies in; ``slot_col`` names a
    column for the slot that reads this block, by which the rows are in the order of the mix.  In that
    order documents of a source are taken until its target is reached; the last one is taken or left
    whole, whichever is nearer.  (Its block can be one that the word-wise mix did not reach; it
    then has the source's last slot.)  Rows are told apart by a number, so repeated and null ids do no harm.
    """
    seed, most = options.get("seed", 17), options.get("most", 2)
    own = numbered(docs)
    rows, reads, _ = mix(own, id_col=id_col, text_col=text_col, block_words=block_words, row_col="q_row", **options)
    last = reads.groupBy("q_src").agg(F.max("slot").alias("q_last"))
    starts = (rows.where("size > 0").withColumn("q_block", F.expr(f"q_start div {block_words}"))
              .withColumn("q_epoch", F.explode(F.sequence(F.lit(0), F.expr("least(ceil(target / source_size), "
                                                                          f"{int(most)}) - 1").cast("int")))))
    starts = (starts.withColumn("q_mix", F.xxhash64("q_src", "q_epoch", "q_block", F.lit(seed)))
              .select("q_row", "q_src", "q_start", "size", "target", "q_block", "q_epoch", "q_mix"))
    ordered = running_total(starts, "q_src", ["q_epoch", "q_mix", "q_block", "q_start"], "size", "q_before")
    chosen = ordered.where(F.col("q_before") + F.col("size") / 2 <= F.col("target"))
    chosen = (chosen.join(reads.select("q_src", "q_block", "q_epoch", "slot").hint("merge"), ["q_src", "q_block", "q_epoch"], "left")
              .join(last, "q_src").select("q_row", F.coalesce("slot", "q_last").alias("q_slot")))
    # whole texts are not sorted for this: the numbers are hashed
    out = own.join(chosen.hint("shuffle_hash"), "q_row")
    return out.select(*docs.columns, *([F.col("q_slot").alias(slot_col)] if slot_col else []))
