"""Section summaries: request rows (M1), extractive summaries (M2), stored results (M3),
with output names (K3) and errors kept as text (X2).

The reference sends each section to a remote model.  Here the summary is computed
on the cluster: the k sentences of a section with the highest corpus-weighted
term-frequency score (Luhn 1958), in reading order.

Rules (integers only, full tie-breaks): tokens are lower-case runs of word
characters; n = number of sections, df = sections holding the token; tokens with
2*df > n are too common and ignored; a sentence scores
``(1000 * sum of section tf over its distinct kept tokens) div (its token count)``;
the top k by (score desc, position asc) are joined by one space in reading order.

Scale: a section is one row from end to end.  The only shuffle is of (token, df) rows,
counted per task before they move.  The too-common tokens, fewer than 2 x (average distinct
tokens per section), are read back up to ``COMMON_LIMIT`` and travel to the tasks; beyond that
limit each section meets its own too-common tokens in a join.  Sentences are then scored
and chosen inside Arrow batches of whole sections, ``AT_ONCE`` tokens at a time, so that a task's
memory is that of one batch and of its largest section.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as RX
from ..functions import text as T
from ..functions.rows import explode_with_pos
from ..session import ensure_checkpoint_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP_K = 3
SCORE_SCALE = 1000
# Most too-common tokens that travel to every task.
COMMON_LIMIT = 10_000
# Tokens and sentences scored at a time; a larger section is scored alone.
AT_ONCE = 1 << 17
# fixed value: the remote model named in request rows and output names.
REQUEST_MODEL = "o3-mini"
EXTRACTIVE_MODEL = "extractive"
EMPTY_SECTION = "empty section"


# K3
def summary_name(model: str, name: Column) -> Column:
    return F.concat(F.lit(f"sum_{model}_"), name)


def _file_name(slug: Column) -> Column:
    return F.concat(slug, F.lit(".md"))


# M1
def summary_requests(chapters: DataFrame, model: str = REQUEST_MODEL, key: str = "doc_id") -> DataFrame:
    """(key, seq, prompt, out_name): one request per chapter file, ready for batch inference."""
    return chapters.select(key, "seq", T.prompt_text("rendered").alias("prompt"),
                           summary_name(model, _file_name(F.col("slug"))).alias("out_name"))


def _tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(RX.TOKEN), 0)


def _tokenized(sections: DataFrame, keep: list[str], body: str) -> DataFrame:
    """(keep..., _blank, _ss, _toks): sentences of each section and the tokens of each sentence."""
    blank = (F.col(body).isNull() | T.is_blank(body)).alias("_blank")
    return (sections.select(*keep, blank, F.coalesce(T.split_sentences(body), F.array()).alias("_ss"))
            .withColumn("_toks", F.transform("_ss", _tokens)))


def _document_frequencies(sections: DataFrame, body: str) -> DataFrame:
    """(token, df); the empty token stands for the section itself, so its df is their number."""
    rows = _tokenized(sections, [], body)
    tokens = F.concat(F.array(F.lit("")), F.array_distinct(F.flatten("_toks")))
    return (explode_with_pos(rows, [], tokens, "_j", "token")
            .groupBy("token").agg(F.count(F.lit(1)).alias("df")))


def common_tokens(sections: DataFrame, body: str = "body", limit: int = COMMON_LIMIT) -> list[str] | None:
    """Tokens in more than half of the sections; None when there are more than ``limit``."""
    top = (_document_frequencies(sections, body).orderBy(F.desc("df"), "token").limit(limit + 2)
           .toArrow().to_pylist())
    n = top[0]["df"] if top else 0
    common = [r["token"] for r in top if r["token"] != "" and 2 * r["df"] > n]
    return common if len(common) <= limit else None


def _own_common(sections: DataFrame, ids: list[str], body: str) -> DataFrame:
    """(ids..., _common): each section's too-common tokens, for any number of them."""
    df = _document_frequencies(sections, body)
    n = df.where("token = ''").select(F.col("df").alias("_n"))      # one row
    common = df.where("token != ''").join(F.broadcast(n)).where(2 * F.col("df") > F.col("_n")).select("token")
    own = explode_with_pos(_tokenized(sections, ids, body), ids, F.array_distinct(F.flatten("_toks")), "_j", "token")
    return own.join(common, "token").groupBy(*ids).agg(F.collect_list("token").alias("_common"))


def _pieces(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The batches cut between sections into pieces of up to ``most`` tokens and sentences."""
    for batch in batches:
        toks = batch.column(batch.schema.get_field_index("_toks"))
        sentences = np.cumsum(pc.list_value_length(toks).to_numpy())
        tokens = np.cumsum(np.r_[0, pc.list_value_length(toks.flatten()).to_numpy()])
        upto = tokens[sentences] + sentences                          # up to the end of each section
        at = 0
        while at < batch.num_rows:
            done = upto[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(upto, done + most, side="right")))
            yield batch.slice(at, end - at)
            at = end


def _summaries(common: list[str] | None, k: int, scale: int, most: int = AT_ONCE):
    """Task function: batches (keep..., _blank, _ss, _toks[, _common]) to (keep..., _blank, summary)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(common or [], type=pa.string())
        for batch in _pieces(batches, most):
            col = dict(zip(batch.schema.names, batch.columns))
            n = batch.num_rows
            per_section = pc.list_value_length(col["_ss"]).to_numpy()
            section = np.repeat(np.arange(n), per_section)            # of each sentence
            sentences, inner = col["_ss"].flatten(), col["_toks"].flatten()
            per_sentence = pc.list_value_length(inner).to_numpy()
            flat = inner.flatten()
            if common is None:
                extra = col["_common"].flatten()
                coded = pa.concat_arrays([flat, extra]).dictionary_encode()
                code, width = coded.indices.to_numpy(), len(coded.dictionary)
                lists = pc.fill_null(pc.list_value_length(col["_common"]), 0).to_numpy()
                ignored = np.repeat(np.arange(n), lists) * width + code[len(flat):]
                code = code[:len(flat)]
            else:
                coded = flat.dictionary_encode()
                code, width = coded.indices.to_numpy(), len(coded.dictionary)
                ignored = None
            sentence = np.repeat(np.arange(len(sentences)), per_sentence)   # of each token
            key = section[sentence] * width + code
            if ignored is None:
                kept = np.flatnonzero(~pc.is_in(coded.dictionary, value_set=known).to_numpy(zero_copy_only=False)[code])
            else:
                kept = np.flatnonzero(~np.isin(key, ignored))
            _, at, tf = np.unique(key[kept], return_inverse=True, return_counts=True)
            tf = tf[at]                                              # of each kept token in its section
            _, once = np.unique(sentence[kept] * width + code[kept], return_index=True)
            total = np.bincount(sentence[kept[once]], tf[once], minlength=len(sentences)).astype(np.int64)
            score = np.where(per_sentence > 0, scale * total // np.maximum(per_sentence, 1), 0)
            best = np.lexsort((np.arange(len(sentences)), -score, section))
            first = np.cumsum(per_section) - per_section
            rank = np.arange(len(best)) - first[section[best]]
            chosen = np.sort(best[rank < k])
            told: list[list[str]] = [[] for _ in range(n)]
            for s, t in zip(section[chosen].tolist(), sentences.take(pa.array(chosen)).to_pylist()):
                told[s].append(t)
            summary = pa.array([None if b else " ".join(t) for b, t in zip(col["_blank"].to_pylist(), told)],
                               type=pa.string())
            keep = [c for c in batch.schema.names if c not in ("_ss", "_toks", "_common")]
            yield pa.RecordBatch.from_arrays([*[col[c] for c in keep], summary], names=[*keep, "summary"])

    return run


# M2
def extractive_summary(sections: DataFrame, key: str = "doc_id", seq: str = "seq",
                       body: str = "body", k: int = TOP_K, common: list[str] | None = None,
                       limit: int = COMMON_LIMIT) -> DataFrame:
    """(key, seq, [slug,] summary, error) for every section (slug carried when present).

    The too-common tokens are counted over ``sections`` when this is called, unless
    ``common`` gives them (a fixed list lets sections be summarized apart from each other).  A
    NULL body is an empty section.  (key, seq) must name a section only beyond ``limit`` common tokens.
    """
    ids = [key, seq, *[c for c in ("slug",) if c in sections.columns]]
    if common is None:
        common = common_tokens(sections, body, limit)
    rows = _tokenized(sections, ids, body)
    if common is None:
        rows = rows.join(_own_common(sections, [key, seq], body), [key, seq], "left").select(
            *ids, "_blank", "_ss", "_toks", "_common")
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in [*ids, "_blank"])
    out = rows.mapInArrow(_summaries(common, k, SCORE_SCALE), f"{schema}, summary string")
    return out.select(*ids, "summary", F.when(F.col("_blank"), F.lit(EMPTY_SECTION)).alias("error"))


# M3 (+ X2)
def store_summaries(summaries: DataFrame, chapters: DataFrame, model: str = EXTRACTIVE_MODEL,
                    key: str = "doc_id") -> DataFrame:
    """(key, seq, out_name, text): stored result per section; a failure is ``Error: <msg>``."""
    named = (summaries if "slug" in summaries.columns
             else summaries.join(chapters.select(key, "seq", "slug"), [key, "seq"]))
    return named.select(
        key, "seq", summary_name(model, _file_name(F.col("slug"))).alias("out_name"),
        F.when(F.col("error").isNotNull(), F.concat(F.lit("Error: "), F.col("error")))
        .otherwise(F.col("summary")).alias("text"))


# M3, kept up to date
STORE_COLUMNS = ("seq", "out_name", "text", "content_hash")


def update_summaries(chapters: DataFrame, store: str, summarize: Callable[[DataFrame], DataFrame],
                     model: str = EXTRACTIVE_MODEL, key: str = "doc_id", buckets: int = 256) -> dict[str, int]:
    """Bring a stored summary table in line with ``chapters`` without redoing unchanged sections.

    The store is a Parquet table (key, seq, out_name, text, content_hash) in ``buckets`` partitions by a hash
    of the key.  A section is summarized only if the store has no row with its (key, seq)
    and content hash (model, slug and body); a section that is gone is dropped.  Only the
    partitions that hold such sections are rewritten; nothing is written when there are none.  ``summarize`` must judge a
    section by itself, as a remote model does; for ``extractive_summary`` fix ``common``.  Errors are stored
    as text and not retried until the section changes.  A run that dies leaves each partition old or
    new; running it again finishes.  NULL keys are sections like others.

    Returns counts: sections, summarized, dropped, partitions rewritten.
    """
    spark = chapters.sparkSession
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    digest = F.sha2(F.concat_ws("\x1f", F.lit(model), F.coalesce("slug", F.lit("")), F.coalesce("body", F.lit(""))), 256)
    now = chapters.withColumns({"content_hash": digest, "bucket": bucket})
    root = spark._jvm.org.apache.hadoop.fs.Path(store)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    fields = f"`{key}` {chapters.schema[key].dataType.simpleString()}, " + ", ".join(
        f"{c} {chapters.schema['seq'].dataType.simpleString() if c == 'seq' else 'string'}" for c in STORE_COLUMNS)
    fields += ", bucket int"
    old = spark.read.schema(fields).parquet(store) if fs.exists(root) else spark.createDataFrame([], fields)

    def same(a: DataFrame, b: DataFrame) -> Column:
        return (a[key].eqNullSafe(b[key]) & a["seq"].eqNullSafe(b["seq"])
                & (a["content_hash"] == b["content_hash"]))

    fresh = now.join(old, same(now, old), "left_anti")
    gone = old.join(now, same(old, now), "left_anti")
    counts = (fresh.select("bucket", F.lit(1).alias("_f"), F.lit(0).alias("_g"))
              .unionByName(gone.select("bucket", F.lit(0).alias("_f"), F.lit(1).alias("_g")))
              .groupBy("bucket").agg(F.sum("_f").alias("f"), F.sum("_g").alias("g")).collect())   # at most ``buckets`` rows
    done = {"sections": now.count(), "summarized": sum(r.f for r in counts), "dropped": sum(r.g for r in counts),
            "partitions": len(counts)}
    if not counts:
        return done
    touched = [r.bucket for r in counts]
    kept = old.where(F.col("bucket").isin(touched)).join(now, same(old, now), "left_semi")
    made = store_summaries(summarize(fresh), fresh, model, key)
    made = made.join(fresh.select(F.col(key).alias("_k"), F.col("seq").alias("_s"), "content_hash", "bucket"),
                     made[key].eqNullSafe(F.col("_k")) & made["seq"].eqNullSafe(F.col("_s"))).drop("_k", "_s")
    ensure_checkpoint_dir(spark)
    # the old partitions are read here and replaced below
    rows = kept.unionByName(made.select(*kept.columns)).checkpoint(eager=True)
    left = {r[0] for r in rows.select("bucket").distinct().collect()}
    (rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket").parquet(store))
    for b in touched:
        if b not in left:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{store}/bucket={b}"), True)
    return done
