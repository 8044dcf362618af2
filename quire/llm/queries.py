"""Registered queries of the operators and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, embed_dedup, exact_dedup, fim, mixing, prefix_trie, quality, reshard, simhash, token_count, topk,
               toxicity, url_filter)
from .common import load

RANKS = "byte_bpe_50k.tiktoken"
END_OF_DOCUMENT = 50256


def vocabulary() -> bpe.Vocabulary:
    return bpe.Vocabulary.load(public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(load(spark, sf_dir, "documents"), hash_all=True)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(load(spark, sf_dir, "pages"), url_filter.train(url_filter.seed_table(spark)))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = toxicity.train(docs, load(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(~toxicity.in_training(), F.lit(False)).alias("held_out"), "score", "predicted")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(load(spark, sf_dir, "documents"), shingle_words=3, max_bits=3)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), slack=1.0)


def op6_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = reshard.reshard(load(spark, sf_dir, "documents"), new_shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(load(spark, sf_dir, "documents"), weights=(5.0, 2.0, 1.0), share=1.5, most=2)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(load(spark, sf_dir, "documents"), vocabulary(), keep=["doc_id"], with_ids=False)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.document_tokens(load(spark, sf_dir, "documents"), vocabulary(), END_OF_DOCUMENT)


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(load(spark, sf_dir, "embeddings"), least=0.98)


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(load(spark, sf_dir, "conversations"))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fim.fill_in_middle(load(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(fim.restored("output", "form").cast("binary"), 256).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_url_filter, op3_toxicity, op4_simhash, op5_quality, op6_reshard, op7_mixing,
    op8_bpe, op9_token_counts, op10_embedding_dedup, op11_topk, op12_prefix_trie, op13_fim)}

OP1_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT *, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM t)
SELECT doc_id, keep_id, group_size, coalesce(doc_id = keep_id, keep_id IS NULL) AS kept, text_sha256 FROM g
"""

OP10_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
e AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT vec_id, vec_id AS root FROM embeddings UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.vec_id),
c AS (SELECT vec_id, min(root) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
SELECT c.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, c.component_id, c.vec_id = c.component_id AS kept
FROM c LEFT JOIN n ON n.a = c.vec_id
"""

OP11_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, c.r AS cr,
         CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
k AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, cr) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM k WHERE rank <= 5
"""

# h is the CRC-32 of the decimal id: a list holds each byte and eight shifts after it, reduced bit by bit
OP12_SQL = """
WITH o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (
  SELECT conv_id, max(pos) AS own, conv_id - conv_id % 100 AS base,
         list_prepend(4294967295, flatten(list_transform(
           string_split(CAST(conv_id AS VARCHAR), ''), lambda s: [CAST(ord(s) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))) AS ops
  FROM o GROUP BY conv_id),
c AS (
  SELECT conv_id, own, base, xor(list_reduce(ops, lambda a, b: CASE WHEN b >= 0 THEN xor(a, b)
           ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 6 AS h FROM n),
t AS (
  SELECT c.conv_id, o.pos, 0 AS part, o.role, o.text FROM c JOIN o ON o.conv_id = c.base AND o.pos <= c.h
  UNION ALL
  SELECT c.conv_id, o.pos, 1, o.role, o.text FROM c JOIN o ON o.conv_id = c.conv_id AND o.pos > c.h),
s AS (
  SELECT c.conv_id, coalesce(list({'role': t.role, 'text': t.text} ORDER BY t.part, t.pos)
                             FILTER (WHERE t.pos IS NOT NULL), []) AS turns
  FROM c LEFT JOIN t ON t.conv_id = c.conv_id GROUP BY c.conv_id),
m AS (SELECT conv_id, len(turns) AS total, unnest(range(len(turns) + 1)) AS depth, turns FROM s),
x AS (
  SELECT depth, turns[1:depth] AS key, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE total = depth), '')) AS ends_sha256
  FROM m GROUP BY ALL),
kids AS (SELECT depth - 1 AS depth, key[1:depth - 1] AS key, count(*) AS n FROM x WHERE depth > 0 GROUP BY ALL),
y AS (SELECT x.*, coalesce(kids.n, 0) AS n_children FROM x LEFT JOIN kids ON kids.depth = x.depth AND kids.key = x.key),
u AS (
  SELECT unnest(range(depth + 1)) AS top, key, n_children,
         (n_convs - 1) * CASE WHEN depth > 0 THEN length(key[depth].text) ELSE 0 END AS saved FROM y),
g AS (
  SELECT top AS depth, key[1:top] AS key, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved
  FROM u GROUP BY ALL)
SELECT y.conv_id, y.depth, p.conv_id AS parent_conv_id, y.n_convs, y.n_children, g.n_leaves,
       CAST(g.saved AS BIGINT) AS saved_tokens, y.ends_sha256
FROM y JOIN g ON g.depth = y.depth AND g.key = y.key
LEFT JOIN x p ON p.depth = y.depth - 1 AND p.key = y.key[1:y.depth - 1]
"""

OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (
  SELECT *, len(units) AS n, CAST('0x' || x[1:8] AS UBIGINT) AS h1, CAST('0x' || x[9:16] AS UBIGINT) AS h2,
         CAST('0x' || x[17:24] AS UBIGINT) AS h3, CAST('0x' || x[25:32] AS UBIGINT) AS h4 FROM d),
c AS (
  SELECT *, CAST(least(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS a, CAST(greatest(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:n], '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CAST(CASE WHEN form <> 'plain' THEN length(prefix) END AS BIGINT) AS prefix_chars,
       CAST(CASE WHEN form <> 'plain' THEN length(middle) END AS BIGINT) AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(prefix || middle || suffix) AS restored_sha256
FROM p
"""

ORACLES = {"op1_exact_dedup": OP1_SQL, "op10_embedding_dedup": OP10_SQL, "op11_topk": OP11_SQL, "op12_prefix_trie": OP12_SQL, "op13_fim": OP13_SQL}
