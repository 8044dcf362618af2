"""Language identification from character n-gram rank profiles.

Training: per language, the 300 most frequent 1- to 3-grams of the whole text of
its labelled documents (lower case, whitespace collapsed), ranked by
(count desc, n-gram asc).  Prediction: each document's own top-300 profile is
compared with every language profile by the out-of-place distance (Cavnar &
Trenkle 1994); a missing n-gram costs 300; the smallest distance wins, ties by
language code.  NULL text, text under 20 stripped characters and text without a
letter are ``eng``.

Scale: n-grams are integers counted by sorting inside Arrow batches (``functions.ngrams``).
Scoring is one narrow step: a document is a row, is read once and is not shuffled; the profiles, at most
300 x languages rows and counted before, are a sorted index in every task.  Training
sends (language, n-gram, count) rows, merged per task, to the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions import ngrams as NG
from ..functions import text as T
from ..functions.rows import explode_with_pos

PROFILE_SIZE = 300
MIN_CHARS = 20
# Characters whose n-grams are counted at a time.
PIECE_CHARS = 1 << 16
DEFAULT_LANG = "eng"
# Largest profile table that every task holds (40 MB); beyond it scoring is a join.
INDEX_PROFILE_ROWS = 2_000_000


def sample(text: str | Column) -> Column:
    """The whole text, lower case, whitespace collapsed."""
    return F.lower(T.collapse_ws(text))


def undetectable(text: str) -> Column:
    """NULL, under 20 stripped characters, or without any letter: no language can be told."""
    return F.coalesce((F.length(T.strip_ws(text)) < MIN_CHARS) | ~F.col(text).rlike(r"\p{L}"), F.lit(True))


def _sampled(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    """(keep..., _s): the sample, NULL when no language can be told."""
    return docs.select(*keep, F.when(~undetectable(text), sample(text)).alias("_s"))


def _field(docs: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names)


def doc_profiles(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, _short, _rd, ngram): each document's 300 best n-grams, rank from 0.

    A document without a detectable language has the one n-gram ``''``, which no
    profile holds, so that it keeps a row.
    """
    size, piece = PROFILE_SIZE, PIECE_CHARS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [[0] if t is None else NG.profile(t, size, piece) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).is_null(),
                                              pa.array(codes, type=pa.list_(pa.int64()))],
                                             names=[key, "_short", "_codes"])

    rows = _sampled(docs, [key], text).mapInArrow(run, f"{_field(docs, [key])}, _short boolean, _codes array<bigint>")
    return explode_with_pos(rows, [key, "_short"], "_codes", "_rd", "_code").select(
        key, "_short", "_rd", NG.ngram_of("_code").alias("ngram"))


def train_profiles(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, ngram, rank): the 300 best n-grams per language, rank from 0.

    Tasks merge the counts of their documents first, so the shuffle carries about one
    row per (language, n-gram) and task.  The top 300 per language run as a window group
    limit, so every task keeps only 300 rows per language before the final ranking.
    """
    sampled = labelled.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string"), sample(text))
    counts = (sampled.mapInArrow(NG.training_counts(PIECE_CHARS), "lang string, code long, n long")
              .groupBy("lang", "code").agg(F.sum("n").alias("cnt")))
    w = Window.partitionBy("lang").orderBy(F.desc("cnt"), F.asc("code"))
    return (counts.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= PROFILE_SIZE)
            .select("lang", NG.ngram_of("code").alias("ngram"), (F.col("_rn") - 1).cast("int").alias("rank")))


def profile_index(profiles: DataFrame) -> tuple | None:
    """The profiles as plain arrays for ``NG.Profiles``; None for more than ``INDEX_PROFILE_ROWS`` rows."""
    rows = (profiles.select("lang", NG.code_of("ngram").alias("code"), F.col("rank").cast("long").alias("rank"))
            .limit(INDEX_PROFILE_ROWS + 1).toArrow())
    if rows.num_rows > INDEX_PROFILE_ROWS:
        return None
    names = rows.column("lang").to_numpy()
    langs, lang = np.unique(names.astype(str), return_inverse=True)
    return langs.tolist(), lang, rows.column("code").to_numpy(), rows.column("rank").to_numpy(), PROFILE_SIZE


def predict(docs: DataFrame, profiles: DataFrame, key: str = "doc_id", text: str = "text",
            out: str = "lang_pred", keep: list[str] | None = None) -> DataFrame:
    """(key, keep..., out): nearest language profile per row (``eng`` for short text, or without profiles).

    A narrow step, rows keep their order; training runs when this is called.  With more
    profiles than a task should hold, rows meet them in a join by n-gram instead, and ``key`` must be unique.
    """
    keep = keep or []
    index = profile_index(profiles)
    if index is None:
        scored = _predict_by_join(docs, profiles, key, text, out)
        return docs.select(key, *keep).join(scored.withColumnRenamed(key, "_key"),
                                            F.col(key).eqNullSafe(F.col("_key"))).select(key, *keep, out)
    size, piece, default, profile, open_index = PROFILE_SIZE, PIECE_CHARS, DEFAULT_LANG, NG.profile, NG.Profiles
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = open_index(*shared.value)
        for batch in batches:
            told = [default if t is None or not known.langs else known.nearest(profile(t, size, piece))
                    for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(told, type=pa.string())],
                                             names=[*batch.schema.names[:-1], out])

    return _sampled(docs, [key, *keep], text).mapInArrow(run, f"{_field(docs, [key, *keep])}, `{out}` string")


def _predict_by_join(docs: DataFrame, profiles: DataFrame, key: str, text: str, out: str) -> DataFrame:
    """(key, out) for any number of profiles: one distance row per (document, language)."""
    prof = profiles.select("ngram", "lang", F.col("rank").alias("_rl"))
    rows = doc_profiles(docs, key, text)
    gains = (rows.join(prof, "ngram").groupBy(key, "lang")
             .agg(F.sum(F.abs(F.col("_rd") - F.col("_rl")) - PROFILE_SIZE).alias("_g")))
    best = gains.groupBy(F.col(key).alias("_key")).agg(F.min(F.struct("_g", "lang"))["lang"].alias("_best"))
    first = profiles.agg(F.min("lang").alias("_first"))
    return (rows.where("_rd = 0").select(key, "_short")
            .join(best, F.col(key).eqNullSafe(F.col("_key")), "left").join(F.broadcast(first))
            .select(key, F.when(F.col("_short"), F.lit(DEFAULT_LANG))
                    .otherwise(F.coalesce("_best", "_first")).alias(out)))


def holdout_split(labelled: DataFrame, key: str = "doc_id", holdout_mod: int = 5):
    """(train, test): documents whose id is a multiple of ``holdout_mod`` are held out."""
    test = F.col(key) % holdout_mod == 0
    return labelled.where(~test), labelled.where(test)


def accuracy(pred: DataFrame, truth: DataFrame, key: str = "doc_id", pred_col: str = "lang_pred",
             lang: str = "lang") -> DataFrame:
    """(n_eval, n_correct) of predictions against labels."""
    j = pred.join(truth.select(key, lang), key)
    return j.agg(F.count(F.lit(1)).cast("bigint").alias("n_eval"),
                 F.sum(F.when(F.col(pred_col) == F.col(lang), 1).otherwise(0)).cast("bigint")
                 .alias("n_correct"))


# J1 / P14
def lang_map_table(spark) -> DataFrame:
    return spark.createDataFrame(T.LANG_PACKS, "iso string, code string")


def lang_map_join(df: DataFrame, lang_map: DataFrame, iso: str = "lang_pred",
                  out: str = "ocr_lang") -> DataFrame:
    """Language code to OCR pack code by a broadcast lookup, passing unknown codes through.

    ``lang_map`` is a fixed 7-row table, so the broadcast is bounded.
    """
    m = F.broadcast(lang_map.select(F.col("iso").alias("_iso"), F.col("code").alias("_code")))
    return (df.join(m, F.col(iso) == F.col("_iso"), "left")
              .withColumn(out, F.coalesce(F.col("_code"), F.col(iso)))
              .drop("_iso", "_code"))


# W3
def first_page_text(text: str = "text", page: str = "page_no") -> Column:
    """Aggregate: the text of a book's first page (a NULL number comes first, as in A2), empty for NULL."""
    return F.min_by(F.coalesce(F.col(text), F.lit("")), F.struct(page))


def document_language(doc_pages: DataFrame, profiles: DataFrame, book: str = "book_id",
                      page: str = "page_no", text: str = "text", given: str | None = None) -> DataFrame:
    """(book, lang, ocr_lang): the language of each book's first selected page,
    ``given`` as it is (no mapping) when the caller fixes one, ``eng`` when the page is missing or short."""
    if given:
        books = doc_pages.select(book).distinct()
        return books.select(book, F.lit(given).alias("lang"), F.lit(given).alias("ocr_lang"))
    first = doc_pages.groupBy(book).agg(first_page_text(text, page).alias("_t"))
    pred = predict(first, profiles, key=book, text="_t", out="lang")
    return pred.select(book, "lang", T.map_lang_code("lang").alias("ocr_lang"))
