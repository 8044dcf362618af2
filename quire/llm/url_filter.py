"""URL filter: host and path rules, then logistic regression on hashed character n-grams.

DataFrame functions only.  Features are the distinct hashed n-grams of the host and of
the path; the model is trained from a small labelled URL table and its weights (one per
bucket, a fixed number) are a literal of the scoring expression, so scoring is one
projection of the page scan: no join, no shuffle, no skew.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .url_seeds import seed_rows

# The rules of the contract.
RULES = (("net/", "block"), ("example.net/en/", "allow"),
         ("example.com/de/", "block"), ("org/fr/", "allow"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlModel:
    weights: list[float]        # one per hash bucket
    intercept: float
    sizes: tuple[int, ...]      # n-gram lengths


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url column; both empty without ``://``."""
    u = F.col(url)
    at = F.locate("://", u)
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"\A[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def rule_match(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict (nulls without one).  ``rules`` is a short list."""
    rule = verdict = F.lit(None).cast("string")
    for text, what in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, tail = text.partition("/")
        fits = (((host == name) | host.endswith("." + name)) & path.startswith(slash + tail))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _bucket(mark: str, size: int):
    return lambda gram: F.pmod(F.xxhash64(F.concat(F.lit(mark), gram)), F.lit(size))


def buckets(host: Column, path: Column, size: int, sizes: tuple[int, ...]) -> Column:
    """Distinct hash buckets of the n-grams of host and path, each with its own mark.

    Digits are read as 0: the number of a page says nothing about it.  A look-ahead finds
    overlapping n-grams in one pass, so long paths cost time in proportion to their length.
    """
    parts = []
    for mark, text in (("h", F.concat(F.lit("^"), host, F.lit("$"))), ("p", path)):
        text = F.translate(text, "123456789", "000000000")
        for n in sizes:
            grams = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))
            parts.append(F.transform(grams, _bucket(mark, size)))
    return F.array_distinct(F.concat(*parts))


def seed_table(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(u).alias("url"), F.lit(float(y)).alias("label")) for u, y in seed_rows()]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def train(labelled: DataFrame, size: int = 1 << 14, sizes: tuple[int, ...] = (3, 4),
          reg: float = 0.0005, prior: float = 0.25) -> UrlModel:
    """Fit on a small labelled table (url, label 1 = block); duplicates and null urls allowed.

    The labelled table may hold more bad URLs than a crawl does, so the intercept is moved
    from the table's share of label 1 to ``prior``.
    """
    host, path = host_and_path("url")
    rows = (labelled.coalesce(1).select(F.col("label").cast("double").alias("label"), host.alias("h"), path.alias("p"))
            .where(F.col("label").isNotNull())
            .select("label", buckets(F.col("h"), F.col("p"), size, sizes).cast("array<string>").alias("g")))
    terms = CountVectorizer(inputCol="g", outputCol="features", vocabSize=size, binary=True).fit(rows)
    fit = LogisticRegression(regParam=reg, maxIter=60, standardization=False).fit(terms.transform(rows))
    weights = [0.0] * size
    for term, w in zip(terms.vocabulary, fit.coefficients.toArray().tolist()):
        weights[int(term)] = w
    share = min(max(rows.agg(F.avg("label")).first()[0], 0.01), 0.99)
    shift = math.log(prior / (1 - prior)) - math.log(share / (1 - share))
    return UrlModel(weights, float(fit.intercept) + shift, sizes)


def probability(host: Column, path: Column, model: UrlModel) -> Column:
    table = F.split(F.lit(",".join(map(repr, model.weights))), ",").cast("array<double>")   # folds to a literal
    total = F.aggregate(buckets(host, path, len(model.weights), model.sizes), F.lit(model.intercept),
                        lambda acc, b: acc + F.element_at(table, (b + 1).cast("int")))
    return 1 / (1 + F.exp(-total))


def judge_urls(pages: DataFrame, model: UrlModel, id_col: str = "page_id", url_col: str = "url",
               rules=RULES) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, probability of ``block``.

    A null url, or one without ``://``, has an empty host and path and is left to the
    model, whose probability is then that of an unknown URL.  Other columns are ignored.
    """
    host, path = host_and_path("q_url")
    rows = pages.select(F.col(id_col), F.col(url_col).alias("q_url"))
    rows = rows.select(id_col, host.alias("host"), path.alias("path"))
    h, p = F.col("host"), F.col("path")
    rule, verdict = rule_match(h, p, rules)
    rows = rows.select(id_col, "host", "path", rule.alias("rule"), verdict.alias("q_v"),
                       probability(h, p, model).alias("probability"))
    by_model = F.when(F.col("probability") >= 0.5, "block").otherwise("allow")
    return rows.select(id_col, "host", "path", "rule",
                       F.coalesce("q_v", by_model).alias("verdict"), "probability")
