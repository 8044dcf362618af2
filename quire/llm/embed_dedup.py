"""Embedding near-duplicates by a pivot-permutation index.

Every vector is described by its nearest reference points (pivots) in order.  Inverted
lists post vectors under the pivots; a list of one pivot would be long, so lists are
intersected two at a time: a vector is posted under every two of its ``head`` nearest
pivots.  For every pair that meets, the shared pivots among the ``depth`` nearest are counted, pairs
with fewer than ``shared`` dropped and the others verified by their cosine in double
precision.  A pair that meets in several lists is counted in one of them only, the list of
its two smallest common pivots, so links are counted without being collected.

Equal vectors of a label are collapsed first and weigh by their number.  Pivots are a
hash sample of the distinct vectors, for each length the square root of their number up to
``max_pivots``; every vector is indexed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cell_pairs, components, forest, pair_cells, written

LEAST_PIVOTS = 24
OVERSAMPLE = 8               # sampled vectors per pivot wanted
VERIFY_AT_ONCE = 1 << 15     # pairs whose vectors are gathered at a time


def usable(vec: str, label: str) -> Column:
    """Label and vector present, components finite and not all zero."""
    v = F.col(vec)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall(v, lambda x: x == 0)
    return F.coalesce(F.col(label).isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~bad & ~zero,
                      F.lit(False))


def units(rows: list) -> np.ndarray:
    """Vectors of one length as unit rows in double precision."""
    x = np.array([np.asarray(r, dtype=np.float64) for r in rows])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def spread(points: np.ndarray, apart: float) -> np.ndarray:
    """Unit rows of which no two have a cosine of ``apart`` or more, taken in their order."""
    kept = points[:0]
    for at in range(0, len(points), 512):
        some = points[at:at + 512]
        if len(kept):
            some = some[(some @ kept.T).max(axis=1) < apart]
        near = some @ some.T >= apart
        use = np.zeros(len(some), dtype=bool)
        for i in range(len(some)):
            use[i] = not (near[i] & use).any()
        kept = np.r_[kept, some[use]]
    return kept


def choose_pivots(reps: DataFrame, max_pivots: int, max_lengths: int = 10_000, apart: float = 0.9) -> dict[int, np.ndarray]:
    """Reference points by vector length: a hash sample of about the square root of the vectors of that length.

    At least 24 are aimed at and at most ``max_pivots``; points near to one another (cosine
    ``apart`` or more) count once, or members of one large group would be described by the order of its own
    copies, which is noise.  Beyond the ``max_lengths`` most frequent lengths there are none.
    """
    dim = F.size("q_vec").alias("q_dim")
    counts = (reps.groupBy(dim).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "q_dim").limit(max_lengths)
              .withColumn("q_aim", F.greatest(F.lit(float(LEAST_PIVOTS)), F.least(F.sqrt("n"), F.lit(float(max_pivots)))))
            .withColumn("q_share", F.least(F.lit(1.0), F.col("q_aim") * OVERSAMPLE / F.col("n"))))
    chance = F.pmod(F.xxhash64("q_rep", F.lit(3)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = (reps.select("q_rep", "q_vec", dim).join(F.broadcast(counts), "q_dim").where(chance < F.col("q_share"))
            .orderBy("q_rep").select("q_vec", "q_aim").toPandas())
    out = {}
    for d, part in some.groupby(some["q_vec"].map(len)):
        points, aim, limit = units(part["q_vec"].tolist()), int(part["q_aim"].iloc[0]), apart
        out[d] = spread(points, limit)[:aim]
        while len(out[d]) < min(LEAST_PIVOTS // 2, len(points)) and limit < 1 - 1e-6:   # crowded, as short vectors are
            limit = 1 - (1 - limit) / 4
            out[d] = spread(points, limit)[:aim]
    return out


def linked(reps: DataFrame, pivots: dict[int, np.ndarray], least: float, head: int, depth: int,
           shared: int) -> DataFrame:
    """Rows (a, b, n): n > 0 adds links to vector a; b not null joins the components of a and b.

    Lists hold numbers only; vectors follow once the lists of one row are gone.
    """
    pairs = list(combinations(range(head), 2))
    kind = reps.schema["q_vec"].dataType.simpleString()

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            own = pdf[["q_rep", "q_label", "q_n"]]
            for size, at in pdf.groupby(pdf["q_vec"].map(len), sort=False).indices.items():
                points, part = pivots.get(int(size)), own.iloc[at]
                if points is None or len(points) < depth:
                    yield part.assign(q_dim=size, q_p=-1, q_q=-1, q_near=[[-1] * depth] * len(part))
                    continue
                order = np.argsort(-(units(pdf["q_vec"].iloc[at].tolist()) @ points.T), axis=1, kind="stable")
                near = order[:, :depth]
                first = np.sort(near[:, :head], axis=1)
                for p, q in pairs:
                    yield part.assign(q_dim=size, q_p=first[:, p], q_q=first[:, q], q_near=near.tolist())

    # narrow hash of the vector's place, so that blocks of a long list are dealt evenly
    posted = reps.mapInPandas(describe, "q_rep long, q_label string, q_n long, "
                                        "q_dim int, q_p int, q_q int, q_near array<int>")

    def with_vectors(cells: DataFrame) -> DataFrame:
        return cells.join(reps.select("q_rep", F.col("q_vec").cast(kind)), "q_rep")

    def judge(pdf: pd.DataFrame, ids: np.ndarray) -> Iterator[pd.DataFrame]:
        near = np.array(pdf["q_near"].tolist(), dtype=np.int32).reshape(len(pdf), -1)
        first = np.sort(near[:, :head], axis=1)
        p, q = pdf["q_p"].to_numpy(), pdf["q_q"].to_numpy()
        rep, weight = pdf["q_rep"].to_numpy(), pdf["q_n"].to_numpy()
        count = np.zeros(len(pdf), dtype=np.int64)
        dims = pdf["q_dim"].to_numpy()
        rows = np.empty(len(pdf), dtype=np.int64)
        unit = {}
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            rows[at] = np.arange(len(at))
            unit[d] = units([pdf["q_vec"].iloc[k] for k in at])
        left, right = [], []
        for i, j in cell_pairs(pdf, ids, 1 << 18):
            if not len(i):
                continue
            common = (first[i][:, :, None] == first[j][:, None, :]).any(axis=2)
            nth = np.cumsum(common, axis=1)
            a = np.take_along_axis(first[i], (nth == 1).argmax(axis=1)[:, None], 1)[:, 0]
            b = np.take_along_axis(first[i], (nth == 2).argmax(axis=1)[:, None], 1)[:, 0]
            own = (p[i] < 0) | ((a == p[i]) & (b == q[i]))
            i, j = i[own], j[own]
            tally = (near[i][:, :, None] == near[j][:, None, :]).any(axis=2).sum(axis=1)
            i, j = i[tally >= shared], j[tally >= shared]
            for at in range(0, len(i), VERIFY_AT_ONCE):
                x, y = i[at:at + VERIFY_AT_ONCE], j[at:at + VERIFY_AT_ONCE]
                ok = np.zeros(len(x), dtype=bool)
                for d, u in unit.items():
                    of = np.flatnonzero(dims[x] == d)
                    ok[of] = np.einsum("nd,nd->n", u[rows[x[of]]], u[rows[y[of]]]) >= least
                x, y = x[ok], y[ok]
                np.add.at(count, x, weight[y])
                np.add.at(count, y, weight[x])
                left.append(rep[x])
                right.append(rep[y])
        hit = np.flatnonzero(count)
        if len(hit):
            a, b = forest(np.concatenate(left), np.concatenate(right))
            yield pd.DataFrame({"a": np.r_[rep[hit], a], "n": np.r_[count[hit], np.zeros(len(a), dtype=np.int64)],
                                "b": pd.array([None] * len(hit) + b.tolist(), dtype="Int64")})

    return pair_cells(posted, ["q_label", "q_dim", "q_p", "q_q"], "q_rep", judge, "a long, n long, b long",
                      late=with_vectors)


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                 label_col: str = "label", least: float = 0.98, head: int = 4, depth: int = 8,
                 shared: int = 3, max_pivots: int = 1 << 13) -> DataFrame:
    """One row per input row: id, n_links (long), component_id, kept (id = component_id).

    Only vectors of equal, non-null label and equal length are compared.  A row whose vector
    is null, empty, zero or holds null or non-finite components, or whose label or id is
    null, links with nothing and is its own component.  Rows that repeat an id and vector
    count as vectors of their own in ``n_links``.
    """
    src = vectors.select(F.col(id_col).alias("q_id"), F.col(vec_col).alias("q_vec"),
                         F.col(label_col).cast("string").alias("q_label"))
    src = src.withColumn("q_ok", usable("q_vec", "q_label") & F.col("q_id").isNotNull())
    v = F.col("q_vec").cast("array<double>")
    key = ["q_label", "q_h1", "q_h2"]
    ids = written(src.select("q_id", "q_ok", "q_label", F.xxhash64("q_vec").alias("q_h1"),
                             F.hash(v).alias("q_h2")))
    # floats travel as they are and are compared in double precision
    plain = F.col("q_vec") if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else v
    reps = written(src.where("q_ok")
                   .select("q_id", "q_label", plain.alias("q_vec"), F.xxhash64("q_vec").alias("q_h1"),
                           F.hash(v).alias("q_h2"))
                   .groupBy(*key).agg(F.min("q_id").alias("q_rep"), F.first("q_vec").alias("q_vec"),
                                      F.count("*").alias("q_n")))
    found = written(linked(reps.select("q_rep", "q_label", "q_vec", "q_n"),
                           choose_pivots(reps, max_pivots), least, head, depth, shared))
    counts = found.groupBy("a").agg(F.sum("n").alias("q_links")).withColumnRenamed("a", "q_rep")
    roots = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "q_rep")
    named = (reps.select(*key, "q_rep", "q_n").join(counts, "q_rep", "left").join(roots, "q_rep", "left")
             .select(*key, F.coalesce("root", "q_rep").alias("q_root"),
                     (F.coalesce("q_links", F.lit(0)) + F.col("q_n") - 1).alias("q_links")))
    linked_rows = ids.where("q_ok").join(named, key).select("q_id", "q_links", "q_root")
    alone = ids.where(~F.col("q_ok")).select("q_id", F.lit(0).cast("long").alias("q_links"),
                                             F.col("q_id").alias("q_root"))
    return linked_rows.unionByName(alone).select(
        F.col("q_id").alias(id_col), F.col("q_links").alias("n_links"),
        F.col("q_root").alias("component_id"), (F.col("q_id").eqNullSafe(F.col("q_root"))).alias("kept"))
