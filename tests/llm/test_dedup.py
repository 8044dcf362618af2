"""Exact, SimHash and embedding deduplication against brute force."""

import hashlib
import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from quire.llm import common, embed_dedup, exact_dedup, simhash

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, schema=DOC):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts], schema)


def union_find(n, pairs):
    par = list(range(n))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        par[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# --- exact ---------------------------------------------------------------------------------------

def brute_exact(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = {}
    for (i, _), n in zip(rows, norm):
        same = [j for (j, _), m in zip(rows, norm) if m == n]
        out[i] = (min(same), len(same), i == min(same), hashlib.sha256(n.encode()).hexdigest())
    return out


TEXTS = [(5, "a  b"), (2, "a\t\nb"), (9, "a b "), (1, None), (3, ""), (4, "   "), (7, " "), (8, "é b"),
         (10, "x" * 300 + "1"), (11, "x" * 300 + "2"), (12, "x" * 300 + "1"), (13, "long " * 40_000),
         (14, "long  " * 40_000), (15, "a b"), (16, "a b")]


def test_exact_groups_equal_brute_force(spark):
    got = {r[0]: tuple(r)[1:] for r in exact_dedup.exact_groups(docs(spark, TEXTS), hash_all=True).collect()}
    assert got == brute_exact(TEXTS)


def test_exact_digests_only_of_survivors(spark):
    got = {r["doc_id"]: r["text_sha256"] for r in exact_dedup.exact_groups(docs(spark, TEXTS)).collect()}
    assert got[15] is None and got[8] is None          # alone by length or prefix
    assert got[10] and got[11] and got[10] != got[11]   # same length and prefix: hashed in full


def test_exact_with_a_saturated_bitmap_changes_nothing(spark):
    got = exact_dedup.exact_groups(docs(spark, TEXTS), hash_all=True, bits=1).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == brute_exact(TEXTS)


def test_exact_empty_table_null_ids_repeated_rows_clashing_columns(spark):
    assert exact_dedup.exact_groups(docs(spark, [])).count() == 0
    df = spark.createDataFrame([(1, "t", 7), (1, "t", 8), (None, "t", 9), (None, "u", 9), (None, "u", 1)],
                               "doc_id long, text string, keep_id long")
    got = sorted((tuple(r)[:4] for r in exact_dedup.exact_groups(df).collect()), key=str)
    assert got == sorted([(1, 1, 3, True), (1, 1, 3, True), (None, 1, 3, False),
                          (None, None, 2, True), (None, None, 2, True)], key=str)


def test_drop_copies_keeps_columns(spark):
    out = exact_dedup.drop_copies(docs(spark, TEXTS))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r[0] for r in out.collect()) == sorted(i for i, b in brute_exact(TEXTS).items() if b[2])


# --- SimHash ---------------------------------------------------------------------------------------

def brute_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    grams = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_fingerprint_equals_brute_force_and_sparks_hash(spark):
    texts = [None, "", " \n", "One", "one two", "A b C d", "ÀB c É", "x y z", "w " * 500, "a b c a b c a b c"]
    assert [simhash.fingerprint(t) % (1 << 64) for t in texts] == [brute_fingerprint(t) for t in texts]
    h = spark.sql("select xxhash64('a b c') h").first()[0]
    assert xxhash.xxh64_intdigest(b"a b c", 42) == h % (1 << 64)


def test_fingerprint_in_chunks(monkeypatch):
    text = " ".join(random.Random(1).choice("abcdefg") for _ in range(1000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 37)
    assert simhash.fingerprint(text) == whole


def test_links_lose_no_pair(spark):
    rng = random.Random(3)
    fps = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        fps.add(base)
        for _ in range(rng.randrange(6)):
            fps.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 7))))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    near = [(i, j) for i in range(len(fps)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 3]
    root = union_find(len(fps), near)
    df = spark.createDataFrame([(s,) for s in signed], "q_fp long")
    got = simhash.links(df, 3).collect()
    at = {s: i for i, s in enumerate(signed)}
    assert union_find(len(fps), [(at[r.a], at[r.b]) for r in got]) == root and near


def test_near_groups_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(1, None), (0, ""), (3, "\t")]
    for g in range(12):
        words = ["w%d" % rng.randrange(300) for _ in range(120)]
        for _ in range(4):
            copy = list(words)
            for _ in range(rng.randrange(2)):
                copy[rng.randrange(len(copy))] = "z"
            rows.append((len(rows) + 5, " ".join(copy)))
    fp = [brute_fingerprint(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if bin(fp[i] ^ fp[j]).count("1") <= 3]
    root = union_find(len(rows), pairs)
    low = {}
    for (i, _), r in zip(rows, root):
        low[r] = min(i, low.get(r, i))
    want = {i: (f"{f:016x}", low[r]) for (i, _), f, r in zip(rows, fp, root)}
    got = {r[0]: (r[1], r[2]) for r in simhash.near_groups(docs(spark, rows)).collect()}
    assert got == want and len(set(low.values())) < len(rows)
    kept = simhash.drop_near_copies(docs(spark, rows))
    assert sorted(r[0] for r in kept.collect()) == sorted(low.values()) and kept.columns[1] == "text"


def test_simhash_empty_table(spark):
    assert simhash.near_groups(docs(spark, [])).count() == 0


def test_long_posting_lists_are_cut_into_cells(spark):
    """A list longer than a block still meets all of its pairs."""
    rng = random.Random(7)
    fps = sorted({rng.getrandbits(8) << 50 | rng.getrandbits(2) for _ in range(300)})
    df = spark.createDataFrame([(1, f) for f in fps], "k int, v long")

    def judge(pdf, ids):
        v = pdf["v"].to_numpy()
        for i, j in common.cell_pairs(pdf, ids):
            yield __import__("pandas").DataFrame({"a": np.minimum(v[i], v[j]), "b": np.maximum(v[i], v[j])})

    got = sorted(tuple(r) for r in common.pair_cells(df, ["k"], "v", judge, "a long, b long", block_rows=20).collect())
    assert got == sorted((a, b) for a in fps for b in fps if a < b)


def test_lists_and_components_are_never_broadcast(spark):
    """Few rows on disk may be many once exploded, which Spark's sizes do not tell."""
    few = common.written(spark.range(1000).select(F.xxhash64("id").alias("q_fp")))
    low = few.groupBy("q_fp").agg(F.count("*").alias("n"))
    for df in (simhash.links(few), common.skew_join(few, low, ["q_fp"]),
               simhash.near_groups(docs(spark, [(1, "a b c d"), (2, "a b c e"), (3, "f g h i")]))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (200, 300), (7, 5), (900, 901), (901, 900), (4, 4)]
    edges += [(1000, 1000 + i) for i in range(1, 50)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 1 for i in range(1, 61)} | {100: 100, 200: 100, 300: 100, 900: 900, 901: 900}
    want |= {1000 + i: 1000 for i in range(50)}
    assert got == want
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- embeddings ------------------------------------------------------------------------------------

def test_near_vectors_against_brute_force(spark):
    rng = np.random.default_rng(2)
    rows, vecs = [], []
    for g in range(150):
        base = rng.normal(size=32)
        for _ in range(rng.integers(1, 6)):
            v = base + rng.normal(size=32) * 0.1 * rng.random()
            vecs.append((v * rng.choice([0.5, 1, 20])).astype(np.float32))
    vecs += [vecs[0], vecs[0], vecs[3] * 2]
    labels = [int(i) % 3 for i in rng.integers(0, 3, len(vecs))]
    rows = [(i, [float(x) for x in v], lab) for i, (v, lab) in enumerate(zip(vecs, labels))]
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [0.0] * 32, 1), (n + 2, [float("nan")] * 32, 1), (n + 3, [None] * 32, 1),
             (n + 4, rows[0][1], None), (n + 5, [], 1), (n + 6, [float("inf")] + [0.0] * 31, 1), (n + 7, [1.0, 2.0], 1),
             (n + 8, [2.0, 4.0], 1)]
    got = {r.vec_id: r for r in embed_dedup.near_vectors(
        spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    unit = np.array([v.astype(float) / np.linalg.norm(v.astype(float)) for v in vecs])
    near = (unit @ unit.T >= 0.98) & (np.array(labels)[:, None] == np.array(labels))
    np.fill_diagonal(near, False)
    found = sum(got[i].n_links for i in range(n))
    assert found >= 0.9 * near.sum() and all(got[i].n_links <= near[i].sum() for i in range(n)) and near.sum()
    if found == near.sum():
        root = union_find(n, np.argwhere(near).tolist())
        assert [got[i].component_id for i in range(n)] == root
    for k in (*range(n, n + 7),):
        assert (got[k].n_links, got[k].component_id, got[k].kept) == (0, k, True)
    assert got[n + 7].n_links == got[n + 8].n_links == 1 and got[n + 8].component_id == n + 7
    assert all(r.kept == (r.component_id == r.vec_id) for r in got.values())


def test_near_vectors_equal_the_sql_on_clusters(spark, tmp_path):
    import duckdb
    from quire.llm.queries import ORACLES
    rng = np.random.default_rng(8)
    rows = []
    for g in range(60):
        base = rng.normal(size=24)
        for _ in range(int(rng.integers(1, 12))):
            rows.append((base + rng.normal(size=24) * 0.05, g % 4))
    hot = rng.normal(size=24)                       # near copies in one list
    rows += [(hot + rng.normal(size=24) * 0.03, 0) for _ in range(400)] + [(hot, 0)] * 50
    rows += [(rng.normal(size=5), 1) for _ in range(70)] + [(np.zeros(24), 2)]
    df = spark.createDataFrame([(i, [float(np.float32(x)) for x in v], int(lab), 1, 2, "x") for i, (v, lab) in enumerate(rows)],
                               "vec_id long, embedding array<float>, label int, q_rep int, n_links int, q_vec string")
    con = duckdb.connect()
    df.select("vec_id", "embedding", "label").write.parquet(str(tmp_path / "e"))
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/e/*.parquet')")
    want = {r[0]: r[1:] for r in con.execute(ORACLES["op10_embedding_dedup"]).fetchall()}
    got = {r[0]: tuple(r)[1:] for r in embed_dedup.near_vectors(df).collect()}
    links = sum(w[0] for w in want.values())
    found = sum(g[0] for g in got.values())
    assert set(got) == set(want) and links > 10_000
    assert found >= 0.99 * links and all(got[i][0] <= want[i][0] for i in got)
    assert sum(got[i][1] == want[i][1] for i in got) >= 0.99 * len(got)


def test_pivots_follow_each_length(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=3 if i % 10 else 7)]) for i in range(4000)],
                               "q_rep long, q_vec array<double>")
    got = {d: len(p) for d, p in embed_dedup.choose_pivots(df, 1 << 16).items()}
    assert 12 <= got[3] <= 60 and 20 <= got[7] <= 24
    assert 12 <= len(embed_dedup.choose_pivots(df, 30)[3]) <= 30
    points = embed_dedup.choose_pivots(df, 1 << 16, apart=0.7)[7]
    cos = points @ points.T
    assert len(points) >= 12 and (cos[~np.eye(len(points), dtype=bool)] < 0.7).all()


def test_near_vectors_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embed_dedup.near_vectors(df).count() == 0


def test_running_total_over_a_hot_group(spark):
    rows = [("a" if i % 5 else "b", i, i % 7) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, o long, n long").repartition(6)
    got = {(r.g, r.o): r.before for r in common.running_total(df, "g", ["o"], "n").collect()}
    want, total = {}, {}
    for g, o, n in sorted(rows):
        want[g, o] = total.get(g, 0)
        total[g] = want[g, o] + n
    assert got == want
    assert common.running_total(df.where("o < 0"), "g", ["o"]).count() == 0
