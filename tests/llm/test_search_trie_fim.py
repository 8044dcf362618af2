"""Exact top-k search, conversation prefix trie and fill-in-the-middle against brute force."""

import hashlib
import math
import random
import re
import zlib
from contextlib import contextmanager

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import fim, prefix_trie, topk


@contextmanager
def small_batches(spark, n):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, old)


# --- fill in the middle ------------------------------------------------------------------------------

def brute_fim(doc_id, text, plain=10, spm=20):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k:k + 8], 16) for k in range(0, 32, 8))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100 - plain:
        return n, "plain", text, None, None
    if h4 % 100 < spm:
        return n, "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return n, "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def odd_texts():
    rng = random.Random(3)
    alphabet = "abzAZ@[`{ \n\t\x00é߿ࠀ中😀\U0010ffff-'1<>PSM"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(300)]
    return made + [None, "", "a", "é", "😀", "word", "with <S> mark", "a<", "<P", "x" * 9, "日本語" * 50,
                   "long words and spaces " * 60_000, "z" * 700_001]


def test_fim_equals_brute_force(spark):
    rows = list(enumerate(odd_texts())) + [(None, "null id"), (3, "same id again"), (3, "same id again")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, form string")
    out = fim.fill_in_middle(df).withColumn("back", fim.restored("output", "form")).collect()
    got = sorted((repr(r.doc_id), r.n, r.form, r.output, r.prefix_chars, r.middle_chars, r.back) for r in out)
    want = sorted((repr(i), *brute_fim(i, t), t or "") for i, t in rows)
    assert [tuple(map(repr, g)) for g in got] == [tuple(map(repr, w)) for w in want]
    assert {r.form for r in out} == {"plain", "psm", "spm"}


def test_unit_scan_across_chunks(monkeypatch):
    monkeypatch.setattr(fim, "CHUNK", 3)
    for t in odd_texts()[:310]:
        data = (t or "").encode()
        units = [u.encode() for u in re.findall(r"[A-Za-z]+|[^A-Za-z]", t or "", re.S)]
        words = fim.words_of(data)
        totals = fim.count_units(words, len(data))
        assert (int(totals[-1]) if len(totals) else 0) == len(units)
        for k in range(len(units) + 1):
            assert fim.byte_after(words, len(data), totals, k) == len(b"".join(units[:k]))
        assert fim.code_points(data) == len(t or "")


def test_fim_of_an_empty_table_and_overlapping_marks(spark):
    assert fim.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    for marks in (("<P>", "<P>", "<M>"), ("ab", "ba", "x"), ("", "s", "m"), ("aa", "s", "m")):
        with pytest.raises(ValueError):
            fim.check_marks(marks)


# --- exact top-k -------------------------------------------------------------------------------------

def brute_top(rows, k, scale=256):
    ok = []
    for n, (i, v, ask) in enumerate(rows):
        if v is None or not v or any(x is None or math.isnan(x) or math.isinf(x) for x in v):
            continue
        ok.append((n, i, [math.floor(scale * x) for x in v], ask))
    out = []
    for n, i, q, ask in ok:
        if not ask:
            continue
        found = [(-sum(a * b for a, b in zip(q, v)), j is None, j or 0, m) for m, j, v, _ in ok
                 if m != n and len(v) == len(q)]
        out += [(i, r, None if x[1] else x[2], -x[0]) for r, x in enumerate(sorted(found)[:k], 1)]
    return sorted(map(repr, out))


def vectors_of(kind):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 12)).astype(np.float32)
    if kind == "copies":
        x[50:250] = x[50]
    if kind == "positive":
        x = np.abs(x)
    if kind == "negative":
        x = -np.abs(x)
        x[::7] *= -1
    if kind == "sparse":
        x[rng.random(x.shape) < 0.8] = 0
    if kind == "ties":
        x = np.sign(x) / 4
    if kind == "outlier":
        x[3] *= 1000
    return [(i, v.tolist(), i % 10 == 0) for i, v in enumerate(x)]


@pytest.mark.parametrize("kind", ["plain", "copies", "positive", "negative", "sparse", "ties", "outlier"])
def test_top_k_equals_brute_force(spark, kind):
    rows = vectors_of(kind)
    df = spark.createDataFrame([(i, v, a, 1, "x") for i, v, a in rows],
                               "vec_id long, embedding array<float>, ask boolean, rank int, score string")
    got = topk.exact_top_k(df, F.col("ask"), k=5, block_rows=90, query_rows=15).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute_top(rows, 5)


def test_top_k_of_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 2.0], True), (0, [1.0, 2.0], True), (1, None, True), (2, [], True), (3, [1.0, None], True),
            (4, [inf, 1.0], False), (5, [nan, 1.0], False), (None, [3.0, 1.0], None), (6, [0.0, 0.0], True),
            (7, [1.0, 2.0, 3.0], True), (8, [-1.0, -0.001], False), (1 << 60, [3.0, 1.0], False),
            ((1 << 60) + 1, [3.0, 1.0], True)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, ask boolean")
    got = topk.exact_top_k(df, F.col("ask"), k=5).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute_top(rows, 5)
    assert topk.exact_top_k(df.where("false"), F.col("ask")).count() == 0
    assert topk.exact_top_k(df, F.lit(None).cast("boolean")).count() == 0


def test_reading_stops_early_but_never_too_early():
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(size=(3000, 16)) * 64).astype(np.int64)
    x[17] = x[400] + 1
    index = topk.ImpactIndex(x, np.arange(3000))
    for q in range(0, 3000, 100):
        at, scores = index.top(x[q], q, 5)
        exact = x @ x[q]
        order = [i for i in np.lexsort((np.arange(3000), -exact)) if i != q][:5]
        assert at.tolist() == order and scores.tolist() == exact[order].tolist()


# --- prefix trie -------------------------------------------------------------------------------------

def brute_trie(rows):
    """rows of (conv_id, turn, role, text) -> node rows."""
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    members = {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    inner = {k[:-1] for k in members if k}
    out = []
    for key, ms in members.items():
        below = [k for k in members if k[:len(key)] == key]
        ends = ",".join(map(str, sorted(c for c in ms if len(full[c]) == len(key))))
        out.append((min(ms), len(key), min(members[key[:-1]]) if key else None, len(ms),
                    sum(1 for k in below if len(k) == len(key) + 1), sum(1 for k in below if k not in inner),
                    sum((len(members[k]) - 1) * (len(k[-1][1]) if k else 0) for k in below),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(repr, out))


def trie_rows(seed, convs=60, most=9, words=2):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(400), convs):
        for t in range(rng.randrange(1, most)):
            rows.append((c, t, rng.choice(["user", "bot"][:words]), rng.choice(["hi", "é😀", ""][:words + 1])))
    rng.shuffle(rows)
    return rows


TURNS = "conv_id long, turn long, role string, text string"


def nodes_of(spark, rows, length):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS + ", depth int, n_convs string")
    return sorted(repr(tuple(r)) for r in prefix_trie.prefix_trie(df, length=length).collect())


@pytest.mark.parametrize("seed,length,batch", [(1, 64, 10_000), (2, 3, 10_000), (3, 64, 2), (4, 2, 3)])
def test_trie_equals_brute_force(spark, seed, length, batch):
    rows = trie_rows(seed, words=1 + seed % 2)
    with small_batches(spark, batch):
        assert nodes_of(spark, rows, length) == brute_trie(rows)


def test_trie_of_copies_and_a_long_conversation(spark):
    rows = [(c, t, "u", f"t{t}") for c in range(1000, 1060) for t in range(7)]
    rows += [(2000, t, "u", f"t{t % 3}") for t in range(150)] + [(2001, t, "u", f"t{t % 3}") for t in range(131)]
    rows += [(2100, t, "u", f"t{t % 3}") for t in range(64)]
    with small_batches(spark, 5):
        assert nodes_of(spark, rows, 64) == brute_trie(rows)
        assert nodes_of(spark, rows, 7) == brute_trie(rows)


def test_trie_of_odd_rows(spark):
    rows = [(5, None, "u", "first"), (5, None, "u", "first"), (5, 0, None, None), (5, 0, "a", None), (5, 0, "a", "b" * 50_000),
            (5, 0, "a", "b" * 49_999 + "a"), (7, 1, "u", "only"), (None, 0, "u", "lost"), (100, 0, "ab", "c"), (101, 0, "a", "bc"),
            (-250, 1, "u", "minus"), (-200, 1, "u", "base")]
    rows += [(c, 0, "u", "short") for c in range(300, 340)]      # many are left turnless
    assert nodes_of(spark, rows, 64) == brute_trie(rows)
    assert nodes_of(spark, [], 64) == []
    assert nodes_of(spark, [(None, 0, "u", "x")], 64) == []

