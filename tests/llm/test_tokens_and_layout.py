"""BPE, token counts, resharding, mixing and the pipeline."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from quire.llm import bpe, mixing, reshard, token_count
from quire.llm.queries import END_OF_DOCUMENT, QUERIES, vocabulary

SF = "/root/testdata/sf0.001"
ODD = ["a", "b", " ", "  ", "\n", "\t", "é", "'s", "'S", "'ll", "1", "23", "²", "½", "ß", "漢", "字", "😀", "\xa0",
       " ", "\x1c", "\x85", "_", "-", "!!", "the", "The", " of", "Ⅷ", "́", "\r\n", "​", "٣", "\x00"]


@pytest.fixture(scope="module")
def vocab():
    return vocabulary()


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal_and_exact(vocab):
    h = vocab.whole
    assert len(h.keys) == len(vocab.ranks) and None not in h.keys
    assert all(h.get(k) == r for k, r in vocab.ranks.items())
    assert h.get(b"no such token at all") == -1
    assert bpe.PerfectHash.build({b"a": 7}).get(b"a") == 7


def test_encoder_equals_tiktoken(vocab, reference):
    rng, coder = random.Random(1), bpe.Encoder(vocab)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(15))) for _ in range(3000)]
    texts += ["", " ", "ab" * 30_000, "x " * 20_000, " " * 5000 + "a", "\n" * 3000, "word" + " \n" * 500 + "word"]
    for t in texts:
        ids = coder.encode(t)
        assert np.frombuffer(ids, dtype="<u4").tolist() == reference.encode_ordinary(t), repr(t)[:80]
        assert coder.decode(ids) == t.encode()


def test_encoder_forgets_without_harm(vocab, reference, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBER", 3)
    coder = bpe.Encoder(vocab)
    t = "The quick brown fox, jumps over the lazzzzy dog " * 5
    assert np.frombuffer(coder.encode(t), dtype="<u4").tolist() == reference.encode_ordinary(t)


def test_encode_documents(spark, vocab, reference):
    rows = [(1, None), (2, ""), (3, "Hello  world\n"), (3, "Hello  world\n"), (None, "é"), (5, "q" * 50_000)]
    d = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, n_tokens long")
    got = bpe.encode_documents(d, vocab, keep=["doc_id"]).collect()
    assert len(got) == len(rows)
    for (i, t), r in zip(rows, got):
        ids = reference.encode_ordinary(t or "")
        assert r.doc_id == i and r.n_tokens == len(ids) and list(r.ids) == ids
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.encode_documents(d.limit(0), vocab, keep=["doc_id"]).count() == 0


def brute_counts(ids, end):
    out, n = [], 0
    for x in ids:
        if x == end:
            out.append((n, True))
            n = 0
        else:
            n += 1
    return out + ([(n, False)] if n else [])


@pytest.mark.parametrize("block", [1, 2, 7, 1000])
def test_separator_scan_equals_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(token_count, "SCAN_RUN", 3)
    rng = random.Random(block)
    files = {f: [rng.choice([9, 9, 1, 2, 3]) if f % 2 else rng.choice([9] + [1] * 12) for _ in range(rng.randrange(1, 60))]
             for f in range(12)}
    files[20] = [9, 9, 9]
    files[21] = [1] * 25
    rows = []
    for f, ids in files.items():
        for b, at in enumerate(range(0, len(ids), block)):
            rows.append((f, b, np.array(ids[at:at + block], dtype="<u2").tobytes()))
    rng.shuffle(rows)
    got = {}
    for r in token_count.count_tokens(spark.createDataFrame(rows, "q_file int, q_block long, q_data binary"), 9).collect():
        got[r.q_file, r.ordinal] = (r.n_tokens, r.ended)
    want = {(f, k): x for f, ids in files.items() for k, x in enumerate(brute_counts(ids, 9))}
    assert got == want


def test_raw_token_files(spark, tmp_path):
    for name, ids in (("a.bin", [1, 2, 9, 3, 9, 9, 4, 5, 6, 9]), ("b.bin", [7] * 50 + [9]), ("c.bin", [])):
        (tmp_path / name).write_bytes(np.array(ids, dtype="<u4").tobytes())
    blocks = token_count.read_flat_files(spark, str(tmp_path), block_bytes=12)
    got = sorted((r.q_file[-5:], r.ordinal, r.n_tokens) for r in token_count.count_tokens(blocks, 9, id_bytes=4).collect())
    assert got == [("a.bin", 0, 2), ("a.bin", 1, 1), ("a.bin", 2, 0), ("a.bin", 3, 3), ("b.bin", 0, 50)]


def test_document_tokens(spark, vocab, reference):
    rows = [(i, t) for i, t in enumerate([None, "", "one two", "a " * 40_000, "three"])] + [(2, "again")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in token_count.document_tokens(d, vocab, END_OF_DOCUMENT).collect())
    assert got == sorted((i, len(reference.encode_ordinary(t or ""))) for i, t in rows)
    assert token_count.document_tokens(d.limit(0), vocab, END_OF_DOCUMENT).count() == 0


# --- resharding ------------------------------------------------------------------------------------

def test_min_cost_flow_moves_the_fewest_bytes():
    rng = random.Random(2)
    for _ in range(50):
        supply = [rng.randrange(50) for _ in range(4)]
        capacity = [rng.randrange(60) for _ in range(6)]
        capacity[-1] += max(0, sum(supply) - sum(capacity))
        cost = [[int(i != j) for j in range(6)] for i in range(4)]
        flow = reshard.min_cost_flow(supply, capacity, cost)
        assert [sum(r) for r in flow] == supply
        assert all(sum(flow[i][j] for i in range(4)) <= capacity[j] for j in range(6))
        moved = sum(flow[i][j] * cost[i][j] for i in range(4) for j in range(6))
        assert moved == sum(max(0, s - capacity[i]) for i, s in enumerate(supply))
    with pytest.raises(ValueError):
        reshard.min_cost_flow([5], [4], [[0]])


def test_reshard_contract(spark):
    rng = random.Random(3)
    texts = ["t%d " % i * rng.randrange(1, 60) for i in range(1500)] + ["copy"] * 90 + [None, "", None]
    d = spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)], "doc_id long, text string, shard int")
    got = reshard.reshard(d).collect()
    assert len(got) == len(texts)
    load, slots, home = {}, {}, {}
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert r["size"] == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw)
        load[r.shard] = load.get(r.shard, 0) + r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
        home.setdefault(raw, set()).add(r.shard)
    assert set(load) == set(range(8)) and max(load.values()) - min(load.values()) < 0.02 * sum(load.values()) / 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in home.values())          # equal texts lie together


def test_reshard_splits_a_text_larger_than_a_shard(spark):
    texts = ["hot text " * 20] * 600 + ["t%d" % i for i in range(300)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    load = {}
    for r in reshard.reshard(d).collect():
        load[r.shard] = load.get(r.shard, 0) + r["size"]
    assert max(load.values()) - min(load.values()) < 0.1 * sum(load.values()) / 8


def test_reshard_odd_inputs(spark):
    d = spark.createDataFrame([(None, "a"), (1, "a"), (1, "a")], "doc_id long, text string")
    assert reshard.reshard(d).count() == 3
    assert reshard.reshard(d.limit(0)).count() == 0


def test_rewrite_touches_changed_shards_only(spark, tmp_path):
    d = spark.createDataFrame([(i, "x" * (i % 9)) for i in range(200)], "doc_id long, text string")
    placed = spark.createDataFrame([(i, i % 4, 3 if i % 4 == 2 else i % 4) for i in range(200)],
                                   "doc_id long, old_shard int, shard int")
    path = str(tmp_path / "out")
    assert reshard.rewrite(d, placed, path) == [2, 3]
    back = spark.read.parquet(path)
    assert back.count() == 100 and back.select("shard").distinct().count() == 1


# --- resharding: rows without or with repeated ids, hot texts ----------------------------------------

def test_rewrite_keeps_every_row_over_existing_files(spark, tmp_path):
    rng = random.Random(5)
    rows = [(None if i % 7 == 0 else i // 2, "x%d " % (i % 50) * rng.randrange(1, 30), i, i % 8) for i in range(400)]
    path = str(tmp_path / "out")
    schema = "doc_id long, text string, other int, shard int"
    spark.createDataFrame(rows, schema).write.partitionBy("shard").parquet(path)
    docs = spark.read.schema(schema).parquet(path)
    placed = reshard.written(reshard.reshard(docs, new_shards=5, old_shards=8, old_col="shard"))
    want = sorted((r.shard, r["size"], r.text_crc32) for r in placed.collect())
    touched = reshard.rewrite(docs, placed, path, old_col="shard")
    assert touched == list(range(8))
    back = spark.read.schema(schema).parquet(path).collect()
    assert sorted(r.other for r in back) == list(range(400))         # shards 5 to 7 are gone, no row is lost or doubled
    assert sorted((r.shard, len(r.text) + 1, zlib.crc32(r.text.encode())) for r in back) == want
    assert {(r.other, r.doc_id, r.text) for r in back} == {(o, i, t) for i, t, o, _ in rows}


def test_a_rewrite_that_dies_is_ended_or_dropped(spark, tmp_path, monkeypatch):
    import os
    path = str(tmp_path / "out")
    schema = "doc_id long, text string, shard int"
    spark.createDataFrame([(i, f"t{i}", i % 4) for i in range(80)], schema).write.partitionBy("shard").parquet(path)
    docs = spark.read.schema(schema).parquet(path)
    placed = reshard.written(docs.select("doc_id", F.col("shard").alias("old_shard"),
                                         F.when(F.col("shard") == 3, 2).otherwise(F.col("shard")).alias("shard")))

    def state():
        return sorted((r.doc_id, r.shard) for r in spark.read.schema(schema).parquet(path).collect())
    before = state()
    want = sorted((i, 2 if i % 4 == 3 else i % 4) for i in range(80))

    # dies before its journal: dropped, nothing has changed
    os.makedirs(f"{path}/_reshard-dead/shard=2")
    open(f"{path}/_reshard-dead/shard=2/part-0.parquet", "w").close()
    assert reshard.finish_rewrite(spark, path) == 0 and state() == before and not os.path.exists(f"{path}/_reshard-dead")

    # dies after it, with one shard dropped and none moved: ended by the next call
    end = reshard.finish_rewrite
    calls = []
    monkeypatch.setattr(reshard, "finish_rewrite", lambda *a: calls.append(1) or (end(*a) if len(calls) == 1 else 0))
    reshard.rewrite(docs, placed, path, old_col="shard")
    (stage,) = [n for n in os.listdir(path) if n.startswith("_reshard-")]
    os.rename(f"{path}/shard=3", str(tmp_path / "gone"))
    assert end(spark, path) == 1 and state() == want and not os.path.exists(f"{path}/{stage}")
    assert end(spark, path) == 0 and state() == want


def test_texts_below_a_shard_are_split_where_they_would_unbalance(spark):
    rows = [(None, "%d " % g * 50) for g in range(9) for _ in range(80)] + [(i, "t%d" % i) for i in range(200)]
    load = {}
    for r in reshard.reshard(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        load[r.shard] = load.get(r.shard, 0) + r["size"]
    assert len(load) == 8 and max(load.values()) - min(load.values()) < 0.05 * sum(load.values()) / 8


def test_texts_beside_a_hot_text_stay_together(spark):
    texts = ["hot text " * 20] * 600 + ["t%d" % (i // 2) for i in range(400)]
    home = {}
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in reshard.reshard(d, blocks=16).collect():
        home.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert all(len(h) == 1 for t, h in home.items() if t[0] == "t") and len(home[texts[0]]) > 4


# --- mixing ----------------------------------------------------------------------------------------

def brute_targets(sizes):
    """Targets by the contract: share by weight, stop at twice the size, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    goal, done = 1.5 * sum(sizes.values()), {}
    while True:
        left = [s for s in order if s not in done]
        total = sum(weight[s] for s in left)
        rate = (goal - sum(done.values())) / total if total else 0
        over = [s for s in left if rate * weight[s] > 2 * sizes[s]]
        if not over:
            return done | {s: rate * weight[s] for s in left}
        done |= {s: 2.0 * sizes[s] for s in over}


def mixing_rows():
    rng = random.Random(9)
    rows = [(i, " ".join("w" for _ in range(rng.randrange(0, 400))), rng.choice(["a", "a", "a", "B", "é", None, "c"]))
            for i in range(600)]
    return rows + [(1000, None, "a"), (1001, "", "empty"), (1002, "w " * 20_000, "z")]


def test_mix_table_contract(spark):
    rows = mixing_rows()
    d = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, target long")
    got = {r.doc_id: r for r in mixing.mix_table(d).collect()}
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    goal = brute_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for i, t, s in rows:
        r = got[i]
        assert r["size"] == len((t or "").split()) and r.source_size == sizes[s]
        assert r.target == pytest.approx(goal[s]) and 0 <= r.taken <= 2 * r["size"]
        taken[s] += r.taken
    assert all(abs(taken[s] - goal[s]) <= 0.5 for s in sizes)
    again = {r.doc_id: r.taken for r in mixing.mix_table(d.repartition(3)).collect()}
    assert again == {i: r.taken for i, r in got.items()}


def test_schedule_equals_brute_force(spark):
    counts = {"a": 63, "b": 320, "c": 3}
    df = spark.createDataFrame(list(counts.items()), "q_src string, q_slots long")

    def brute(golden):
        n = sum(counts.values())
        points = sorted(((k + 0.5) * golden % 1.0, k) for k in range(n))
        place = {k: r for r, (_, k) in enumerate(points)}
        turn, out = dict.fromkeys(counts, 0), {}
        for k in range(n):
            s = "a" if place[k] < 63 else "b" if place[k] < 383 else "c"
            out[k] = (s, turn[s])
            turn[s] += 1
        return out

    got = {}
    for golden in (mixing.GOLDEN, 0.123):
        got[golden] = {r.slot: (r.q_src, r.q_turn) for r in mixing.schedule(df, golden).collect()}
        assert got[golden] == brute(golden)
    assert got[mixing.GOLDEN] != got[0.123]
    # every prefix of the golden-ratio schedule is in proportion, to within a few slots
    seen = dict.fromkeys(counts, 0)
    for k in range(386):
        seen[got[mixing.GOLDEN][k][0]] += 1
        assert all(abs(seen[s] - (k + 1) * counts[s] / 386) <= 3 for s in counts)


def test_block_order_equals_brute_force(spark):
    table = {"a": (1000, 1300.4), "b": (500, 1000.0), "c": (37, 11.0), "d": (16, 16.0), "e": (3, 0.2), "f": (0, 0.0)}
    df = spark.createDataFrame([(s, *v) for s, v in table.items()], "q_src string, q_total long, target double")
    got = {}
    for r in mixing.block_order(df, 16, 2, 17).collect():
        got.setdefault(r.q_src, []).append((r.q_turn, r.q_epoch, r.q_block, r.q_take))
    assert set(got) == {"a", "b", "c", "d"}
    for s, reads in got.items():
        total, goal = table[s]
        reads.sort()
        assert [t for t, *_ in reads] == list(range(len(reads)))
        assert sum(w for *_, w in reads) == round(goal)
        full = [b for _, e, b, _ in reads if e == 0]
        assert len(set(full)) == len(full) and (goal < total or sorted(full) == list(range(-(-total // 16))))
        assert all(w == min(16, total - 16 * b) for _, _, b, w in reads[:-1])
    assert [b for _, e, b, _ in got["a"] if e == 0] != sorted(b for _, e, b, _ in got["a"] if e == 0)      # shuffled
    assert [b for _, e, b, _ in got["b"] if e == 0] != [b for _, e, b, _ in got["b"] if e == 1]


def test_the_query_follows_its_schedule(spark):
    rows = mixing_rows()
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    order = {g: {r.doc_id: r.first_slot for r in mixing.mix_table(d, golden=g).collect()} for g in (mixing.GOLDEN, 0.123)}
    assert order[mixing.GOLDEN] != order[0.123]
    assert QUERIES["op7_mixing"](spark, SF).where("taken > 0 and first_slot is null or taken = 0 and first_slot is not null").isEmpty()
    # words read by every prefix of the mix are in proportion to the targets
    _, reads, pieces = mixing.mix(d, block_words=64)
    by_slot = {r.slot: r for r in reads.collect()}
    assert sorted(by_slot) == list(range(len(by_slot)))
    words = {}
    for r in pieces.collect():
        words[r.slot] = words.get(r.slot, 0) + r.words
    assert words == {k: r.q_take for k, r in by_slot.items()}
    goal, seen, total = {}, {}, sum(words.values())
    for k, r in by_slot.items():
        goal[r.q_src] = goal.get(r.q_src, 0) + words[k]
    for k in range(len(by_slot)):
        seen[by_slot[k].q_src] = seen.get(by_slot[k].q_src, 0) + words[k]
        done = sum(seen.values())
        assert all(abs(seen.get(s, 0) - done * goal[s] / total) <= 4 * 64 for s in goal)


def test_blocks_and_reads_are_never_broadcast(spark, monkeypatch):
    """A row per block, sorted and compressed: their files say too little of their size in memory."""
    plans, write = [], mixing.written

    def plan_of(df):
        return df._jdf.queryExecution().executedPlan().toString()

    def watched(df, **options):
        plans.append(plan_of(df))
        return write(df, **options)

    monkeypatch.setattr(mixing, "written", watched)
    docs = spark.createDataFrame([(i, "w " * 300, "en", "ab"[i % 2], 600) for i in range(20)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    plans.append(plan_of(mixing.mixed_documents(docs)))
    assert any(re.search(r"SortMergeJoin \[q_src#\d+, q_turn#", p) for p in plans[:-1])
    assert re.search(r"SortMergeJoin \[q_src#\d+, q_block#", plans[-1])
    table = plan_of(mixing.mix_table(docs))
    assert re.search(r"SortMergeJoin \[q_src#\d+, q_block#", table) and re.search(r"SortMergeJoin \[q_row#", table)
    assert not any(re.search(r"BroadcastHashJoin \[(q_row|q_src#\w+, (q_turn|q_block))", p) for p in [*plans, table])


def test_mixed_documents_are_whole_and_near_their_targets(spark):
    rows = mixing_rows()
    d = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows],
                              "doc_id long, text string, lang string, source string, n_chars long")
    out = mixing.mixed_documents(d)
    assert out.columns == d.columns
    text = {i: t for i, t, _ in rows}
    words, count, goal, longest = {}, {}, {}, {}
    for r in mixing.mix_table(d).collect():
        s = next(x for i, _, x in rows if i == r.doc_id)
        goal[s], longest[s] = r.target, max(longest.get(s, 0), r["size"])
    for r in out.collect():
        assert r.text == text[r.doc_id] and r.n_chars == len(r.text)
        words[r.source] = words.get(r.source, 0) + len(r.text.split())
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    assert max(count.values()) <= 2
    assert all(abs(words.get(s, 0) - goal[s]) <= longest[s] / 2 + 1 for s in goal)
    slots = [r.at for r in mixing.mixed_documents(d, slot_col="at").collect()]
    assert len(slots) == sum(count.values()) and None not in slots
    other = [r.at for r in mixing.mixed_documents(d, slot_col="at", golden=0.123).collect()]
    assert sorted(slots) != sorted(other)


def test_many_rows_of_one_id_and_size(spark):
    d = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    assert mixing.mixed_documents(d).count() == 30_000


def test_mixing_odd_inputs(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mix_table(spark.createDataFrame([], schema)).count() == 0
    same = spark.createDataFrame([(1, "a b c", "s"), (1, "a b c", "s"), (None, "d e", "s"), (2, None, None)], schema)
    got = mixing.mix_table(same).collect()
    assert len(got) == 4 and all(r.taken <= 2 * r["size"] for r in got)
    assert mixing.mixed_documents(same).count() >= 3
    empty = spark.createDataFrame([(1, "", "s"), (2, None, "t")], schema)
    assert [r.taken for r in mixing.mix_table(empty).collect()] == [0, 0]
    assert mixing.mixed_documents(empty).count() == 0


def test_small_sources_reach_their_targets(spark):
    rows = [(i, "w " * (1 + i % 40), "host%03d" % i) for i in range(120)] + [(1000 + i, "w " * 500, "zz") for i in range(20)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for share, least in ((0.75, 16), (1.5, 5000)):
        taken, goal = {}, {}
        for r, (_, _, s) in zip(sorted(mixing.mix_table(d, share=share, block_words=least).collect()), rows):
            taken[s] = taken.get(s, 0) + r.taken
            goal[s] = r.target
        assert all(abs(taken[s] - goal[s]) <= 0.5 + goal[s] / 64 for s in goal)


# --- pipeline --------------------------------------------------------------------------------------

def test_pipeline_stages_have_effect(spark, reference):
    from quire.llm.common import load, written
    docs = load(spark, SF, "documents")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, SF))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
        kept.append(out.count())
        before, docs = docs, out
    assert kept[0] <= 200 and kept[1] < kept[0] and kept[2] <= kept[1] and kept[4] == kept[3]
    texts = {}
    for r in before.collect():
        texts.setdefault(r.doc_id, []).append(tuple(reference.encode_ordinary(r.text)))
    got = {}
    for r in docs.collect():
        got.setdefault(r.doc_id, []).append(tuple(r.ids))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in texts.items()}


def test_pipeline_dedup_stages_against_brute_force(spark):
    import re
    from quire.llm import simhash
    from quire.llm.common import load
    docs = load(spark, SF, "documents")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    first = {}
    for i, t in rows:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), i)
    exact = corpus_pipeline.exact_stage(spark, docs, SF)
    assert sorted(r.doc_id for r in exact.collect()) == sorted(first.values())
    fp = {i: simhash.fingerprint(t) % (1 << 64) for i, t in rows}
    low = {i: i for i in fp}
    for i in fp:
        for j in fp:
            if bin(fp[i] ^ fp[j]).count("1") <= 3:
                a, b = sorted((low[i], low[j]))
                low = {k: a if v == b else v for k, v in low.items()}
    near = corpus_pipeline.simhash_stage(spark, docs, SF)
    assert sorted(r.doc_id for r in near.collect()) == sorted(set(low.values()))


def test_stages_judge_rows_not_ids(spark):
    rows = [(1, "same", "a"), (2, "same", "a"), (2, "unique text", "b")] + [(3, "x y z", "a")] * 3 + [(None, "same", "c"), (None, "lone", None)]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    want = [(1, "same"), (2, "unique text"), (3, "x y z"), (None, "lone")]
    for stage in (corpus_pipeline.exact_stage, corpus_pipeline.simhash_stage):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(want, key=repr)
    mixed = {(r.doc_id, r.text) for r in corpus_pipeline.mixing_stage(spark, docs, SF).collect()}
    assert mixed <= {(i, t) for i, t, _ in rows}


def test_the_pipeline_leaves_its_results_only(spark):
    import os
    from quire.session import ensure_checkpoint_dir
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    out = corpus_pipeline.run(spark, SF)
    assert len(set(os.listdir(folder)) - before) == len(corpus_pipeline.STAGES) and out.count() > 0


def test_pipeline_of_odd_inputs(spark, tmp_path):
    from quire.llm.common import load
    sf = str(tmp_path)
    load(spark, SF, "labels").write.parquet(f"{sf}/labels.parquet")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, rows in {"none": [], "odd": [(1, None, None, None, None), (1, "", "en", "s", 0), (None, "a b c", None, "s", 5),
                                           (1, "a b c", "en", None, 5), (1, "a b c", "en", None, 5), (2, "d " * 400, "en", "s", 800)]}.items():
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{sf}/documents.parquet")
        out = corpus_pipeline.run(spark, sf)
        got = {(r.doc_id, r.source) for r in out.collect()}
        assert got == (set() if name == "none" else got) and got <= {(1, None), (2, "s")}
        assert name == "none" or got


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op11_topk", "op12_prefix_trie"}))
def test_queries_return_every_row(spark, name):
    table = {"op2_url_filter": "pages", "op10_embedding_dedup": "embeddings"}.get(name, "documents")
    out = QUERIES[name](spark, SF)
    assert out.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
    assert not [f for f in out.schema.fields if f.dataType.simpleString() == "void"]
