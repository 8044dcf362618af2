"""Assembly by name blocks, block-wise line reflow, keyed summaries and the odd corpora."""

import os
import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from quire.operators import assemble as AS
from quire.operators import chapters as CH
from quire.operators import entries as EN
from quire.operators import langid as LI
from quire.operators import summarize as SU
from quire.plans import books as BK
from quire.sinks import files as K


def _in_file_order(folder):
    names = sorted(n for n in os.listdir(folder) if n.startswith("part-"))
    return "".join(open(os.path.join(folder, n), newline="").read() for n in names)


# --- A1, A3: one group with half of all rows --------------------------------------------------------

def _half_hot(spark):
    rng = random.Random(1)
    names = [f"n{rng.randrange(10**6):06d}" for _ in range(3000)] + ["same"] * 20 + [None]
    rows = [("hot", n, f"t{k}" if k % 7 else None) for k, n in enumerate(names)]
    rows += [(f"g{k % 600}", f"x{k}", f"y{k}") for k in range(3000)] + [(None, "b", "null 2"), (None, "a", "null 1")]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "g string, name string, text string")


def test_name_blocks_split_a_hot_group_and_change_nothing(spark, tmp_path):
    df = _half_hot(spark)
    plain = {r.g: r.text for r in AS.concat_docs(df, "g", "name").collect()}
    cuts = AS.name_blocks(df, "g", "name", blocks=16)
    assert [r.g for r in cuts.collect()] == ["hot"]        # small groups stay whole
    assert {r.g: r.text for r in AS.concat_docs(df, "g", "name", cuts=cuts).collect()} == plain
    rows = AS.with_name_block(df, "g", "name", cuts).where("g = 'hot'").groupBy("_blk").count().collect()
    assert len(rows) >= 5 and max(r["count"] for r in rows) < 1500
    parts = AS.concat_docs_parts(df.where("g is not null"), "g", "name", cuts=cuts)
    K.write_ordered_parts(parts, str(tmp_path / "a1"), "g", "block", drop_empty=False)
    assert _in_file_order(tmp_path / "a1" / "g=hot") == plain["hot"]


def test_more_cuts_than_names(spark):
    df = spark.createDataFrame([("a", n, n) for n in "cab"] * 40, "g string, name string, text string")
    cuts = AS.name_blocks(df, "g", "name", blocks=100)
    want = AS.concat_docs(df, "g", "name").first()["text"]
    assert AS.concat_docs(df, "g", "name", cuts=cuts).first()["text"] == want
    none = AS.name_blocks(df.where("false"), "g", "name")
    assert none.count() == 0 and AS.concat_docs(df, "g", "name", cuts=none).first()["text"] == want


def test_entries_in_blocks(spark, tmp_path):
    rows = [("big", f"p{k % 997:04d}/{k}.html", "" if k % 5 == 0 else f"<p>e{k}</p>") for k in range(2000)]
    rows += [("small", "b.xhtml", "<b>B</b>"), ("small", "a.htm", "<i>A</i>"), ("small", "c.css", "x")]
    df = spark.createDataFrame(rows, "book_id string, entry_path string, html string")
    text = {r.book_id: r.text for r in EN.entries_to_text(df, blocks=1).collect()}
    assert text["small"] == "A\n\nB"
    assert text["big"] == "\n\n".join(f"e{k}" for k in sorted((k for k in range(2000) if k % 5), key=lambda k: f"p{k % 997:04d}/{k}"))
    assert {r.book_id: r.text for r in EN.entries_to_text(df, blocks=16).collect()} == text
    parts = EN.entries_to_text_parts(df, blocks=16)
    assert parts.where("book_id = 'big'").count() > 4
    K.write_ordered_parts(parts, str(tmp_path / "a3"), "book_id", "block")
    assert _in_file_order(tmp_path / "a3" / "book_id=big") == text["big"] + "\n\n"


# --- A2, Q1 ----------------------------------------------------------------------------------------

def test_pages_of_many_blocks_keep_numbers_and_first_text(spark):
    rows = [(b, p, None if p % 4 == 0 else f"p{p}", "e" if p % 8 == 0 else None) for b in (1, None) for p in range(40)]
    rows += [(1, None, "front", None)]
    df = spark.createDataFrame(rows, "book_id long, page_no int, text string, error string")
    one = {r.book_id: tuple(r)[1:] for r in AS.pages_to_text(df, first="f").collect()}
    for size in (1, 3, 7):
        assert {r.book_id: tuple(r)[1:] for r in AS.pages_to_text(df, block_pages=size, first="f").collect()} == one
    assert one[1][2] == "front" and one[None][2] == "" and one[1][1] == 41
    assert one[None][0].startswith("[ERROR ON PAGE 1]\n\np1\n\np2\n\np3\n\np5")
    assert one[1][0].startswith("front\n\n[ERROR ON PAGE 2]\n\np1")


def test_a_book_without_a_number_is_kept(spark):
    rows = [(None, 1, "der und das ist ein nicht der", None), (1, 1, "the one is not of the and to a", None)]
    df = spark.createDataFrame(rows, "book_id long, page_no int, text string, error string")
    docs = spark.createDataFrame([("der die das und ist nicht ein eine " * 30, "de"), ("the and of is not a one to in " * 30, "en")],
                                 "text string, lang string")
    got = {r.book_id: r.lang for r in BK.pages_to_book(df, LI.train_profiles(docs)).collect()}
    assert got == {None: "de", 1: "en"}
    assert {r.book_id: r.lang for r in BK.pages_to_book(df, language="fr").collect()} == {None: "fr", 1: "fr"}
    assert {r.book_id: r.lang for r in BK.pages_to_book(df).collect()} == {None: "eng", 1: "eng"}


def test_pages_are_scanned_once(spark):
    from test_plans import _plan
    plan = _plan(E.queries()["Q1_pages_to_book"](spark, SF_SMALL))
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan


# --- L1 --------------------------------------------------------------------------------------------

def _profiles(spark):
    docs = spark.createDataFrame([("der die das und ist nicht ein eine ä" * 30, "de"), ("the and of is not a one to in " * 30, "en"),
                                  ("日本語のテキスト😀です" * 30, "ja")], "text string, lang string")
    return LI.train_profiles(docs)


def test_prediction_is_narrow_and_join_path_agrees(spark, monkeypatch):
    from test_plans import _plan
    prof = _profiles(spark)
    texts = ["der und das ist ein nicht", "the one is not of the and", "日本語です" * 5, None, "", "zzzz qqqq xxxx vvvv yyyy", "9" * 50]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(None, "das ist nicht eine der die")], "doc_id long, text string")
    pred = LI.predict(docs, prof)
    assert "Exchange" not in _plan(pred)
    got = {r.doc_id: r.lang_pred for r in pred.collect()}
    assert (got[0], got[1], got[2], got[3], got[6], got[None]) == ("de", "en", "ja", "eng", "eng", "de")
    monkeypatch.setattr(LI, "INDEX_PROFILE_ROWS", 10)
    assert {r.doc_id: r.lang_pred for r in LI.predict(docs, prof).collect()} == got
    kept = LI.predict(docs.withColumn("x", F.lit(7)), prof, keep=["x"])
    assert {(r.doc_id, r.x, r.lang_pred) for r in kept.collect()} == {(k, 7, v) for k, v in got.items()}


def test_profiles_by_hand(spark):
    docs = spark.createDataFrame([("Ab  ab", "x"), (None, "x"), ("", "x"), ("é", None), ("😀", "y")], "text string, lang string")
    got = sorted(tuple(r) for r in LI.train_profiles(docs).collect())
    assert got == [("x", " ", 3), ("x", " a", 4), ("x", " ab", 5), ("x", "a", 0), ("x", "ab", 1), ("x", "ab ", 6),
                   ("x", "b", 2), ("x", "b ", 7), ("x", "b a", 8), ("y", "😀", 0)]
    docs = spark.createDataFrame([(1, "the and of is not a one to in")], "doc_id long, text string")
    assert LI.predict(docs, LI.train_profiles(spark.createDataFrame([], "text string, lang string"))).first()[1] == "eng"


# --- W2 over lines ---------------------------------------------------------------------------------

def test_line_blocks_equal_the_row_form(spark):
    rng = random.Random(4)
    pool = ["", " ", "text", "- item", "  * deep", "```", "# head", "ends.", "tail", "+ plus", "\x01odd", "- ", "a:"]
    docs = [(d, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 120)))) for d in range(40)] + [(99, "")]
    df = spark.createDataFrame(docs, "doc_id long, md string")
    want = {r.doc_id: r.out for r in EN.with_reflow(df, "md", "out").collect()}
    lines = AS.explode_lines(df)
    for size in (1, 2, 5, 4096):
        assert {r.doc_id: r.md for r in EN.reflow_lines(lines, block_lines=size).collect()} == want
    null = lines.withColumn("doc_id", F.when(F.col("doc_id") != 3, F.col("doc_id")))
    assert {r.doc_id: r.md for r in EN.reflow_lines(null, block_lines=9).collect()}[None] == want[3]


def test_one_long_document_is_spread_over_its_blocks(spark):
    lines = spark.range(100_000).select(F.lit(1).alias("doc_id"), F.col("id").cast("int").alias("i"), F.when(
        F.col("id") % 9 == 0, F.lit("- x")).when(F.col("id") % 17 == 0, F.lit("")).otherwise(F.concat(F.lit("l"), "id")).alias("line"))
    parts = EN.reflow_line_parts(lines)
    assert parts.count() == 25
    whole = EN.with_reflow(lines.groupBy("doc_id").agg(F.array_join(F.sort_array(F.collect_list(F.struct("i", "line")))["line"], "\n")
                                                       .alias("md")), "md", "out").first().out
    assert "".join(r.text for r in sorted(parts.collect(), key=lambda r: r.block)) == whole


# --- M2, M3 ----------------------------------------------------------------------------------------

MD = ("# One\nThe cat sat on the mat. A dog ran. The cat and the dog slept! Rain fell.\n"
      "# Two\nThe sun. The cat purred and purred and purred.\n# Three\n \n")


def test_summary_by_hand_and_without_a_shared_list(spark):
    df = spark.createDataFrame([(1, MD), (2, "# Four\nthe end is near? yes.")], "doc_id long, md string")
    ch = CH.last_slug_wins(df)
    # sections: 4; "the" is in 3 of them and too common, "cat" is in 2 and is not
    assert SU.common_tokens(ch) == ["the"]
    got = {(r.doc_id, r.slug): (r.summary, r.error) for r in SU.extractive_summary(ch, k=1).collect()}
    assert got == {(1, "one"): ("A dog ran.", None), (1, "two"): ("The cat purred and purred and purred.", None),
                   (1, "three"): (None, "empty section"), (2, "four"): ("yes.", None)}
    assert sorted(SU.extractive_summary(ch, limit=0).collect()) == sorted(SU.extractive_summary(ch).collect())


def test_summary_of_odd_sections(spark):
    df = spark.createDataFrame([(1, 0, None), (1, 1, ""), (2, 0, "!!! ???"), (None, 0, "one. two. three. four.")],
                               "doc_id long, seq int, body string")
    got = {(r.doc_id, r.seq): (r.summary, r.error) for r in SU.extractive_summary(df, k=2).collect()}
    assert got == {(1, 0): (None, "empty section"), (1, 1): (None, "empty section"), (2, 0): ("!!! ???", None),
                   (None, 0): ("one. two.", None)}
    assert SU.extractive_summary(df.where("false")).count() == 0


def _section_batch(sizes, words=2000):
    """Sections of the given numbers of sentences, 30 tokens each, as the summary's task function gets them."""
    rng = random.Random(5)
    toks = [[[f"w{rng.randrange(words)}" for _ in range(30)] for _ in range(n)] for n in sizes]
    return pa.RecordBatch.from_pydict({
        "seq": list(range(len(sizes))), "_blank": [n == 0 for n in sizes],
        "_ss": pa.array([[" ".join(t) for t in x] for x in toks], pa.list_(pa.string())),
        "_toks": pa.array(toks, pa.list_(pa.list_(pa.string()))),
        "_common": pa.array([["w1", "w7"] if i % 3 else None for i in range(len(sizes))], pa.list_(pa.string()))})


def test_summary_memory_does_not_grow_with_the_batch():
    peaks = []
    for n in (100, 800):
        batch = _section_batch([40] * n)
        tracemalloc.start()
        told = sum(b.num_rows for b in SU._summaries(["w1"], 3, SU.SCORE_SCALE)(iter([batch])))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert told == n
    assert peaks[1] < 1.5 * peaks[0], peaks      # eight times the sections


@pytest.mark.parametrize("common", [["w1", "w7"], None])
def test_summary_is_the_same_for_any_cut_of_a_batch(common):
    batch = _section_batch([0, 3, 50, 0, 0, 1, 2, 9, 200, 0, 4, 0], words=60)
    whole = [r for b in SU._summaries(common, 3, SU.SCORE_SCALE, 1 << 40)(iter([batch, batch.slice(0, 0)])) for r in b.to_pylist()]
    assert len(whole) == batch.num_rows
    for most in (1, 40, 700, 6300):
        parts = list(SU._summaries(common, 3, SU.SCORE_SCALE, most)(iter([batch.slice(0, 4), batch.slice(4)])))
        assert [r for b in parts for r in b.to_pylist()] == whole and len(parts) > 2


def test_summary_plan_moves_no_sections(spark):
    from test_plans import _plan
    plan = _plan(E.queries()["M2_extractive_summary"](spark, SF_SMALL))
    assert "Exchange" not in plan and "MapInArrow" in plan


def _files(folder):
    return {os.path.join(at, n): os.stat(os.path.join(at, n)).st_mtime_ns for at, _, names in os.walk(folder)
            for n in names if n.startswith("part-")}


def test_only_changed_sections_are_summarized_again(spark, tmp_path):
    store = str(tmp_path / "store")
    seen = []

    def summarize(sections):
        seen.append([(r.doc_id, r.slug) for r in sections.collect()])
        return SU.extractive_summary(sections, common=[])

    def run(docs):
        df = spark.createDataFrame(docs, "doc_id long, md string")
        return SU.update_summaries(CH.last_slug_wins(df), store, summarize, buckets=8)

    def stored():
        return sorted(((r.doc_id, r.out_name, r.text) for r in spark.read.parquet(store).collect()), key=repr)

    docs = [(d, f"# A\nalpha {d}.\n# B\nbeta {d}.\n# C\n\n") for d in range(12)] + [(None, "# N\nnone.")]
    first = run(docs)
    assert first["sections"] == first["summarized"] == 37 and len(stored()) == 37
    before, rows = _files(store), stored()
    assert run(docs) == {"sections": 37, "summarized": 0, "dropped": 0, "partitions": 0}
    assert _files(store) == before and len(seen) == 1

    docs[5] = (5, "# A\nchanged.\n# B\nbeta 5.\n# C\n\n")
    done = run(docs)
    assert (done["summarized"], done["dropped"], done["partitions"]) == (1, 1, 1) and seen[-1] == [(5, "a")]
    after = _files(store)
    assert len({os.path.dirname(f) for f in set(before) ^ set(after)}) == 1      # one partition was rewritten
    assert set(stored()) ^ set(rows) == {(5, "sum_extractive_a.md", "alpha 5."), (5, "sum_extractive_a.md", "changed.")}

    done = run([docs[0]])                                  # all others are gone; emptied partitions too
    assert done["summarized"] == 0 and done["dropped"] == 34
    assert {r[0] for r in stored()} == {0}
    assert run([]) == {"sections": 0, "summarized": 0, "dropped": 3, "partitions": 1} and _files(store) == {}


# --- branches that the plain tables never reach ----------------------------------------------------

FIRES = {
    "W6_first_equal_chapter_odd": "first_equal != seq + 1",
    "W5_last_slug_wins_odd": "slug = 'chapter_1'",
    "H7_validate_markdown_odd": "reason = 'document without text'",
    "M3_store_summaries_odd": "text = 'Error: empty section'",
    "P14_map_lang_code_odd": "ocr_lang = 'chi_sim'",
    "J1_lang_map_join_odd": "lang = 'ru' and ocr_lang = 'rus'",
    "H6_route_by_format_odd": "route = 'epub' and reject_reason is null",
    "P12_item_title_odd": "item_title like 'Chapter %'",
    "Q1_pages_to_book_odd": "book_id is null and n_pages > 0",
}


@pytest.mark.parametrize("name", sorted(FIRES))
def test_the_branch_fires(spark, name):
    assert E.queries()[name](spark, SF_SMALL).where(FIRES[name]).count() > 0


def test_empty_titles_are_skipped(spark):
    from quire.sources import corpora as C
    md = C.corpus(spark, "md_odd", SF_SMALL).where("doc_id % 7 = 1")
    cuts = CH.first_equal_chapter(md).count()
    kept = CH.split_chapters(md)
    assert cuts == 3 * md.count() and {r.slug for r in kept.collect()} == {"named"}
