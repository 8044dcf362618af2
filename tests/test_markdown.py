"""A4 rendering and W1 table-of-contents detection (hand cases)."""

from pyspark.sql import functions as F

from quire.operators import markdown as MD


def _md(spark, text, title=None, author=None):
    df = spark.createDataFrame([(1, text, title, author)], "doc_id long, text string, title string, author string")
    return MD.text_to_markdown(df).first()["md"]


def test_render(spark):
    assert _md(spark, "p1\n\np2") == "\np1\n\n\np2\n\n"
    assert _md(spark, "") == ""
    assert _md(spark, "p", "T", "A") == "# T\n\n*By A*\n\n\np\n\n"
    assert _md(spark, "CHAPTER ONE\n\nbody") == "\n## CHAPTER ONE\n\n\nbody\n\n"


def _toc(spark, paras):
    df = spark.createDataFrame([(1, "\n\n".join(paras))], "doc_id long, text string")
    row = MD.with_toc_bounds(df.withColumn("_paras", F.split("text", "\n\n"))).first()
    return row["_toc_start"], row["_toc_end"]


def T(k):
    return f"T{k} .... {k}"


def test_toc_cases(spark):
    assert _toc(spark, ["x", "Contents", T(0), T(1), T(2), "body"]) == (1, 4)
    assert _toc(spark, ["Contents", T(0), T(1), "b"])[1] == -1
    assert _toc(spark, ["Contents", T(0), T(1), T(2)])[1] == -1
    assert _toc(spark, ["TOC", T(0), T(1), "b", T(0), T(1), T(2), T(3), "c"]) == (0, 7)
    assert _toc(spark, ["TOC"] + [T(k) for k in range(48)] + ["c"]) == (0, 48)
    assert _toc(spark, ["TOC"] + [T(k) for k in range(49)] + ["c"])[1] == -1
    assert _toc(spark, [T(k) for k in range(5)] + ["c"]) == (-1, -1)


def test_toc_window_operator_agrees(spark):
    cases = [["x", "Contents", T(0), T(1), T(2), "body"],
             ["TOC", T(0), T(1), "b", T(0), T(1), T(2), T(3), "c"],
             ["TOC"] + [T(k) for k in range(49)] + ["c"]]
    rows = [(d, i, p) for d, ps in enumerate(cases) for i, p in enumerate(ps)]
    paras = spark.createDataFrame(rows, "doc_id long, i int, text string")
    got = {r[0]: (r[1], r[2]) for r in MD.toc_range(paras).collect()}
    assert got == {0: (1, 4), 1: (0, 7), 2: (0, -1)}


def test_toc_removed_in_markdown(spark):
    text = "\n\n".join(["Intro", "Contents", T(0), T(1), T(2), "Body"])
    md = _md(spark, text)
    assert "## Table of Contents" in md and "T1 ...." not in md and "Body" in md
