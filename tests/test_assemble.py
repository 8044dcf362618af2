"""A1, A2, A2b assembly; W2 reflow; html; page positions."""

from pyspark.sql import functions as F

from quire.functions import html as H
from quire.operators import assemble as AS
from quire.operators import entries as EN
from conftest import one


def test_concat_docs(spark):
    df = spark.createDataFrame([("d", "b", "B"), ("d", "a", "A"), ("d", "c", "")], "g string, name string, text string")
    assert AS.concat_docs(df, "g", "name").first()["text"] == "A\n\nB\n\n\n\n"


def test_pages_to_text(spark):
    df = spark.createDataFrame([(1, 1, "x", None), (1, 2, "", None), (1, 3, None, "boom")],
                               "book_id long, page_no int, text string, error string")
    r = AS.pages_to_text(df).first()
    assert (r.text, r.n_pages) == ("x\n\n[ERROR ON PAGE 3]", 3)
    # positions count inside the selected range and across blocks
    r = AS.pages_to_text(df.where("page_no >= 2"), block_pages=1).first()
    assert r.text == "[ERROR ON PAGE 2]"


def test_page_position_blocks(spark):
    df = spark.createDataFrame([(1, p, "t", None) for p in (3, 5, 9, 10, 17)],
                               "book_id long, page_no int, text string, error string")
    got = [r.position for r in AS.page_position(df, block_pages=4).orderBy("page_no").collect()]
    assert got == [1, 2, 3, 4, 5]


def _reflow(spark, s):
    df = spark.createDataFrame([(1, s)], "doc_id long, md string")
    return EN.with_reflow(df, "md", "out").first()["out"]


def test_reflow_cases(spark):
    assert _reflow(spark, "a.\n\nb") == "a.\n\n\nb"
    assert _reflow(spark, "a\nb\n c.\nd") == "a b c.\n\nd"
    assert _reflow(spark, "# T\nbody") == "# T body"
    assert _reflow(spark, "x\n# T") == "x\n\n# T"
    assert _reflow(spark, "p\n- a\n  b\n\nq\nr") == "p\n- a\n  b\n\n\nq r"
    assert _reflow(spark, "```\nx\n\ny\n```") == "```\nx\n\n\ny\n```"


def test_reflow_window_agrees(spark):
    texts = ["a.\n\nb", "a\nb\n c.\nd", "p\n- a\n  b\n\nq\nr", "```\nx\n\ny\n```", "x\n# T"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, md string")
    in_row = {r.doc_id: r.out for r in EN.with_reflow(df, "md", "out").collect()}
    windowed = {r.doc_id: r.md for r in EN.reflow_lines(AS.explode_lines(df, "doc_id", "md")).collect()}
    assert in_row == windowed


def test_html(spark):
    html = '<html><head><title>T</title><script>var t="</p>";</script></head><body><p>a &amp;lt; &amp b</p><!-- c --><p>x&#233;&am</p></body></html>'
    assert one(spark, H.html_to_text("x"), html) == "Ta &lt; & bxé&am"
    md = one(spark, H.html_to_markdown("x"), '<h2>Head</h2><p>One <b>bold</b> <a href="u">link</a></p><ul><li>i1</li></ul><img alt="p" src="s.png">')
    assert md == "## Head\n\nOne **bold** [link](u)\n\n* i1\n\n![p](s.png)"


def test_decode_entities_edges(spark):
    cases = {"a &amp;lt; b": "a &lt; b", "&am x": "&am x", "&amp x": "& x", "&#0;": "�",
             "&bogus; &copy &#x1F600;&#233;": "&bogus; © 😀é", "no entity": "no entity", "&": "&",
             "": ""}
    for k, v in cases.items():
        assert one(spark, H.decode_entities("x"), k) == v, k


def test_null_page_numbers_come_first(spark):
    df = spark.createDataFrame([(1, 2, "two", None), (1, None, "none", None), (1, 1, None, "boom"), (None, 1, "x", None)],
                               "book_id long, page_no int, text string, error string")
    got = {r.book_id: (r.text, r.n_pages) for r in AS.pages_to_text(df).collect()}
    assert got == {1: ("none\n\n[ERROR ON PAGE 2]\n\ntwo", 3), None: ("x", 1)}
    pos = {(r.book_id, r.page_no): r.position for r in AS.page_position(df, block_pages=2).collect()}
    assert pos == {(1, None): 1, (1, 1): 2, (1, 2): 3, (None, 1): 1}
    md = {r.book_id: r.md for r in AS.pages_to_markdown(df, F.lit("n")).collect()}
    assert md[1] == "# n\n\n\n## none\n\n\n## two\n\n"


def test_parts_join_to_the_whole_text(spark):
    rows = [(b, p, None if p % 5 == 0 else f"page {p}", "bad" if p % 10 == 0 else None) for b in (1, 2) for p in range(1, 60)]
    df = spark.createDataFrame(rows, "book_id long, page_no int, text string, error string")
    whole = {r.book_id: r.text for r in AS.pages_to_text(df).collect()}
    parts = AS.pages_to_text_parts(df, block_pages=5).where("text <> ''").orderBy("book_id", "block").collect()
    for b in (1, 2):
        assert "\n\n".join(r.text for r in parts if r.book_id == b) == whole[b]
