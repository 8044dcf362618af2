"""E2 chapter cutting, W5 last slug wins, W6 unnamed chapters, H7 validation."""

from quire.operators import chapters as CH


def _df(spark, *mds):
    return spark.createDataFrame([(i, m) for i, m in enumerate(mds)], "doc_id long, md string")


def test_split(spark):
    rows = CH.split_chapters(_df(spark, "pre\n# A\nx\n## s\n# B-C d!\ny")).orderBy("seq").collect()
    assert [(r.title, r.slug, r.rendered) for r in rows] == [
        ("A", "a", "# A\n\nx\n## s"), ("B-C d!", "b_c_d", "# B-C d!\n\ny")]


def test_unnamed_and_empty_title(spark):
    r = CH.split_chapters(_df(spark, "# ???\nz")).first()
    assert (r.title, r.slug, r.rendered) == ("???", "chapter_1", "# ???\n\nz")
    r = CH.split_chapters(_df(spark, "# \nfoo")).first()
    assert (r.title, r.body) == ("foo", "")


def test_last_slug_wins(spark):
    rows = CH.last_slug_wins(_df(spark, "# A\n1\n# a\n2")).collect()
    assert len(rows) == 1 and rows[0].body == "2"


def test_validate(spark):
    got = {r.doc_id: r.reason for r in CH.validate_markdown(_df(spark, "no heading", "  ", "# ok\n")).collect()}
    assert got[0].startswith("no line starts a chapter") and got[1] == "document without text" and got[2] is None


def test_first_equal_positions(spark):
    md = "# x\n# y\n# x\n# z\n# y\n# \n# \n"
    got = [r.first_equal for r in CH.first_equal_chapter(_df(spark, md)).orderBy("seq").collect()]
    assert got == [1, 2, 1, 4, 2, 6, 6]


def test_unnamed_chapters_numbered_by_first_equal(spark):
    rows = CH.split_chapters(_df(spark, "# ???\na\n# !!!\nb\n# ???\na\n")).orderBy("seq").collect()
    assert [r.slug for r in rows] == ["chapter_1", "chapter_2", "chapter_1"]
