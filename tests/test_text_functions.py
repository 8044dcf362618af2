"""Hand cases for the text column functions (outputs traced from the reference)."""

from pyspark.sql import functions as F

from quire.functions import text as T
from conftest import one


def test_split_paragraphs(spark):
    assert one(spark, T.split_paragraphs("x"), "a\n\n\nb\n \nc\nd\n\n") == ["a", "b", "c d"]
    assert one(spark, T.split_paragraphs("x"), "  \n \t ") == []


def test_header_level(spark):
    cases = {"OK": None, "ABCDE": None, "ABCDEF": 1, "CHAPTER 1": 1, "123456": None,
             "STRAßE": None, "chapter 3 begins": 2, "Section  2": 2, "1. intro": 2,
             "2.1 details": 2, "1. Überblick": 3, "3. 2x": 3, "1.Intro": None, "chapter one": None}
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    got = {r[0]: r[1] for r in df.select("x", T.header_level("x")).collect()}
    assert got == cases


def test_clean_page_text(spark):
    cases = {"a-b-c": "ab-c", "well-known": "wellknown", "inter-\nnational": "international",
             "aBcD": "a Bc D", "éÉ": "éÉ"}
    for k, v in cases.items():
        assert one(spark, T.clean_page_text("x"), k) == v


def test_is_short_title(spark):
    assert one(spark, T.is_short_title("x"), "Short name") is True
    assert one(spark, T.is_short_title("x"), "Short name.") is False
    assert one(spark, T.is_short_title("x"), "A" * 80) is True
    assert one(spark, T.is_short_title("x"), "") is False


def test_slugify_and_names(spark):
    assert one(spark, T.slugify("x"), "B-C d!") == "b_c_d"
    assert one(spark, T.slugify("x"), "???") == ""
    assert one(spark, T.slugify("x"), "Über-Teil 2") == "über_teil_2"
    assert one(spark, T.base_name("x"), "/a/b/book.tar.gz") == "book.tar"
    assert one(spark, T.base_name("x"), ".bashrc") == ".bashrc"
    assert one(spark, T.file_suffix("x"), "/a/B.PDF") == ".PDF"


def test_route_by_format(spark):
    r = one(spark, T.route_by_format("x"), "/x/Book.EPUB")
    assert (r["route"], r["reject_reason"]) == ("epub", None)
    r = one(spark, T.route_by_format("x"), "/x/book.docx")
    assert r["route"] is None and r["reject_reason"] == "no reader for format .docx"
    assert one(spark, T.route_by_format("x", text_only=True), "a.TXT")["route"] == "text"


def test_strip_matches_python(spark):
    s = "　  a b \x1c\x85\xa0"
    assert one(spark, T.strip_ws("x"), s) == s.strip()


def test_is_upper_matches_python(spark):
    for s in ["ABC", "ABCª", "123", "ǅA", "ÀÉ", "Ⅳ"]:
        assert one(spark, T.is_upper("x"), s) is s.isupper(), s


def test_map_lang_code(spark):
    assert one(spark, T.map_lang_code("x"), "zh") == "chi_sim"
    assert one(spark, T.map_lang_code("x"), "en") == "en"


def test_sentences(spark):
    assert one(spark, T.split_sentences("x"), "A b. C d! E?  F") == ["A b.", "C d!", "E?", "F"]


def test_white_space_is_the_same_set_everywhere(spark):
    from pyspark.sql import functions as F
    from quire.functions import patterns as RX
    points = [c for c in range(0x11000) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c, chr(c)) for c in points], "c int, x string")
    py = {c for c in points if chr(c).isspace()}
    assert set(map(ord, RX.WS_LIST)) == py and len(RX.WS_LIST) == 29
    for pattern in (RX.WS, RX.WS_SPARK):
        assert {r.c for r in df.where(F.col("x").rlike(pattern)).collect()} == py
    got = df.select("x", T.strip_ws(F.concat("x", F.lit(" a b\t"), "x")).alias("s"), T.strip_ws("x").alias("e")).collect()
    assert all((r.s, r.e) == ((r.x + " a b\t" + r.x).strip(), r.x.strip()) for r in got)
