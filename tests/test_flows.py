"""Q1 options: page range, given language, stop after the text."""

from quire.plans import books as BK


def _pages(spark):
    rows = [(1, 1, "Intro page", None), (1, 2, "CHAPTER TWO\n\nbody", None), (1, 3, None, "boom"),
            (2, 1, "short", None)]
    return spark.createDataFrame(rows, "book_id long, page_no int, text string, error string")


def test_q1_given_language_and_range(spark):
    out = {r.book_id: r for r in BK.pages_to_book(_pages(spark), pages=(2, 3), language="zh").collect()}
    assert set(out) == {1}
    r = out[1]
    assert (r.lang, r.ocr_lang, r.n_pages) == ("zh", "zh", 2)
    assert r.text == "CHAPTER TWO\n\nbody\n\n[ERROR ON PAGE 2]"
    # an upper-case placeholder is a header by the upper-case rule, as in the reference
    assert r.md == "\n## CHAPTER TWO\n\n\nbody\n\n\n## [ERROR ON PAGE 2]\n\n"


def test_q1_skip_markdown_default_language(spark):
    df = BK.pages_to_book(_pages(spark), skip_markdown=True)
    assert "md" not in df.columns
    got = {r.book_id: (r.lang, r.text) for r in df.collect()}
    assert got == {1: ("eng", "Intro page\n\nCHAPTER TWO\n\nbody\n\n[ERROR ON PAGE 3]"), 2: ("eng", "short")}


def test_language_of_undetectable_texts(spark):
    from quire.operators import langid as LI
    long_de = "der die das und ist nicht ein eine " * 30
    docs = spark.createDataFrame([(1, long_de, "de"), (2, "the and of is not a one to in " * 30, "en")],
                                 "doc_id long, text string, lang string")
    prof = LI.train_profiles(docs)
    test = spark.createDataFrame([(1, None), (2, ""), (3, "1234567890 " * 9), (4, "der und das ist ein nicht der"),
                                  (5, "short"), (6, "the one is not of the and to a")], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in LI.predict(test, prof).collect()}
    assert got == {1: "eng", 2: "eng", 3: "eng", 4: "de", 5: "eng", 6: "en"}


def test_pieces_do_not_change_profiles(spark, monkeypatch):
    from quire.operators import langid as LI
    docs = spark.createDataFrame([(1, "abc äbc abd " * 40, "x"), (2, "xyz " * 33, "y")],
                                 "doc_id long, text string, lang string")

    def both():
        return (sorted(LI.train_profiles(docs).collect()),
                sorted(LI.doc_profiles(docs).select("doc_id", "_rd", "ngram").collect()))
    base = both()
    monkeypatch.setattr(LI, "PIECE_CHARS", 7)
    assert both() == base


def test_manifest_takes_documents_by_default(spark):
    items = spark.createDataFrame([("b", "B", 1, "i1", "document", "<p>Text.</p>"), ("b", "B", 2, "i2", "style", "p {}")],
                                  "book_id string, book_title string, item_seq int, item_id string, item_type string, html string")
    assert BK.manifest_to_book(items).first().md == "# B\n\n## Chapter i1\n\nText.\n\n"
    assert "p {}" in BK.manifest_to_book(items, type_col=None).first().md
