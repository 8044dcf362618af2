"""File sources and sinks with files in a scratch folder."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quire.sinks import files as K
from quire.sinks import named as N
from quire.sources import files as S


def test_scan_text_dir(spark):
    d = tempfile.mkdtemp(prefix="quire-src-")
    with open(os.path.join(d, "b.md"), "w") as f:
        f.write("B\r\nline")
    with open(os.path.join(d, "a.txt"), "w") as f:
        f.write("A")
    with open(os.path.join(d, "bad.bin"), "wb") as f:
        f.write(b"\xff\xfe\x00bad")
    os.mkdir(os.path.join(d, "sub"))
    with open(os.path.join(d, "sub", "c.md"), "w") as f:
        f.write("C")
    ok, rejects = S.scan_text_dir(spark, d)
    got = {r.name: r.text for r in ok.collect()}
    assert got == {"a.txt": "A", "b.md": "B\nline"}
    assert [r.reason for r in rejects.collect()] == ["not valid UTF-8"]
    tree, _ = S.scan_markdown_tree(spark, d)
    assert sorted(r.name for r in tree.collect()) == ["b.md", "c.md"]


def test_require_rows(spark):
    with pytest.raises(ValueError):
        S.require_rows(spark.range(0), "No markdown files found to process.")


def _in_file_order(folder):
    names = sorted(n for n in os.listdir(folder) if n.startswith("part-"))
    return "".join(open(os.path.join(folder, n), newline="").read() for n in names)


def test_write_ordered_parts(spark):
    from quire.operators import assemble as AS
    base = tempfile.mkdtemp(prefix="quire-sink-")
    pages = spark.createDataFrame([(b, p, "" if p == 4 else f"page {p}", None) for b in (1, 2) for p in range(1, 30)],
                                  "book_id long, page_no int, text string, error string")
    K.write_ordered_parts(AS.pages_to_text_parts(pages, block_pages=3), base + "/a2", "book_id", "block")
    for r in AS.pages_to_text(pages).collect():
        assert _in_file_order(f"{base}/a2/book_id={r.book_id}") == r.text + "\n\n"
    docs = spark.createDataFrame([("d", f"n{k:02d}", "" if k == 3 else f"text {k}\n") for k in range(20)],
                                 "g string, name string, text string")
    K.write_ordered_parts(docs, base + "/a1", "g", "name", drop_empty=False)
    assert _in_file_order(base + "/a1/g=d") == AS.concat_docs(docs, "g", "name").first()["text"]


def test_read_text_docs_combined_and_summaries_left_out(spark):
    base = tempfile.mkdtemp(prefix="quire-src-")
    for n, t in {"a.md": "A", "sum_x_a.md": "S", "b.md": "B"}.items():
        with open(os.path.join(base, n), "w") as f:
            f.write(t)
    ok, bad = S.read_text_docs(spark, [base + "/a.md", base + "/b.md"])
    assert sorted((r.name, r.text) for r in ok.collect()) == [("a.md", "A"), ("b.md", "B")] and not bad.count()
    tree, _ = S.scan_markdown_tree(spark, base)
    assert sorted(r.name for r in tree.collect()) == ["a.md", "b.md"]
    single, _ = S.scan_markdown_tree(spark, base + "/sum_x_a.md")
    assert [r.text for r in single.collect()] == ["S"]
    K.write_combined(ok.where("name = 'a.md'"), base + "/all")
    assert _in_file_order(base + "/all") == "A\n"


def test_a_vanished_file_is_skipped(spark):
    d = tempfile.mkdtemp(prefix="quire-src-")
    for n in ("a.txt", "b.txt"):
        with open(os.path.join(d, n), "w") as f:
            f.write(n)
    ok, rejects = S.scan_text_dir(spark, d)
    os.remove(os.path.join(d, "b.txt"))
    assert [r.text for r in ok.collect()] == ["a.txt"]
    assert [tuple(r) for r in rejects.collect()] == [(f"file:{d}/b.txt", S.GONE)]


def test_odd_names_empty_and_unreadable_files(spark):
    d = tempfile.mkdtemp(prefix="quire src%20é+-")
    os.mkdir(d + "/deep er")
    for n, t in {"a b.md": "A", "c%41+é.md": "C", "empty.md": "", "deep er/x.md": "X", "deep er/gone.md": "g"}.items():
        with open(os.path.join(d, n), "w") as f:
            f.write(t)
    with open(d + "/bad.md", "wb") as f:
        f.write(b"\xff")
    os.symlink("/proc/self/mem", d + "/deep er/broken.md")      # opens, but no byte can be read
    ok, rejects = S.scan_markdown_tree(spark, d)
    os.remove(d + "/deep er/gone.md")
    assert sorted((r.name, r.text) for r in ok.collect()) == [("a b.md", "A"), ("c%41+é.md", "C"), ("empty.md", ""),
                                                              ("x.md", "X")]
    got = {r.path[len("file:" + d):]: r.reason for r in rejects.collect()}
    assert set(got) == {"/bad.md", "/deep er/gone.md", "/deep er/broken.md"}
    assert got["/bad.md"] == S.NOT_UTF8 and got["/deep er/gone.md"] == S.GONE
    assert got["/deep er/broken.md"].startswith(S.UNREADABLE)
    top, _ = S.scan_text_dir(spark, d)
    assert sorted(r.name for r in top.collect()) == ["a b.md", "c%41+é.md", "empty.md"]


def test_reasons_of_files_that_cannot_be_opened(tmp_path):
    class Denied:
        def get_file_info(self, name):
            raise PermissionError(13, "Permission denied")

    assert S.look_again("hdfs://h/x", lambda u: (Denied(), u)) == (False, "could not be read: PermissionError")
    assert S.look_again("nosuch://h/x")[1].startswith(S.UNREADABLE)
    assert S.look_again(f"file:{tmp_path}/none") == (False, S.GONE)
    (tmp_path / "zero").write_text("")
    assert S.look_again(f"file:{tmp_path}/zero") == (True, None)


def _tree(folder):
    return {os.path.relpath(os.path.join(at, n), folder): open(os.path.join(at, n), newline="").read()
            for at, _, names in os.walk(folder) for n in names}


def test_files_under_their_own_names(spark, tmp_path):
    from quire.operators import chapters as CH
    from quire.operators import summarize as SU
    out = str(tmp_path / "out")
    md = spark.createDataFrame([("in/my book.txt", "# One!\nx\n# Two\n\n# One?\nlater\r\nend")], "path string, md string")
    ch = CH.last_slug_wins(md, key="path")
    N.write_chapter_files(ch, out, source="path")
    N.write_summary_files(SU.store_summaries(SU.extractive_summary(ch, key="path"), ch, key="path"), out, source="path")
    assert _tree(out) == {
        "my book_chapters/one.md": "# One?\n\nlater\r\nend", "my book_chapters/two.md": "# Two\n\n",
        "my book_chapters/sum_extractive_one.md": "later\r\nend", "my book_chapters/sum_extractive_two.md": "Error: empty section"}
    docs = spark.createDataFrame([("x/a.txt", "A/B: c", "text A\n"), ("b.tar.gz", "T", ""), ("c", "U", None)],
                                 "path string, title string, text string")
    N.write_documents(docs, out + "2")
    N.write_documents(docs, out + "2", title="title", suffix=".txt")
    assert _tree(out + "2") == {"a.md": "text A\n", "b.tar.md": "", "c.md": "", "A_B: c.txt": "text A\n", "T.txt": "", "U.txt": ""}
    N.write_documents(docs.limit(1).withColumn("text", F.lit("new")), out + "2")     # replaced by name, others stay
    assert _tree(out + "2")["a.md"] == "new" and len(_tree(out + "2")) == 6
    assert docs.select(N.summary_path("m", F.col("path"))).collect()[0][0] == "x/sum_m_a.txt"


def test_combined_file_in_order(spark, tmp_path):
    from quire.operators import assemble as AS
    docs = spark.createDataFrame([("g", f"n{k:03d}", "" if k == 3 else f"text {k}\n") for k in range(200)],
                                 "g string, name string, text string").repartition(7)
    N.write_combined_file(docs, str(tmp_path))
    assert _tree(tmp_path) == {"all.md": AS.concat_docs(docs, "g", "name").first()["text"]}


@pytest.mark.parametrize("names", [["a", "a"], ["a", None], ["a", ""], ["a", "../b"], ["a", "x//y"], ["a", "/b"]])
def test_a_failed_write_leaves_nothing(spark, tmp_path, names):
    (tmp_path / "keep.txt").write_text("old")
    df = spark.createDataFrame([(n, f"t{k}") for k, n in enumerate(names)] + [(f"z{k}", "z") for k in range(50)],
                               "name string, text string")
    with pytest.raises(Exception, match="name"):
        N.write_files(df, str(tmp_path), F.col("name"))
    assert _tree(tmp_path) == {"keep.txt": "old"}


def test_only_accepted_attempts_are_committed(tmp_path):
    writer = N.NamedFileWriter(str(tmp_path), False)
    for k, text in ((1, "first try"), (2, "second try")):
        folder = tmp_path / writer.stage / str(k)
        folder.mkdir(parents=True)
        (folder / "a.md").write_text(text)
    writer.commit([N.Attempt(f"{writer.stage}/2", 1), None])
    assert _tree(tmp_path) == {"a.md": "second try"}
    with pytest.raises(ValueError):
        for k in (1, 2):
            (tmp_path / writer.stage / str(k)).mkdir(parents=True)
            (tmp_path / writer.stage / str(k) / "b.md").write_text("x")
        writer.commit([N.Attempt(f"{writer.stage}/{k}", 1) for k in (1, 2)])


def test_write_one_per_doc_and_chapters(spark):
    from quire.operators import chapters as CH
    base = tempfile.mkdtemp(prefix="quire-sink-")
    docs = spark.createDataFrame([("a", "text A"), ("b", "text B")], "name string, text string")
    K.write_one_per_doc(docs, base + "/docs", "name")
    assert [r.value for r in spark.read.text(base + "/docs/name=b").collect()] == ["text B"]
    md = spark.createDataFrame([(1, "# One\nx\n# Two\ny\n")], "doc_id long, md string")
    K.write_chapters(CH.last_slug_wins(md), base + "/ch")
    back = spark.read.text(base + "/ch/doc_id=1/slug=two", wholetext=True).first().value
    assert back == "# Two\n\ny\n"


def test_write_summaries(spark):
    from quire.operators import chapters as CH
    from quire.operators import summarize as SU
    out = tempfile.mkdtemp(prefix="quire-sink-") + "/sum"
    md = spark.createDataFrame([(1, "# One\nA b c. D e f.\n# Two\n \n")], "doc_id long, md string")
    ch = CH.last_slug_wins(md)
    K.write_summaries(SU.store_summaries(SU.extractive_summary(ch), ch), out)
    one = spark.read.text(out + "/doc_id=1/out_name=sum_extractive_one.md").first().value
    assert one == "A b c. D e f."
    two = spark.read.text(out + "/doc_id=1/out_name=sum_extractive_two.md").first().value
    assert two == "Error: empty section"
