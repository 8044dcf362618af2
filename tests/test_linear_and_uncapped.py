"""Long inputs in linear time and without stack use; no caps on references or bodies."""

import time

from conftest import one
from quire.functions import html as H
from quire.functions import text as T
from quire.operators import entries
from quire.session import ensure_checkpoint_dir


def test_numeric_references_of_any_length(spark):
    cases = {"caf&#0000000233;": "café", "&#x000000000E9;": "é", "&#99999999999999999999;": "�",
             "&#0;": "�", "&#65 b": "A b", "&amp;lt;": "&lt;", "&#;": "&#;", "&#xD800;": "�"}
    for raw, want in cases.items():
        assert one(spark, H.decode_entities("x"), raw) == want, raw


def test_long_list_and_code_blocks_keep_the_jvm_alive(spark):
    for head in ("- item", "```"):
        text = "\n".join([head] + ["line %d" % i for i in range(50_000)] + ["", "after", "all"])
        df = spark.createDataFrame([(text,)], "x string")
        got = entries.with_reflow(df, "x", "out").first()["out"]
        assert got.startswith(head) and got.endswith("after all")


def test_long_word_is_linear(spark):
    t0 = time.time()
    assert one(spark, T.clean_page_text("x"), "x" * 80_000 + " well- known") == "x" * 80_000 + " wellknown"
    assert time.time() - t0 < 10


def test_hyphen_forms_agree(spark):
    for raw, want in {"a-b-c": "ab-c", "well-\n known": "wellknown", "-a": "-a", "a- -b": "a- -b", "a--b": "a--b"}.items():
        assert one(spark, T.clean_page_text("x"), raw) == want


def test_checkpoint_folder_is_set_once(spark):
    first = ensure_checkpoint_dir(spark)
    assert all(ensure_checkpoint_dir(spark) == first for _ in range(200))


def test_entities_html5_legacy_and_windows(spark):
    cases = {"it&apos;s": "it's", "&#146;": "’", "&#x80;&#129;": "€\x81", "caf&#0000000233;": "café",
             "p?x=1&lang=en&sub=2": "p?x=1&lang=en&sub=2", "&eacute &notin; &hellip;": "é ∉ …",
             "&hellip": "&hellip", "&NotEqualTilde;": "≂̸", "&copy2": "©2", "&bogus;&": "&bogus;&"}
    for raw, want in cases.items():
        assert one(spark, H.decode_entities("x"), raw) == want, raw


def test_tags_with_quoted_angles_and_unclosed_script(spark):
    cases = {'<p title="a > b">text</p>': "text", "<p title='a > b' id=x>text</p>": "text",
             "a<script>var x = 1 < 2;": "a", "<p>it's</p> don't": "it's don't",
             '<p title="open>text</p>': "text", "<header>H</header><style>s</style>x": "Hx"}
    for raw, want in cases.items():
        assert one(spark, H.html_to_text("x"), raw) == want, raw


def test_links_and_images(spark):
    cases = {'<a href="u">see <abbr>HTML</abbr> spec</a>': "[see HTML spec](u)",
             "<a class=c href='u v'>t</a>": "[t](u v)", "<a href=u?x=1>t</a>": "[t](u?x=1)",
             "<img src='s.png' alt=pic>": "![pic](s.png)", '<img alt="a > b" src="s">': "![a > b](s)",
             "<a href='1'>one <a href='2'>two</a>": "one [two](2)", "<head>x</head><header>H</header>": "H"}
    for raw, want in cases.items():
        assert one(spark, H.html_to_markdown("x"), raw) == want, raw


def test_anchors_without_an_end_are_linear(spark):
    t0 = time.time()
    one(spark, H.html_to_markdown("x"), "<a href='u'>text " * 20_000)
    assert time.time() - t0 < 20


def test_lines_that_start_with_the_mark(spark):
    for raw, want in {"a\n\x01b": "a \x01b", "- x\n\x01y\n\nz\n\x01q": "- x\n\x01y\n\n\nz \x01q", "\x02a\x01": "\x02a\x01"}.items():
        df = spark.createDataFrame([(raw,)], "x string")
        assert entries.with_reflow(df, "x", "out").first()["out"] == want
