"""Column functions against the same rules written with Python's own text functions.

The SQL oracles share the patterns of the library; here every rule is stated anew in
Python, whose ``re``, ``str.strip`` and ``str.isupper`` define the semantics, and both are run over
hand-written edge cases and random strings of awkward characters.
"""

import random
import re

import pytest
from pyspark.sql import functions as F

from quire.functions import text as T

ODD = list("aZbß-_.!?,;:# \t\n\r\f\x0b\x1c\x85\xa0 　éÉ１2Ⅳªǆ") + ["chapter ", "Section ", "toc", "....", "12. ", "3.4 ", "![x](y)", "\n\n\n"]


def strings(seed, n=600, most=14):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randrange(most))) for _ in range(n)]


def check(spark, column, rule, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, x string")
    got = {r.k: r.v for r in df.select("k", column.alias("v")).collect()}
    wrong = [(t, got[k], rule(t)) for k, t in enumerate(texts) if got[k] != rule(t)]
    assert not wrong, wrong[:5]


def page_text(t):
    flat = re.sub(r"\s+", " ", t)
    joined = re.sub(r"(\w+)-\s*(\w+)", lambda m: m[1] + m[2], flat)
    return re.sub("(?<=[a-z])(?=[A-Z])", " ", joined).strip()


def squeezed(t):
    few = re.sub("\n\n\n+", "\n\n", t)
    return re.sub(" +\n", "\n", re.sub(r"!\[.*?\]\(.*?\)", "", few))


def slug(t):
    kept = "".join(c for c in t.lower() if c.isspace() or c in "-_" or re.match(r"\w", c))
    return re.sub(r"[-\s]+", "_", kept)


def level(t):
    s = t.strip()
    if len(s) < 3:
        return None
    if s.isupper() and len(s) > 5:
        return 1
    for n, start in ((2, r"chapter\s+\d|section\s+\d|\d+\.\s+[A-Z]|\d+\.\d+\s+[A-Z]"), (3, r"\d+\.\s+\w")):
        if re.match(start, s, re.IGNORECASE):
            return n
    return None


def short_title(t):
    return bool(t.strip()) and len(t) < 75 and t[-1] not in ".!?,;:" or t.isupper()


RULES = {
    "P1": (lambda: T.collapse_ws("x"), lambda t: " ".join(t.split())),
    "P4": (lambda: T.split_paragraphs_strict("x"), lambda t: [p.strip() for p in re.split("\n\n+", t) if p.strip()]),
    "P5": (lambda: T.split_sentences("x"), lambda t: re.split(r"(?<=[.!?])\s+", t)),
    "P6": (lambda: T.clean_page_text("x"), page_text),
    "P7": (lambda: T.md_squeeze("x"), squeezed),
    "P11": (lambda: T.slugify("x"), slug),
    "P12": (lambda: T.item_title("x", F.lit("i7")), lambda t: t.split("# ", 1)[1].split("\n", 1)[0] if "# " in t else "Chapter i7"),
    "H1": (lambda: T.header_level("x"), level),
    "H2": (lambda: T.is_short_title("x"), short_title),
    "H3": (lambda: T.is_toc_heading("x"), lambda t: " ".join(t.split()).lower() in ("table of contents", "contents", "toc")),
    "H4": (lambda: T.is_toc_entry("x"), lambda t: bool(re.match(r".*\.{2,}.*\d", t))),
    "strip": (lambda: T.strip_ws("x"), str.strip),
    "is_blank": (lambda: T.is_blank("x"), lambda t: not t.strip()),
    "is_upper": (lambda: T.is_upper("x"), str.isupper),
}
HAND = ["", " ", "Table  of\nContents", "CONTENTS", "TOC ", "Alpha .... 12", "a..b\n3", "1. intro", "1. Überblick", "CHAPTER 1", "chapter 3 x",
        "inter-\nnational thenCase", "a-b-c", "# T", "x # mid\nnext", "## Deep", "a\n\n\n\nb   \n![f](g) c", "Über-Teil 2!", "- -", "SECTION HEADING"]


@pytest.mark.parametrize("name", sorted(RULES))
def test_rule(spark, name):
    column, rule = RULES[name]
    check(spark, column(), rule, HAND + strings(sum(map(ord, name))))
