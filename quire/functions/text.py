"""Text column functions (P1-P7, P11-P17) and predicates (H1-H6).

Each function takes and returns a ``Column`` built only from Spark's built-in
functions, so it runs inside whole-stage codegen (or, for array lambdas, in the
JVM without a Python round trip) and never shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as RX

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: ColumnOrName) -> Column:
    """Python ``str.strip()``: trims all 29 Unicode whitespace code points.

    Looks at both ends only, where a pattern would try every run of white space.
    """
    return F.btrim(_c(c), F.lit(RX.WS_LIST))


def is_blank(c: ColumnOrName) -> Column:
    return ~_c(c).rlike(RX.NON_WS)


def is_upper(c: ColumnOrName) -> Column:
    """Python ``str.isupper()``: some cased character, none lower or title case."""
    c = _c(c)
    return c.rlike(RX.UPPER) & ~c.rlike(RX.LOWER_OR_TITLE)


# P1
def collapse_ws(c: ColumnOrName) -> Column:
    """Runs of whitespace to one space, stripped."""
    return F.trim(F.regexp_replace(_c(c), RX.WS_SPARK + "+", " "))


# P2
def join_broken_lines(c: ColumnOrName) -> Column:
    return F.regexp_replace(_c(c), "\n", " ")


# P3
def split_paragraphs(c: ColumnOrName) -> Column:
    """Paragraphs: split at a blank line, lines joined and spaces collapsed, empties dropped."""
    parts = F.split(_c(c), RX.PARAGRAPH_BREAK, -1)
    return F.filter(F.transform(parts, collapse_ws), lambda p: p != "")


# P4
def split_paragraphs_strict(c: ColumnOrName) -> Column:
    """Split at two or more newlines, strip each part, drop blank parts."""
    parts = F.split(_c(c), RX.STRICT_PARAGRAPH_BREAK, -1)
    return F.filter(F.transform(parts, strip_ws), lambda p: p != "")


# P5
def split_sentences(c: ColumnOrName) -> Column:
    """Break after ``.``, ``!`` or ``?`` followed by whitespace."""
    return F.split(_c(c), RX.sentence_break_spark(), -1)


def format_paragraph(c: ColumnOrName) -> Column:
    """Sentences rejoined with one space (the reference's paragraph formatting)."""
    return F.array_join(split_sentences(c), " ")


# P6
def clean_page_text(c: ColumnOrName) -> Column:
    """Whitespace collapsed, hyphenated words joined, camelCase split, stripped."""
    t = F.regexp_replace(_c(c), RX.WS + "+", " ")
    t = F.regexp_replace(t, "\f", "")
    t = F.regexp_replace(t, RX.HYPHEN_JOIN_LINEAR, "$1$2")
    t = F.regexp_replace(t, RX.CAMEL, "$1 $2")
    return strip_ws(t)


# P7
def md_squeeze(c: ColumnOrName) -> Column:
    """3+ newlines to 2, image references removed, spaces before a newline removed."""
    t = F.regexp_replace(_c(c), r"\n{3,}", "\n\n")
    t = F.regexp_replace(t, RX.IMAGE_REF, "")
    return F.regexp_replace(t, r" +\n", "\n")


# P11
def slugify(title: ColumnOrName, number: ColumnOrName | None = None) -> Column:
    """File-name slug: lower case, only word characters, spaces, hyphens; runs to ``_``.

    When the slug is empty and ``number`` is given, ``chapter_<number>``.
    """
    s = F.regexp_replace(F.lower(_c(title)), rf"[^{RX.WC_CHARS}{RX.WS_CHARS}-]", "")
    s = F.regexp_replace(s, rf"[-{RX.WS_CHARS}]+", "_")
    if number is None:
        return s
    return F.when(s == "", F.concat(F.lit("chapter_"), _c(number).cast("string"))).otherwise(s)


# P12
def item_title(md: ColumnOrName, item_id: ColumnOrName) -> Column:
    """Text after the first ``# `` up to the end of its line, else ``Chapter <id>``."""
    md = _c(md)
    found = F.regexp_extract(md, r"# ([^\n]*)", 1)
    return F.when(md.rlike("# "), found).otherwise(
        F.concat(F.lit("Chapter "), _c(item_id).cast("string")))


# P13
def heading_markdown(level: ColumnOrName, text: ColumnOrName, stripped: bool = False) -> Column:
    """``#`` repeated min(level + 1, 6) times, a space and the stripped text."""
    n = F.least(_c(level) + 1, F.lit(6))
    return F.concat(F.repeat(F.lit("#"), n), F.lit(" "), _c(text) if stripped else strip_ws(text))


# P14
# fixed values: language code -> OCR language pack code; others pass through.
LANG_PACKS = [("zh", "chi_sim"), ("ja", "jpn"), ("ko", "kor"), ("ru", "rus"),
              ("ar", "ara"), ("hi", "hin"), ("fa", "fas")]


def map_lang_code(iso: ColumnOrName) -> Column:
    lookup = F.create_map(*[F.lit(x) for kv in LANG_PACKS for x in kv])
    iso = _c(iso)
    return F.coalesce(F.element_at(lookup, iso), iso)


# P15
def base_name(path: ColumnOrName) -> Column:
    """File name without directory and last suffix (a leading-dot name has none)."""
    name = F.regexp_extract(_c(path), r"([^/]*)\z", 1)
    return F.regexp_replace(name, r"\A(\.*[^.][^/]*?)\.[^.]*\z", "$1")


def file_suffix(path: ColumnOrName) -> Column:
    name = F.regexp_extract(_c(path), r"([^/]*)\z", 1)
    return F.regexp_extract(name, r"\A\.*[^.].*(\.[^.]*)\z", 1)


def file_name(path: ColumnOrName) -> Column:
    return F.regexp_extract(_c(path), r"([^/]*)\z", 1)


# P16
def preview(c: ColumnOrName, n: int = 300) -> Column:
    return F.concat(F.substring(_c(c), 1, n), F.lit("..."))


# P17
def prompt_text(c: ColumnOrName) -> Column:
    return F.concat(F.lit("\n\n"), _c(c))


# H1
def header_level(c: ColumnOrName, stripped: bool = False) -> Column:
    """Header level of a paragraph (1, 2, 3) or NULL for an ordinary paragraph.

    ``stripped=True`` skips the strip for text that has none to remove (P3 output).
    """
    s = _c(c) if stripped else strip_ws(c)
    return (F.when(F.length(s) < 3, F.lit(None))
            .when(is_upper(s) & (F.length(s) > 5), F.lit(1))
            .when(s.rlike(RX.HEADER_L2), F.lit(2))
            .when(s.rlike(RX.HEADER_L3), F.lit(3))
            .otherwise(F.lit(None)).cast("int"))


# H2
def is_short_title(c: ColumnOrName) -> Column:
    c = _c(c)
    short = ((strip_ws(c) != "") & (F.length(c) < 75)
             & ~c.rlike(f"[{RX.TITLE_END_PUNCT}]\\z"))
    return F.coalesce(short | is_upper(c), F.lit(False))


# H3
def is_toc_heading(c: ColumnOrName) -> Column:
    return F.coalesce(_c(c).rlike(RX.TOC_HEADING), F.lit(False))


# H4
def is_toc_entry(c: ColumnOrName) -> Column:
    return F.coalesce(_c(c).rlike(RX.TOC_ENTRY), F.lit(False))


# H5
def non_blank(c: ColumnOrName) -> Column:
    """Keep rows whose text is neither NULL nor empty."""
    c = _c(c)
    return c.isNotNull() & (c != "")


# H6
def route_by_format(name: ColumnOrName, text_only: bool = False) -> Column:
    """STRUCT(route, reject_reason): route is 'epub', 'pdf', 'text' or NULL."""
    name = _c(name)
    if text_only:
        ok = F.lower(name).endswith(".txt")
        return F.struct(F.when(ok, F.lit("text")).alias("route"),
                        F.when(~ok, F.lit("only .txt names are read as ready text"))
                        .alias("reject_reason"))
    ext = F.lower(file_suffix(name))
    route = F.when(ext == ".epub", F.lit("epub")).when(ext == ".pdf", F.lit("pdf"))
    return F.struct(route.alias("route"),
                    F.when(route.isNull(), F.concat(F.lit("no reader for format "), ext))
                    .alias("reject_reason"))
