"""HTML column functions: entity decoding (P10), HTML to text (P8), HTML to Markdown.

All rules are ordered ``regexp_replace`` steps on the whole entry, so they run in
the JVM per row with no parser object and no Python.  Elements whose content is
not text (comments, declarations, script, style) are removed *before* tags are
stripped, which keeps ``"</p>"`` inside a script from leaking.  Entities are
decoded last, in one pass, so ``&amp;lt;`` gives ``&lt;``.
"""

from __future__ import annotations

import html.entities

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as RX
from .text import _c, ColumnOrName

# HTML 5 names from the standard library, most with ``;``; the legacy ones also without.
NAMED_ENTITIES: dict[str, str] = dict(sorted(html.entities.html5.items(), key=lambda kv: (len(kv[0]), kv[0])))
_LEGACY = "|".join(sorted((k for k in NAMED_ENTITIES if not k.endswith(";")), key=len, reverse=True))

ENTITY = rf"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;|{_LEGACY})"
REPLACEMENT_CHAR = "�"
# Numeric references 128-159 name the windows-1252 characters where that code has one.
WINDOWS_1252 = [bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)]


def aci(word: str) -> str:
    """ASCII-only case-insensitive literal (HTML tag names)."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


# Attributes up to the end of a tag; ``>`` inside a quoted value does not end it.
ATTRS = r"""(?:[^>=]++|=[ \t\n\r\f]*+(?:"[^"]*+"|'[^']*+')?+)*+"""


def _element(tag: str) -> str:
    """An element with its content, up to the end of the text when it is not closed."""
    return rf"(?s)<{aci(tag)}\b{ATTRS}>.*?(?:</{aci(tag)}\b[^>]*>|\z)"


# Order matters: non-text elements first, then any tag.
COMMENT = r"(?s)<!--.*?-->"
DECLARATION = r"<![^>]*>"
PROC_INSTR = r"<\?[^>]*>"
TAG = rf"</?[A-Za-z]{ATTRS}>"
HTML_WS = r"[ \t\n\r\f]+"


def _code_point_char(n: Column) -> Column:
    ok = (n > 0) & (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
    as_char = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    return F.when(ok, as_char).otherwise(F.lit(REPLACEMENT_CHAR))


def _decode_one(e: Column) -> Column:
    lookup = F.str_to_map(F.lit("\x02".join(f"{k}\x01{v}" for k, v in NAMED_ENTITIES.items())),
                          F.lit("\x02"), F.lit("\x01"))
    # leading zeros do not count; more than 7 digits left is above U+10FFFF
    hexd = F.regexp_extract(e, r"\A&#[xX]0*+([0-9a-fA-F]*+)", 1)
    decd = F.regexp_extract(e, r"\A&#0*+([0-9]*+)", 1)
    number = (F.when(F.greatest(F.length(hexd), F.length(decd)) > 7, F.lit(0x110000).cast("bigint"))
              .when(hexd != "", F.conv(hexd, 16, 10).cast("bigint"))
              .when(decd != "", decd.cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    windows = F.try_element_at(F.array(*[F.lit(x) for x in WINDOWS_1252]), (number - 127).cast("int"))
    return (F.when(e.startswith("&#"), F.when(number.between(128, 159), windows).otherwise(_code_point_char(number)))
            .otherwise(F.coalesce(F.element_at(lookup, F.substring(e, 2, F.length(e))), e)))


# P10
def decode_entities(c: ColumnOrName) -> Column:
    """Named (HTML 5 set; the legacy names also without ``;``) and numeric character
    references, one pass.

    Unknown names stay as they are.  Numbers 128-159 give the windows-1252 character;
    code point 0, surrogates and values above U+10FFFF give U+FFFD.  The text is cut
    into entity / plain / lone-``&`` pieces by one regex, so the input expression is
    read exactly once.
    """
    pieces = F.regexp_extract_all(_c(c), F.lit(f"{ENTITY}|[^&]+|&"), 0)
    return F.array_join(F.transform(pieces, lambda p: F.when(
        p.startswith("&") & (p != "&"), _decode_one(p)).otherwise(p)), "")


def _strip_non_text(t: Column) -> Column:
    for p in (COMMENT, _element("script"), _element("style"), DECLARATION, PROC_INSTR):
        t = F.regexp_replace(t, p, "")
    return t


# P8
def html_to_text(c: ColumnOrName) -> Column:
    """Text of an HTML entry: script, style, comments and declarations dropped, text
    nodes joined with no separator, entities decoded, whitespace collapsed."""
    t = _strip_non_text(_c(c))
    t = F.regexp_replace(t, TAG, "")
    t = decode_entities(t)
    return F.trim(F.regexp_replace(t, RX.WS + "+", " "))


# P9 rules, in order: (pattern, replacement).
BLOCK_TAGS = ("p", "div", "article", "section", "header", "footer", "nav", "main", "aside",
              "ul", "ol", "table", "tr", "blockquote", "body", "html", "title")


# An attribute value in its three forms: three groups, one of which matches.
VALUE = r"""(?:"([^"]*)"|'([^']*)'|([^ "'<>]+))"""
# Text of a link, which does not run past the start of another one.
LINK_TEXT = r"((?:[^<]++|<(?!/?[aA]\b))*+)"


def _md_rules() -> list[tuple[str, str]]:
    blocks = "|".join(aci(t) for t in BLOCK_TAGS)
    link, image = f"<{aci('a')}\\b", f"<{aci('img')}\\b"
    href, src, alt = (rf"[^>]*? {aci(n)} ?= ?{VALUE}" for n in ("href", "src", "alt"))
    rules = [(_element("head"), "")]
    rules += [(rf"<{aci('h')}{n}\b{ATTRS}>", "\n\n" + "#" * n + " ") for n in range(1, 7)]
    rules += [
        (rf"</{aci('h')}[1-6]\b[^>]*>", "\n\n"),
        (rf"</?(?:{blocks})\b{ATTRS}>", "\n\n"),
        (rf"<{aci('br')}\b{ATTRS}>", "\n"),
        (rf"<{aci('li')}\b{ATTRS}>", "\n* "),
        (rf"</{aci('li')}\b[^>]*>", ""),
        (rf"</?(?:{aci('strong')}|{aci('b')})\b{ATTRS}>", "**"),
        (rf"</?(?:{aci('em')}|{aci('i')})\b{ATTRS}>", "_"),
        (rf"{link}{href}{ATTRS}>{LINK_TEXT}</{aci('a')} ?>", "[$4]($1$2$3)"),
        (rf"{image}{src}{alt}{ATTRS}>", "![$4$5$6]($1$2$3)"),
        (rf"{image}{alt}{src}{ATTRS}>", "![$1$2$3]($4$5$6)"),
        (rf"{image}{src}{ATTRS}>", "![]($1$2$3)"),
        (TAG, ""),
    ]
    return rules


MD_RULES = _md_rules()


def html_to_markdown(c: ColumnOrName) -> Column:
    """Markdown of an HTML entry (our own rule set, see README): headings, paragraphs,
    line breaks, list items, bold, italic, links, images; head, script, style and
    comments dropped; no line wrapping."""
    t = _strip_non_text(_c(c))
    t = F.regexp_replace(t, HTML_WS, " ")
    for pattern, repl in MD_RULES:
        t = F.regexp_replace(t, pattern, repl)
    t = decode_entities(t)
    t = F.regexp_replace(t, r" *\n *", "\n")
    t = F.regexp_replace(t, r"\n{3,}", "\n\n")
    return F.regexp_replace(t, r"\A[ \n]+|[ \n]+\z", "")
