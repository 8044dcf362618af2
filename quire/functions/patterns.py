"""Regular-expression building blocks shared by the Spark code and the SQL oracles.

Spark evaluates patterns with java.util.regex, DuckDB with RE2.  Every class below
is written so that both engines read it the same way: explicit ``\\x{..}`` code
points instead of ``\\s``/``\\w``, ``\\A``/``\\z`` instead of ``^``/``$``.  The
only construct that differs is the multi-line flag: Java needs ``d`` (UNIX_LINES)
so that ``^`` and ``.`` only treat ``\\n`` as a line end, RE2 already does.
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
# Python's str whitespace (the set used by str.strip(), str.split() and
# re's \s on str patterns): 29 code points.
WS_CHARS = (r"\t\n\x{0b}\f\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
# Python's \w on str patterns: letters, numbers and underscore.
WC_CHARS = r"\p{L}\p{N}_"
# Python's \d on str patterns: decimal digits (Nd).
DIGIT = r"\p{Nd}"
# Characters Python's str.isupper() counts as upper case beyond Lu (Other_Uppercase).
UPPER_EXTRA = r"\x{2160}-\x{216f}\x{24b6}-\x{24cf}\x{1f130}-\x{1f149}\x{1f150}-\x{1f169}\x{1f170}-\x{1f189}"
# Characters that make str.isupper() false beyond Ll and Lt (Other_Lowercase).
LOWER_EXTRA = (r"\x{aa}\x{ba}\x{2b0}-\x{2b8}\x{2c0}\x{2c1}\x{2e0}-\x{2e4}\x{345}\x{37a}"
               r"\x{1d2c}-\x{1d6a}\x{1d78}\x{1d9b}-\x{1dbf}\x{2071}\x{207f}\x{2090}-\x{209c}"
               r"\x{2170}-\x{217f}\x{24d0}-\x{24e9}")
# Letters that Python's IGNORECASE matching treats as equal to an ASCII letter
# besides its upper/lower case pair.
CASE_EXTRA = {"i": r"\x{130}\x{131}", "s": r"\x{17f}", "k": r"\x{212a}"}
# Markdown image reference, as removed from converted HTML.
IMAGE_REF = r"!\[[^\n]*?\]\([^\n]*?\)"
# Paragraph terminators that stop a line from being joined to the next one.
LINE_END_PUNCT = ".!?:;"
# Sentence terminators for sentence splitting.
SENTENCE_END = ".!?"
# Characters that end a line which is then not a short title.
TITLE_END_PUNCT = ".!?,;:"
# ---------------------------------------------------------------------------

WS = f"[{WS_CHARS}]"
NON_WS = f"[^{WS_CHARS}]"
# the same set for Java: one range test rules out nearly every other character
WS_SPARK = rf"[\x00-\x20\x{{85}}-\x{{3000}}&&[{WS_CHARS}]]"
# the same set as text
WS_LIST = "".join(chr(c) for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                   0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
WS_NO_NL = WS.replace(r"\t\n", r"\t")
WC = f"[{WC_CHARS}]"
UPPER = rf"[\p{{Lu}}{UPPER_EXTRA}]"
LOWER_OR_TITLE = rf"[\p{{Ll}}\p{{Lt}}{LOWER_EXTRA}]"
# ``[A-Z]`` under Python's IGNORECASE.
LETTER_CI = r"[A-Za-z\x{130}\x{131}\x{17f}\x{212a}]"

STRIP = rf"\A{WS}+|{WS}+\z"


def ci(word: str) -> str:
    """Case-insensitive literal written out as classes, identical in both engines."""
    out = []
    for ch in word:
        if ch.isalpha():
            out.append(f"[{ch.lower()}{ch.upper()}{CASE_EXTRA.get(ch.lower(), '')}]")
        elif ch == " ":
            out.append(f"{WS}+")
        else:
            out.append(ch)
    return "".join(out)


def multiline(engine: str) -> str:
    """Inline flag for ``^`` at every line start, ``\\n`` being the only line end."""
    return "(?md)" if engine == "spark" else "(?m)"


# Header rules for a stripped paragraph.
HEADER_L2 = (rf"\A(?:{ci('chapter')}{WS}+{DIGIT}|{ci('section')}{WS}+{DIGIT}"
             rf"|{DIGIT}+\.{WS}+{LETTER_CI}|{DIGIT}+\.{DIGIT}+{WS}+{LETTER_CI})")
HEADER_L3 = rf"\A{DIGIT}+\.{WS}+{WC}"
TOC_HEADING = (rf"\A{WS}*(?:{ci('table of contents')}|{ci('contents')}|{ci('toc')}){WS}*\z")
TOC_ENTRY = rf"\A[^\n]*\.{{2,}}[^\n]*{DIGIT}"

PARAGRAPH_BREAK = rf"\n{WS}*\n"
STRICT_PARAGRAPH_BREAK = r"\n{2,}"
HYPHEN_JOIN = rf"({WC}+)-{WS}*({WC}+)"
# the same matches in time linear in the word length; RE2 has neither look-behind nor possessives
HYPHEN_JOIN_LINEAR = rf"(?<!{WC})({WC}++)-{WS}*+({WC}++)"
CAMEL = r"([a-z])([A-Z])"
TOKEN = rf"{WC}+"


def sentence_break_spark() -> str:
    return rf"(?<=[{SENTENCE_END}]){WS}+"


def list_or_code_line(engine: str) -> str:
    """A line that opens a list or code block once stripped."""
    return rf"{multiline(engine)}^{WS_NO_NL}*(?:[-*+] [^\n]*{NON_WS}|```)[^\n]*"


def block_region(engine: str) -> str:
    """A list/code opening line and the non-blank lines that follow it.

    Possessive, so that Java does not recurse once per line; Spark only.
    """
    return rf"{list_or_code_line(engine)}(?:\n[^\n]*{NON_WS}[^\n]*)*+"


def chapter_cut(level: int, engine: str) -> str:
    return multiline(engine) + "^" + "#" * level + " "


def sql_str(s: str) -> str:
    """Quote a Python string as a SQL string literal (no escape processing)."""
    return "'" + s.replace("'", "''") + "'"
