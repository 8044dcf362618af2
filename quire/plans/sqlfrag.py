"""SQL fragments for the DuckDB oracles.

The oracles restate each operator in plain SQL (window functions, ``unnest``,
ordered ``string_agg``) over the same tables, using the shared regex constants,
so a wrong rule in the Spark code shows up as a hash mismatch.
"""

from __future__ import annotations

from ..functions import patterns as RX

q = RX.sql_str


def e(s: str) -> str:
    """A string literal that may hold newlines and other control characters."""
    out = s.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\f", "\\f")
    return "E'" + out + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(RX.STRIP)}, '', 'g')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, {q(RX.WS + '+')}, ' ', 'g'))"


def rlike(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q(pattern)})"


def is_upper(x: str) -> str:
    return f"({rlike(x, RX.UPPER)} AND NOT {rlike(x, RX.LOWER_OR_TITLE)})"


def paragraphs(x: str) -> str:
    return (f"list_filter(list_transform(regexp_split_to_array({x}, {q(RX.PARAGRAPH_BREAK)}), "
            f"lambda p: {collapse('p')}), lambda p: p <> '')")


def header_level(x: str) -> str:
    s = strip(x)
    return (f"(CASE WHEN length({s}) < 3 THEN NULL "
            f"WHEN {is_upper(s)} AND length({s}) > 5 THEN 1 "
            f"WHEN {rlike(s, RX.HEADER_L2)} THEN 2 "
            f"WHEN {rlike(s, RX.HEADER_L3)} THEN 3 END)")


def heading(level: str, x: str) -> str:
    return f"(repeat('#', least({level} + 1, 6)) || ' ' || {strip(x)})"


def clean_page_text(x: str) -> str:
    t = f"regexp_replace({x}, {q(RX.WS + '+')}, ' ', 'g')"
    t = f"regexp_replace({t}, {e(chr(12))}, '', 'g')"
    t = f"regexp_replace({t}, {q(RX.HYPHEN_JOIN)}, '\\1\\2', 'g')"
    t = f"regexp_replace({t}, {q(RX.CAMEL)}, '\\1 \\2', 'g')"
    return strip(t)


def is_short_title(x: str) -> str:
    return (f"coalesce(({strip(x)} <> '' AND length({x}) < 75 AND NOT "
            f"{rlike(x, '[' + RX.TITLE_END_PUNCT + ']' + chr(92) + 'z')}) OR {is_upper(x)}, false)")


def md_squeeze(x: str) -> str:
    t = f"regexp_replace({x}, {q(r'\n{3,}')}, {e(chr(10) * 2)}, 'g')"
    t = f"regexp_replace({t}, {q(RX.IMAGE_REF)}, '', 'g')"
    return f"regexp_replace({t}, {q(r' +\n')}, {e(chr(10))}, 'g')"


def slugify(x: str) -> str:
    s = f"regexp_replace(lower({x}), {q('[^' + RX.WC_CHARS + RX.WS_CHARS + '-]')}, '', 'g')"
    return f"regexp_replace({s}, {q('[-' + RX.WS_CHARS + ']+')}, '_', 'g')"


def sentences(x: str) -> str:
    """Sentence split without look-behind: mark each break with U+001F, then split."""
    mark = f"regexp_replace({x}, {q('([' + RX.SENTENCE_END + '])' + RX.WS + '+')}, '\\1' || chr(31), 'g')"
    return f"string_split({mark}, chr(31))"


def strict_paragraphs(x: str) -> str:
    return (f"list_filter(list_transform(regexp_split_to_array({x}, {q(RX.STRICT_PARAGRAPH_BREAK)}), "
            f"lambda p: {strip('p')}), lambda p: p <> '')")


def page_markdown(x: str) -> str:
    paras = strict_paragraphs(clean_page_text(f"coalesce({x}, '')"))
    piece = (f"CASE WHEN {is_short_title('p')} THEN chr(10) || '## ' || p || chr(10) || chr(10) "
             f"ELSE array_to_string({sentences('p')}, ' ') || chr(10) || chr(10) END")
    return f"array_to_string(list_transform({paras}, lambda p: {piece}), '')"


def _rx_replace(x: str, pattern: str, repl: str) -> str:
    """regexp_replace with a Java-style replacement ($n) turned into RE2 style (\\n)."""
    import re
    from ..functions import html as H
    r = re.sub(r"\$(\d)", r"\\\1", repl)
    # RE2 needs no possessive forms and has no look-ahead
    pattern = pattern.replace(H.LINK_TEXT, r"((?:[^<]|<[^aA/]|</[^aA]|</?[aA][A-Za-z0-9_])*?)")
    for form in ("*+", "++", "?+"):
        pattern = pattern.replace(form, form[0])
    return f"regexp_replace({x}, {q(pattern)}, {e(r) if chr(10) in r else q(r)}, 'g')"


def decode_entities(x: str) -> str:
    """Character references by the HTML rules, the tables taken from ``html.unescape``."""
    import html
    from html.entities import html5

    def table(d: dict) -> str:
        return "MAP {" + ", ".join(f"{k}: {q(v)}" for k, v in d.items()) + "}"

    bare = "|".join(sorted((k for k in html5 if ";" not in k), key=lambda k: -len(k)))
    token = "&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]*;|" + bare + ")"
    names = table({q("&" + k): v for k, v in html5.items()})
    low = table({n: html.unescape(f"&#{n};") for n in range(128, 160)})
    hexn = "CAST(('0x0' || regexp_extract(e, '[xX]0*([0-9a-fA-F]+)', 1)) AS HUGEINT)"
    digits = "regexp_extract(e, '#[xX]?0*([0-9a-fA-F]*)', 1)"
    n = (f"(CASE WHEN length({digits}) > 7 OR {digits} = '' THEN 0 "
         f"WHEN e ILIKE '&#x%' THEN {hexn} ELSE CAST({digits} AS BIGINT) END)")
    char = (f"(CASE WHEN {n} BETWEEN 128 AND 159 THEN {low}[CAST({n} AS INTEGER)] "
            f"WHEN {n} = 0 OR {n} > 1114111 OR {n} BETWEEN 55296 AND 57343 THEN chr(65533) "
            f"ELSE chr(CAST({n} AS INTEGER)) END)")
    one = f"CASE WHEN e LIKE '&#%' THEN {char} ELSE coalesce({names}[e], e) END"
    ents = f"list_transform(regexp_extract_all({x}, {q(token)}), lambda e: {one})"
    joined = (f"array_to_string(list_transform(regexp_split_to_array({x}, {q(token)}), "
              f"lambda part, k: part || coalesce(({ents})[k], '')), '')")
    return f"(CASE WHEN strpos({x}, '&') > 0 THEN {joined} ELSE {x} END)"


def strip_non_text(x: str) -> str:
    from ..functions import html as H
    t = x
    for p in (H.COMMENT, H._element("script"), H._element("style"), H.DECLARATION, H.PROC_INSTR):
        t = _rx_replace(t, p, "")
    return t


def html_to_text(x: str) -> str:
    from ..functions import html as H
    t = _rx_replace(strip_non_text(x), H.TAG, "")
    return collapse(decode_entities(t))


def html_to_markdown(x: str) -> str:
    from ..functions import html as H
    t = _rx_replace(strip_non_text(x), H.HTML_WS, " ")
    for pattern, repl in H.MD_RULES:
        t = _rx_replace(t, pattern, repl)
    t = decode_entities(t)
    t = _rx_replace(t, r" *\n *", "\n")
    t = _rx_replace(t, r"\n{3,}", "\n\n")
    return _rx_replace(t, r"\A[ \n]+|[ \n]+\z", "")


def item_title(md: str, item_id: str) -> str:
    return (f"(CASE WHEN strpos({md}, '# ') > 0 THEN regexp_extract({md}, {q(r'# ([^\n]*)')}, 1) "
            f"ELSE 'Chapter ' || CAST({item_id} AS VARCHAR) END)")
