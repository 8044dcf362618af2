"""DuckDB SQL oracles, one per registered query (see ``registry.py``)."""

from __future__ import annotations

from ..functions import patterns as RX
from ..operators import markdown as MDOP
from ..sources.corpora import corpus_sql
from . import sqlfrag as S

q = RX.sql_str


def _paragraph_rows(src: str) -> str:
    """CTEs ``src`` -> ``p`` (doc_id, i, para) -> ``t`` with TOC bounds per paragraph."""
    return f"""
src AS ({src}),
pa AS (SELECT doc_id, {S.paragraphs('text')} AS paras FROM src),
p AS (SELECT doc_id, unnest(paras) AS para, generate_subscripts(paras, 1) - 1 AS i FROM pa),
f AS (SELECT doc_id, i, para,
             {S.rlike('para', RX.TOC_HEADING)} AS head,
             {S.rlike('para', RX.TOC_ENTRY)} AS entry
      FROM p),
s AS (SELECT *, min(CASE WHEN head THEN i END) OVER (PARTITION BY doc_id) AS st,
             lag(entry, 1) OVER w AS e1, lag(entry, 2) OVER w AS e2, lag(entry, 3) OVER w AS e3
      FROM f WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
t AS (SELECT *, min(CASE WHEN NOT entry AND e1 AND e2 AND e3 AND i - 3 > st AND i < st + {MDOP.TOC_WINDOW}
                         THEN i END) OVER (PARTITION BY doc_id) - 1 AS en
      FROM s)"""


def toc_range_sql(src: str) -> str:
    return f"""WITH {_paragraph_rows(src)}
SELECT doc_id, CAST(coalesce(min(st), -1) AS INTEGER) AS toc_start,
       CAST(coalesce(min(en), -1) AS INTEGER) AS toc_end
FROM t GROUP BY doc_id"""


def explode_paragraphs_sql(src: str) -> str:
    lvl = S.header_level("para")
    return f"""WITH {_paragraph_rows(src)}
SELECT doc_id, CAST(i AS INTEGER) AS i, para AS text,
       CASE WHEN en IS NOT NULL AND i BETWEEN st AND en THEN 'toc'
            WHEN {lvl} IS NOT NULL THEN 'header' ELSE 'paragraph' END AS kind,
       CAST(CASE WHEN en IS NOT NULL AND i BETWEEN st AND en THEN NULL
                 WHEN {lvl} IS NOT NULL THEN least({lvl} + 1, 6) END AS INTEGER) AS md_level
FROM t"""


def text_to_markdown_sql(src: str, with_meta: bool = True) -> str:
    lvl = S.header_level("para")
    toc_block = S.e("\n" + MDOP.TOC_HEADING_MD + "\n" + MDOP.TOC_NOTE_MD)
    if with_meta:
        meta = (f"concat_ws(chr(10), CASE WHEN title <> '' THEN '# ' || title || chr(10) END, "
                f"CASE WHEN author <> '' THEN '*By ' || author || '*' || chr(10) END, '')")
    else:
        meta = "''"
    return f"""WITH {_paragraph_rows(src)},
r AS (SELECT doc_id, i,
             CASE WHEN en IS NOT NULL AND i BETWEEN st AND en
                  THEN CASE WHEN i = st THEN {toc_block} ELSE '' END
                  ELSE chr(10) || CASE WHEN {lvl} IS NOT NULL THEN {S.heading(lvl, 'para')} ELSE para END
                       || chr(10) || chr(10) END AS piece
      FROM t),
g AS (SELECT doc_id, string_agg(piece, '' ORDER BY i) AS body FROM r GROUP BY doc_id)
SELECT src.doc_id,
       CASE WHEN src.text IS NULL THEN NULL ELSE {meta} || coalesce(g.body, '') END AS md
FROM src LEFT JOIN g ON src.doc_id = g.doc_id"""


ORACLES: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    ORACLES[name] = sql


register("A4_text_to_markdown", text_to_markdown_sql(corpus_sql("book_text")))
register("A4_documents_to_markdown",
         text_to_markdown_sql("SELECT doc_id, text, NULL AS title, NULL AS author FROM documents"))
register("W1_toc_range", toc_range_sql(corpus_sql("book_text")))
register("E1_explode_paragraphs", explode_paragraphs_sql(corpus_sql("book_text")))


def _chapter_cuts(src: str, level: int = 1) -> str:
    cut = RX.chapter_cut(level, "duckdb")
    return f"""
src AS ({src}),
cu AS (SELECT doc_id, regexp_split_to_array(md, {q(cut)})[2:] AS parts FROM src),
c AS (SELECT doc_id, unnest(parts) AS raw, generate_subscripts(parts, 1) - 1 AS seq FROM cu),
x AS (SELECT doc_id, seq, raw, {S.strip('raw')} AS s FROM c),
y AS (SELECT doc_id, seq, raw,
             {S.strip("split_part(s, chr(10), 1)")} AS title,
             {S.strip("CASE WHEN strpos(s, chr(10)) > 0 THEN substr(s, strpos(s, chr(10)) + 1) ELSE '' END")} AS body,
             min(seq) OVER (PARTITION BY doc_id, raw) + 1 AS first_equal
      FROM x),
z AS (SELECT doc_id, seq, title, body,
             CASE WHEN {S.slugify('title')} = '' THEN 'chapter_' || CAST(first_equal AS VARCHAR)
                  ELSE {S.slugify('title')} END AS slug
      FROM y WHERE title <> '')"""


def split_chapters_sql(src: str, last_wins: bool = False) -> str:
    where = ""
    if last_wins:
        where = "QUALIFY row_number() OVER (PARTITION BY doc_id, slug ORDER BY seq DESC) = 1"
    return f"""WITH {_chapter_cuts(src)}
SELECT doc_id, CAST(seq AS INTEGER) AS seq, title, slug, body,
       '# ' || title || chr(10) || chr(10) || body AS rendered
FROM z {where}"""


def first_equal_sql(src: str) -> str:
    return f"""WITH {_chapter_cuts(src)}
SELECT doc_id, CAST(seq AS INTEGER) AS seq, CAST(first_equal AS INTEGER) AS first_equal FROM y"""


def _validation(src: str, keys: str) -> str:
    cut = q(RX.chapter_cut(1, "duckdb"))
    parts = f"len(regexp_split_to_array(md, {cut})) - 1"
    reason = (f"CASE WHEN md IS NULL OR NOT {S.rlike('md', RX.NON_WS)} THEN 'document without text' "
              f"WHEN {parts} = 0 THEN 'no line starts a chapter with ''# ''' END")
    return f"""WITH src AS ({src})
SELECT {keys}, {reason} IS NULL AS ok, {reason} AS reason FROM src"""


def validate_sql() -> str:
    return _validation(f"""SELECT 'md_raw' AS source, doc_id, md FROM ({corpus_sql('md_raw')})
                  UNION ALL SELECT 'documents', doc_id, text FROM documents""", "source, doc_id")


register("E2_split_chapters", split_chapters_sql(corpus_sql("md_raw")))
register("W5_last_slug_wins", split_chapters_sql(corpus_sql("md_raw"), last_wins=True))
register("W6_first_equal_chapter", first_equal_sql(corpus_sql("md_raw")))
register("H7_validate_markdown", validate_sql())


PAGE_RANGE = (3, 8)


def _pages_src(ranged: bool) -> str:
    src = corpus_sql("book_pages")
    if ranged:
        src = f"SELECT * FROM ({src}) WHERE page_no BETWEEN {PAGE_RANGE[0]} AND {PAGE_RANGE[1]}"
    return src


def pages_to_text_sql(ranged: bool) -> str:
    return _pages_text(_pages_src(ranged))


def _pages_text(src: str) -> str:
    return f"""WITH src AS ({src}),
r AS (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY page_no) AS pos FROM src),
x AS (SELECT book_id, page_no,
             CASE WHEN error IS NOT NULL THEN '[ERROR ON PAGE ' || CAST(pos AS VARCHAR) || ']' ELSE text END AS piece
      FROM r)
SELECT book_id,
       coalesce(string_agg(piece, chr(10) || chr(10) ORDER BY page_no) FILTER (WHERE piece <> ''), '') AS text,
       CAST(count(*) AS BIGINT) AS n_pages
FROM x GROUP BY book_id"""


register("S4_select_pages", f"SELECT book_id, page_no, text, error FROM ({_pages_src(True)})")
register("A2_pages_to_text", pages_to_text_sql(False))
register("A2_pages_to_text_range", pages_to_text_sql(True))
register("W4_page_position", f"""SELECT book_id, page_no, text, error,
  CAST(row_number() OVER (PARTITION BY book_id ORDER BY page_no) AS INTEGER) AS position
FROM ({_pages_src(True)})""")
register("A6_corpus_counts", f"""SELECT book_id, CAST(count(*) AS BIGINT) AS n
FROM ({_pages_src(False)}) GROUP BY book_id""")
register("A2b_pages_to_markdown", f"""WITH src AS ({_pages_src(False)}),
x AS (SELECT book_id, page_no, {S.page_markdown('text')} AS piece FROM src)
SELECT book_id, '# book_' || CAST(book_id AS VARCHAR) || chr(10) || chr(10)
       || string_agg(piece, '' ORDER BY page_no) AS md
FROM x GROUP BY book_id""")
register("E3_explode_lines", f"""WITH src AS ({corpus_sql('md_raw')}),
l AS (SELECT doc_id, string_split(md, chr(10)) AS ls FROM src)
SELECT doc_id, CAST(generate_subscripts(ls, 1) - 1 AS INTEGER) AS i, unnest(ls) AS line FROM l""")
register("E4_explode_sentences", f"""WITH {_paragraph_rows(corpus_sql('book_text'))},
ss AS (SELECT doc_id, i, {S.sentences('para')} AS sl FROM p)
SELECT doc_id, CAST(i AS INTEGER) AS i, CAST(generate_subscripts(sl, 1) - 1 AS INTEGER) AS s,
       unnest(sl) AS sentence FROM ss""")


def reflow_sql(src: str, keys: list[str]) -> str:
    """W2 over ``src`` (keys..., md) with windows; result (keys..., md)."""
    k = ", ".join(keys)
    opener = RX.list_or_code_line("duckdb").replace("(?m)^", "\\A")
    nonblank = lambda x: S.rlike(x, RX.NON_WS)
    return f"""
rl AS (SELECT {k}, string_split(md, chr(10)) AS ls FROM ({src})),
rx AS (SELECT {k}, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS i FROM rl),
ry AS (SELECT *, CASE WHEN {S.rlike('line', opener)} THEN 1 WHEN NOT {nonblank('line')} THEN 0 END AS ev FROM rx),
rz AS (SELECT *, coalesce(last_value(ev IGNORE NULLS) OVER (PARTITION BY {k} ORDER BY i
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) = 1 AS inb,
              lag(line) OVER (PARTITION BY {k} ORDER BY i) AS prev FROM ry),
re AS (SELECT {k}, i,
              CASE WHEN i = 0 THEN line
                   WHEN inb THEN chr(10) || line
                   WHEN {nonblank('line')} AND NOT starts_with(line, '#') AND {nonblank('prev')}
                        AND NOT {S.rlike('prev', '[' + RX.LINE_END_PUNCT + ']' + chr(92) + 'z')}
                        THEN ' ' || {S.strip('line')}
                   WHEN {nonblank('prev')} THEN chr(10) || chr(10) || line
                   ELSE chr(10) || line END AS piece FROM rz),
reflowed AS (SELECT {k}, string_agg(piece, '' ORDER BY i) AS md FROM re GROUP BY {k})"""


ENTRIES = corpus_sql("content_entries")
ITEMS = corpus_sql("manifest_items")
# document items, restated from the corpus arithmetic instead of the type column
DOC_ITEMS = f"SELECT * FROM ({ITEMS}) WHERE CAST(item_id AS BIGINT) % 7 NOT IN (3, 5)"
_SUFFIX = "(ends_with(entry_path, '.html') OR ends_with(entry_path, '.xhtml') OR ends_with(entry_path, '.htm'))"

register("P10_decode_entities", f"SELECT page_id, {S.decode_entities('html')} AS decoded FROM pages")
register("P8_html_to_text", f"SELECT page_id, {S.html_to_text('html')} AS text FROM pages")
register("P9_html_to_markdown", f"SELECT page_id, {S.html_to_markdown('html')} AS md FROM pages")
register("S5_select_content_entries",
         f"SELECT book_id, entry_path FROM ({ENTRIES}) WHERE {_SUFFIX}")
register("A3_entries_to_text", f"""WITH x AS (
  SELECT book_id, entry_path, {S.html_to_text('html')} AS t FROM ({ENTRIES}) WHERE {_SUFFIX})
SELECT book_id, string_agg(t, chr(10) || chr(10) ORDER BY entry_path) AS text
FROM x WHERE t <> '' GROUP BY book_id""")
register("P7_md_squeeze", f"SELECT doc_id, {S.md_squeeze('md')} AS md FROM ({corpus_sql('md_raw')})")
_SQUEEZED = f"SELECT doc_id, {S.md_squeeze('md')} AS md FROM ({corpus_sql('md_raw')})"
register("W2_reflow_lines", f"WITH {reflow_sql(_SQUEEZED, ['doc_id'])} SELECT doc_id, md FROM reflowed")
register("W2_reflow_text", f"WITH {reflow_sql(_SQUEEZED, ['doc_id'])} SELECT doc_id, md FROM reflowed")



def _items_cte(items: str) -> str:
    md = f"SELECT book_id, item_seq, {S.md_squeeze(S.html_to_markdown('html'))} AS md FROM ({items})"
    return f"""{reflow_sql(md, ['book_id', 'item_seq'])},
it AS (SELECT i.book_id, i.book_title, i.item_seq, r.md,
              {S.item_title('r.md', 'i.item_id')} AS item_title
       FROM ({items}) i JOIN reflowed r ON i.book_id = r.book_id AND i.item_seq = r.item_seq)"""


register("S6_manifest_documents", f"SELECT book_id, item_seq, item_id FROM ({DOC_ITEMS})")
register("P12_item_title", f"WITH {_items_cte(ITEMS)} SELECT book_id, item_seq, item_title FROM it")
register("A5_items_to_markdown", f"""WITH {_items_cte(DOC_ITEMS)}
SELECT book_id, '# ' || book_title || chr(10) || chr(10)
       || string_agg('## ' || item_title || chr(10) || chr(10) || md || chr(10) || chr(10), '' ORDER BY item_seq) AS md
FROM it GROUP BY book_id, book_title""")


def smp_expr() -> str:
    return f"lower({S.collapse('text')})"


def grams_expr() -> str:
    return ("list_concat("
            "list_transform(range(1, length(smp) + 1), lambda i: substring(smp, i, 1)), "
            "list_transform(range(1, length(smp)), lambda i: substring(smp, i, 2)), "
            "list_transform(range(1, length(smp) - 1), lambda i: substring(smp, i, 3)))")


def _undetectable() -> str:
    return f"coalesce(length({S.strip('text')}) < 20 OR NOT {S.rlike('text', chr(92) + 'p{L}')}, true)"


def _langid_ctes(holdout_mod: int | None = None) -> str:
    smp = smp_expr()
    grams = grams_expr()
    train_cond = f"doc_id % {holdout_mod} <> 0" if holdout_mod else "true"
    return f"""
s AS (SELECT doc_id, lang, {smp} AS smp, {_undetectable()} AS short FROM documents),
g AS (SELECT doc_id, lang, unnest({grams}) AS ngram FROM s),
pc AS (SELECT lang, ngram, count(*) AS c FROM g WHERE {train_cond} AND lang IS NOT NULL
       GROUP BY lang, ngram),
prof AS (SELECT * FROM (SELECT lang, ngram, row_number() OVER (PARTITION BY lang ORDER BY c DESC, ngram) - 1 AS rl
                        FROM pc) WHERE rl < 300),
dc AS (SELECT doc_id, ngram, count(*) AS c FROM g GROUP BY doc_id, ngram),
dp AS (SELECT * FROM (SELECT doc_id, ngram, row_number() OVER (PARTITION BY doc_id ORDER BY c DESC, ngram) - 1 AS rd
                      FROM dc) WHERE rd < 300),
langs AS (SELECT DISTINCT lang FROM prof),
dist AS (SELECT d.doc_id, l.lang, sum(coalesce(abs(d.rd - p.rl), 300)) AS dd
         FROM dp d CROSS JOIN langs l LEFT JOIN prof p ON p.lang = l.lang AND p.ngram = d.ngram
         GROUP BY d.doc_id, l.lang),
best AS (SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY doc_id ORDER BY dd, lang) AS k
                                   FROM dist) WHERE k = 1),
pred AS (SELECT s.doc_id, s.lang AS truth, CASE WHEN s.short THEN 'eng' ELSE best.lang END AS lang_pred
         FROM s LEFT JOIN best ON s.doc_id = best.doc_id)"""


def _ocr(col: str) -> str:
    from ..functions.text import LANG_PACKS
    cases = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in LANG_PACKS)
    return f"coalesce(CASE {col} {cases} END, {col})"


register("L1_train_profiles", f"WITH {_langid_ctes()} SELECT lang, ngram, CAST(rl AS INTEGER) AS rank FROM prof")
register("L1_identify_language",
         f"WITH {_langid_ctes()} SELECT doc_id, lang_pred, {_ocr('lang_pred')} AS ocr_lang FROM pred")
register("L1_accuracy", f"""WITH {_langid_ctes(5)}
SELECT CAST(count(*) AS BIGINT) AS n_eval, CAST(sum(CASE WHEN lang_pred = truth THEN 1 ELSE 0 END) AS BIGINT) AS n_correct
FROM pred WHERE doc_id % 5 = 0 AND truth IS NOT NULL""")
register("J1_lang_map_join", f"""SELECT lang, {_ocr('lang')} AS ocr_lang, CAST(count(*) AS BIGINT) AS n
FROM documents GROUP BY lang""")
def document_language_sql(pages: str) -> str:
    return f"""WITH {_langid_ctes()},
bp AS ({pages}),
fp AS (SELECT book_id, coalesce(arg_min(coalesce(text, ''), page_no), '') AS text FROM bp GROUP BY book_id),
fs AS (SELECT book_id, {smp_expr()} AS smp, {_undetectable()} AS short FROM fp),
fg AS (SELECT book_id, unnest({grams_expr()}) AS ngram FROM fs),
fc AS (SELECT book_id, ngram, count(*) AS c FROM fg GROUP BY book_id, ngram),
fdp AS (SELECT * FROM (SELECT book_id, ngram, row_number() OVER (PARTITION BY book_id ORDER BY c DESC, ngram) - 1 AS rd
                       FROM fc) WHERE rd < 300),
fdist AS (SELECT d.book_id, l.lang, sum(coalesce(abs(d.rd - p.rl), 300)) AS dd
          FROM fdp d CROSS JOIN langs l LEFT JOIN prof p ON p.lang = l.lang AND p.ngram = d.ngram
          GROUP BY d.book_id, l.lang),
fbest AS (SELECT book_id, lang FROM (SELECT book_id, lang, row_number() OVER (PARTITION BY book_id ORDER BY dd, lang) AS k
                                     FROM fdist) WHERE k = 1),
fl AS (SELECT fs.book_id, CASE WHEN fs.short THEN 'eng' ELSE fbest.lang END AS lang
       FROM fs LEFT JOIN fbest ON fs.book_id IS NOT DISTINCT FROM fbest.book_id)
SELECT book_id, lang, {_ocr('lang')} AS ocr_lang FROM fl"""


register("W3_document_language", document_language_sql(corpus_sql("book_pages")))


_W5 = split_chapters_sql(corpus_sql("md_raw"), last_wins=True)


def summary_sql(k: int = 3, chapters: str = _W5) -> str:
    sl = S.sentences("body")
    toks = f"regexp_extract_all(lower(sentence), {q(RX.TOKEN)})"
    return f"""
ch AS ({chapters}),
se AS (SELECT doc_id, seq, unnest({sl}) AS sentence, generate_subscripts({sl}, 1) - 1 AS s FROM ch),
tk AS (SELECT doc_id, seq, s, sentence, {toks} AS toks FROM se),
al AS (SELECT doc_id, seq, s, unnest(toks) AS token FROM tk),
tf AS (SELECT doc_id, seq, token, count(*) AS tf FROM al GROUP BY doc_id, seq, token),
dfc AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
nn AS (SELECT count(*) AS n FROM ch),
ds AS (SELECT DISTINCT doc_id, seq, s, token FROM al),
sc AS (SELECT ds.doc_id, ds.seq, ds.s, sum(tf.tf) AS tsum
       FROM ds JOIN tf ON ds.doc_id = tf.doc_id AND ds.seq = tf.seq AND ds.token = tf.token
       JOIN dfc ON dfc.token = ds.token, nn
       WHERE 2 * dfc.df <= nn.n GROUP BY ds.doc_id, ds.seq, ds.s),
scored AS (SELECT tk.doc_id, tk.seq, tk.s, tk.sentence,
                  CASE WHEN len(tk.toks) > 0 THEN (1000 * coalesce(sc.tsum, 0)) // len(tk.toks) ELSE 0 END AS score
           FROM tk LEFT JOIN sc ON tk.doc_id = sc.doc_id AND tk.seq = sc.seq AND tk.s = sc.s),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, seq ORDER BY score DESC, s) AS rn
                       FROM scored) WHERE rn <= {k}),
summ AS (SELECT doc_id, seq, string_agg(sentence, ' ' ORDER BY s) AS summary FROM top GROUP BY doc_id, seq),
res AS (SELECT ch.doc_id, ch.seq, ch.slug,
               CASE WHEN ch.body IS NULL OR NOT {S.rlike('ch.body', RX.NON_WS)} THEN NULL
                    ELSE coalesce(summ.summary, '') END AS summary,
               CASE WHEN ch.body IS NULL OR NOT {S.rlike('ch.body', RX.NON_WS)} THEN 'empty section' END AS error
        FROM ch LEFT JOIN summ ON ch.doc_id = summ.doc_id AND ch.seq = summ.seq),
stored AS (SELECT doc_id, seq, 'sum_extractive_' || slug || '.md' AS out_name,
                  CASE WHEN error IS NOT NULL THEN 'Error: ' || error ELSE summary END AS text FROM res)"""


register("M1_summary_requests", f"""SELECT doc_id, seq, chr(10) || chr(10) || rendered AS prompt,
  'sum_o3-mini_' || slug || '.md' AS out_name FROM ({_W5})""")
register("M2_extractive_summary", f"WITH {summary_sql()} SELECT doc_id, seq, summary, error FROM res")
register("M3_store_summaries", f"WITH {summary_sql()} SELECT doc_id, seq, out_name, text FROM stored")
register("Q5_split_summarize_combine", f"""WITH {summary_sql()}
SELECT doc_id, string_agg(text || chr(10) || chr(10), '' ORDER BY out_name) AS text FROM stored GROUP BY doc_id""")
register("A1_concat_docs", f"""SELECT doc_id, string_agg(rendered || chr(10) || chr(10), '' ORDER BY slug || '.md') AS text
FROM ({_W5}) GROUP BY doc_id""")
register("Q3_manifest_to_book", ORACLES["A5_items_to_markdown"])
register("Q4_direct_pages_to_book", ORACLES["A2b_pages_to_markdown"])
_A3 = ORACLES["A3_entries_to_text"]
register("Q2_archive_to_book", text_to_markdown_sql(
    f"SELECT book_id AS doc_id, text, NULL AS title, NULL AS author FROM ({_A3})").replace(
    "SELECT src.doc_id,", "SELECT src.doc_id AS book_id,"))


def pages_to_book_sql(pages: str) -> str:
    a2 = _pages_text(pages)
    return f"""SELECT a.book_id, w.lang, w.ocr_lang, a.n_pages, a.text, m.md
FROM ({a2}) a
JOIN ({document_language_sql(pages)}) w ON a.book_id IS NOT DISTINCT FROM w.book_id
JOIN ({text_to_markdown_sql(f"SELECT coalesce(book_id, -1) AS doc_id, text, NULL AS title, NULL AS author FROM ({a2})")}) m
  ON m.doc_id = coalesce(a.book_id, -1)"""


register("Q1_pages_to_book", pages_to_book_sql(_pages_src(False)))


_BT_PARAS = f"WITH {_paragraph_rows(corpus_sql('book_text'))}"
_NAME = "regexp_extract(url, '://[^/]*(/[^?#]*)', 1)"


def _base(x: str) -> str:
    name = f"regexp_extract({x}, '([^/]*)\\z', 1)"
    return f"regexp_replace({name}, '\\A(\\.*[^.][^/]*?)\\.[^.]*\\z', '\\1')"


def _suffix(x: str) -> str:
    name = f"regexp_extract({x}, '([^/]*)\\z', 1)"
    return f"regexp_extract({name}, '\\A\\.*[^.].*(\\.[^.]*)\\z', 1)"


_EXT = f"lower({_suffix(_NAME)})"
register("P1_collapse_ws", f"SELECT doc_id, {S.collapse('text')} AS text FROM documents")
register("P2_join_broken_lines", "SELECT doc_id, replace(text, chr(10), ' ') AS text FROM documents")
register("P4_split_paragraphs_strict", f"""WITH b AS (SELECT doc_id, {S.strict_paragraphs('text')} AS ps
  FROM ({corpus_sql('book_text')}))
SELECT doc_id, CAST(generate_subscripts(ps, 1) - 1 AS INTEGER) AS i, unnest(ps) AS text FROM b""")
register("P5_split_sentences", f"""WITH b AS (SELECT doc_id, {S.sentences('text')} AS ss FROM documents)
SELECT doc_id, CAST(generate_subscripts(ss, 1) - 1 AS INTEGER) AS s, unnest(ss) AS sentence FROM b""")
register("P6_clean_page_text",
         f"SELECT book_id, page_no, {S.clean_page_text('text')} AS text FROM ({corpus_sql('book_pages')})")
register("P11_slugify", f"""WITH {_chapter_cuts(corpus_sql('md_raw'))}
SELECT doc_id, CAST(seq AS INTEGER) AS seq, {S.slugify('title')} AS slug FROM z""")
register("P13_heading_markdown", f"""{_BT_PARAS}
SELECT doc_id, CAST(i AS INTEGER) AS i,
       CASE WHEN {S.header_level('para')} IS NOT NULL THEN {S.heading(S.header_level('para'), 'para')} END AS heading
FROM p""")
register("P14_map_lang_code", f"SELECT doc_id, {_ocr('lang')} AS ocr_lang FROM documents")
register("P15_base_name", f"SELECT page_id, {_base('url')} AS base, {_suffix('url')} AS suffix FROM pages")
register("P16_preview", "SELECT doc_id, substring(text, 1, 300) || '...' AS preview FROM documents")
register("P17_prompt_text", "SELECT doc_id, chr(10) || chr(10) || text AS prompt FROM documents")
register("H1_header_level", f"SELECT doc_id, CAST(i AS INTEGER) AS i, CAST({S.header_level('para')} AS INTEGER) AS level FROM ({_BT_PARAS} SELECT * FROM p)")
register("H2_is_short_title", f"""WITH b AS (SELECT book_id, page_no, {S.clean_page_text('text')} AS t
  FROM ({corpus_sql('book_pages')}))
SELECT book_id, page_no, {S.is_short_title('t')} AS is_title FROM b""")
register("H3_H4_toc_predicates", f"""{_BT_PARAS}
SELECT doc_id, CAST(i AS INTEGER) AS i, coalesce({S.rlike('para', RX.TOC_HEADING)}, false) AS toc_heading,
       coalesce({S.rlike('para', RX.TOC_ENTRY)}, false) AS toc_entry FROM p""")
register("H5_drop_blank", f"SELECT book_id, page_no FROM ({corpus_sql('book_pages')}) WHERE text IS NOT NULL AND text <> ''")
register("H6_route_by_format", f"""SELECT page_id,
  CASE {_EXT} WHEN '.epub' THEN 'epub' WHEN '.pdf' THEN 'pdf' END AS route,
  CASE WHEN {_EXT} NOT IN ('.epub', '.pdf') THEN 'no reader for format ' || {_EXT} END AS reject_reason,
  CASE WHEN ends_with(lower({_NAME}), '.txt') THEN 'text' END AS text_route
FROM pages""")


register("A2_conversations_to_text", """SELECT conv_id AS book_id,
  coalesce(string_agg(concat_ws(': ', role, text), chr(10) || chr(10) ORDER BY turn)
           FILTER (WHERE concat_ws(': ', role, text) <> ''), '') AS text,
  CAST(count(*) AS BIGINT) AS n_pages
FROM conversations GROUP BY conv_id""")


def _chapters_level2_sql() -> str:
    a4 = text_to_markdown_sql(corpus_sql("book_text"))
    return split_chapters_sql(a4).replace(
        q(RX.chapter_cut(1, "duckdb")), q(RX.chapter_cut(2, "duckdb")))


register("E2_chapters_of_converted_text", _chapters_level2_sql())


# Corpora on which branches fire that the plain tables never reach.
_ODD = corpus_sql("md_odd")
register("E2_split_chapters_odd", split_chapters_sql(_ODD))
register("W5_last_slug_wins_odd", split_chapters_sql(_ODD, last_wins=True))
register("W6_first_equal_chapter_odd", first_equal_sql(_ODD))
register("H7_validate_markdown_odd", _validation(_ODD, "doc_id"))
register("M3_store_summaries_odd",
         f"WITH {summary_sql(chapters=split_chapters_sql(_ODD, last_wins=True))} SELECT doc_id, seq, out_name, text FROM stored")
register("P14_map_lang_code_odd", f"SELECT doc_id, {_ocr('lang')} AS ocr_lang FROM ({corpus_sql('lang_odd')})")
register("J1_lang_map_join_odd", f"""SELECT lang, {_ocr('lang')} AS ocr_lang, CAST(count(*) AS BIGINT) AS n
FROM ({corpus_sql('lang_odd')}) GROUP BY lang""")
_EXT2 = f"lower({_suffix('name')})"
register("H6_route_by_format_odd", f"""SELECT doc_id,
  CASE {_EXT2} WHEN '.epub' THEN 'epub' WHEN '.pdf' THEN 'pdf' END AS route,
  CASE WHEN {_EXT2} NOT IN ('.epub', '.pdf') THEN 'no reader for format ' || {_EXT2} END AS reject_reason,
  CASE WHEN ends_with(lower(name), '.txt') THEN 'text' END AS text_route
FROM ({corpus_sql('file_names')})""")
register("P12_item_title_odd", f"WITH {_items_cte(corpus_sql('items_odd'))} SELECT book_id, item_seq, item_title FROM it")
register("Q1_pages_to_book_odd", pages_to_book_sql(corpus_sql("pages_odd")))
