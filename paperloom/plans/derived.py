"""Tables that both engines derive from the given ones with one and the same SQL: names of files, pages, units and states whose number grows with the
tables. What a query asks of them is then computed by Spark on one side and by SQL of its own on the other."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
#: A letter of another script for each of a-z.
LATIN, ARABIC = "abcdefghijklmnopqrstuvwxyz", "ابتثجحخدذرزسشصضطظعغفقكلمنه"


class Derived:
    """A SELECT in what both dialects share: no backslashes, no casts but to STRING, INTEGER, BIGINT and DOUBLE."""

    def __init__(self, select: str):
        self.select = select
        self.sql = f"({select})"

    def df(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        for name in TABLES:
            if re.search(rf"\b{name}\b", self.select):
                spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)
        return spark.sql(self.select)  # resolved now, so that the names may mean other tables later


def quoted(value) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


def pick(number: str, values) -> str:
    """One of some values in turn."""
    values = list(values)
    return f"(CASE ({number}) % {len(values)} " + " ".join(f"WHEN {i} THEN {quoted(v)}" for i, v in enumerate(values)) + " END)"


def part(number: str, by: int) -> str:
    return f"CAST(floor(({number}) / {by}) AS BIGINT)"


def text(number: str) -> str:
    return f"CAST({number} AS STRING)"


def arabic(column: str) -> str:
    return f"translate(lower({column}), '{LATIN}', '{ARABIC}')"


NL, BACKSLASH = "chr(10)", "chr(92)"
_SUBJECTS = ("arabe", "english", "francais", "islamic", "math", "physic", "svt")
_EASTERN = f"translate({{0}}, '0123456789', '٠١٢٣٤٥٦٧٨٩')"
_YEAR = f"{text('2008 + o_orderkey % 20')}"

FILES = Derived(
    f"""SELECT CASE WHEN o_orderkey % 13 = 0 THEN upper(f) ELSE f END AS filename FROM (SELECT o_orderkey, 'bac_' || {pick("o_orderkey", (*_SUBJECTS, "egnlish", "latin"))} || '_'
 || CASE WHEN o_orderkey % 3 = 0 THEN {_EASTERN.format(_YEAR)} ELSE {_YEAR} END || CASE WHEN o_custkey % 11 = 0 THEN '_sujet1_and_sujet2' ELSE '_sujet' || {text("1 + o_custkey % 2")} END
 || {pick(part("o_custkey", 2), ("", "_solution"))} || {pick(part("o_custkey", 5), ("", "_session1", "_session2", ""))} || {pick("o_orderkey", (".pdf", ".pdf", ".PDF", ".txt"))} AS f FROM orders) x"""
)
OTHER = Derived(
    f"""SELECT CASE WHEN p_partkey % 17 = 0 THEN '.' ELSE '' END || CASE WHEN p_partkey % 3 = 0 THEN 'curriculum_' || {pick("p_partkey", (*_SUBJECTS, "Math", "egnlish", "latin"))} || {pick("p_size", (".txt", ".PDF", ".png"))}
 ELSE 'threshold_' || {pick("p_partkey", (*_SUBJECTS, "latin"))} || '_' || CASE WHEN p_size % 2 = 0 THEN {_EASTERN.format(text("2005 + p_size"))} ELSE {text("2005 + p_size")} END || {pick("p_size", (".txt", ".pdf"))} END AS filename FROM part"""
)
STEMS = Derived(
    f"""SELECT 'bac_' || {pick("o_orderkey", _SUBJECTS)} || '_' || {text("o_orderkey + 1000")} || '_sujet' || {text("1 + o_custkey % 2")} || {pick("o_custkey", ("", "_solution", "_and_sujet2"))}
 || {pick(part("o_custkey", 3), ("", "_session1", "_session2", "_x"))} AS stem FROM orders"""
)
IMAGES = Derived(
    f"""SELECT {pick("p_partkey", ("bac_", "figure_", "x"))} || {pick("p_size", (*_SUBJECTS, ""))} || '_' || {text("p_size * 50")} || CASE WHEN p_partkey % 7 = 0 THEN '' ELSE '_page' || {text("p_partkey")} END
 || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE '_img' || {text("p_size")} END || '.png' AS name FROM part"""
)
KEYS = Derived(
    f"""SELECT 'bac_' || {pick("l_orderkey", _SUBJECTS)} || '_' || {text("l_orderkey")} || CASE l_partkey % 4 WHEN 0 THEN '__p' || {text("l_linenumber")} WHEN 1 THEN '__ex' || {text("l_linenumber")} || '__q' || {text("l_suppkey")} || '.' || {text("l_linenumber")}
 WHEN 2 THEN '__s' || {text("l_linenumber")} || '__q' || {text("l_suppkey")} || '#' || {text("l_linenumber")} ELSE '' END AS key FROM lineitem"""
)
TEXTS = Derived(
    f"""SELECT doc_id AS i, CASE doc_id % 5 WHEN 0 THEN coalesce(text, '') WHEN 1 THEN {arabic("text")} WHEN 2 THEN translate(lower(text), 'abcdefghijkl', '{ARABIC[:12]}') WHEN 3 THEN translate(lower(text), 'aeiou', '{ARABIC[:5]}')
 ELSE '   ' || replace({arabic("text")}, '.', 'ـ  ') || {NL} || {NL} || {NL} || {NL} || text || '  ' END AS t FROM documents WHERE text IS NOT NULL"""
)
PAGED = Derived(
    f"""SELECT {text("doc_id")} AS stem, CASE WHEN doc_id % 9 = 0 THEN text ELSE 'before' || {NL} || '[PAGE ' || {text("1 + doc_id % 3")} || ']' || {NL} || replace(text, {NL}, {NL} || '[PAGE ' || {text("doc_id % 7")} || ']' || {NL}) || {NL} || '[PAGE 2]' || {NL} || 'again ' || {text("doc_id")} END AS content
 FROM (SELECT doc_id, max(text) AS text FROM documents WHERE text IS NOT NULL GROUP BY doc_id) d"""
)
_ORDINALS = ("الأول", "الثاني", "الثالث", "الرابع", "الخامس", "السادس")
LINES = Derived(
    f"""SELECT (l_orderkey * 10 + l_linenumber) * 1000000000 + l_partkey * 1000 + l_suppkey % 1000 AS i, {pick("l_partkey", ("", "**", "# ", "<u>a</u> / ", "نص "))} || {pick("l_suppkey", ("التَّمرين ", "التمربن ", "الجزء ", "**الجزء** "))} || {pick("l_linenumber", _ORDINALS)}
 || {pick(part("l_partkey", 5), ("**", " | ", " : ", "", "<br/>"))} || {pick(part("l_suppkey", 4), ("(", "", "( "))} || {text("CAST(l_quantity AS INTEGER)")} || {pick("l_partkey", (",5 نقطة)", " نقاط)", " نقاط) x", " أشياء"))} || {pick("l_suppkey", ("<br>التمرين الثاني", "", " / b|z"))} AS t FROM lineitem"""
)
PAIRS = Derived(
    f"""SELECT l_orderkey * 10 + l_linenumber AS i, CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE {text("1 + l_partkey % 3")} || CASE WHEN l_partkey % 2 = 0 THEN '.' || {text("1 + l_suppkey % 3")} ELSE '' END || CASE WHEN l_partkey % 5 = 0 THEN '.1' ELSE '' END END AS a,
 {text("1 + l_suppkey % 3")} || CASE WHEN l_suppkey % 2 = 0 THEN '.' || {text("1 + l_linenumber % 3")} ELSE '' END AS b FROM lineitem"""
)
FORMULAS = Derived(
    f"""SELECT l_orderkey * 10 + l_linenumber AS i, CASE l_partkey % 8 WHEN 0 THEN '$' || {BACKSLASH} || 'dfrac{{a}}{{' || {text("l_linenumber")} || '}} ' || {BACKSLASH} || 'times ' || {text("l_suppkey")} || ',5$' WHEN 1 THEN {BACKSLASH} || 'left( x ' || {BACKSLASH} || 'right) ' || {BACKSLASH} || 'approx ' || {text("l_linenumber")}
 WHEN 2 THEN '−' || {text("l_suppkey")} || '·y' WHEN 3 THEN '$$' WHEN 4 THEN {BACKSLASH} || 'Delta' WHEN 5 THEN 'm_{{0}} = ' || {text("l_suppkey")} || ' kg + H2O' WHEN 6 THEN 'x^{{' || {text("l_linenumber")} || '}} ' || {BACKSLASH} || 'simeq 4' ELSE '- - -' END AS f FROM lineitem"""
)
_FRAGMENTS = (
    "short", "", "ايرولاكب امتحان", "ا ب ت ث ج ح خ د ذ ر في السطر الأول", "الشكل محور ا ب ت ث ج ح خ د ذ ر", "دورة 8102 في الجزائر", "Le tejuS numero un", "نص ab cd ef gh ij kl هنا", "12 i 34 apres", "Here is the extracted text of the page", "[PAGE REPROCESS NEEDED - vertical]",
)
PAGES = Derived(
    f"""SELECT doc_id AS i, {pick("doc_id", _SUBJECTS)} AS subject, {pick(part("doc_id", 7), _FRAGMENTS)} || CASE WHEN doc_id % 11 = 0 THEN '' ELSE ' ' || CASE {part("doc_id", 77)} % 3 WHEN 0 THEN text ELSE {arabic("text")} END END AS t FROM documents WHERE text IS NOT NULL"""
)
HEADS = Derived(
    f"""SELECT {text("o_orderkey")} AS key, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END AS year, {pick("o_orderkey", _SUBJECTS)} AS subject, 'دورة ' || {text("CAST(year(o_orderdate) AS INTEGER) + CAST(o_custkey % 3 AS INTEGER) - 1")}
 || {pick("o_custkey", ("", "9", " x"))} || ' ' || {pick("o_custkey", ("علوم الطبيعة", "الرياضيات", "English", "العلوم الإسلامية", "الفيزيائية", "français", "اللغة العربية"))} AS head FROM orders"""
)
POINTED = Derived(
    f"""SELECT {text("o_orderkey")} AS key, 'التمرين الأول (' || {text("1 + o_orderkey % 12")} || ' نقاط) التمرين الثاني ( ' || {text("o_custkey % 8")} || ',5 نقطة ) x (' || {text("o_orderkey % 25")} || '.5 points)' || {pick("o_custkey", (" الموضوع الثاني ", " "))}
 || '(' || {text("o_custkey % 21")} || ' pts) (' || {text("20 - o_custkey % 21")} || {pick("o_orderkey", (" pts)", " ن.)", " things)"))} AS t FROM orders"""
)
_DOC = "(SELECT doc_id, max(coalesce(text, '')) AS text FROM documents GROUP BY doc_id) d"
AUDITED = Derived(f"SELECT {text('doc_id')} AS stem, {pick('doc_id', _SUBJECTS)} AS subject, {pick(part('doc_id', 7), ('exam', 'solution'))} AS type, CASE WHEN doc_id % 23 = 0 THEN NULL ELSE CAST(1 + doc_id % 3 AS INTEGER) END AS n_pages FROM {_DOC}")
EXTRACTED = Derived(f"SELECT {text('doc_id')} AS stem, CASE WHEN doc_id % 13 = 0 THEN '' ELSE '[PAGE 1]' || {NL} || text || {NL} || '[PAGE 2]' || {NL} || substr(text, 1, CAST(doc_id % 60 AS INTEGER)) END AS content FROM {_DOC} WHERE doc_id % 17 <> 0")
CUT = Derived(f"SELECT {text('doc_id')} AS stem, 1 AS page_num, text FROM {_DOC} WHERE doc_id % 17 <> 0 AND doc_id % 13 <> 0 UNION ALL SELECT {text('doc_id')}, 2, substr(text, 1, CAST(doc_id % 60 AS INTEGER)) FROM {_DOC} WHERE doc_id % 17 <> 0 AND doc_id % 13 <> 0")
VERIFIED = Derived(f"SELECT {text('o_orderkey')} AS stem, {pick('o_orderkey', _SUBJECTS)} AS subject, o_orderkey % 19 <> 0 AS has_text, o_custkey % 17 <> 0 AS has_pdf FROM orders")
WORKED = Derived(f"SELECT {text('l_orderkey')} AS stem, l_linestatus = 'F' AS needs, {pick('l_partkey', ('pending', 'corrected', 'pending', 'reprocess_failed', 'pending', 'pending', 'pending'))} AS status FROM lineitem WHERE l_suppkey % 5 = 0")
METHOD_FILES = Derived("SELECT " + text("o_orderkey") + " AS stem, CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE CAST(2008 + o_orderkey % 19 AS INTEGER) END AS year, o_custkey % 3 <> 0 AS has_report FROM orders")
METHOD_PAGES = Derived("SELECT " + text("l_orderkey") + " AS stem, l_linenumber AS page_num, CAST(max(CASE WHEN l_orderkey % 4 = 0 THEN 0 ELSE l_quantity * 3 END) AS INTEGER) AS n_chars, max(l_partkey % 7) = 0 AS reprocessed FROM lineitem GROUP BY l_orderkey, l_linenumber")
MANIFESTED = Derived(f"SELECT DISTINCT {pick('p_partkey', ('x/', 'y/', 'z/'))} || {text(part('p_partkey', 2))} || '.pdf' AS path FROM part")
ON_DISK = Derived(f"SELECT DISTINCT {pick('p_partkey', ('x/', 'y/', 'z/'))} || {text(part('p_partkey', 2))} || '.pdf' AS path, CASE WHEN {part('p_partkey', 2)} % 10 = 0 THEN 0 ELSE 5 END AS size_bytes FROM part WHERE {part('p_partkey', 2)} % 7 <> 0")
#: Each order is an exam of seven units at most; a key has those of even parts, with the part left out or changed for some.
_ROWS = "(SELECT o_orderkey AS o, n FROM orders CROSS JOIN (SELECT 1 AS n UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) k) r"
UNITS = Derived(
    f"""SELECT {text("o")} || CASE WHEN key_ THEN 's' ELSE 'e' END || {text("n")} AS id, 'm' || {text("o")} || CASE WHEN key_ THEN '_solution' ELSE '' END AS stem, CASE WHEN o % 4 = 0 THEN 'francais' ELSE 'math' END AS subject, CASE WHEN key_ THEN 'solution' ELSE 'exam' END AS doc_type, CAST(n AS INTEGER) AS ix,
 CASE WHEN o % 4 = 0 THEN NULL WHEN key_ THEN {pick("o + n", ("P1", None, "P9"))} WHEN n % 3 = 0 THEN NULL ELSE 'P1' END AS part, CASE WHEN o % 4 = 0 THEN NULL ELSE CAST(n AS INTEGER) END AS exercise_index,
 CASE WHEN o % 4 <> 0 THEN NULL WHEN key_ AND o % 12 = 0 THEN 'whole' ELSE {pick("n", ("writing", "text", "comprehension", "production"))} END AS section_key, key_ AND o % 12 = 0 AS whole_document
 FROM {_ROWS} CROSS JOIN (SELECT true AS key_ UNION ALL SELECT false) s WHERE NOT key_ OR (o % 5 <> 0 AND (o + n) % 4 <> 0 AND (o % 12 <> 0 OR n = 1))"""
)
COPIES = Derived(f"SELECT 'm' || {text('o_orderkey')} || '_solution' AS stem FROM orders WHERE o_orderkey % 31 = 0")
_Q = f"(SELECT l_orderkey AS o, l_linenumber AS n, max(l_partkey) AS p, max(l_suppkey) AS s FROM lineitem GROUP BY l_orderkey, l_linenumber) x"
QUESTIONS = Derived(
    f"""SELECT 'u' || {text("o")} || '__q' || {text("n")} AS qid, 'u' || {text("o")} AS unit_id, n AS ix, {text("n")} AS label, m AS match, CASE WHEN m IN ('none', 'parent_stub', 'legend') THEN NULL ELSE {pick("s", ("A", "B", "C", "D"))} END AS answer, CASE WHEN m IN ('none', 'parent_stub', 'legend') THEN NULL ELSE {text("1 + s % 7")} END AS answer_label,
 CASE WHEN m IN ('none', 'parent_stub', 'legend') THEN NULL ELSE CAST(s % 7 AS INTEGER) END AS block, CASE WHEN m IN ('none', 'parent_stub', 'legend') THEN NULL WHEN s % 5 = 0 THEN 0.0E0 WHEN s % 5 = 1 THEN 0.5E0 ELSE 1.0E0 END AS label_agree FROM (SELECT *, {pick("p", ("strong", "good", "none", "label_supported", "parent_stub", "legend", "strong"))} AS m FROM {_Q}) y"""
)
BLOCKS = Derived(f"SELECT 'u' || {text('o')} AS unit_id, n - 1 AS block, {text('1 + p % 5')} AS label, 'block ' || {text('p')} AS text FROM {_Q}")
TURNED = Derived(f"SELECT {text('o_orderkey')} AS key, CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE CAST(2005 + o_orderkey % 25 AS INTEGER) END AS year, 'دورة ' || reverse({text('2005 + o_orderkey % 25')}) || ' و ' || reverse({text('2008 + o_custkey % 19')}) || '/' || {text('2005 + o_orderkey % 25')} AS t FROM orders")
NAMED = Derived(f"SELECT {pick('o_orderkey', ('', 'see ', 'x_'))} || 'bac_math_' || {text('2012 + o_custkey % 3')} || '_sujet' || {text('1 + o_orderkey % 2')} || {pick('o_custkey', ('', '_solution', '_and_sujet2', '.txt and bac_math_2013_sujet2__ex1', '0'))} || '#' || {text('o_orderkey')} AS name FROM orders")
SCORED = Derived(f"SELECT {text('o_orderkey')} AS key, 'page ' || {text('o_custkey')} || {pick('o_orderkey', ('', '', ' [SCORES — x]'))} AS t, {pick('o_custkey', ('1 | 2', 'NO_SCORES here', None, 'RECHECK', '0,25', 'SCORES_ALREADY_IN_TEXT'))} AS r FROM orders")
WORDS = Derived(
    f"""SELECT {text("user_id")} AS stem, CAST(event_id % 5 AS INTEGER) AS page, CAST(event_id % 600 AS DOUBLE) AS x0, CAST({part("event_id", 5)} % 800 AS DOUBLE) AS y0, {pick("event_id", ("0.5", "1", "2", "word", "0,25", "2×0.5", "3.75", " 4 ", "x1", "9.00"))} AS word, 600.0E0 AS page_width FROM events"""
)
REPLIES = Derived(f"SELECT {text('event_id')} AS key, {pick('event_id', ('CATEGORY: ', 'category:', 'none '))} || {pick('user_id', ('GRAPH', 'table', 'LOGO', 'TEXTUAL', 'other'))} || {NL} || {pick('user_id', ('MEANINGFUL: YES', 'meaningful:no', 'Meaningful'))} || {NL} || {pick('event_id', ('DESC: ', 'desc:', 'x DESC: '))} || event_type || ' ' AS r FROM events")
ROUTED = Derived(
    f"""SELECT {text("event_id")} AS key, {pick("event_id", ("good text", "x", ""))} AS t, event_id % 4 <> 0 AS low, user_id % 2 = 0 AS rendered, CASE WHEN user_id % 2 <> 0 THEN NULL ELSE {pick(part("event_id", 3), ("read", " ", "seen", None))} END AS ocr, CASE WHEN user_id % 2 <> 0 THEN NULL ELSE (event_id % 21) / 20.0E0 END AS conf FROM events"""
)
OVERRIDES = Derived(
    f"""SELECT 'u' || {text("o")} || '__q' || {text("n")} AS qid, CASE WHEN p % 4 = 0 THEN NULL WHEN p % 4 = 1 THEN '0,1' WHEN p % 4 = 2 THEN {text("s % 7")} ELSE '1,' || {text("s % 9")} END AS bs, {pick("s", ("two", "gone"))} AS note,
 CASE WHEN s % 6 = 0 THEN 'u' || {text("o + 1")} END AS from_unit FROM {_Q} WHERE p % 3 = 0"""
)
PATCHED = Derived(f"SELECT {text('o_orderkey')} AS stem, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE {pick('o_custkey', ('one two one ', 'x ', 'two one ', 'one '))} || {text('o_custkey')} END AS content FROM orders")
PATCHES = Derived(
    f"""SELECT {text("o_orderkey")} AS stem, n AS seq, CASE n WHEN 1 THEN 'one' WHEN 2 THEN 'two' ELSE 'one' END AS old, CASE n WHEN 1 THEN '1' WHEN 2 THEN 'one' ELSE 'uno' END AS new, n > 1 AS everywhere
 FROM orders CROSS JOIN (SELECT 1 AS n UNION ALL SELECT 2 UNION ALL SELECT 3) k WHERE o_orderkey % 3 <> 0"""
)
