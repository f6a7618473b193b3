"""Queries over small literal tables, for what the driver's tables hold nothing of: Arabic text, names of exam files, units, states.

Each has DuckDB SQL that computes the same from the same rows by its own means."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..functions import names, quality, repair, replies
from ..functions import text as T
from ..operators import align, audit, catalog, figures, formulas, linking, overlay, reports, segments, sequences
from . import derived
from .catalogue import ORACLES, QUERIES, query, read

__all__ = ["ORACLES", "QUERIES"]


def _cell(x) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, bool):
        return str(x).upper()
    if isinstance(x, (list, tuple)):
        return "[" + ", ".join(map(_cell, x)) + "]"
    return "'" + x.replace("'", "''") + "'" if isinstance(x, str) else repr(x)


def values(rows: list[tuple], schema: str) -> str:
    """The rows as a table expression of SQL."""
    kinds = {"string": "VARCHAR", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "long": "BIGINT", "array<string>": "VARCHAR[]", "array<int>": "INTEGER[]"}
    fields = [f.split(" ", 1) for f in schema.split(", ")]
    casts = ", ".join(f"CAST({n} AS {kinds[k]}) AS {n}" for n, k in fields)
    return f"(SELECT {casts} FROM (VALUES {', '.join('(' + ', '.join(map(_cell, r)) + ')' for r in rows)}) v({', '.join(n for n, _ in fields)}))"


def rx(pattern: str) -> str:
    """A pattern as DuckDB takes it: characters instead of their numbers."""
    return re.sub(r"\\u([0-9a-fA-F]{4})", lambda m: chr(int(m[1], 16)), pattern)


def table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


_AR = "؀-ۿݐ-ݿࢠ-ࣿﭐ-﷿ﹰ-﻿"
_WEST = "translate({0}, '٠١٢٣٤٥٦٧٨٩', '0123456789')"

# ---- names

_YEARS_SQL = values([(y, era, c, s) for y, era, _, _, c, s in fixed.YEAR_ROWS], "year int, era string, censored boolean, sealed boolean")
_MANIFEST_SQL = rf"""WITH f AS {derived.FILES.sql},
p AS (SELECT filename, regexp_extract(filename, '{fixed.SINGLE_NAME}', ['s', 'y', 'n', 'k', 'x']) AS a, regexp_extract(filename, '{fixed.COMBINED_NAME}', ['s', 'y', 'k', 'x']) AS c FROM f),
q AS (SELECT filename, a.s = '' AND c.s <> '' AS twin, {_WEST.format("lower(CASE WHEN a.s <> '' THEN a.s ELSE c.s END)")} AS raw, TRY_CAST({_WEST.format("CASE WHEN a.s <> '' THEN a.y ELSE c.y END")} AS INTEGER) AS y, a.n AS n,
  CASE WHEN a.s <> '' THEN a.k ELSE c.k END <> '' AS sol, TRY_CAST(CASE WHEN a.s <> '' THEN a.x ELSE c.x END AS INTEGER) AS session FROM p),
r AS (SELECT *, CASE WHEN raw = 'egnlish' THEN 'english' WHEN raw IN {fixed.SUBJECTS} THEN raw END AS subject FROM q)
SELECT filename, CASE WHEN subject IS NULL THEN NULL WHEN twin THEN 'C' WHEN sol THEN 'B' ELSE 'A' END AS family, subject, CASE WHEN subject IS NOT NULL THEN y END AS year, CASE WHEN subject IS NULL THEN NULL WHEN twin THEN 'both' ELSE n END AS topic_choice,
  CASE WHEN subject IS NULL THEN NULL WHEN sol THEN 'solution' ELSE 'exam' END AS type, CASE WHEN subject IS NOT NULL THEN session END AS session,
  CASE WHEN subject IS NULL OR session IS NULL THEN NULL WHEN session = 2 AND y = 2016 THEN 'reexam' WHEN session = 2 AND y = 2017 THEN 'exceptional' ELSE 'normal' END AS session_type,
  CASE WHEN subject IS NOT NULL THEN twin END AS duplicate, era, censored, sealed
FROM r LEFT JOIN {_YEARS_SQL} d ON d.year = CASE WHEN subject IS NOT NULL THEN y END"""


@query(_MANIFEST_SQL)
def manifest_records(spark, sf_dir):
    return catalog.manifest(derived.FILES.df(spark, sf_dir))


@query(f"""WITH m AS ({_MANIFEST_SQL}), c AS (SELECT subject, year, session, max(CAST(topic_choice = '1' AND type = 'exam' AS INTEGER)) AS topic1_exam, max(CAST(topic_choice = '1' AND type = 'solution' AS INTEGER)) AS topic1_solution,
max(CAST(topic_choice = '2' AND type = 'exam' AS INTEGER)) AS topic2_exam, max(CAST(topic_choice = '2' AND type = 'solution' AS INTEGER)) AS topic2_solution FROM m WHERE family IN ('A', 'B') AND NOT duplicate GROUP BY ALL)
SELECT *, array_to_string(list_filter([CASE WHEN topic1_exam = 0 THEN 'topic1_exam' END, CASE WHEN topic1_solution = 0 THEN 'topic1_solution' END, CASE WHEN topic2_exam = 0 THEN 'topic2_exam' END, CASE WHEN topic2_solution = 0 THEN 'topic2_solution' END], lambda x: x IS NOT NULL), ',') AS missing FROM c""")
def coverage_slots(spark, sf_dir):
    return catalog.coverage(catalog.manifest(derived.FILES.df(spark, sf_dir))).withColumn("missing", F.concat_ws(",", "missing"))


@query(rf"""WITH f AS {derived.OTHER.sql}, p AS (SELECT filename, lower(regexp_extract(filename, '{fixed.PROGRAMME_NAME}', 1)) AS c, lower(regexp_extract(filename, '{fixed.THRESHOLD_NAME}', 1)) AS t, {_WEST.format(f"regexp_extract(filename, '{fixed.THRESHOLD_NAME}', 2)")} AS y FROM f WHERE NOT starts_with(filename, '.')),
s AS (SELECT filename, CASE WHEN c = 'egnlish' THEN 'english' WHEN c IN {fixed.SUBJECTS} THEN c END AS c, CASE WHEN t IN {fixed.SUBJECTS} THEN t END AS t, TRY_CAST(y AS INTEGER) AS y FROM p)
SELECT filename, coalesce(c, t) AS subject, CASE WHEN c IS NOT NULL THEN 'programme' ELSE 'threshold' END AS type, CASE WHEN t IS NOT NULL THEN y END AS year, era FROM s LEFT JOIN {_YEARS_SQL} d ON d.year = y AND t IS NOT NULL WHERE coalesce(c, t) IS NOT NULL""")
def other_records(spark, sf_dir):
    files = derived.OTHER.df(spark, sf_dir)
    return catalog.built(files.limit(0), files, files)[0].select("filename", "subject", "type", "year", "era")


@query(rf"""WITH s AS {derived.STEMS.sql}, p AS (SELECT stem, regexp_extract(stem, '{fixed.STEM}', ['a', 'y', 'n', 'k', 'x']) AS g FROM s)
SELECT stem, nullif(g.a, '') AS subject, TRY_CAST(g.y AS INTEGER) AS year, TRY_CAST(g.n AS INTEGER) AS sujet, TRY_CAST(g.x AS INTEGER) AS session, CASE WHEN g.a = '' THEN NULL WHEN g.k <> '' THEN 'solution' ELSE 'exam' END AS doc_type,
CASE WHEN regexp_matches(stem, '_session[0-9]$') THEN regexp_replace(stem, '_(session[0-9])$', '_solution_\1') ELSE stem || '_solution' END AS key FROM p""")
def stem_parts(spark, sf_dir):
    rows = derived.STEMS.df(spark, sf_dir).withColumn("p", names.stem(F.col("stem")))
    return rows.select("stem", "p.*", names.solution_stem(F.col("stem")).alias("key"))


@query(r"SELECT *, coalesce(TRY_CAST(regexp_extract(tail, '^([0-9]+)(_img[^_]*)?$', 1) AS INTEGER), 1) AS page_num, coalesce(TRY_CAST(regexp_extract(tail, '_img([0-9]+)$', 1) AS INTEGER), 1) AS img_index FROM (SELECT name, stem, CASE WHEN contains(stem, '_') THEN split_part(stem, '_', 2) ELSE 'unknown' END AS subject, TRY_CAST(regexp_extract(split_part(stem, '_', 3), '^[0-9]+$') AS INTEGER) AS year, tail FROM (SELECT name, regexp_extract(b, '^(.*)_page([^p]*)$', 1) AS h, CASE WHEN contains(b, '_page') THEN regexp_extract(b, '^(.*)_page([^p]*)$', 1) ELSE b END AS stem, regexp_extract(b, '^(.*)_page([^p]*)$', 2) AS tail FROM (SELECT name, regexp_replace(name, '\.png$', '') AS b FROM " + derived.IMAGES.sql + "))) ORDER BY 1")
def image_parts(spark, sf_dir):
    rows = derived.IMAGES.df(spark, sf_dir).withColumn("p", names.image(F.col("name")))
    return rows.select("name", "p.stem", "p.subject", "p.year", F.regexp_extract(F.regexp_replace("name", r"\.png$", ""), "_page([^p]*)$", 1).alias("tail"), "p.page_num", "p.img_index")


@query(r"SELECT key, nullif(regexp_extract(key, '^(.*)__p([0-9]+)$', 1), '') AS stem, TRY_CAST(regexp_extract(key, '^(.*)__p([0-9]+)$', 2) AS INTEGER) AS page_num, split_part(key, '__q', 1) AS unit_id, split_part(split_part(key, '__q', 2), '#', 1) AS label, coalesce(TRY_CAST(split_part(split_part(key, '__q', 2), '#', 2) AS INTEGER), 1) AS occurrence FROM " + derived.KEYS.sql)
def key_parts(spark, sf_dir):
    rows = derived.KEYS.df(spark, sf_dir).select("key", names.page_key(F.col("key")).alias("p"), names.question_key(F.col("key")).alias("q"))
    return rows.select("key", "p.stem", "p.page_num", "q.unit_id", "q.label", "q.occurrence")


@query("SELECT p_partkey, CASE WHEN p_size * 90 * CAST(p_retailprice AS BIGINT) > 2000000 AND p_size * 90.0 / CAST(p_retailprice AS BIGINT) > 0.55 AND p_size * 90.0 / CAST(p_retailprice AS BIGINT) < 0.85 THEN true ELSE false END AS scan, greatest(p_size, 30) >= 50 AS big FROM (SELECT p_partkey, p_size, floor(p_retailprice) AS p_retailprice FROM part)")
def image_sizes(spark, sf_dir):
    """Parts as images: their size as width, their price as height."""
    w, h = F.col("p_size") * 90, F.floor("p_retailprice").cast("long")
    return read(spark, sf_dir, "part").select("p_partkey", names.page_scan(w, h).alias("scan"), names.big_enough(F.col("p_size"), F.lit(30)).alias("big"))


# ---- text

_TEXT_SQL = derived.TEXTS.sql


@query(f"""WITH c AS (SELECT i, t, length(regexp_replace(t, '[^{_AR}]', '', 'g')) AS ar, length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS la, list_filter(regexp_split_to_array(t, '[\\s  ]+'), lambda x: x <> '') AS w, length(regexp_replace(t, '^[\\s  ]+|[\\s  ]+$', '', 'g')) AS n FROM {_TEXT_SQL}),
a AS (SELECT *, list_filter(w, lambda x: 2 * length(regexp_replace(x, '[^{_AR}]', '', 'g')) > length(x)) AS aw, list_filter(w, lambda x: regexp_matches(x, '[{_AR}]')) AS tw FROM c)
SELECT i, CASE WHEN ar + la = 0 THEN 'unknown' WHEN ar / (ar + la) > 0.6 THEN 'arabic' WHEN ar / (ar + la) < 0.2 THEN 'latin' ELSE 'mixed' END AS script, round(coalesce(ar / nullif(n, 0), 0), 6) AS density,
round(coalesce(list_sum(list_transform(aw, lambda x: length(x))) / nullif(len(aw), 0), 0), 6) AS word_length, round(coalesce(list_sum(list_transform(tw, lambda x: length(x))) / nullif(len(tw), 0), 0), 6) AS token_length FROM a""")
def arabic_measures(spark, sf_dir):
    t = F.col("t")
    measures = (T.arabic_density(t).alias("density"), T.arabic_word_length(t).alias("word_length"), T.arabic_token_length(t).alias("token_length"))
    return derived.TEXTS.df(spark, sf_dir).select("i", T.script(t).alias("script"), *(F.round(m, 6).alias(n) for m, n in zip(measures, ("density", "word_length", "token_length"))))


@query(f"SELECT i, regexp_replace(regexp_replace(regexp_replace(nfc_normalize(regexp_replace(replace(t, ' ', ' '), '[​-‏‪- ⁠-⁤﻿ـ]', '', 'g')), '[ \t]{{2,}}', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '^[\\s ]+|[\\s ]+$', '', 'g') AS t FROM {_TEXT_SQL}")
def normal_forms(spark, sf_dir):
    return derived.TEXTS.df(spark, sf_dir).select("i", T.normalized(F.col("t")).alias("t"))


@query(f"""WITH l AS (SELECT stem, i, string_split(content, chr(10))[i] AS line FROM (SELECT stem, content, unnest(range(1, len(string_split(content, chr(10))) + 1)) AS i FROM {derived.PAGED.sql})),
m AS (SELECT *, TRY_CAST(regexp_extract(line, '^\\[PAGE\\s+(\\d+)\\]', 1) AS INTEGER) AS mark FROM l), n AS (SELECT *, count(mark) OVER (PARTITION BY stem ORDER BY i) AS nth FROM m),
g AS (SELECT stem, nth, max(mark) AS page_num, trim(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (mark IS NULL), ''), chr(10) || ' ') AS text FROM n WHERE nth > 0 GROUP BY ALL)
SELECT stem, page_num, arg_max(text, nth) AS text FROM g GROUP BY ALL""")
def page_texts(spark, sf_dir):
    pages = sequences.pages_of(derived.PAGED.df(spark, sf_dir))
    return pages.withColumn("text", F.expr("trim(BOTH '\\n ' FROM text)"))


@query(f"SELECT stem, CAST(i - 1 AS INTEGER) AS page_num, trim(p[i], chr(10) || ' ') AS text FROM (SELECT stem, p, unnest(range(2, len(p) + 1)) AS i FROM (SELECT stem, regexp_split_to_array(content, '\\[PAGE \\d+\\]') AS p FROM {derived.PAGED.sql}))")
def nth_pages(spark, sf_dir):
    return sequences.nth_pages(derived.PAGED.df(spark, sf_dir))


@query("SELECT CAST(conv_id AS VARCHAR) AS stem, string_agg('[PAGE ' || turn || ']' || chr(10) || coalesce(CASE WHEN turn = 1 THEN '!' || text ELSE text END, ''), chr(10) || chr(10) ORDER BY turn) AS content FROM conversations GROUP BY conv_id")
def rendered_pages(spark, sf_dir):
    """Turns as pages; the first of each is replaced."""
    pages = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("stem"), F.col("turn").alias("page_num"), F.coalesce("text", F.lit("")).alias("text"))
    new = pages.filter("page_num = 1").select("stem", "page_num", F.concat(F.lit("!"), "text").alias("text"))
    return sequences.rendered(sequences.replaced_pages(pages, new))


_PLAIN = f"regexp_replace(regexp_replace(t, '{fixed.MARKS}', '', 'g'), '</?u>|</?b>|\\*\\*|__|[‎‏]', '', 'g')"


@query(f"SELECT i, CAST(k - 1 AS INTEGER) AS k, p[k] AS f FROM (SELECT i, p, unnest(range(1, len(p) + 1)) AS k FROM (SELECT i, regexp_split_to_array({_PLAIN}, '<br\\s*/?>|\\||\\s/\\s') AS p FROM {derived.LINES.sql}))")
def line_fragments(spark, sf_dir):
    return derived.LINES.df(spark, sf_dir).select("i", F.posexplode(segments.fragments(F.col("t"))).alias("k", "f"))


@query(f"""WITH f AS (SELECT i, k, p[k] AS f FROM (SELECT i, p, unnest(range(1, len(p) + 1)) AS k FROM (SELECT i, regexp_split_to_array({_PLAIN}, '<br\\s*/?>|\\||\\s/\\s') AS p FROM {derived.LINES.sql}))),
h AS (SELECT i, k, regexp_extract(f, '^[\\s#*_\\-]*(التمر[يب]ن|الجزء)\\s+({"|".join(fixed.ORDINALS)})[\\s:：*_]*(?:\\(?\\s*([0-9٠-٩]+(?:[.,][0-9]+)?)\\s*\\)?\\s*(?:{fixed.POINTS})(?:[^\\p{{L}}]|$))?', ['k', 'o', 'p']) AS g FROM f),
t AS (SELECT i, k, CASE WHEN g.k = 'الجزء' THEN 'part' ELSE 'exercise' END AS kind, g.o AS o, TRY_CAST(replace({_WEST.format('g.p')}, ',', '.') AS DOUBLE) AS points FROM h WHERE g.k <> '')
SELECT i, kind, arg_min(CASE o {" ".join(f"WHEN '{o}' THEN {n}" for o, n in fixed.ORDINALS.items())} END, k) AS number, arg_min(coalesce(points, -1), k) AS points FROM t GROUP BY ALL""")
def line_headings(spark, sf_dir):
    lines = derived.LINES.df(spark, sf_dir).select(F.lit("u").alias("unit"), "i", F.col("t").alias("line"))
    return segments.headings(lines).select("i", "kind", "number", F.coalesce("points", F.lit(-1.0)).alias("points"))


@query(f"""WITH p AS (SELECT a, b, array_to_string(list_reverse(string_split(a, '.')), '.') AS x, array_to_string(list_reverse(string_split(b, '.')), '.') AS y FROM {derived.PAIRS.sql})
SELECT a, b, CAST(CASE WHEN a IN (b, y) OR x IN (b, y) THEN 1.0 WHEN starts_with(a, b || '.') OR starts_with(b, a || '.') OR starts_with(x, b || '.') OR starts_with(b, x || '.') OR starts_with(a, y || '.') OR starts_with(y, a || '.') OR starts_with(x, y || '.') OR starts_with(y, x || '.') THEN 0.5 ELSE 0.0 END AS DOUBLE) AS agreement, TRY_CAST(split_part(a, '.', 1) AS INTEGER) AS leading FROM p""")
def label_agreements(spark, sf_dir):
    return derived.PAIRS.df(spark, sf_dir).select("a", "b", T.label_agreement(F.col("a"), F.col("b")).alias("agreement"), T.leading(F.col("a")).alias("leading"))


@query("SELECT conv_id, turn, substr(trim(regexp_replace(regexp_replace(coalesce(text, ''), '\\*\\*|<[^>]+>', '', 'g'), '[\\s]+', ' ', 'g')), 1, 40) AS short FROM conversations")
def short_texts(spark, sf_dir):
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", T.short(F.col("text"), 40).alias("short"))


# ---- formulas


def _canonical_sql(c: str) -> str:
    out = f"trim(regexp_replace(trim({c}), '^\\$+|\\$+$', '', 'g'))"
    for a, b in fixed.FORMULA_FORMS:
        out = f"replace({out}, '{a}', '{b}')"
    return f"regexp_replace(regexp_replace({out}, '\\s+', '', 'g'), '\\{{([^{{}}])\\}}', '\\1', 'g')"


@query(f"SELECT i, {_canonical_sql('f')} AS canonical, " + " OR ".join(f"regexp_matches(trim(regexp_replace(trim(f), '^`+|`+$', '', 'g')), '{rx(p)}')" for p in fixed.FORMULA_NOISE) + f" AS noise, length(regexp_replace(f, '[^\\\\^]', '', 'g')) + len(regexp_extract_all(f, '_\\{{')) AS density FROM {derived.FORMULAS.sql}")
def formula_forms(spark, sf_dir):
    f = F.col("f")
    return derived.FORMULAS.df(spark, sf_dir).select("i", formulas.canonical(f).alias("canonical"), formulas.is_noise(f).alias("noise"), formulas.density(f).cast("long").alias("density"))


_COMPUTED = [("p%d" % i, t, k, ok) for i, (t, k, ok) in enumerate((
    ("3 \\times 4 = 12", "product", True), ("3 × 4 = 12.3", "product", True), ("3 * 4 = 13", "product", False), ("2,5 \\times 10^{3} \\times 2 = 5 \\times 10^3", "product", True), ("10 / 4 = 2,5", "quotient", True), ("10 / 4 \\approx 3", "quotient", False),
    ("\\frac{6}{4} = 1.5", "fraction", True), ("\\frac{6 \\times 2}{4} = 4", "fraction", False), ("\\sqrt{16} = 4", "root", True), ("\\sqrt{2} \\simeq 1.5", "root", False), ("7 / 0 = 3", "quotient", True), ("-3 \\times 2 = 6", "product", False),
))]


@query(f"SELECT key, kind FROM {values(_COMPUTED, 'key string, t string, kind string, ok boolean')} WHERE NOT ok")
def arithmetic_kinds(spark, sf_dir):
    """The SQL has the outcomes, worked out by hand."""
    return table(spark, _COMPUTED, "key string, t string, kind string, ok boolean").select("key", F.explode(formulas.slips(F.col("t"))).alias("s")).select("key", "s.kind")


# ---- quality

_ARABIC_SUBJECTS, _SCIENCE = str(fixed.ARABIC_SUBJECTS), str(fixed.SCIENCE)


@query(rf"""WITH p AS (SELECT *, length(regexp_replace(t, '[^{_AR}]', '', 'g')) AS ar, length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS la, length(trim(t)) AS n FROM {derived.PAGES.sql}),
c AS (SELECT *, subject IN {_ARABIC_SUBJECTS} AS is_ar, subject IN {_SCIENCE} AS is_sc FROM p)
SELECT i, 'LANG_MISMATCH' AS tag FROM c WHERE n >= 50 AND ((is_ar AND ar < 20 AND ar + la > 0 AND ar / (ar + la) < 0.2) OR (NOT is_ar AND la < 20 AND ar / (ar + la) > 0.6))
UNION ALL SELECT i, 'REVERSED_BAKA' FROM c WHERE contains(t, '{fixed.REVERSED_NAME}')
UNION ALL SELECT i, 'GARBLE' FROM c WHERE len(list_filter(regexp_extract_all(t, '{fixed.GARBLE}'), lambda m: NOT regexp_matches(substr(t, greatest(1, instr(t, m) - 100), instr(t, m) - greatest(1, instr(t, m) - 100) + length(m) + 100), '{fixed.DIAGRAM}'))) > 0
UNION ALL SELECT i, 'REVERSED_YEAR' FROM c WHERE regexp_matches(t, '\b({"|".join(str(y)[::-1] for y in range(2007, 2027))})\b')
UNION ALL SELECT i, 'REVERSED_LATIN' FROM c WHERE regexp_matches(t, '{fixed.REVERSED_LATIN}')
UNION ALL SELECT i, 'LATIN_GIBBER_IN_ARABIC' FROM c WHERE is_ar AND NOT is_sc AND regexp_matches(t, '{fixed.LATIN_GIBBERISH}')
UNION ALL SELECT i, 'PAGE_NUM_NOISE' FROM c WHERE NOT is_sc AND regexp_matches(t, '{fixed.PAGE_NOISE}')
UNION ALL SELECT i, 'REPROCESS_MARKER' FROM c WHERE contains(t, '{fixed.REPROCESS}')
UNION ALL SELECT i, 'HALLUCINATION' FROM c WHERE regexp_matches(t, '{fixed.MODEL_TALK}')""")
def page_issue_tags(spark, sf_dir):
    pages = derived.PAGES.df(spark, sf_dir)
    return pages.select("i", F.explode(quality.page_issues(F.col("t"), F.col("subject"))).alias("x")).select("i", "x.tag")


@query(rf"""WITH p AS (SELECT *, length(regexp_replace(t, '[^{_AR}]', '', 'g')) AS ar, length(trim(t)) AS n, list_filter(regexp_split_to_array(t, '\s+'), lambda x: regexp_matches(x, '[{_AR}]')) AS w FROM {derived.PAGES.sql}),
c AS (SELECT *, subject IN {_ARABIC_SUBJECTS} AS is_ar, ar / n AS d, coalesce(list_sum(list_transform(w, lambda x: length(x))) / nullif(len(w), 0), 0) AS m FROM p)
SELECT i, 'very_short' AS tag FROM c WHERE n < 30 UNION ALL SELECT i, 'low_arabic_density' FROM c WHERE is_ar AND d < 0.1 AND n > 50 UNION ALL SELECT i, 'fragmented_arabic' FROM c WHERE is_ar AND m > 0 AND m <= 3.5 AND d > 0.4
UNION ALL SELECT i, 'reversed_text_detected' FROM c WHERE contains(t, '{fixed.REVERSED_NAME}') UNION ALL SELECT i, 'garble_pattern_detected' FROM c WHERE regexp_matches(t, '{rx(fixed.SHORT_GARBLE)}')""")
def local_page_checks(spark, sf_dir):
    pages = derived.PAGES.df(spark, sf_dir)
    return pages.select("i", F.explode(quality.local_issues(F.col("t"), F.col("subject"))).alias("x")).select("i", "x.tag")


@query(rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, CASE lang WHEN 'en' THEN 'math' ELSE 'arabe' END AS subject FROM documents), c AS (SELECT *, length(regexp_replace(t, '^\s+|\s+$', '', 'g')) AS n FROM d)
SELECT doc_id, 'NO_QUESTION_STRUCTURE' AS tag FROM c WHERE n >= 200 AND NOT ({" OR ".join(f"regexp_matches(t, '{rx(p)}')" for p in fixed.QUESTION_FORMS)})
UNION ALL SELECT doc_id, 'NO_SCIENCE_MARKERS' FROM c WHERE n >= 200 AND subject = 'math' AND NOT regexp_matches(t, '{fixed.SCIENCE_MARKS}')
UNION ALL SELECT doc_id, 'SHORT_EXAM_FILE' FROM c WHERE n BETWEEN 100 AND 499 UNION ALL SELECT doc_id, 'VERY_SHORT_FILE' FROM c WHERE n < 100""")
def file_tags(spark, sf_dir):
    """Documents as files: English ones as science."""
    subject, text = F.when(F.col("lang") == "en", "math").otherwise("arabe"), F.coalesce("text", F.lit(""))
    tags = F.concat(quality.file_warnings(text, subject, F.lit("exam")), quality.file_issues(text))
    return read(spark, sf_dir, "documents").select("doc_id", F.explode(tags).alias("x")).select("doc_id", "x.tag")


@query(f"""SELECT key, CASE WHEN year IS NULL THEN false ELSE NOT regexp_matches(head, '(^|[^0-9])' || year || '([^0-9]|$)') END AS year_off, CASE subject {" ".join(f"WHEN '{s}' THEN " + " OR ".join(f"contains(head, '{n}')" for n in names_) for s, names_ in fixed.SUBJECT_NAMES.items())} END AS named
FROM {derived.HEADS.sql}""")
def header_checks(spark, sf_dir):
    rows = derived.HEADS.df(spark, sf_dir)
    return rows.select("key", quality.year_is_off(F.col("head"), F.col("year")).alias("year_off"), quality.names_subject(F.col("head"), F.col("subject")).alias("named"))


@query(f"""WITH p AS (SELECT key, i, string_split(regexp_replace(t, 'الموضوع\\s+الثاني', chr(1), 'g'), chr(1))[i] AS part FROM (SELECT *, unnest([1, 2]) AS i FROM {derived.POINTED.sql})),
v AS (SELECT key, i, list_filter(list_transform(regexp_extract_all(part, '\\(\\s*([0-9]{{1,2}}(?:[.,][0-9]+)?)\\s*(?:نقاط|نقطة|ن\\.?|points?|pts)\\s*\\)', 1), lambda x: CAST(replace(x, ',', '.') AS DOUBLE)), lambda x: x > 0 AND x <= 20) AS v FROM p WHERE part IS NOT NULL)
SELECT key, i AS part, CAST(list_sum(v) AS DOUBLE) AS total FROM v WHERE len(v) >= 2 AND abs(list_sum(v) - 20) > 0.01""")
def points_by_topic(spark, sf_dir):
    rows = derived.POINTED.df(spark, sf_dir).select("key", F.explode(quality.points_off(F.col("t"))).alias("x"))
    return rows.select("key", "x.part", F.aggregate("x.points", F.lit(0.0), lambda s, v: s + v).alias("total"))


@query(rf"SELECT doc_id, len(list_filter(regexp_extract_all(t, '([0-9]+(?:[.,][0-9]+)?)\s*(?:نقطة|نقاط|pts|pt|points)', 1), lambda x: CAST(replace(x, ',', '.') AS DOUBLE) <> 0.125 AND (CAST(replace(x, ',', '.') AS DOUBLE) > 20 OR (CAST(replace(x, ',', '.') AS DOUBLE) * 4) % 1 <> 0))) AS n FROM (SELECT doc_id, (doc_id % 50) / 8.0 || ' points, ' || doc_id % 30 || ' pts' AS t FROM documents)")
def weird_scores(spark, sf_dir):
    """Points made from ids."""
    text = F.concat(((F.col("doc_id") % 50) / 8.0).cast("string"), F.lit(" points, "), (F.col("doc_id") % 30).cast("string"), F.lit(" pts"))
    return read(spark, sf_dir, "documents").select("doc_id", F.size(quality.weird_scores(text)).alias("n"))


@query("SELECT doc_id, count(*) AS n FROM (SELECT doc_id, l FROM (SELECT doc_id, trim(unnest(string_split(text, chr(10)))) AS l FROM documents) WHERE length(l) >= 45 AND NOT starts_with(l, '|') AND NOT regexp_matches(l, '^[-=_*|:\\s]+$') GROUP BY ALL HAVING count(*) > 1) GROUP BY doc_id")
def repeated_page_lines(spark, sf_dir):
    """In each document's row, without a shuffle."""
    return read(spark, sf_dir, "documents").select("doc_id", F.size(quality.repeated_lines(F.col("text"))).cast("long").alias("n")).filter("n > 0")


@query(rf"""WITH c AS (SELECT doc_id, list_filter(regexp_extract_all(text, '\b[a-zA-ZÀ-ÿ]{{4,}}\b'), lambda x: lower(x) NOT IN {fixed.LATEX_WORDS}) AS w, text FROM documents)
SELECT count(*) AS text_pages, CAST(sum(length(text)) AS BIGINT) AS page_text_chars, count_if(text = '') AS empty_pages, count_if(text <> '' AND length(text) < 30) AS very_short_pages, count_if(contains(text, chr(65533))) AS fffd_pages, count_if(regexp_matches(text, '[\x{{E000}}-\x{{F8FF}}]')) AS pua_pages FROM c""")
def integrity_counts(spark, sf_dir):
    """Each document as a page."""
    pages = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("stem"), F.lit(1).alias("page_num"), F.coalesce("text", F.lit("")).alias("text"))
    return audit.integrity(pages).select("text_pages", "page_text_chars", "empty_pages", "very_short_pages", "fffd_pages", "pua_pages")


# ---- audits and states


def _findings(spark, sf_dir):
    files, texts = derived.AUDITED.df(spark, sf_dir), derived.EXTRACTED.df(spark, sf_dir)
    return files, audit.findings(files, texts, derived.CUT.df(spark, sf_dir))


_FINDINGS_SQL = f"""WITH f AS {derived.AUDITED.sql}, t AS {derived.EXTRACTED.sql}, p AS {derived.CUT.sql},
j AS (SELECT f.*, content FROM f LEFT JOIN t USING (stem)), h AS (SELECT * FROM j WHERE content <> ''), n AS (SELECT stem, count(*) AS n FROM p GROUP BY stem),
e AS (SELECT h.stem, k AS page_num, length(trim(coalesce(p.text, ''))) AS n FROM (SELECT *, unnest(range(1, greatest(coalesce(n_pages, 1), 1) + 1)) AS k FROM h) h LEFT JOIN p ON p.stem = h.stem AND p.page_num = h.k), m AS (SELECT stem, avg(n) AS m FROM e GROUP BY stem),
o AS (SELECT stem, 'issue' AS severity, 'MISSING_TXT' AS tag FROM j WHERE content IS NULL UNION ALL SELECT stem, 'issue', 'EMPTY_TXT' FROM j WHERE content = '' UNION ALL SELECT stem, 'issue', 'PDF_UNREADABLE' FROM h WHERE coalesce(n_pages, -1) <= 0
UNION ALL SELECT stem, 'issue', 'PAGE_COUNT_MISMATCH' FROM h JOIN n USING (stem) WHERE n_pages > 0 AND n_pages <> n UNION ALL SELECT stem, 'issue', CASE WHEN n = 0 THEN 'EMPTY_PAGE' ELSE 'SHORT_PAGE' END FROM e WHERE n < 30
UNION ALL SELECT stem, 'warning', 'LOW_RELATIVE_PAGE' FROM e JOIN m USING (stem) WHERE m > 200 AND n < 20 UNION ALL SELECT p.stem, 'issue', 'LANG_MISMATCH' FROM p JOIN f USING (stem) WHERE subject IN {_ARABIC_SUBJECTS} AND length(trim(text)) >= 50
UNION ALL SELECT stem, 'warning', 'NO_QUESTION_STRUCTURE' FROM h WHERE length(content) >= 200 UNION ALL SELECT stem, 'issue', 'VERY_SHORT_FILE' FROM h WHERE length(trim(content)) < 100 UNION ALL SELECT p.stem, 'issue', 'LATIN_GIBBER_IN_ARABIC' FROM p JOIN f USING (stem) WHERE subject IN {_ARABIC_SUBJECTS} AND subject NOT IN {_SCIENCE} AND regexp_matches(text, '{fixed.LATIN_GIBBERISH}')
UNION ALL SELECT stem, 'warning', 'SHORT_EXAM_FILE' FROM h WHERE type = 'exam' AND length(trim(content)) BETWEEN 100 AND 499)"""


@query(_FINDINGS_SQL + " SELECT severity, tag, count(*) AS n, count(DISTINCT stem) AS files FROM o GROUP BY ALL")
def audit_tags(spark, sf_dir):
    return audit.tag_counts(_findings(spark, sf_dir)[1])


@query(_FINDINGS_SQL + ", s AS (SELECT f.stem, subject, count_if(severity = 'issue') AS i, count_if(severity = 'warning') AS w FROM f LEFT JOIN o ON o.stem = f.stem GROUP BY ALL) SELECT subject, count(*) AS total, count_if(i = 0) AS n_pass, count_if(i > 0) AS n_issues, count_if(i = 0 AND w > 0) AS n_warnings_only FROM s GROUP BY ROLLUP (subject)")
def audit_statistics(spark, sf_dir):
    return audit.statistics(audit.passed(*_findings(spark, sf_dir)))


@query(f"""WITH f AS {derived.VERIFIED.sql}, p AS {derived.WORKED.sql},
g AS (SELECT f.*, count_if(status = 'corrected') AS c, count_if(status = 'reprocess_failed') AS x, count_if(needs) AS n FROM f LEFT JOIN p USING (stem) GROUP BY ALL),
s AS (SELECT subject, CASE WHEN NOT has_text THEN 'failed_missing_txt' WHEN NOT has_pdf THEN 'failed_missing_pdf' WHEN x > 0 THEN 'verified_with_failures' WHEN n > 0 AND c = 0 THEN 'verified_issues_uncorrected' WHEN c > 0 THEN 'verified_corrected' ELSE 'verified_pass' END AS z FROM g)
SELECT subject, count(*) AS total, count_if(z = 'verified_pass') AS verified_pass, count_if(z = 'verified_corrected') AS verified_corrected, count_if(z = 'verified_issues_uncorrected') AS verified_issues_uncorrected, count_if(z = 'verified_with_failures') AS verified_with_failures,
count_if(contains(z, 'missing')) AS missing, CAST(0 AS BIGINT) AS error FROM s GROUP BY ROLLUP (subject)""")
def verification_states(spark, sf_dir):
    files = derived.VERIFIED.df(spark, sf_dir)
    return audit.state_summary(audit.file_states(files, derived.WORKED.df(spark, sf_dir)))


@query("""WITH RECURSIVE e AS (SELECT user_id AS key, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k, CASE event_type WHEN 'view' THEN 'reextract' WHEN 'click' THEN 'halves' WHEN 'purchase' THEN 'quarters' ELSE 'reverify' END AS stage,
CASE event_id % 4 WHEN 0 THEN 'FAITHFUL' WHEN 1 THEN 'CORRUPTED' WHEN 2 THEN 'IMPROVED' ELSE 'ERROR' END AS v FROM events), o AS (SELECT key, row_number() OVER (PARTITION BY key ORDER BY k) AS k, stage, v FROM e WHERE v <> 'ERROR'),
f AS (SELECT key, CAST(0 AS BIGINT) AS k, 'CORRUPTED' AS s FROM (SELECT DISTINCT key FROM o) UNION ALL SELECT o.key, o.k, CASE WHEN stage = 'reverify' THEN CASE WHEN v = 'CORRUPTED' THEN 'CORRUPTED' ELSE f.s END WHEN v = 'FAITHFUL' THEN 'FIXED_VERIFIED'
WHEN stage = 'halves' AND v = 'IMPROVED' THEN 'PARTIAL_IMPROVED' WHEN stage = 'quarters' THEN 'UNRESOLVED_FINAL' ELSE 'UNRESOLVED' END FROM f JOIN o ON o.key = f.key AND o.k = f.k + 1)
SELECT key, arg_max(s, k) AS status FROM f GROUP BY key""")
def fix_cascade(spark, sf_dir):
    """Events as attempts to fix what their user stands for."""
    stage = F.when(F.col("event_type") == "view", "reextract").when(F.col("event_type") == "click", "halves").when(F.col("event_type") == "purchase", "quarters").otherwise("reverify")
    verdict = F.element_at(F.array(*map(F.lit, ("FAITHFUL", "CORRUPTED", "IMPROVED", "ERROR"))), (F.col("event_id") % 4 + 1).cast("int"))
    rows = read(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.struct("ts", "event_id").alias("ts"), stage.alias("stage"), verdict.alias("verdict"))
    return audit.fix_states(rows)


@query(f"""WITH f AS {derived.METHOD_FILES.sql}, p AS {derived.METHOD_PAGES.sql},
m AS (SELECT CASE WHEN NOT has_report THEN CASE WHEN coalesce(year <= 2014, false) OR sum(n_chars) OVER (PARTITION BY stem) = 0 THEN 'gemini' ELSE 'pdfplumber' END WHEN coalesce(year <= 2014, false) OR reprocessed OR n_chars <= 50 THEN 'gemini' ELSE 'pdfplumber' END AS method FROM p JOIN f USING (stem))
SELECT method, count(*) AS n FROM m GROUP BY method""")
def rebuilt_method_totals(spark, sf_dir):
    files, pages = derived.METHOD_FILES.df(spark, sf_dir), derived.METHOD_PAGES.df(spark, sf_dir)
    return audit.method_totals(audit.rebuilt_methods(files, pages))


@query(f"""WITH m AS (SELECT path, regexp_extract(path, '([^/]*)\\.pdf$', 1) AS s, size_bytes FROM {derived.MANIFESTED.sql} LEFT JOIN {derived.ON_DISK.sql} USING (path))
SELECT path, 'missing' AS problem FROM m WHERE size_bytes IS NULL UNION ALL SELECT path, 'zero_bytes' FROM m WHERE size_bytes = 0 UNION ALL SELECT path, 'duplicate_stem' FROM m WHERE s IN (SELECT s FROM m GROUP BY s HAVING count(*) > 1)""")
def manifest_audit(spark, sf_dir):
    return audit.manifest_problems(derived.MANIFESTED.df(spark, sf_dir), derived.ON_DISK.df(spark, sf_dir))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS key, problem FROM (SELECT *, unnest(list_filter([CASE WHEN o_orderkey % 5 = 0 THEN 'missing' END, CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 90 < 80 THEN 'too_short' END, CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 200 > 2 * (o_orderkey % 90) THEN 'shrunk' END], lambda x: x IS NOT NULL)) AS problem FROM orders)")
def fixed_page_regressions(spark, sf_dir):
    """Orders as pages: texts as long as their keys say."""
    k = F.col("o_orderkey")
    rows = read(spark, sf_dir, "orders").select(k.cast("string").alias("key"), F.repeat(F.lit("x"), (k % 90).cast("int")).alias("now"), F.repeat(F.lit("x"), (k % 200).cast("int")).alias("was"), k)
    return audit.fixed_page_regressions(rows, rows.filter("o_orderkey % 5 <> 0").select("key", F.col("now").alias("text")), rows.select("key", F.col("was").alias("text")))


# ---- units, pairs, overrides


@query(f"""WITH u AS (SELECT *, replace(stem, '_solution', '') AS d FROM {derived.UNITS.sql}), e AS (SELECT * FROM u WHERE doc_type = 'exam'), c_ AS (SELECT replace(stem, '_solution', '') AS d FROM {derived.COPIES.sql} z), s AS (SELECT * FROM u WHERE doc_type = 'solution' AND d NOT IN (SELECT d FROM c_)),
a AS (SELECT e.id, s.id AS s FROM e JOIN s ON e.d = s.d AND e.part IS NOT DISTINCT FROM s.part AND e.exercise_index = s.exercise_index), b AS (SELECT e.id, s.id AS s FROM e JOIN s ON e.d = s.d AND s.part IS NULL AND e.exercise_index = s.exercise_index WHERE e.id NOT IN (SELECT id FROM a) AND s.id NOT IN (SELECT s FROM a)),
c AS (SELECT e.id, s.id AS s FROM e JOIN s ON e.d = s.d AND e.exercise_index = s.exercise_index WHERE e.id NOT IN (SELECT id FROM a UNION ALL SELECT id FROM b) AND s.id NOT IN (SELECT s FROM a UNION ALL SELECT s FROM b)),
k AS (SELECT e.id, s.id AS s FROM e JOIN s ON e.d = s.d AND e.section_key = s.section_key AND NOT s.whole_document), x AS (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c UNION ALL SELECT * FROM k), w AS (SELECT d, arg_min(id, ix) AS first FROM s GROUP BY d)
SELECT e.id AS pair_id, CASE WHEN e.d IN (SELECT d FROM c_) THEN NULL WHEN x.s IS NOT NULL THEN x.s WHEN e.section_key <> 'text' THEN w.first END AS solution_id,
CASE WHEN e.d IN (SELECT d FROM c_) THEN 'solution_is_exam_copy' WHEN x.s IS NOT NULL THEN 'unit' WHEN e.section_key = 'text' THEN 'none_expected' WHEN e.section_key IS NOT NULL AND w.first IS NOT NULL THEN 'document_fallback' ELSE 'none' END AS solution_match FROM e LEFT JOIN x ON x.id = e.id LEFT JOIN w ON w.d = e.d""")
def unit_pairs(spark, sf_dir):
    copies = derived.COPIES.df(spark, sf_dir)
    return linking.paired(derived.UNITS.df(spark, sf_dir), copies).select("pair_id", "solution_id", "solution_match")


@query(f"""WITH q AS {derived.QUESTIONS.sql}, o AS (SELECT qid, list_transform(string_split(bs, ','), lambda x: CAST(x AS INTEGER)) AS blocks, note, from_unit FROM {derived.OVERRIDES.sql} z), b AS {derived.BLOCKS.sql},
x AS (SELECT q.qid, coalesce(from_unit, unit_id) AS u, unnest(blocks) AS block, unnest(range(1, len(blocks) + 1)) AS pos FROM q JOIN o USING (qid)), t AS (SELECT qid, string_agg(text, chr(10) ORDER BY pos) AS text FROM x JOIN b ON b.unit_id = x.u AND b.block = x.block GROUP BY qid)
SELECT q.qid, CASE WHEN o.qid IS NULL THEN match WHEN t.text IS NULL THEN 'solution_missing' ELSE 'human' END AS match, CASE WHEN o.qid IS NULL THEN answer ELSE t.text END AS answer FROM q LEFT JOIN o USING (qid) LEFT JOIN t USING (qid)""")
def override_texts(spark, sf_dir):
    overrides = derived.OVERRIDES.df(spark, sf_dir).select("qid", F.split("bs", ",").cast("array<int>").alias("blocks"), "note", "from_unit")
    return align.overridden(derived.QUESTIONS.df(spark, sf_dir), overrides, derived.BLOCKS.df(spark, sf_dir)).select("qid", "match", "answer")


@query(f"""WITH q AS {derived.QUESTIONS.sql} SELECT unit_id, count(*) AS questions, count_if(match IN ('strong', 'good', 'label_supported', 'human')) AS answered, round(100.0 * count_if(match IN ('strong', 'good', 'label_supported', 'human')) / greatest(count_if(match NOT IN ('parent_stub', 'legend', 'solution_missing')), 1), 1) AS answered_pct, count_if(coalesce(label_agree = 0, false)) AS despite_labels FROM q GROUP BY unit_id""")
def alignment_statistics(spark, sf_dir):
    return align.statistics(derived.QUESTIONS.df(spark, sf_dir), ["unit_id"]).select("unit_id", "questions", "answered", "answered_pct", "despite_labels")


@query(f"""WITH q AS {derived.QUESTIONS.sql}, s AS (SELECT *, answer IS NOT NULL AND row_number() OVER (PARTITION BY unit_id, substr(answer, 1, 60) ORDER BY ix) > 1 AS shared FROM q)
SELECT qid, array_to_string(list_filter([CASE match WHEN 'none' THEN 'NONE' WHEN 'parent_stub' THEN 'STUB' WHEN 'label_supported' THEN 'LBL' WHEN 'legend' THEN 'LEGEND' END, CASE WHEN label_agree = 0 THEN 'CONTRA' END, CASE WHEN shared THEN 'SHARED' END], lambda x: x IS NOT NULL), ',') AS flags FROM s""")
def review_flags(spark, sf_dir):
    return align.flags(derived.QUESTIONS.df(spark, sf_dir)).select("qid", F.concat_ws(",", "flags").alias("flags"))


@query(f"""WITH q AS {derived.QUESTIONS.sql} SELECT DISTINCT unit_id FROM (SELECT *, count(*) OVER (PARTITION BY unit_id, substr(answer, 1, 60)) AS c FROM q) WHERE match = 'none' OR label_agree = 0 OR (answer <> '' AND c > 1)""")
def flagged_units(spark, sf_dir):
    return reports.flagged_units(derived.QUESTIONS.df(spark, sf_dir), strict=True)


@query(f"""WITH o AS (SELECT qid, note, coalesce(from_unit, split_part(qid, '__q', 1)) AS u, split_part(qid, '__q', 2) AS asked, unnest(blocks) AS block FROM (SELECT qid, list_transform(string_split(bs, ','), lambda x: CAST(x AS INTEGER)) AS blocks, note, from_unit FROM {derived.OVERRIDES.sql} z)), b AS {derived.BLOCKS.sql}
SELECT qid, o.block, CASE WHEN u NOT IN (SELECT unit_id FROM b) THEN 'missing unit' WHEN b.unit_id IS NULL THEN 'out of range' ELSE 'label' END AS problem FROM o LEFT JOIN b ON b.unit_id = u AND b.block = o.block WHERE b.label IS NULL OR NOT (b.label = asked OR starts_with(asked, b.label || '.') OR starts_with(b.label, asked || '.'))""")
def override_checks(spark, sf_dir):
    overrides = derived.OVERRIDES.df(spark, sf_dir).select("qid", F.split("bs", ",").cast("array<int>").alias("blocks"), "note", "from_unit")
    return linking.override_problems(overrides, derived.BLOCKS.df(spark, sf_dir))


# ---- repairs, merges, boxes


@query(f"SELECT key, CASE WHEN year BETWEEN 2008 AND 2026 THEN replace(t, reverse(CAST(year AS VARCHAR)), CAST(year AS VARCHAR)) ELSE t END AS one, " + "".join("replace(" for _ in range(19)) + "t" + "".join(f", '{str(y)[::-1]}', '{y}')" for y in range(2026, 2007, -1)) + f" AS every FROM {derived.TURNED.sql}")
def turned_years(spark, sf_dir):
    return derived.TURNED.df(spark, sf_dir).select("key", repair.year_turned_back(F.col("t"), F.col("year")).alias("one"), repair.years_turned_back(F.col("t")).alias("every"))


@query(rf"""WITH n AS {derived.NAMED.sql}, m AS (SELECT name, regexp_replace(regexp_replace(name, 'bac_math_2013_sujet1(_and|_solution|[A-Za-z0-9])', 'KEEP1\1', 'g'), 'bac_math_2013_sujet2(_and|_solution|[A-Za-z0-9])', 'KEEP2\1', 'g') AS x FROM n)
SELECT name, replace(replace(replace(replace(replace(x, 'bac_math_2013_sujet1', 'SWAP'), 'bac_math_2013_sujet2', 'bac_math_2013_sujet1'), 'SWAP', 'bac_math_2013_sujet2'), 'KEEP1', 'bac_math_2013_sujet1'), 'KEEP2', 'bac_math_2013_sujet2') AS exam FROM m""")
def exchanged_topics(spark, sf_dir):
    return derived.NAMED.df(spark, sf_dir).select("name", overlay.swapped_topics(F.col("name"), "math", "2013", "exam").alias("exam"))


_STATUSES = " || ',' || ".join(f"CASE WHEN contains(coalesce({x}, ''), '{y}') THEN 'OK' ELSE 'NOT_FOUND' END" for x, y in (("t", "one"), ("u", "two"), ("v", "one")))


@query(f"""WITH d AS (SELECT stem, content AS t, CAST(stem AS BIGINT) % 3 <> 0 AS p FROM {derived.PATCHED.sql} z), a AS (SELECT *, CASE WHEN p THEN regexp_replace(t, 'one', '1') ELSE t END AS u FROM d), b AS (SELECT *, CASE WHEN p THEN replace(u, 'two', 'one') ELSE u END AS v FROM a),
c AS (SELECT *, CASE WHEN p THEN replace(v, 'one', 'uno') ELSE v END AS w FROM b)
SELECT stem, w AS content, CASE WHEN NOT p THEN '' ELSE {_STATUSES} END AS statuses FROM c""")
def text_patches(spark, sf_dir):
    """In order: the first place, then everywhere what that may have made."""
    done = repair.patched(derived.PATCHED.df(spark, sf_dir), derived.PATCHES.df(spark, sf_dir))
    return done.select("stem", "content", F.concat_ws(",", F.transform("log", lambda x: x["status"])).alias("statuses"))


@query(f"""SELECT key, CASE WHEN s THEN t ELSE t || chr(10) || '[SCORES — read from source image, top→bottom: ' || r || ']' END AS page, CASE WHEN s THEN 'SKIP' ELSE 'APPENDED' END AS status FROM (SELECT *, r IS NULL OR regexp_matches(r, '^(NO_SCORES|RECHECK|SCORES_ALREADY_IN_TEXT)') OR contains(t, '[SCORES') AS s FROM {derived.SCORED.sql})""")
def score_blocks(spark, sf_dir):
    page, status = repair.with_scores(F.col("t"), F.col("r"))
    return derived.SCORED.df(spark, sf_dir).select("key", page.alias("page"), status.alias("status"))


_BOXES_SQL = "SELECT event_id AS id, user_id % 97 AS page, CAST(event_id % 600 AS DOUBLE) AS x0, coalesce(value, 0) % 800 AS y0, CAST(event_id % 600 AS DOUBLE) + 30 AS x1, coalesce(value, 0) % 800 + 20 AS y1 FROM events"


@query(f"WITH b AS ({_BOXES_SQL}) SELECT a.page, a.id AS a, c.id AS b FROM b a JOIN b c ON a.page = c.page AND a.id % 2 = 0 AND c.id % 2 = 1 WHERE a.x0 < c.x1 AND c.x0 < a.x1 AND a.y0 < c.y1 AND c.y0 < a.y1")
def overlapping_boxes(spark, sf_dir):
    """Events as boxes on pages, even ones against odd ones."""
    x, y = (F.col("event_id") % 600).cast("double"), F.coalesce("value", F.lit(0.0)) % 800
    boxes = read(spark, sf_dir, "events").select(F.col("event_id").alias("id"), (F.col("user_id") % 97).alias("page"), x.alias("x0"), y.alias("y0"), (x + 30).alias("x1"), (y + 20).alias("y1"))
    return figures.overlapping(boxes.filter("id % 2 = 0"), boxes.filter("id % 2 = 1"), ["page"])


@query(f"""WITH w AS (SELECT *, x0 < 180 AS l, x0 > 420 AS r FROM {derived.WORDS.sql} WHERE regexp_matches(replace(trim(word), '×', 'x'), '{fixed.SCORE_TOKEN}')),
c AS (SELECT *, count(*) OVER p AS n, count_if(l) OVER p AS nl, count_if(r) OVER p AS nr FROM w WINDOW p AS (PARTITION BY stem, page))
SELECT stem, page, string_agg(trim(word), ' | ' ORDER BY y0, x0, word) AS scores FROM c WHERE n >= 2 AND CASE WHEN greatest(nl, nr) < 2 THEN true WHEN nl >= nr THEN l ELSE r END GROUP BY ALL""")
def score_columns(spark, sf_dir):
    return figures.score_columns(derived.WORDS.df(spark, sf_dir))


@query(f"""SELECT key, CASE {" ".join(f"WHEN regexp_matches(upper(r), 'CATEGORY: ?{c}') THEN '{c}'" for c in replies.CATEGORIES)} ELSE 'UNCLEAR' END AS category, CASE WHEN regexp_matches(upper(r), 'MEANINGFUL: ?YES') THEN true WHEN regexp_matches(upper(r), 'MEANINGFUL: ?NO') THEN false END AS meaningful, trim(regexp_extract(r, '(?im)^DESC:(.*)$', 1)) AS description FROM {derived.REPLIES.sql}""")
def reply_tags(spark, sf_dir):
    r = F.col("r")
    return derived.REPLIES.df(spark, sf_dir).select("key", replies.category(r).alias("category"), replies.meaningful(r).alias("meaningful"), replies.tagged(r, "DESC").alias("description"))


@query(f"""SELECT key, CASE WHEN NOT low THEN 'pdfplumber' WHEN rendered AND trim(coalesce(ocr, '')) <> '' THEN CASE WHEN conf >= 0.9 THEN 'gemini' ELSE 'paddleocr' END WHEN rendered OR t = '' THEN 'failed' ELSE 'pdfplumber' END AS method, CASE WHEN low AND trim(coalesce(ocr, '')) = '' AND (rendered OR t = '') THEN true ELSE false END AS failed FROM {derived.ROUTED.sql}""")
def page_routes(spark, sf_dir):
    rows = derived.ROUTED.df(spark, sf_dir)
    return rows.withColumn("r", replies.routed(F.col("t"), F.col("low"), F.col("rendered"), F.col("ocr"), F.col("conf"))).select("key", "r.method", "r.failed")


@query("SELECT lang, doc_id FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY n DESC, doc_id DESC) AS r FROM (SELECT lang, doc_id, len(regexp_extract_all(text, '\\\\|\\^|_\\{')) + length(text) AS n FROM documents)) WHERE r <= 7")
def densest_documents(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("lang", F.col("doc_id").alias("key"), "text")
    langs = ("de", "en", "es", "fr")
    some = reports.dense_sample(docs, formulas.density(F.col("text")) + F.length("text"), "lang", dict.fromkeys(langs, 7), dict.fromkeys(langs, 7))
    return some.select("lang", F.col("key").alias("doc_id"))


@query("SELECT event_type, n FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1) ORDER BY n DESC, event_type LIMIT 3 OFFSET 1")
def second_page_of_types(spark, sf_dir):
    return reports.page(reports.most_common(read(spark, sf_dir, "events"), "event_type"), [F.desc("n"), F.col("event_type")], 1, 3)


@query("SELECT user_id, arg_min(event_id, event_id) AS event_id, arg_min(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def first_events(spark, sf_dir):
    return reports.first_seen(read(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id")
