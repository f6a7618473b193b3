"""Reading, segmentation and alignment over texts put together from the given tables' rows. Their SQL folds the same rows by recursion."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed
from ..functions import quality, repair
from ..functions import text as T
from ..operators import align, labels, overlay, reading, sequences, units, vectors
from ..sources import files
from ..sources.versions import Versions
from ..streaming.incremental import work_dir
from . import golden  # registers what these replace
from .catalogue import _ANCHORS, _turn_pairs, query, read
from .derived import NL, PAGES, Derived, part, pick, text
from .records import _AR

QUERIES, ORACLES = golden.QUERIES, golden.ORACLES
_N = "(1 + CAST(l_quantity AS INTEGER) % 16)"
_ORDINALS = tuple(fixed.KEY_ORDINALS)

_LABELLED = Derived(
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER) AS q, CASE l_partkey % 10 WHEN 0 THEN {text(_N)} || ') Calculer' WHEN 1 THEN '-' || {text(_N)} || ' احسب' WHEN 2 THEN {text("1 + l_linenumber")} || '.' || {text(_N)} || ' - x'
 WHEN 3 THEN '(' || {text("l_linenumber")} || ') a (' || {text("1 + l_suppkey % 9")} || ') b' WHEN 4 THEN {text(_N)} || ' / 20' WHEN 5 THEN 'ج ' || {text(_N)} || ' - نعم' WHEN 6 THEN 'الجواب على السؤال ' || {pick("l_suppkey", _ORDINALS)} || ': نعم'
 WHEN 7 THEN {text(_N)} || ',5' WHEN 8 THEN '**' || {text(_N)} || '** The text is' ELSE 'plain ' || {text(_N)} || ') x' END AS line FROM lineitem"""
)


@query(
    f"""SELECT l_orderkey, l_linenumber, line, CASE l_partkey % 10 WHEN 2 THEN CASE WHEN 1 + q % 16 <= 12 THEN (1 + l_linenumber) || '.' || (1 + q % 16) END WHEN 6 THEN CASE l_suppkey % {len(_ORDINALS)} {" ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(fixed.KEY_ORDINALS.values()))} END
WHEN 3 THEN NULL WHEN 4 THEN NULL WHEN 7 THEN NULL WHEN 9 THEN NULL ELSE CAST(1 + q % 16 AS VARCHAR) END AS label FROM {_LABELLED.sql} x"""
)
def item_labels(spark, sf_dir):
    """Line items as lines; their SQL knows each line's form."""
    return _LABELLED.df(spark, sf_dir).select("l_orderkey", "l_linenumber", "line", reading.item_label(F.col("line")).alias("label"))


#: Lines of a part's text, in order: items, parts of items, plain lines, rows of matching tables.
_ITEM_LINES = Derived(
    f"""SELECT l_partkey AS unit, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, {_N} AS n, l_suppkey % 4 AS form,
 CASE l_suppkey % 4 WHEN 0 THEN {text(_N)} || ') item of ' || {text("l_orderkey")} WHEN 1 THEN {text(_N)} || '.' || {text("l_linenumber")} || ') part of ' || {text("l_orderkey")} WHEN 2 THEN 'line ' || {text("l_orderkey")} ELSE {text(_N)} || '. Read' END AS line FROM lineitem"""
)
_LINE_ORDER = ("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")


@query(f"""WITH RECURSIVE l AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY {", ".join(_LINE_ORDER)}) AS i FROM {_ITEM_LINES.sql} x),
s AS (SELECT unit, CAST(0 AS BIGINT) AS i, 1 AS expected, CAST(NULL AS INTEGER) AS open, false AS opens FROM (SELECT DISTINCT unit FROM l)
UNION ALL SELECT unit, i, CASE WHEN opens THEN n + 1 ELSE expected END, CASE WHEN opens THEN n ELSE open END, opens FROM (SELECT l.unit, l.i, l.n, expected, open, l.form <> 2 AND CASE WHEN l.unit % 2 = 1 THEN l.form = 0 AND (n = expected OR (open IS NULL AND n <= 3))
ELSE l.form = 1 OR n IN (1, expected) OR CASE WHEN open IS NULL THEN n <= 12 ELSE n > open AND n <= 15 END END AS opens FROM s JOIN l ON l.unit = s.unit AND l.i = s.i + 1)),
k AS (SELECT l.unit, l.i, l.line, l.n, l.form, l.l_linenumber, s.opens, count_if(s.opens) OVER (PARTITION BY l.unit ORDER BY l.i) AS k FROM l JOIN s ON s.unit = l.unit AND s.i = l.i)
SELECT unit, k, max(CASE WHEN opens THEN n || CASE WHEN form = 1 THEN '.' || l_linenumber ELSE '' END END) AS label, string_agg(line, chr(10) ORDER BY i) AS text FROM k WHERE k > 0 GROUP BY unit, k""")
def split_items(spark, sf_dir):
    """The items of each part's lines, strictly for odd parts."""
    lines = _ITEM_LINES.df(spark, sf_dir)
    texts = lines.groupBy("unit").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*_LINE_ORDER, "line"))), lambda x: x["line"]), "\n").alias("t"))
    return texts.select("unit", F.posexplode(reading.items(F.col("t"), F.col("unit") % 2 == 1)).alias("k", "i")).select("unit", (F.col("k") + 1).cast("long").alias("k"), "i.label", "i.text")


@query("""WITH l AS (SELECT l_orderkey AS unit, l_linenumber, l_suppkey, l_partkey, l_extendedprice, l_linenumber % 3 + 1 AS a, l_suppkey % 3 + 1 AS b, row_number() OVER w AS i, lag(l_linenumber % 3 + 1) OVER w AS pa, lag(l_suppkey % 3 + 1) OVER w AS pb FROM lineitem
WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey, l_extendedprice)), t AS (SELECT unit, count_if(a <> pa) > count_if(b <> pb) AS turn FROM l GROUP BY unit)
SELECT unit, CAST(i - 1 AS INTEGER) AS ix, a || '.' || b AS label_raw, CASE WHEN turn THEN b || '.' || a ELSE a || '.' || b END AS label FROM l JOIN t USING (unit)""")
def turned_labels(spark, sf_dir):
    """Labels of two parts of each order's lines, turned round where the first part changes more often than the last."""
    label = F.concat((F.col("l_linenumber") % 3 + 1).cast("string"), F.lit("."), (F.col("l_suppkey") % 3 + 1).cast("string"))
    rows = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("unit")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice", label.alias("label"), F.lit("").alias("text")))).alias("r"))
    return rows.select("unit", F.posexplode(reading.oriented(F.transform("r", lambda x: F.struct(x["label"].alias("label"), x["text"].alias("text"))))).alias("ix", "o")).select("unit", "ix", "o.label_raw", "o.label")


_MENTIONS = Derived(
    f"""SELECT l_orderkey, l_linenumber, {text("1 + l_suppkey % 3")} || CASE WHEN l_partkey % 2 = 0 THEN '.' || {text("1 + l_linenumber % 3")} ELSE '' END AS label, {pick("l_partkey", ("1) head", "see (2) there", ""))} || {NL} || {pick("l_suppkey", ("**", "  (", "| x | ", "see "))} || {text("1 + l_partkey % 3")}
 || CASE WHEN l_suppkey % 2 = 0 THEN '.' || {text("1 + l_partkey % 4")} ELSE '' END || {pick("l_partkey", (" - y", ") y", " y"))} AS t FROM lineitem"""
)


@query(rf"""WITH m AS (SELECT *, replace(label, '.', '\.') AS a, replace(array_to_string(list_reverse(string_split(label, '.')), '.'), '.', '\.') AS b, CASE WHEN contains(t, chr(10)) THEN chr(10) || substr(t, instr(t, chr(10)) + 1) ELSE '' END AS later FROM {_MENTIONS.sql} x)
SELECT l_orderkey, l_linenumber, label, t, regexp_matches(later, '(?:\n|\|)\s*\**\(?\s*(?:' || a || '|' || b || ')\s*[\.\)\-–/:]') AS mentions FROM m""")
def label_mentions(spark, sf_dir):
    rows = _MENTIONS.df(spark, sf_dir)
    return rows.select("l_orderkey", "l_linenumber", "label", "t", labels.block_mentions(F.col("label"), F.col("t")).alias("mentions"))


# ---- segmentation

_KIND, _K = "length(text) % 8", part("length(text)", 8)
#: Turns as lines of a text of a science subject, those of odd conversations as its key's.
_EXAM_LINES = Derived(
    f"""SELECT conv_id, turn, {_KIND} AS kind, {_K} % 5 + 1 AS n, {_K} % 3 AS p, CASE {_KIND} WHEN 0 THEN '**التمرين ' || {pick(_K, ("الأول", "الثاني", "الثالث", "الرابع", "الخامس"))} || '**' || {pick(_K, ("", " (4 نقاط)", " (3,5 نقاط)"))}
 WHEN 1 THEN 'الجزء ' || {pick(_K, ("الأول", "الثاني", "الثالث", "الرابع", "الخامس"))} || ' (' || {text(f"{_K} % 7 + 6")} || ' نقاط)' WHEN 2 THEN 'الجزء ' || {pick(_K, ("الأول", "الثاني", "الثالث", "الرابع", "الخامس"))} || ' :' WHEN 3 THEN 'الموضوع ' || {pick(_K, ("الأول", "الثاني"))}
 ELSE 'line ' || {text("turn")} || ' ' || {text("length(text)")} || repeat('x', CAST(length(text) % 97 AS INTEGER)) END AS line FROM conversations WHERE text IS NOT NULL"""
)
_STEM = f"'bac_math_' || {text('1000 + conv_id % 9000')} || '_sujet' || {text('1 + ' + part('conv_id', 9000) + ' % 9')} || CASE WHEN conv_id % 2 = 1 THEN '_solution' ELSE '' END"
_NAMES = "CASE {0} WHEN 1 THEN 'الأول' WHEN 2 THEN 'الثاني' WHEN 3 THEN 'الثالث' WHEN 4 THEN 'الرابع' ELSE 'الخامس' END"


@query(f"""WITH RECURSIVE l AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, 1 + CAST(floor(conv_id / 9000) AS BIGINT) % 9 AS sujet FROM {_EXAM_LINES.sql} x),
r AS (SELECT *, max(CASE WHEN kind = 0 THEN n END) OVER (PARTITION BY conv_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before, first_value(CASE WHEN kind = 0 THEN n END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after FROM l),
c AS (SELECT conv_id, min(i) AS cut FROM r WHERE kind = 3 AND (CASE WHEN line LIKE '%الثاني' THEN 2 ELSE 1 END) <> sujet AND after <= coalesce(before, 0) GROUP BY conv_id),
k AS (SELECT l.* FROM l LEFT JOIN c USING (conv_id) WHERE i < coalesce(cut, 1e18)),
f AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, false AS here, CAST(NULL AS VARCHAR) AS part, CAST(NULL AS DOUBLE) AS pp, CAST(0 AS BIGINT) AS u, false AS opens, false AS closes FROM (SELECT DISTINCT conv_id FROM k)
UNION ALL SELECT conv_id, i, kind = 0 OR (here AND NOT section), CASE WHEN section THEN 'الجزء ' || {_NAMES.format("n")} ELSE part END, CASE WHEN section THEN pts ELSE pp END, u + CASE WHEN kind = 0 THEN 1 ELSE 0 END, kind = 0, section
FROM (SELECT k.conv_id, k.i, k.kind, k.n, here, part, pp, u, kind = 1 OR (kind = 2 AND NOT here) AS section, CASE WHEN kind = 1 THEN CAST(regexp_extract(line, '[0-9]+') AS DOUBLE) END AS pts FROM f JOIN k ON k.conv_id = f.conv_id AND k.i = f.i + 1)),
m AS (SELECT k.*, f.here, f.part, f.pp, f.u, f.opens, f.closes FROM k JOIN f ON f.conv_id = k.conv_id AND f.i = k.i),
h AS (SELECT conv_id, u, part, n AS ix, CASE WHEN p = 1 THEN 4.0 WHEN p = 2 THEN 3.5 ELSE pp END AS points, CASE WHEN p > 0 THEN 'heading' WHEN pp IS NOT NULL THEN 'part' END AS source FROM m WHERE opens),
g AS (SELECT conv_id, part, ix, min(u) AS u FROM h GROUP BY ALL),
t AS (SELECT g.conv_id, g.u, string_agg(m.line, chr(10) ORDER BY m.i) AS text FROM g JOIN h ON h.conv_id = g.conv_id AND h.part IS NOT DISTINCT FROM g.part AND h.ix = g.ix JOIN m ON m.conv_id = h.conv_id AND m.u = h.u AND m.here GROUP BY ALL),
o AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY i) AS body, sum(length(line)) AS n FROM m WHERE NOT here AND NOT closes GROUP BY conv_id),
e AS (SELECT t.conv_id, t.u, h.part, CAST(h.ix AS INTEGER) AS exercise_index, h.points, h.source AS points_source, t.text, false AS heading_inferred, false AS whole_document FROM t JOIN h ON h.conv_id = t.conv_id AND h.u = t.u),
a AS (SELECT * FROM e UNION ALL SELECT e.conv_id, 0, e.part, 1, NULL, NULL, o.body, true, false FROM e JOIN o USING (conv_id) WHERE e.u = 1 AND e.exercise_index <> 1 AND o.n > 300
 UNION ALL SELECT conv_id, 0, NULL, NULL, NULL, NULL, string_agg(line, chr(10) ORDER BY i), false, true FROM l WHERE conv_id % 2 = 1 AND conv_id NOT IN (SELECT conv_id FROM e) GROUP BY conv_id),
z AS (SELECT *, {_STEM} || '__ex' || row_number() OVER (PARTITION BY conv_id ORDER BY u) AS id FROM a)
SELECT id, part, exercise_index, points, points_source, text, heading_inferred, whole_document FROM z""")
def exercise_units(spark, sf_dir):
    """Conversations as texts: exercises with parts, points, repeated headings, foreign topics, missing first headings."""
    lines = _EXAM_LINES.df(spark, sf_dir)
    texts = lines.groupBy("conv_id").agg(F.concat(F.lit("[PAGE 1]\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "line"))), lambda x: x["line"]), "\n")).alias("content"))
    found = units.segmented(texts.select(F.expr(_STEM).alias("stem"), "content"))
    return found.select("id", "part", "exercise_index", "points", "points_source", "text", "heading_inferred", "whole_document")


# ---- alignment

_LEX = "round(CASE WHEN len(q.w) = 0 OR len(a.w) = 0 THEN 0 ELSE len(list_intersect(q.w, a.w)) / sqrt(len(q.w) * len(a.w)::DOUBLE) END, 6)"


@query(f"""WITH RECURSIVE t AS (SELECT conv_id, turn, role, {_ANCHORS} AS w FROM conversations), s AS (
SELECT q.conv_id AS unit, q.turn AS q, a.turn AS b, {_LEX} AS lex, a.turn % 4 <> 1 AS again FROM t q JOIN t a ON q.conv_id = a.conv_id AND q.role = 'user' AND a.role = 'assistant'),
r AS (SELECT unit, q, row_number() OVER (PARTITION BY unit ORDER BY q) AS i, list(lex ORDER BY b) AS s, list(b ORDER BY b) AS bs, list(again ORDER BY b) AS ag FROM (SELECT unit, q, b, max(lex) AS lex, bool_or(again) AS again FROM s GROUP BY ALL) GROUP BY unit, q),
dp AS (SELECT DISTINCT unit, CAST(0 AS BIGINT) AS i, len(bs) AS m, list_transform(range(0, len(bs) + 1), lambda x: 0.0::DOUBLE) AS best, list_transform(range(0, len(bs) + 1), lambda x: -1::BIGINT) AS pick FROM r
UNION ALL SELECT unit, i, m, list_transform(range(0, m + 1), lambda j: CASE WHEN coalesce(list_max(v[1:j]), -1e9) > best[j + 1] + 1e-12 THEN list_max(v[1:j]) ELSE best[j + 1] END),
list_transform(range(0, m + 1), lambda j: CASE WHEN coalesce(list_max(v[1:j]), -1e9) > best[j + 1] + 1e-12 THEN list_position(list_transform(v[1:j], lambda x: x >= list_max(v[1:j]) - 1e-12), true)::BIGINT - 1 ELSE -1 END)
FROM (SELECT dp.unit, r.i, m, best, list_transform(range(1, m + 1), lambda k: CASE WHEN s[k] > 0 AND (pick[k + 1] <> k - 1 OR ag[k]) THEN best[k + 1] + s[k] - CASE WHEN pick[k + 1] = k - 1 THEN {align.AGAIN} ELSE 0 END ELSE -1e9 END) AS v FROM dp JOIN r ON r.unit = dp.unit AND r.i = dp.i + 1)),
back AS (SELECT unit, max(i) AS i, any_value(m)::BIGINT AS j FROM dp GROUP BY unit UNION ALL SELECT back.unit, back.i - 1, CASE WHEN pick[j + 1] >= 0 THEN pick[j + 1] + 1 ELSE j END FROM back JOIN dp ON dp.unit = back.unit AND dp.i = back.i WHERE back.i > 0)
SELECT unit, q, b FROM (SELECT back.unit, r.q, bs[pick[j + 1] + 1] AS b, ag[pick[j + 1] + 1] AS again, row_number() OVER (PARTITION BY back.unit, pick[j + 1] ORDER BY back.i) AS n FROM back JOIN dp ON dp.unit = back.unit AND dp.i = back.i JOIN r ON r.unit = back.unit AND r.i = back.i WHERE back.i > 0 AND pick[j + 1] >= 0) WHERE n = 1 OR again""")
def reused_answers(spark, sf_dir):
    """monotone_alignment where three of four assistants' turns may answer the next question as well."""
    pairs = _turn_pairs(spark, sf_dir).select(F.col("conv_id").alias("unit"), "q", "b", F.round("lex", 6).alias("score"), (F.col("b") % 4 != 1).alias("again"))
    return align.aligned_scores(pairs)


@query(f"""WITH t AS (SELECT conv_id, turn, role, {_ANCHORS} AS w FROM conversations)
SELECT unit, q, b, round(lex, 6) AS lex FROM (SELECT q.conv_id AS unit, q.turn AS q, a.turn AS b, len(list_intersect(q.w, a.w)) / sqrt(len(q.w) * len(a.w)::DOUBLE) AS lex FROM t q JOIN t a ON q.conv_id = a.conv_id AND q.role = 'user' AND a.role = 'assistant' AND len(q.w) > 0 AND len(a.w) > 0) WHERE lex >= 0.15""")
def indexed_candidates(spark, sf_dir):
    """User and assistants' turns of a conversation with enough words in common, met in an index of their rarest words."""
    turns = read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("unit"), "turn", "role", T.anchors(F.col("text")).alias("words"))
    side = lambda role, key: turns.filter(F.col("role") == role).select("unit", F.col("turn").alias(key), "words")
    return align.indexed(side("user", "q"), side("assistant", "b"), 0.15).withColumn("lex", F.round("lex", 6))


# ---- figures and pages


@query(r"""WITH a AS (SELECT page_id, regexp_replace(html, '(?s)<svg\b.*?</svg>', '[FIGURE]', 'g') AS t FROM pages), b AS (SELECT page_id, regexp_replace(t, '<img\b[^>]*alt="([^">]+)"[^>]*>', '[FIGURE: \1]', 'g') AS t FROM a)
SELECT page_id, regexp_replace(t, '<img\b[^>]*>', '[FIGURE]', 'g') AS text FROM b""")
def plain_figures(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", repair.figures(F.col("html")).alias("text"))


@query(f"""WITH p AS (SELECT i, subject, t, length(regexp_replace(t, '[^{_AR}]', '', 'g')) AS ar, length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS la, length(regexp_replace(t, '^\\s+|\\s+$', '', 'g')) AS n, list_filter(regexp_split_to_array(t, '\\s+'), lambda x: 2 * length(regexp_replace(x, '[^{_AR}]', '', 'g')) > length(x)) AS w FROM {PAGES.sql} x),
s AS (SELECT *, subject IN {fixed.ARABIC_SUBJECTS} AS is_ar, CASE WHEN ar + la = 0 THEN 'unknown' WHEN ar / (ar + la) > 0.6 THEN 'arabic' WHEN ar / (ar + la) < 0.2 THEN 'latin' ELSE 'mixed' END AS script, coalesce(list_sum(list_transform(w, lambda x: length(x))) / nullif(len(w), 0), 0) AS mean FROM p)
SELECT i, n < 50 OR (n > 100 AND (CASE WHEN is_ar THEN script = 'latin' ELSE script = 'arabic' END OR (is_ar AND script IN ('arabic', 'mixed') AND mean < 3.0))) AS low FROM s""")
def low_quality_pages(spark, sf_dir):
    return PAGES.df(spark, sf_dir).select("i", quality.low_quality(F.col("t"), F.col("subject")).alias("low"))


# ---- files of any size, versions, files with broken rows

_MARKED = Derived("SELECT l_returnflag AS stem, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CASE WHEN l_suppkey % 20 = 0 THEN l_partkey END AS mark FROM lineitem")
_PLACE = ("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_partkey")


@query(f"""SELECT stem, l_orderkey, l_linenumber, l_partkey, last_value(mark IGNORE NULLS) OVER (PARTITION BY stem ORDER BY {", ".join(_PLACE)}, mark NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS page_num FROM {_MARKED.sql} x""")
def carried_markers(spark, sf_dir):
    """Three texts of a third of all line items each, whose lines many tasks scan."""
    return sequences.carried(_MARKED.df(spark, sf_dir), "stem", list(_PLACE), "mark", "page_num", partitions=16).select("stem", "l_orderkey", "l_linenumber", "l_partkey", "page_num")


_OTHER = "CASE WHEN {0} % 2 = 1 THEN {0} - 1 WHEN {0} + 1 < (SELECT count(*) FROM customer) THEN {0} + 1 ELSE {0} END"


@query(f"""SELECT o_orderkey, {_OTHER.format("o_custkey")} AS o_custkey, c_name, CAST(count(*) OVER (PARTITION BY o_custkey) AS BIGINT) AS logged FROM orders JOIN customer ON o_custkey = c_custkey""")
def exchanged_customers(spark, sf_dir):
    """Customers' keys exchanged in pairs, in both tables that hold them, as one version; orders with their customers of that version and its log."""
    customer, orders = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders")
    versions = Versions(spark, work_dir(spark, "versions"))
    first = versions.commit({"customer": customer.select("c_custkey", "c_name"), "orders": orders.select("o_orderkey", "o_custkey")}, note="as given")
    was = versions.snapshot(first)
    old = was["customer"].select(F.col("c_custkey").alias("old"))
    mapping = old.withColumn("new", F.when(F.col("old") % 2 == 1, F.col("old") - 1).otherwise(F.col("old") + 1)).join(old.withColumnRenamed("old", "new"), "new", "left_semi").select("old", "new")
    new, log = overlay.permuted_everywhere({"customer": (was["customer"], ["c_custkey"]), "orders": (was["orders"], ["o_custkey"])}, mapping)
    second = versions.commit(new | {"log": log}, since=first, note="exchanged")
    now = versions.snapshot(second)
    logged = now["log"].filter("`table` = 'orders'").select(F.col("new").alias("o_custkey"), F.col("n").alias("logged"))
    unmoved = now["orders"].groupBy("o_custkey").agg(F.count(F.lit(1)).alias("here"))
    joined = now["orders"].join(now["customer"], F.col("o_custkey") == F.col("c_custkey")).join(logged, "o_custkey", "left").join(unmoved, "o_custkey")
    return joined.select("o_orderkey", "o_custkey", "c_name", F.coalesce("logged", "here").alias("logged"))


@query("SELECT conv_id, turn, role, length(text) AS n FROM conversations WHERE (conv_id + turn) % 7 <> 0")
def broken_lines(spark, sf_dir):
    """Conversations written as JSON lines, every seventh cut off in its middle, and read back."""
    rows = read(spark, sf_dir, "conversations")
    line = F.to_json(F.struct("conv_id", "turn", "role", "text"))
    path = work_dir(spark, "lines")
    rows.select(F.when((F.col("conv_id") + F.col("turn")) % 7 == 0, F.substring(line, 1, 20)).otherwise(line).alias("value")).write.text(path)
    return files.json_rows(spark, path, "conv_id long, turn long, role string, text string").select("conv_id", "turn", "role", F.length("text").alias("n"))


# ---- embeddings


@query("""WITH q AS (SELECT vec_id AS q, embedding FROM embeddings WHERE vec_id % 50 = 0),
s AS (SELECT q, e.vec_id, round(list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 6) AS cos FROM q JOIN embeddings e ON q <> e.vec_id)
SELECT q, vec_id, cos FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY cos DESC, vec_id) AS r FROM s) WHERE r <= 3""")
def nearest_vectors(spark, sf_dir):
    """Every 50th vector against all, in blocks."""
    e = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return vectors.nearest(e.filter("id % 50 = 0"), e, 3).select(F.col("q").alias("q"), F.col("id").alias("vec_id"), "cos")
