"""Page and file checks, filters, coverage, overrides, samples and decisions over tables derived from the given ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed
from ..functions import names, quality, repair, replies
from ..operators import align, audit, catalog, formulas, labels, linking, overlay, reports, units
from . import derived, given
from .catalogue import query, read
from .derived import BLOCKS, FILES, NL, OVERRIDES, PAGED, PAGES, QUESTIONS, VERIFIED, WORKED, Derived, part, pick, text
from .records import _AR, _MANIFEST_SQL, _YEARS_SQL

QUERIES, ORACLES = given.QUERIES, given.ORACLES
_SUBJECTS = fixed.SUBJECTS

# ---- pages and files

_NAMED = tuple(" ".join(f"التمرين {o}" for o in ("الأول", "الثاني", "الثالث", "الرابع", "الخامس")[:n]) for n in range(6))
_COUNTED = Derived(
    f"SELECT 'm' || {text('o_orderkey')} AS stem, {pick('o_orderkey', _NAMED)} || ' x ' || {pick('o_orderkey', _NAMED)} AS content FROM orders UNION ALL SELECT 'm' || {text('o_orderkey')} || '_solution', {pick('o_custkey', _NAMED)} FROM orders"
)


@query("SELECT 'm' || o_orderkey AS exam, 'm' || o_orderkey || '_solution' AS solution, CAST(o_orderkey % 6 AS INTEGER) AS n_exam, CAST(o_custkey % 6 AS INTEGER) AS n_solution FROM orders WHERE o_orderkey % 6 > 0 AND o_custkey % 6 > 0 AND abs(o_orderkey % 6 - o_custkey % 6) >= 2")
def exercise_counts(spark, sf_dir):
    return linking.exercise_counts(_COUNTED.df(spark, sf_dir))


_ENDED = Derived(f"SELECT doc_id, text || {pick('doc_id', ('', ' cut off here', '.', ' a)'))} || {pick(part('doc_id', 4), ('', NL + 'Page 2 / 4', 'END OF'))} AS t FROM documents WHERE text IS NOT NULL".replace(f"'{NL}Page", f"{NL} || 'Page"))


@query(rf"""WITH p AS (SELECT doc_id, t, regexp_replace(t, '^\s+|\s+$', '', 'g') AS page FROM {_ENDED.sql} x), l AS (SELECT *, regexp_replace(regexp_extract(page, '[^\n]*$'), '^\s+|\s+$', '', 'g') AS line FROM p)
SELECT doc_id, NOT regexp_matches(substr(t, greatest(1, length(t) - 299), 300), '{fixed.PAGE_END}') AND line <> '' AND NOT regexp_matches(line, '[.!?؟:،)\]\}}]$|\$$') AND length(line) < 120 AS cut FROM l""")
def truncated_files(spark, sf_dir):
    return _ENDED.df(spark, sf_dir).select("doc_id", quality.truncated(F.col("t")).alias("cut"))


@query(rf"""WITH p AS (SELECT stem, content, CAST(stem AS BIGINT) % 5 = 0 AS bom, list_transform(regexp_extract_all(content, '(?m)^\s*\[PAGE\s+(\d+)\]\s*$', 1), lambda x: CAST(x AS INTEGER)) AS n, len(regexp_extract_all(content, '\[PAGE\s+\d+\]')) AS every FROM {PAGED.sql} x)
SELECT stem, 'bom' AS tag FROM p WHERE bom UNION ALL SELECT stem, 'page_markers' FROM p WHERE list_transform(range(1, len(n) + 1), lambda x: CAST(x AS INTEGER)) <> n UNION ALL SELECT stem, 'stray_marker_in_body' FROM p WHERE every > len(n)""")
def page_mark_checks(spark, sf_dir):
    rows = PAGED.df(spark, sf_dir).withColumn("raw", F.unhex(F.when(F.col("stem").cast("long") % 5 == 0, "EFBBBF41").otherwise("41")))
    return rows.select("stem", F.explode(quality.file_marks(F.col("raw"), F.col("content"))).alias("x")).select("stem", "x.tag")


@query(rf"""WITH l AS (SELECT i, t, list_filter(list_transform(string_split(t, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS l FROM {PAGES.sql} x),
b AS (SELECT i, t, len(l) AS n, len(list_filter(l, lambda x: length(regexp_replace(x, '[^{_AR}]', '', 'g')) > 0.6 * length(replace(x, ' ', '')) AND length(regexp_replace(x, '\s+', '', 'g')) <= 4 * len(list_filter(regexp_split_to_array(x, '\s+'), lambda w: w <> '')))) AS bad FROM l)
SELECT i, CASE WHEN bad > 0.6 * n THEN '{fixed.GARBLED_PAGE}' ELSE t END AS text FROM b""")
def side_bars(spark, sf_dir):
    return PAGES.df(spark, sf_dir).select("i", quality.without_side_bars(F.col("t")).alias("text"))


_B = derived.BACKSLASH
_LATEX = Derived(
    f"""SELECT l_orderkey, l_linenumber, {pick("l_partkey", _SUBJECTS)} AS subject, {pick("l_suppkey", ("$a$ ", "$$b$$ ", "$c ", ""))} || CASE l_partkey % 5 WHEN 0 THEN {_B} || 'frac12 ' WHEN 1 THEN {_B} || 'frac{{a}}{{b}} ' WHEN 2 THEN 'x^ ' || {NL} WHEN 3 THEN {_B} || 'alpha x_1 ' ELSE 'plain ' END
 || repeat('{{', l_linenumber) || {pick("l_suppkey", ("", "}}}}", "y_"))} AS t FROM lineitem"""
)


@query(rf"""WITH l AS (SELECT *, length(replace(t, '$$', '')) - length(replace(replace(t, '$$', ''), '$', '')) AS d, length(replace(t, '}}', '')) - length(replace(t, '{{', '')) AS g, subject IN {fixed.SCIENCE} AND contains(t, '\') AS s FROM {_LATEX.sql} x)
SELECT l_orderkey, l_linenumber, 'odd_dollars' AS issue FROM l WHERE d % 2 = 1 UNION ALL SELECT l_orderkey, l_linenumber, 'braces' FROM l WHERE s AND abs(g) > 2 UNION ALL SELECT l_orderkey, l_linenumber, 'bare_fraction' FROM l WHERE s AND (length(t) - length(replace(t, '\frac', ''))) / 5 > (length(t) - length(replace(t, '\frac{{', ''))) / 6
UNION ALL SELECT l_orderkey, l_linenumber, 'dangling' FROM l WHERE s AND regexp_matches(t, '[\^_]\s*(\$|\n|$)')""")
def latex_issues(spark, sf_dir):
    return _LATEX.df(spark, sf_dir).select("l_orderkey", "l_linenumber", F.explode(formulas.latex_issues(F.col("t"), F.col("subject"))).alias("issue"))


@query("SELECT doc_id, doc_id % 7 = 3 AS forms FROM documents WHERE text IS NOT NULL")
def presentation_forms(spark, sf_dir):
    """Every seventh document has a letter in a presentation form put into its text."""
    shaped = F.when(F.col("doc_id") % 7 == 3, F.concat(F.lit("ﷲ "), "text")).otherwise(F.col("text"))
    return read(spark, sf_dir, "documents").filter("text IS NOT NULL").select("doc_id", quality.presentation_forms(shaped).alias("forms"))


# ---- images

_IMAGES = Derived(f"SELECT p_partkey, {pick('p_partkey', ('bac_svt_', 'bac_math_', 'x_'))} || {text(part('p_partkey', 3))} || CASE WHEN p_partkey % 5 = 0 THEN '.png' ELSE '_page1_img' || {text('p_size')} || '.png' END AS filename, p_size % 4 * 10 AS size_bytes, {pick('p_size', ('89504E47', '47494638', '89504E47'))} AS hex FROM part")
_IMAGE_STEMS = Derived(f"SELECT 'bac_svt_' || {text('p_partkey')} AS stem FROM part WHERE p_partkey % 2 = 0")


@query(rf"""WITH i AS (SELECT *, regexp_extract(filename, '{fixed.IMAGE_NAME}', 1) AS stem FROM {_IMAGES.sql} x)
SELECT filename, 'zero_size' AS problem FROM i WHERE size_bytes = 0 UNION ALL SELECT filename, 'bad_header' FROM i WHERE size_bytes > 0 AND hex <> '89504E47' UNION ALL SELECT filename, 'orphan' FROM i WHERE stem NOT IN (SELECT stem FROM {_IMAGE_STEMS.sql} y)""")
def image_checks(spark, sf_dir):
    return audit.image_problems(_IMAGES.df(spark, sf_dir).withColumn("magic", F.unhex("hex")), _IMAGE_STEMS.df(spark, sf_dir))


_LISTED = Derived(f"SELECT {pick('p_size', (*_SUBJECTS, None))} AS subject, CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE 'd/' || {text('p_partkey')} || '.png' END AS image_path FROM part")


@query(f"""WITH r AS (SELECT subject, image_path, CAST(regexp_extract(image_path, '[0-9]+') AS BIGINT) % 4 <> 0 AS has FROM {_LISTED.sql} x), b AS (SELECT subject, count(*) AS n, count_if(coalesce(has, false)) AS on_disk, count_if(coalesce(NOT has, false)) AS missing FROM r GROUP BY subject)
SELECT * FROM b UNION ALL SELECT NULL, CAST(sum(n) AS BIGINT), CAST(sum(on_disk) AS BIGINT), CAST(sum(missing) AS BIGINT) FROM b""")
def image_coverage(spark, sf_dir):
    listed = _LISTED.df(spark, sf_dir)
    found = listed.filter("image_path IS NOT NULL AND CAST(regexp_extract(image_path, '[0-9]+', 0) AS BIGINT) % 4 <> 0").select("image_path")
    return audit.image_coverage(listed, found).drop("sample")


_BOXED = Derived("SELECT event_id, CAST(event_id % 500 AS DOUBLE) AS x0, CAST(user_id % 700 AS DOUBLE) AS y0, CAST(event_id % 500 + event_id % 41 * 15 AS DOUBLE) AS x1, CAST(user_id % 700 + event_id % 37 * 20 AS DOUBLE) AS y1 FROM events")


@query(f"""WITH b AS (SELECT *, greatest(0, CAST(trunc(x0 * 2) AS INTEGER)) AS l, greatest(0, CAST(trunc((800 - y1) * 2) AS INTEGER)) AS t, least(1200, CAST(trunc(x1 * 2) AS INTEGER)) AS r, least(1600, CAST(trunc((800 - y0) * 2) AS INTEGER)) AS m FROM {_BOXED.sql} x)
SELECT event_id, l AS left_, t AS top, r AS right_, m AS bottom, (x1 - x0) * (y1 - y0) / 480000 >= 0.8 AS page_scan FROM b WHERE x1 > x0 AND y1 > y0 AND r > l AND m > t""")
def image_crops(spark, sf_dir):
    c = names.crop(F.struct("x0", "y0", "x1", "y1"), F.lit(600.0), F.lit(800.0), F.lit(2.0))
    return _BOXED.df(spark, sf_dir).select("event_id", c.alias("c")).filter("c IS NOT NULL").select("event_id", F.col("c.left").alias("left_"), "c.top", F.col("c.right").alias("right_"), "c.bottom", "c.page_scan")


@query("SELECT p_partkey, p_partkey % 7 IN (4, 5, 6) AND p_size * 10 * (100 + p_partkey % 900) >= 10000 AND NOT (p_size * 10 * (100 + p_partkey % 900) > 2000000 AND p_size * 10.0 / (100 + p_partkey % 900) > 0.55 AND p_size * 10.0 / (100 + p_partkey % 900) < 0.85) AS wanted FROM part")
def caption_targets(spark, sf_dir):
    """Parts as images of subjects; those of science with pixels enough that are no scans of pages."""
    subject = F.element_at(F.array(*map(F.lit, _SUBJECTS)), (F.col("p_partkey") % 7 + 1).cast("int"))
    return read(spark, sf_dir, "part").select("p_partkey", names.wants_caption(subject, F.col("p_size") * 10, 100 + F.col("p_partkey") % 900).alias("wanted"))


# ---- files, years, states


@query(f"SELECT filename FROM ({_MANIFEST_SQL}) m WHERE NOT duplicate AND family IN ('A', 'B') AND subject IN {fixed.SCIENCE}")
def files_in_scope(spark, sf_dir):
    m = catalog.manifest(FILES.df(spark, sf_dir))
    return m.filter(names.in_scope(F.col("family"), F.col("duplicate"), F.col("subject"), fixed.SCIENCE)).select("filename")


@query(f"SELECT era, count(*) AS n, CAST(sum(CASE WHEN s IN (2016, 2017) THEN 1 ELSE 0 END) AS BIGINT) AS n_two_sessions FROM (SELECT 2008 + o_orderkey % 19 AS s FROM orders) o JOIN {_YEARS_SQL} y ON y.year = o.s WHERE NOT sealed GROUP BY era")
def orders_of_training_years(spark, sf_dir):
    years = catalog.training_years(catalog.year_regimes(spark))
    two = catalog.two_sessions(years).select("year", F.lit(1).alias("two"))
    rows = read(spark, sf_dir, "orders").select((2008 + F.col("o_orderkey") % 19).cast("int").alias("year")).join(F.broadcast(years.select("year", "era")), "year").join(F.broadcast(two), "year", "left")
    return rows.groupBy("era").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("two"), F.lit(0)).cast("long").alias("n_two_sessions"))


@query(f"""WITH f AS {VERIFIED.sql}, p AS {WORKED.sql}, g AS (SELECT f.stem, has_text, has_pdf, count_if(coalesce(status = 'corrected', false)) AS c, count_if(coalesce(status = 'reprocess_failed', false)) AS x, count_if(coalesce(needs, false)) AS n FROM f LEFT JOIN p ON p.stem = f.stem GROUP BY ALL)
SELECT stem FROM g WHERE has_text AND has_pdf AND (x > 0 OR (n > 0 AND c = 0))""")
def uncorrected_files(spark, sf_dir):
    pages = WORKED.df(spark, sf_dir)
    return audit.really_uncorrected(audit.file_states(VERIFIED.df(spark, sf_dir), pages), pages)


@query("SELECT CAST(p_partkey AS VARCHAR) AS path, CASE WHEN p_size % 3 = 0 THEN '0-byte file' ELSE 'not a PDF (magic bytes mismatch)' END AS reason FROM part WHERE p_partkey % 4 <> 0 AND (p_size % 3 = 0 OR p_size % 5 = 0)")
def invalid_files(spark, sf_dir):
    rows = read(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("path"), F.when(F.col("p_size") % 3 == 0, 0).otherwise(9).cast("long").alias("size_bytes"), F.when(F.col("p_partkey") % 4 != 0, (F.col("p_size") % 3 != 0) & (F.col("p_size") % 5 != 0)).alias("valid_pdf"))
    return audit.invalid_pdfs(rows).select("path", "reason")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS path FROM orders WHERE o_custkey % 3 <> 2 AND o_orderkey % 4 <> 0")
def retried_files(spark, sf_dir):
    """Orders as files; the last result of some had no quality and wasn't skipped."""
    o = read(spark, sf_dir, "orders")
    path = F.col("o_orderkey").cast("string").alias("path")
    results = o.select(path, F.when(F.col("o_custkey") % 3 == 0, 0.0).when(F.col("o_custkey") % 3 == 1, F.lit(None)).otherwise(0.5).alias("quality_score"), F.when(F.col("o_orderkey") % 4 == 0, True).when(F.col("o_orderkey") % 4 == 1, False).alias("skipped"))
    return overlay.retry(o.select(path), results, "path")


@query("SELECT user_id, CAST(floor(sum(octet_length(encode(props))) / greatest(count(*), 1)) AS BIGINT) AS mean, floor(sum(octet_length(encode(props))) / greatest(count(*), 1)) <= 9 AS within FROM events GROUP BY user_id")
def guarded_users(spark, sf_dir):
    per = read(spark, sf_dir, "events").groupBy("user_id").agg(F.sum(F.octet_length("props")).alias("c"), F.count(F.lit(1)).alias("n"))
    mean = audit.within_guard(F.col("c"), F.col("n"))
    return per.select("user_id", mean.alias("mean"), (mean <= 9).alias("within"))


# ---- replies, overrides, samples

_REPLIED = Derived(
    f"""SELECT event_id, user_id % 100 AS k, CASE event_id % 4 WHEN 0 THEN '```json' || {NL} || '{{"n": ' || {text("user_id % 100")} || '}}' || {NL} || '```' WHEN 1 THEN 'well: {{"n": ' || {text("user_id % 100")} || '}} ok' WHEN 2 THEN 'none ' || event_type
 ELSE '{{"n": ' || {text("user_id % 100")} || ', "t": "' || {_B} || 'frac{{a}} ' || {_B} || 'alpha"}}' END AS t FROM events"""
)


@query(f"SELECT event_id, CASE WHEN event_id % 4 <> 2 THEN CAST(k AS INTEGER) END AS n FROM {_REPLIED.sql} x")
def reply_objects(spark, sf_dir):
    return _REPLIED.df(spark, sf_dir).select("event_id", replies.json_of(F.col("t"), "n int, t string").getField("n").alias("n"))


@query(f"""WITH o AS (SELECT * FROM {OVERRIDES.sql} x), old AS (SELECT * FROM o WHERE length(qid) % 2 = 0), new AS (SELECT qid, CASE WHEN note = 'gone' THEN NULL ELSE bs END AS bs, note || '!' AS note, from_unit FROM o), q AS {QUESTIONS.sql}
SELECT new.qid, CASE WHEN new.bs IS NULL THEN 'solution_missing' ELSE 'human' END AS match, old.note AS previous_note, q.match AS had, new.note AS reason FROM new LEFT JOIN q USING (qid) LEFT JOIN old USING (qid)""")
def override_log(spark, sf_dir):
    rows = OVERRIDES.df(spark, sf_dir).select("qid", F.split("bs", ",").cast("array<int>").alias("blocks"), "note", F.lit("me").alias("by"), "from_unit")
    new = rows.withColumn("blocks", F.when(F.col("note") != "gone", F.col("blocks"))).withColumn("note", F.concat("note", F.lit("!")))
    log = overlay.override_set(rows.filter(F.length("qid") % 2 == 0), QUESTIONS.df(spark, sf_dir), new)[1]
    return log.select("qid", "match", "previous_note", F.col("old_mapping.match").alias("had"), "reason")


@query(f"""WITH o AS (SELECT qid, split_part(qid, '__q', 1) AS u, split_part(qid, '__q', 2) AS asked FROM {OVERRIDES.sql} x WHERE bs IS NULL) SELECT qid, unit_id, block FROM o JOIN {BLOCKS.sql} b ON b.unit_id = o.u AND b.label = o.asked""")
def missing_solutions(spark, sf_dir):
    overrides = OVERRIDES.df(spark, sf_dir).select("qid", F.split("bs", ",").cast("array<int>").alias("blocks"))
    return linking.answers_after_all(overrides, BLOCKS.df(spark, sf_dir))


@query(f"""WITH q AS {QUESTIONS.sql}, o AS {OVERRIDES.sql} SELECT q.qid, q.unit_id, a.match AS old_match, q.match, CASE WHEN a.qid IS NOT NULL THEN a.answer IS DISTINCT FROM q.answer END AS changed, o.note AS reason FROM q JOIN o USING (qid) LEFT JOIN (SELECT qid, match, CASE WHEN ix % 2 = 0 THEN answer ELSE 'Z' END AS answer FROM q WHERE ix % 3 <> 0) a USING (qid)""")
def override_decisions(spark, sf_dir):
    q = QUESTIONS.df(spark, sf_dir)
    automatic = q.filter("ix % 3 <> 0").withColumn("answer", F.when(F.col("ix") % 2 == 0, F.col("answer")).otherwise("Z"))
    overrides = OVERRIDES.df(spark, sf_dir).select("qid", F.split("bs", ",").cast("array<int>").alias("blocks"), "note", F.lit("me").alias("by"))
    return reports.decisions(q, automatic, overrides).select("qid", "unit_id", "old_match", "match", "changed", "reason")


@query(f"""WITH q AS (SELECT *, CAST(substr(unit_id, 2) AS BIGINT) % 40 AS subject FROM {QUESTIONS.sql} x), p AS (SELECT subject, match, count(*) AS n FROM q WHERE match NOT IN ('parent_stub', 'legend') AND ix % 5 <> 0 GROUP BY ALL) SELECT subject, CAST(greatest(sum(least(n, 2)), least(sum(n), 12)) AS BIGINT) AS n FROM p GROUP BY subject""")
def audit_samples(spark, sf_dir):
    """Two of each class, more up to twelve of a subject; none seen before, no stubs and legends. Which they are is a hash's choice, how many isn't."""
    q = QUESTIONS.df(spark, sf_dir).withColumn("subject", F.substring("unit_id", 2, 20).cast("long") % 40)
    return reports.audit_sample(q, q.filter("ix % 5 = 0").select("qid"), 2, 12).groupBy("subject").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT md5(text) AS key, CAST(256 AS INTEGER) AS size FROM (SELECT DISTINCT text FROM conversations WHERE text NOT IN (SELECT text FROM conversations WHERE turn = 0))")
def text_embeddings(spark, sf_dir):
    """Keys of the distinct texts that a cache of all first turns doesn't have."""
    rows = read(spark, sf_dir, "conversations")
    cache = rows.filter("turn = 0").select(F.md5(F.col("text").cast("binary")).alias("key")).distinct()
    return align.embedded(rows.select("text"), cache).select("key", F.size("vector").alias("size"))


@query("SELECT event_id, CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 ELSE 5 END AS tier FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS r FROM events) WHERE event_type <> 'click' OR r <= 25")
def event_tiers(spark, sf_dir):
    return reports.tiers(read(spark, sf_dir, "events").select("event_id", "event_type"), "event_type", {"error": 0, "purchase": 1}, "click", 25, "event_id").select("event_id", "tier")


@query("SELECT o_orderkey FROM (SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_custkey END AS k FROM orders) ORDER BY k NULLS LAST, o_orderkey LIMIT 200")
def head_of_orders(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey")).alias("k"))
    return reports.head(rows, [F.col("k").asc_nulls_last(), F.col("o_orderkey")], 200).select("o_orderkey")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'a' || doc_id WHEN doc_id % 3 = 1 THEN 'b' || doc_id END AS t FROM (SELECT DISTINCT doc_id FROM documents)")
def fallback_texts(spark, sf_dir):
    ids = read(spark, sf_dir, "documents").select("doc_id").distinct()
    first = ids.filter("doc_id % 3 = 0").select("doc_id", F.concat(F.lit("a"), "doc_id").alias("t"))
    second = ids.filter("doc_id % 3 <> 2").select("doc_id", F.concat(F.lit("b"), "doc_id").alias("t"))
    return overlay.with_fallback(ids, first, second, "doc_id", "t")


@query("SELECT event_id, coalesce(nullif(CASE event_id % 3 WHEN 0 THEN 'new' WHEN 1 THEN '' END, ''), event_type) AS kind, props AS description FROM events")
def merged_captions(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select("event_id", F.struct(F.col("event_type").alias("kind"), F.col("props").alias("description")).alias("a"), F.struct(F.when(F.col("event_id") % 3 == 0, "new").when(F.col("event_id") % 3 == 1, "").alias("kind"), F.lit("").alias("description")).alias("b"))
    return rows.select("event_id", repair.merged_fields(F.col("a"), F.col("b"), ["kind", "description"]).alias("m")).select("event_id", "m.kind", "m.description")


# ---- lines, blocks, units

_CELLS = Derived(
    f"""SELECT l_orderkey, l_linenumber, l_suppkey % 5 AS form, 1 + l_partkey % 20 AS n, l_suppkey AS s, CASE l_suppkey % 5 WHEN 0 THEN {text("1 + l_partkey % 20")} || '.' || {NL} || 'text ' || {text("l_suppkey")} WHEN 1 THEN {text("1 + l_partkey % 20")} || {NL} || '0,5'
 WHEN 2 THEN '| ' || {text("1 + l_partkey % 20")} || ' | كلمة ' || {text("l_suppkey")} || ' | 0,5 |' || {NL} || '|---|---|' WHEN 3 THEN 'x<br>' || {text("l_suppkey")} || '<br/>z' ELSE {text("1 + l_partkey % 20")} || ')' || {NL} || '2) more' END AS t FROM lineitem"""
)


@query(f"""WITH c AS (SELECT *, CASE form WHEN 0 THEN CASE WHEN n <= 15 THEN [n || '. text ' || s] ELSE [n || '.', 'text ' || s] END WHEN 1 THEN [CAST(n AS VARCHAR), '0,5'] WHEN 2 THEN CASE WHEN n <= 15 THEN [n || ' كلمة ' || s, '0,5'] ELSE [CAST(n AS VARCHAR), 'كلمة ' || s, '0,5'] END
WHEN 3 THEN CASE WHEN s BETWEEN 1 AND 15 THEN ['x', s || ' z'] ELSE ['x', CAST(s AS VARCHAR), 'z'] END ELSE [n || ')', '2) more'] END AS l FROM {_CELLS.sql} x) SELECT l_orderkey, l_linenumber, unnest(l) AS line FROM c""")
def seen_lines(spark, sf_dir):
    return _CELLS.df(spark, sf_dir).select("l_orderkey", "l_linenumber", F.explode(labels.seen_lines(F.col("t"))).alias("line"))


def _unit_texts(spark, sf_dir):
    lines = given._ITEM_LINES.df(spark, sf_dir)
    return lines.groupBy("unit").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*given._LINE_ORDER, "line"))), lambda x: x["line"]), "\n").alias("t"))


@query(f"""WITH l AS (SELECT *, row_number() OVER w AS i, count_if(form <> 2) OVER w AS k FROM {given._ITEM_LINES.sql} x WINDOW w AS (PARTITION BY unit ORDER BY {", ".join(given._LINE_ORDER)} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT unit, min(CASE form WHEN 0 THEN CAST(n AS VARCHAR) WHEN 1 THEN n || '.' || l_linenumber WHEN 3 THEN CAST(n AS VARCHAR) END) AS label, string_agg(line, chr(10) ORDER BY i) AS clean FROM l GROUP BY unit, k""")
def answer_blocks(spark, sf_dir):
    """Each part's lines as an answer key."""
    return _unit_texts(spark, sf_dir).select("unit", F.explode(labels.blocks(F.col("t"))).alias("b")).select("unit", "b.label", "b.clean")


_SAID = Derived(
    f"""SELECT l_partkey AS unit, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_suppkey % 6 AS form, CASE l_suppkey % 6 WHEN 0 THEN '**says** ' || {text("l_orderkey")} WHEN 1 THEN {text("l_linenumber")} || ',5 x ' || {text("l_linenumber")} WHEN 2 THEN 'صفحة ' || {text("l_linenumber")} || ' من 9'
 WHEN 3 THEN 'التمرين الأول (' || {text("l_linenumber")} || ' نقاط)' WHEN 4 THEN 'التمرين الأول: an answer on the line ' || {text("l_orderkey")} ELSE '' END AS line FROM lineitem"""
)


@query(f"""SELECT unit, coalesce(string_agg(CASE form WHEN 0 THEN 'says ' || l_orderkey WHEN 4 THEN line END, chr(10) ORDER BY {", ".join(given._LINE_ORDER)}), '') AS clean FROM {_SAID.sql} x GROUP BY unit""")
def scoring_texts(spark, sf_dir):
    """What is left of each part's lines without scores, footers, blank lines and bare headings."""
    texts = _SAID.df(spark, sf_dir).groupBy("unit").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*given._LINE_ORDER, "line"))), lambda x: x["line"]), "\n").alias("t"))
    return texts.select("unit", labels.cleaned(F.col("t")).alias("clean"))


def _units(spark, sf_dir):
    lines = given._EXAM_LINES.df(spark, sf_dir)
    texts = lines.groupBy("conv_id").agg(F.concat(F.lit("[PAGE 1]\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "line"))), lambda x: x["line"]), "\n")).alias("content"))
    return units.segmented(texts.select(F.expr(given._STEM).alias("stem"), "content"))


_FILES_SQL = f"WITH u AS ({ORACLES['exercise_units']}), f AS (SELECT split_part(id, '__', 1) AS stem, count(*) AS n, count_if(points IS NULL AND NOT contains(id, '_solution')) AS unpriced, bool_or(whole_document) AS whole, sum(coalesce(points, 0)) AS points FROM u GROUP BY 1)"


@query(_FILES_SQL + " SELECT 'math' AS subject, CASE WHEN contains(stem, '_solution') THEN 'solution' ELSE 'exam' END AS doc_type, CAST(n AS VARCHAR) AS shape, count(*) AS files, CAST(sum(n) AS BIGINT) AS units, CAST(sum(unpriced) AS BIGINT) AS points_missing, count_if(whole) AS whole_documents FROM f GROUP BY ALL")
def segmentation_report(spark, sf_dir):
    return units.report(_units(spark, sf_dir))


@query(_FILES_SQL + """, b AS (SELECT replace(stem, '_solution', '') AS stem, sum(CASE WHEN NOT contains(stem, '_solution') THEN points END) AS points, CAST(sum(CASE WHEN contains(stem, '_solution') THEN 0 ELSE n END) AS BIGINT) AS n_exam, CAST(sum(CASE WHEN contains(stem, '_solution') THEN n ELSE 0 END) AS BIGINT) AS n_solution FROM f GROUP BY 1)
SELECT stem, coalesce(points <> 20, false) AS points_off, n_exam, n_solution FROM b WHERE coalesce(points <> 20, false) OR (n_solution > 0 AND n_exam <> n_solution)""")
def segmentation_sanity(spark, sf_dir):
    return units.sanity(_units(spark, sf_dir))


_DIGITS = Derived(
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {pick("l_partkey", ("التمرين ", "كلام ", "x ", "الجزء "))} || CASE WHEN l_suppkey % 3 = 0 THEN '0' ELSE '' END || {text("CAST(l_quantity AS INTEGER)")} || {pick("l_suppkey", (" في ", " " + "و" * 90 + " ", " "))} || {text("l_linenumber * 12")} || ' 2018 ' || {text("l_suppkey")} || ' 007' AS t FROM lineitem"""
)


@query(f"""WITH w AS (SELECT *, string_split(t, ' ') AS w FROM {_DIGITS.sql} x), p AS (SELECT l_orderkey, l_linenumber, l_partkey, t, w[k] AS number, CAST(coalesce(list_sum(list_transform(w[1:k - 1], lambda x: length(x) + 1)), 0) AS INTEGER) AS place FROM (SELECT *, unnest(range(1, len(w) + 1)) AS k FROM w)),
r AS (SELECT *, CASE WHEN starts_with(number, '0') THEN 'leading zero' WHEN length(number) = 2 AND regexp_matches(substr(t, greatest(place - 80, 0) + 1, place + length(number) + 80 - greatest(place - 80, 0)), '{fixed.SECTION_CONTEXT}') THEN 'near a section' END AS reason FROM p WHERE regexp_full_match(number, '[0-9]{{2,3}}'))
SELECT l_orderkey, l_linenumber, l_partkey, number, reason, place FROM r WHERE reason IS NOT NULL""")
def digit_runs(spark, sf_dir):
    runs = _DIGITS.df(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", F.explode(quality.digit_runs(F.col("t"))).alias("r"))
    return runs.select("l_orderkey", "l_linenumber", "l_partkey", "r.number", "r.reason", F.col("r.offset").alias("place"))
