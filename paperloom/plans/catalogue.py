"""All queries of the engine's own operators, and their SQL. Documents stand for files, hosts for partitions, languages for subjects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import quality
from ..functions import text as T
from ..operators import align, figures, formulas, overlay, segments, sequences
from ..streaming import incremental

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SCRIPT = "CASE WHEN la = 0 THEN 'unknown' ELSE 'latin' END"


@query(f"""
WITH p AS (SELECT lang, source, length(text) AS n, len(list_filter(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')) AS t, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS la FROM documents)
SELECT lang, source, {_SCRIPT} AS script, count(*) AS n_pages, count_if(n < 50 OR la = 0) AS n_low, CAST(sum(n) AS BIGINT) AS n_chars, round(0.6 * avg(CASE WHEN n < 50 THEN 0.0 ELSE 1.0 END) + 0.4 * least(1.0, sum(n) / (count(*) * 500.0)), 4) AS quality_score
FROM p GROUP BY ALL""")
def page_quality_rollup(spark, sf_dir):
    text = F.col("text")
    pages = read(spark, sf_dir, "documents").select("lang", "source", F.length("text").alias("n"), T.script(text).alias("script"))
    low = (F.col("n") < 50) | (F.col("script") == "unknown")
    score = F.round(0.6 * F.avg(F.when(F.col("n") < 50, 0.0).otherwise(1.0)) + 0.4 * F.least(F.lit(1.0), F.sum("n") / (F.count("*") * 500.0)), 4)
    return pages.groupBy("lang", "source", "script").agg(F.count("*").alias("n_pages"), F.count_if(low).alias("n_low"), F.sum("n").alias("n_chars"), score.alias("quality_score"))


@query(f"SELECT lang, {_SCRIPT} AS script, count(*) AS n FROM (SELECT lang, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS la FROM documents) GROUP BY ALL")
def lang_script_counts(spark, sf_dir):
    return read(spark, sf_dir, "documents").groupBy("lang", T.script(F.col("text")).alias("script")).agg(F.count("*").alias("n"))


@query(r"SELECT doc_id, length(regexp_replace(regexp_replace(text, '[ \t]{2,}', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g')) AS n FROM documents")
def normalize_text_lengths(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.length(T.collapsed(F.col("text"))).alias("n"))


@query(r"SELECT doc_id, round(coalesce(list_sum(list_transform(t, lambda x: length(x))) / nullif(len(t), 0), 0), 6) AS avg_len FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS t FROM documents)")
def avg_token_len(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.round(T.average_token(F.col("text")), 6).alias("avg_len"))


@query("SELECT doc_id, len(string_split(text, chr(10))) AS n_lines, len(list_filter(string_split(text, chr(10)), lambda x: x = '')) AS n_blank FROM documents")
def doc_lines(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.size(T.lines(F.col("text"))).alias("n_lines"), F.size(F.filter(T.lines(F.col("text")), lambda x: x == "")).alias("n_blank"))


@query("SELECT lang, count_if(length(text) = 0) AS n_empty, count_if(length(text) < 100) AS n_very_short, count_if(length(text) < 500) AS n_short FROM documents GROUP BY lang")
def short_empty_docs(spark, sf_dir):
    n = F.length("text")
    return read(spark, sf_dir, "documents").groupBy("lang").agg(F.count_if(n == 0).alias("n_empty"), F.count_if(n < 100).alias("n_very_short"), F.count_if(n < 500).alias("n_short"))


@query("SELECT doc_id, source FROM (SELECT doc_id, source, length(text) AS n, avg(length(text)) OVER (PARTITION BY source) AS a FROM documents) WHERE n < 0.1 * a AND a > 200")
def low_relative_doc(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", F.length("text").alias("n"))
    mean = docs.groupBy("source").agg(F.avg("n").alias("a"))  # partial sums, so that a large source is no single task
    return docs.join(mean, "source").filter((F.col("n") < 0.1 * F.col("a")) & (F.col("a") > 200)).select("doc_id", "source")


@query(r"SELECT doc_id, count(*) AS n_lines, CAST(sum(length(l)) AS BIGINT) AS n_chars FROM (SELECT doc_id, l FROM (SELECT doc_id, regexp_replace(unnest(string_split(text, chr(10))), '^\s+|\s+$', '', 'g') AS l FROM documents) WHERE length(l) >= 45 AND NOT starts_with(l, '|') AND NOT regexp_matches(l, '^[-=_*|:\s]+$') GROUP BY ALL HAVING count(*) > 1) GROUP BY doc_id")
def duplicate_long_lines(spark, sf_dir):
    found = read(spark, sf_dir, "documents").select("doc_id", quality.repeated_lines(F.col("text")).alias("l")).filter(F.size("l") > 0)
    return found.select("doc_id", F.size("l").cast("long").alias("n_lines"), F.aggregate("l", F.lit(0).cast("long"), lambda n, x: n + F.length(x)).alias("n_chars"))


@query(r"SELECT doc_id, round(avg(CASE WHEN t > 0 AND c <= 4 * t THEN 1.0 ELSE 0.0 END), 6) AS ratio FROM (SELECT doc_id, len(regexp_extract_all(l, '[^ ]+')) AS t, length(replace(l, ' ', '')) AS c FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents) WHERE l <> '') GROUP BY doc_id")
def suspicious_line_ratio(spark, sf_dir):
    """In each document's own row."""
    lines = F.filter(T.lines(F.col("text")), lambda x: x != "")

    def short(x):
        t = F.regexp_count(x, F.lit("[^ ]+"))
        return (t > 0) & (F.length(F.replace(x, F.lit(" "), F.lit(""))) <= 4 * t)

    return read(spark, sf_dir, "documents").select("doc_id", lines.alias("l")).filter(F.size("l") > 0).select("doc_id", F.round(F.size(F.filter("l", short)) / F.size("l"), 6).alias("ratio"))


@query("SELECT role, count(*) AS n, count_if(regexp_matches(lower(text), 'as an ai|i cannot|i''m sorry|here is the')) AS n_marked FROM conversations GROUP BY role")
def hallucination_markers(spark, sf_dir):
    return read(spark, sf_dir, "conversations").groupBy("role").agg(F.count("*").alias("n"), F.count_if(F.lower("text").rlike("as an ai|i cannot|i'm sorry|here is the")).alias("n_marked"))


@query("SELECT doc_id, len(regexp_extract_all(text, '[0-9]+')) AS n_runs, len(list_filter(regexp_extract_all(text, '[0-9]+'), lambda x: length(x) BETWEEN 2 AND 3 AND starts_with(x, '0'))) AS n_suspect FROM documents WHERE regexp_matches(text, '[0-9]')")
def digit_run_suspects(spark, sf_dir):
    runs = F.regexp_extract_all("text", F.lit("([0-9]+)"), F.lit(1))
    suspect = F.filter(runs, lambda x: F.length(x).between(2, 3) & x.startswith("0"))
    return read(spark, sf_dir, "documents").filter(F.col("text").rlike("[0-9]")).select("doc_id", F.size(runs).alias("n_runs"), F.size(suspect).alias("n_suspect"))


@query("SELECT doc_id, len(regexp_extract_all(text, '(?:^| )[A-Za-z]{1,2}(?: [A-Za-z]{1,2}){5,}(?: |$)')) AS n_runs FROM documents")
def garble_runs(spark, sf_dir):
    """A run's words end where the next begins, so the pattern gives none back: a group that may costs the JVM's stack a frame for each word."""
    return read(spark, sf_dir, "documents").select("doc_id", F.regexp_count("text", F.lit(r"(?:^| )[A-Za-z]{1,2}(?: [A-Za-z]{1,2}(?= |\z)){5,}+(?: |\z)")).alias("n_runs"))


_ARTIFACTS = {"n_img": "<img", "n_script": "<script", "n_link": "<a ", "n_comment": "<!--", "n_list": "<li>", "n_entity": "&[a-z]+;"}


@query("SELECT " + ", ".join(f"CAST(sum(len(regexp_extract_all(html, '{p}'))) AS BIGINT) AS {n}, count_if(regexp_matches(html, '{p}')) AS pages_{n}" for n, p in _ARTIFACTS.items()) + " FROM pages")
def html_artifact_counts(spark, sf_dir):
    counts = read(spark, sf_dir, "pages").select(*(F.regexp_count("html", F.lit(p)).alias(n) for n, p in _ARTIFACTS.items()))
    return counts.agg(*(x for n in _ARTIFACTS for x in (F.sum(n).cast("long").alias(n), F.count_if(F.col(n) > 0).alias(f"pages_{n}"))))


@query("SELECT page_id, length(regexp_replace(html, '<img[^>]*>|<li><a[^>]*>[^<]*</a></li>', '[FIGURE]', 'g')) AS n FROM pages")
def figure_placeholders(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", F.length(F.regexp_replace("html", "<img[^>]*>|<li><a[^>]*>[^<]*</a></li>", "[FIGURE]")).alias("n"))


@query("SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '/([a-z]{2})/[0-9]+', 1) AS lang, TRY_CAST(regexp_extract(url, '/[a-z]{2}/([0-9]+)', 1) AS BIGINT) AS number FROM pages")
def url_parse(spark, sf_dir):
    part = lambda rx: F.regexp_extract("url", rx, 1)
    return read(spark, sf_dir, "pages").select("page_id", part("^([a-z]+)://").alias("scheme"), part("/([a-z]{2})/[0-9]+").alias("lang"), part("/[a-z]{2}/([0-9]+)").try_cast("long").alias("number"))


@query("SELECT r_name, n_name, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
def manifest_dim_enrich(spark, sf_dir):
    # dimensions: Spark broadcasts them by their statistics
    c = read(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"), F.sum("c_acctbal").alias("b"))
    joined = c.join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return joined.groupBy("r_name", "n_name").agg(F.sum("n").alias("n"), F.round(F.sum("b"), 2).alias("balance"))


@query("SELECT year(o_orderdate) AS year, " + ", ".join(f"count_if(o_orderstatus = '{s}') AS has_{s}" for s in "FOP") + ", count(*) AS n FROM orders GROUP BY 1")
def coverage_pivot(spark, sf_dir):
    return read(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(*(F.count_if(F.col("o_orderstatus") == s).alias(f"has_{s}") for s in "FOP"), F.count("*").alias("n"))


@query("SELECT user_id % 100 AS bucket, event_type AS method, count(*) AS n FROM events GROUP BY ALL")
def method_breakdown_map(spark, sf_dir):
    counted = read(spark, sf_dir, "events").groupBy((F.col("user_id") % 100).alias("bucket"), "event_type").agg(F.count("*").alias("n"))
    maps = counted.groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("methods"))
    return maps.select("bucket", F.explode("methods").alias("method", "n"))


@query("SELECT lang, count(*) AS n_docs, count(l.doc_id) AS n_labelled, CAST(sum(toxic) AS BIGINT) AS n_toxic, round(avg(length(text)), 1) AS avg_chars FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY lang")
def dataset_summary(spark, sf_dir):
    labels = read(spark, sf_dir, "labels").withColumn("has", F.lit(1))
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", F.length("text").alias("n")).join(labels, "doc_id", "left")
    return docs.groupBy("lang").agg(F.count("*").alias("n_docs"), F.count("has").alias("n_labelled"), F.sum("toxic").alias("n_toxic"), F.round(F.avg("n"), 1).alias("avg_chars"))


@query("SELECT l_returnflag, floor(l_quantity / 10) AS bucket, count(*) AS n FROM lineitem GROUP BY ALL")
def points_histogram(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").groupBy("l_returnflag", F.floor(F.col("l_quantity") / 10).alias("bucket")).agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, round(sum(l_quantity), 2) AS points FROM lineitem GROUP BY 1 HAVING abs(sum(l_quantity) - 100) > 0.01")
def points_total_check(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("p")).filter("abs(p - 100) > 0.01").select("l_orderkey", F.round("p", 2).alias("points"))


@query("SELECT l_orderkey, run, count(*) AS n FROM (SELECT l_orderkey, sum(new) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS run FROM (SELECT *, CASE WHEN l_partkey > lag(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) THEN 0 ELSE 1 END AS new FROM lineitem)) GROUP BY ALL")
def numbering_runs(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("o"), "l_partkey")
    return sequences.runs(rows, "l_orderkey", "o", "l_partkey").groupBy("l_orderkey", "run").agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, CAST(n AS INTEGER) AS after FROM (SELECT l_orderkey, n, lead(n) OVER (PARTITION BY l_orderkey ORDER BY n) AS m FROM (SELECT DISTINCT l_orderkey, l_partkey % 20 AS n FROM lineitem)) WHERE m = n + 2")
def numbering_gaps(spark, sf_dir):
    """Parts of an order as numbers."""
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_partkey") % 20).cast("int").alias("n"))
    return sequences.gaps(rows, "l_orderkey", "n")


@query("SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS occurrence FROM conversations")
def occurrence_number(spark, sf_dir):
    return sequences.occurrences(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role"), ["conv_id", "role"], ["turn"])


@query("SELECT conv_id, island, any_value(role) AS role, min(turn) AS first, max(turn) AS last, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM (SELECT *, CASE WHEN role IS NOT DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AND row_number() OVER (PARTITION BY conv_id ORDER BY turn) > 1 THEN 0 ELSE 1 END AS new FROM conversations)) GROUP BY conv_id, island")
def carry_forward_section(spark, sf_dir):
    return sequences.islands(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role"), "conv_id", "turn", "role")


@query("SELECT conv_id, turn, nturn AS answer_turn FROM (SELECT conv_id, turn, role, lead(turn) OVER w AS nturn, lead(role) OVER w AS nrole FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND nrole = 'assistant'")
def pair_turns(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn")
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.lead("turn").over(w).alias("answer_turn"), F.lead("role").over(w).alias("_next"))
    return turns.filter("role = 'user' AND _next = 'assistant'").select("conv_id", "turn", "answer_turn")


@query("""WITH s AS (SELECT min(s_suppkey) AS k, s_nationkey AS nk FROM supplier GROUP BY s_nationkey), r AS (SELECT min(s_suppkey) AS k, n_regionkey AS rk FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_regionkey)
SELECT c_custkey, coalesce(s.k, r.k) AS match, CASE WHEN s.k IS NOT NULL THEN 1 WHEN r.k IS NOT NULL THEN 2 ELSE 3 END AS tier FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN s ON c_nationkey = s.nk LEFT JOIN r ON n_regionkey = r.rk""")
def tiered_pairing(spark, sf_dir):
    """Exact key first, then the wider one."""
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    supplier = read(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    exact = supplier.groupBy(F.col("s_nationkey").alias("nk")).agg(F.min("s_suppkey").alias("a"))
    wide = supplier.groupBy(F.col("n_regionkey").alias("rk")).agg(F.min("s_suppkey").alias("b"))
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    joined = c.join(exact, F.col("c_nationkey") == F.col("nk"), "left").join(wide, F.col("n_regionkey") == F.col("rk"), "left")
    return joined.select("c_custkey", F.coalesce("a", "b").alias("match"), F.when(F.col("a").isNotNull(), 1).when(F.col("b").isNotNull(), 2).otherwise(3).alias("tier"))


_ANCHORS = "list_distinct(regexp_extract_all(lower(text), '[a-z0-9]{2,}'))"


@query(f"""WITH t AS (SELECT conv_id, turn, role, {_ANCHORS} AS w FROM conversations)
SELECT q.conv_id, q.turn AS q, a.turn AS b, round(CASE WHEN len(q.w) = 0 OR len(a.w) = 0 THEN 0 ELSE len(list_intersect(q.w, a.w)) / sqrt(len(q.w) * len(a.w)::DOUBLE) END, 6) AS lex FROM t q JOIN t a ON q.conv_id = a.conv_id AND q.role = 'user' AND a.role = 'assistant'""")
def candidate_lexical(spark, sf_dir):
    return _turn_pairs(spark, sf_dir).select("conv_id", "q", "b", F.round("lex", 6).alias("lex"))


def _turn_pairs(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", T.anchors(F.col("text")).alias("w"))
    q = turns.filter("role = 'user'").select("conv_id", F.col("turn").alias("q"), F.col("w").alias("qw"))
    a = turns.filter("role = 'assistant'").select("conv_id", F.col("turn").alias("b"), F.col("w").alias("aw"))
    return q.join(a, "conv_id").select("conv_id", "q", "b", T.lexical(F.col("qw"), F.col("aw")).alias("lex"))


@query(f"""WITH t AS (SELECT conv_id, turn, role, {_ANCHORS} AS w FROM conversations), s AS (
SELECT q.conv_id, q.turn AS q, a.turn AS b, round(CASE WHEN len(q.w) = 0 OR len(a.w) = 0 THEN 0 ELSE len(list_intersect(q.w, a.w)) / sqrt(len(q.w) * len(a.w)::DOUBLE) END, 6) AS lex FROM t q JOIN t a ON q.conv_id = a.conv_id AND q.role = 'user' AND a.role = 'assistant')
SELECT conv_id, q, CASE WHEN m >= 0.6 THEN 'strong' WHEN m >= 0.4 THEN 'good' WHEN m > 0 THEN 'label_supported' ELSE 'none' END AS match FROM (SELECT conv_id, q, max(lex) AS m FROM s GROUP BY ALL)""")
def hybrid_score_class(spark, sf_dir):
    best = _turn_pairs(spark, sf_dir).groupBy("conv_id", "q").agg(F.max(F.round("lex", 6)).alias("m"))
    m = F.col("m")
    return best.select("conv_id", "q", F.when(m >= 0.6, "strong").when(m >= 0.4, "good").when(m > 0, "label_supported").otherwise("none").alias("match"))


@query(f"""WITH RECURSIVE t AS (SELECT conv_id, turn, role, {_ANCHORS} AS w FROM conversations), s AS (
SELECT q.conv_id AS unit, q.turn AS q, a.turn AS b, round(CASE WHEN len(q.w) = 0 OR len(a.w) = 0 THEN 0 ELSE len(list_intersect(q.w, a.w)) / sqrt(len(q.w) * len(a.w)::DOUBLE) END, 6) AS lex FROM t q JOIN t a ON q.conv_id = a.conv_id AND q.role = 'user' AND a.role = 'assistant'),
r AS (SELECT unit, q, row_number() OVER (PARTITION BY unit ORDER BY q) AS i, list(lex ORDER BY b) AS s, list(b ORDER BY b) AS bs FROM (SELECT unit, q, b, max(lex) AS lex FROM s GROUP BY ALL) GROUP BY unit, q),
dp AS (SELECT DISTINCT unit, CAST(0 AS BIGINT) AS i, len(bs) AS m, list_transform(range(0, len(bs) + 1), lambda x: 0.0::DOUBLE) AS best, list_transform(range(0, len(bs) + 1), lambda x: -1::BIGINT) AS pick FROM r
UNION ALL SELECT unit, i, m, list_transform(range(0, m + 1), lambda j: CASE WHEN coalesce(list_max(v[1:j]), -1e9) > best[j + 1] + 1e-12 THEN list_max(v[1:j]) ELSE best[j + 1] END),
list_transform(range(0, m + 1), lambda j: CASE WHEN coalesce(list_max(v[1:j]), -1e9) > best[j + 1] + 1e-12 THEN list_position(v[1:j], list_max(v[1:j]))::BIGINT - 1 ELSE -1 END)
FROM (SELECT dp.unit, r.i, m, best, list_transform(range(1, m + 1), lambda k: CASE WHEN s[k] > 0 AND pick[k + 1] <> k - 1 THEN best[k + 1] + s[k] ELSE -1e9 END) AS v FROM dp JOIN r ON r.unit = dp.unit AND r.i = dp.i + 1)),
back AS (SELECT unit, max(i) AS i, any_value(m)::BIGINT AS j FROM dp GROUP BY unit UNION ALL SELECT back.unit, back.i - 1, CASE WHEN pick[j + 1] >= 0 THEN pick[j + 1] + 1 ELSE j END FROM back JOIN dp ON dp.unit = back.unit AND dp.i = back.i WHERE back.i > 0)
SELECT unit, q, b FROM (SELECT back.unit, r.q, bs[pick[j + 1] + 1] AS b, row_number() OVER (PARTITION BY back.unit, pick[j + 1] ORDER BY back.i) AS n FROM back JOIN dp ON dp.unit = back.unit AND dp.i = back.i JOIN r ON r.unit = back.unit AND r.i = back.i WHERE back.i > 0 AND pick[j + 1] >= 0) WHERE n = 1""")
def monotone_alignment(spark, sf_dir):
    """User turns as questions, assistants' as blocks."""
    return align.aligned_scores(_turn_pairs(spark, sf_dir).select(F.col("conv_id").alias("unit"), "q", "b", F.round("lex", 6).alias("score")))


@query("""WITH q AS (SELECT vec_id AS q, label, embedding FROM embeddings WHERE vec_id % 50 = 0),
s AS (SELECT q, e.vec_id, round(list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 6) AS cos FROM q JOIN embeddings e USING (label) WHERE q <> e.vec_id)
SELECT q, vec_id, cos FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY cos DESC, vec_id) AS r FROM s) WHERE r <= 3""")
def embedding_cosine_topk(spark, sf_dir):
    v = F.col("embedding")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    e = read(spark, sf_dir, "embeddings").select("vec_id", "label", F.transform(v, lambda x: x / norm).alias("embedding"))
    q = e.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("q"), "label", F.col("embedding").alias("qe"))
    s = e.join(q, "label").filter("q <> vec_id").select("q", "vec_id", F.round(T.dot(F.col("qe"), F.col("embedding")), 6).alias("cos"))
    return s.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("cos"), "vec_id"))).filter("r <= 3").drop("r")


@query("SELECT role, CASE WHEN contains(h, 'VERDICT: GOOD') OR contains(h, 'VERDICT:GOOD') THEN 'GOOD' WHEN contains(h, 'VERDICT: BAD') OR contains(h, 'VERDICT:BAD') THEN 'BAD' WHEN contains(h, 'GOOD') THEN 'GOOD' WHEN contains(h, 'BAD') THEN 'BAD' ELSE 'UNCLEAR' END AS verdict, count(*) AS n FROM (SELECT role, upper(substr(text, 1, 200)) AS h FROM conversations) GROUP BY ALL")
def verdict_parse(spark, sf_dir):
    return read(spark, sf_dir, "conversations").groupBy("role", T.verdict(F.col("text"), "VERDICT", "GOOD", "BAD").alias("verdict")).agg(F.count("*").alias("n"))


@query("SELECT quality, toxic, count(*) AS n, grouping_id(quality, toxic) AS level FROM labels GROUP BY GROUPING SETS ((quality, toxic), (quality), ())")
def verdict_crosstab(spark, sf_dir):
    return read(spark, sf_dir, "labels").rollup("quality", "toxic").agg(F.count("*").alias("n"), F.grouping_id("quality", "toxic").cast("long").alias("level"))


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def verdict_state_latest(spark, sf_dir):
    return overlay.latest(read(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", "ts"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).drop("ts")


@query("SELECT o_orderkey, o_orderstatus, round(o_totalprice, 2) AS price, 'prior' AS origin FROM orders WHERE o_orderkey % 3 <> 0 AND NOT (o_orderkey % 2 = 0 AND o_orderstatus <> 'P') UNION ALL SELECT o_orderkey, o_orderstatus, round(o_totalprice * 2, 2), 'new' FROM orders WHERE o_orderkey % 2 = 0 AND o_orderstatus <> 'P'")
def upsert_merge(spark, sf_dir):
    """Orders not divisible by 3 as prior rows, even ones as new; those with status P count as skipped."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    prior = orders.filter("o_orderkey % 3 <> 0").select("o_orderkey", "o_orderstatus", F.round("o_totalprice", 2).alias("price"), F.lit("prior").alias("origin"))
    new = orders.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_orderstatus", F.round(F.col("o_totalprice") * 2, 2).alias("price"), F.lit("new").alias("origin"))
    return overlay.upsert(prior, new, ["o_orderkey"], F.col("o_orderstatus") == "P")


@query("SELECT lang, count(*) AS n_pending FROM documents d ANTI JOIN labels l USING (doc_id) GROUP BY lang")
def anti_semi_resume(spark, sf_dir):
    return overlay.pending(read(spark, sf_dir, "documents").select("doc_id", "lang"), read(spark, sf_dir, "labels").select("doc_id"), ["doc_id"]).groupBy("lang").agg(F.count("*").alias("n_pending"))


@query("SELECT a.doc_id, a.quality AS before, b.toxic AS after FROM labels a JOIN labels b USING (doc_id) WHERE a.quality IS DISTINCT FROM b.toxic")
def regression_diff(spark, sf_dir):
    labels = read(spark, sf_dir, "labels")
    return overlay.regressions(labels.select("doc_id", F.col("quality").alias("v")), labels.select("doc_id", F.col("toxic").alias("v")), "doc_id", "v")


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN l.quality ELSE d.v END AS v, CASE WHEN l.doc_id IS NOT NULL THEN 'human' ELSE 'auto' END AS by FROM (SELECT doc_id, CAST(length(text) % 2 AS INTEGER) AS v FROM documents) d LEFT JOIN labels l USING (doc_id)")
def override_overlay(spark, sf_dir):
    auto = read(spark, sf_dir, "documents").select("doc_id", (F.length("text") % 2).alias("v"))
    return overlay.overlaid(auto, read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("v")), "doc_id", "v")


@query("SELECT p.p_brand, p.p_type, q.p_partkey, b.block FROM part q JOIN part p ON p.p_partkey = q.p_partkey JOIN (SELECT p_brand, p_type, min(p_partkey) AS block FROM part WHERE p_size < 10 GROUP BY ALL HAVING count(*) = 1) b ON b.p_brand = q.p_brand AND b.p_type = q.p_type WHERE q.p_size >= 10")
def unique_label_autofix(spark, sf_dir):
    part = read(spark, sf_dir, "part").select("p_brand", "p_type", "p_partkey", "p_size")
    blocks = part.filter("p_size < 10").select("p_brand", "p_type", F.col("p_partkey").alias("block"))
    return overlay.unique_label_fix(part.filter("p_size >= 10").drop("p_size"), blocks, "p_brand", "p_type", "block")


@query("SELECT lang, source, doc_id FROM (SELECT lang, source, doc_id, row_number() OVER (PARTITION BY lang, source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) AS r FROM documents) WHERE r <= 5")
def stratified_sample(spark, sf_dir):
    return overlay.stratified(read(spark, sf_dir, "documents").select("lang", "source", "doc_id"), ["lang", "source"], "doc_id", 5)


@query("SELECT CASE n_regionkey WHEN 0 THEN 1 WHEN 1 THEN 0 ELSE n_regionkey END AS n_regionkey, n_nationkey, n_name FROM nation")
def label_swap(spark, sf_dir):
    mapping = spark.createDataFrame([(0, 1), (1, 0)], "old int, new int")
    return overlay.permuted(read(spark, sf_dir, "nation"), F.broadcast(mapping), "n_regionkey")


@query("SELECT (SELECT count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)) AS only_documents, (SELECT count(*) FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)) AS only_labels")
def key_set_equality(spark, sf_dir):
    d, l = read(spark, sf_dir, "documents").select("doc_id"), read(spark, sf_dir, "labels").select("doc_id")
    sides = d.subtract(l).select(F.lit("d").alias("s")).unionByName(l.subtract(d).select(F.lit("l").alias("s")))
    return sides.agg(F.count_if(F.col("s") == "d").alias("only_documents"), F.count_if(F.col("s") == "l").alias("only_labels"))


@query("SELECT l_shipmode_key AS bucket, round(sum(l_quantity) * 0.75 / 1e6 + sum(l_extendedprice) * 3.75 / 1e6, 4) AS usd, count(*) AS calls FROM (SELECT l_returnflag || l_linestatus AS l_shipmode_key, l_quantity, l_extendedprice FROM lineitem) GROUP BY 1")
def spend_rollup(spark, sf_dir):
    usd = F.round(F.sum("l_quantity") * 0.75 / 1e6 + F.sum("l_extendedprice") * 3.75 / 1e6, 4)
    return read(spark, sf_dir, "lineitem").groupBy(F.concat("l_returnflag", "l_linestatus").alias("bucket")).agg(usd.alias("usd"), F.count("*").alias("calls"))


@query("SELECT event_id FROM (SELECT event_id, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS d FROM events) WHERE d < 2000000")
def events_min_interval(spark, sf_dir):
    """Events less than two seconds after the user's one before."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    gap = at - F.lag(at).over(w)
    return read(spark, sf_dir, "events").select("event_id", "user_id", "ts", gap.alias("d")).filter("d < 2000000").select("event_id")


@query()
def rect_clusters(spark, sf_dir):
    """Events as boxes on 97 pages; those without a value are none."""
    boxes = read(spark, sf_dir, "events").select((F.col("user_id") % 97).alias("page"), (F.col("event_id") % 600).cast("double").alias("x0"), F.col("value").alias("y0"))
    return figures.rect_clusters(boxes.filter("y0 IS NOT NULL").select("page", "x0", "y0", (F.col("x0") + 10).alias("x1"), (F.col("y0") + 1).alias("y1")), 1.0)


@query("""WITH RECURSIVE s AS (SELECT l_orderkey AS u, CAST(l_partkey % 20 AS INTEGER) AS n, l_quantity > 45 AS d, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_partkey % 20, l_quantity > 45) AS k FROM lineitem),
f AS (SELECT u, k, CASE WHEN d OR n <= 12 THEN n END AS cur, d OR n <= 12 AS o FROM s WHERE k = 1
UNION ALL SELECT u, k, CASE WHEN o THEN n ELSE cur END, o FROM (
SELECT s.u, s.k, s.n, f.cur, s.d OR s.n = coalesce(f.cur, 0) + 1 OR s.n = 1 OR (f.cur IS NULL AND s.n <= 12) OR coalesce(s.n > f.cur AND s.n <= 15, false) AS o FROM f JOIN s ON s.u = f.u AND s.k = f.k + 1))
SELECT u AS l_orderkey, CAST(k AS INTEGER) AS k, cur AS n FROM f WHERE o""")
def item_openings(spark, sf_dir):
    """Lines of an order as labels of a text."""
    labels = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("unit"), "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_partkey") % 20).cast("int").alias("n"), (F.col("l_quantity") > 45).alias("dotted"))
    return segments.opened(labels, ["l_linenumber", "l_partkey", "l_suppkey"]).withColumnRenamed("unit", "l_orderkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE CASE WHEN l_partkey = 0 THEN l_linenumber * l_suppkey > 1e-9 ELSE abs(l_linenumber * l_suppkey - l_partkey) > 0.03 * l_partkey END")
def arithmetic_slips(spark, sf_dir):
    stated = F.concat("l_linenumber", F.lit(" * "), "l_suppkey", F.lit(" = "), "l_partkey")
    return read(spark, sf_dir, "lineitem").filter(F.size(formulas.slips(stated)) > 0).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(r"""WITH f AS (SELECT DISTINCT l_orderkey AS k, l_linenumber % 2 AS i, 'y = ' || l_partkey || CASE WHEN l_quantity > 25 THEN ' + ' ELSE ' - ' END || 'x^' || l_suppkey AS f FROM lineitem),
g AS (SELECT *, regexp_replace(f, '[-+]', '', 'g') AS sg, regexp_replace(f, '\^\{[^}]*\}|\^.', '', 'g') AS xp FROM f), s AS (SELECT * FROM g WHERE i = 1), o AS (SELECT * FROM g WHERE i = 0 AND length(f) >= 12 AND (k, f) NOT IN (SELECT k, f FROM s))
SELECT o.k AS l_orderkey, o.f AS "left", s.f AS "right", 'sign' AS differs_in FROM o JOIN s ON o.k = s.k AND o.sg = s.sg UNION ALL SELECT o.k, o.f, s.f, 'exponent' FROM o JOIN s ON o.k = s.k AND o.xp = s.xp AND o.sg <> s.sg""")
def formula_sign_variants(spark, sf_dir):
    """Even lines of an order against odd ones."""
    f = F.concat(F.lit("y = "), "l_partkey", F.when(F.col("l_quantity") > 25, " + ").otherwise(" - "), F.lit("x^"), "l_suppkey")
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", f.alias("formula"))
    return formulas.sign_variants(rows.filter("l_linenumber % 2 = 0"), rows.filter("l_linenumber % 2 = 1"), "l_orderkey", "formula")


@query(r"SELECT doc_id, (length(replace(text, '$$', '')) - length(replace(replace(text, '$$', ''), '$', ''))) % 2 = 1 AS odd_dollars, length(replace(text, '}', '')) - length(replace(text, '{', '')) AS brace_gap, len(regexp_extract_all(text, '\\frac($|[^{])')) AS bare_fractions, regexp_matches(text, '[\^_]\s*(\$|\n|$)') AS dangling FROM documents")
def latex_balance(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", *(c.alias(n) for n, c in formulas.latex_counts(F.col("text")).items()))


@query("""WITH c AS (SELECT doc_id, length(l) - length(replace(l, '|', '')) AS c FROM (SELECT doc_id, unnest(string_split('|' || replace(replace(text, ',', '|'), chr(10), '|' || chr(10) || '|') || '|', chr(10))) AS l FROM documents)),
s AS (SELECT doc_id, sum(k) AS n_rows, max(k) AS m FROM (SELECT doc_id, c, count(*) AS k FROM c GROUP BY ALL) GROUP BY doc_id)
SELECT doc_id, CAST(n_rows AS INTEGER) AS n_rows, CAST(n_rows - m AS INTEGER) AS n_off FROM s WHERE n_rows >= 3 AND n_rows - m > greatest(1, floor(n_rows / 3))""")
def uneven_tables(spark, sf_dir):
    """Lines as rows of a table, their commas as separators."""
    rows = F.concat(F.lit("|"), F.replace(F.replace("text", F.lit(","), F.lit("|")), F.lit("\n"), F.lit("|\n|")), F.lit("|"))
    return read(spark, sf_dir, "documents").select("doc_id", formulas.uneven_table(rows).alias("t")).filter("t IS NOT NULL").select("doc_id", "t.*")


@query("SELECT strftime(ts, '%Y-%m-%d %H:00') AS hour, event_type, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY ALL")
def stream_hourly_counts(spark, sf_dir):
    """The events file as a stream."""
    schema = read(spark, sf_dir, "events").schema
    stream = incremental.arriving(spark, sf_dir, schema, "parquet", "events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    counts = incremental.completed(spark, incremental.windowed_counts(stream, "ts", ["event_type"]), "hourly")
    return counts.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("hour"), "event_type", "n")


_LABEL = "CASE WHEN l_quantity > 25 THEN CAST(l_partkey % 3 AS {t}) ELSE CAST(l_partkey % 3 AS {t}) || '.' || l_linenumber END"


@query(f"""SELECT l_orderkey, label, coalesce(starts_with(lead(label) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, label), label || '.'), false) AS stub
FROM (SELECT *, {_LABEL.format(t='VARCHAR')} AS label FROM lineitem)""")
def parent_stubs(spark, sf_dir):
    """Lines of an order as labels of one or two parts."""
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.expr(_LABEL.format(t="STRING")).alias("label"))
    return sequences.parent_stubs(rows, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "label"], "label").select("l_orderkey", "label", "stub")


@query("SELECT conv_id, turn, text IS NOT NULL AND row_number() OVER (PARTITION BY conv_id, substr(text, 1, 60) ORDER BY turn) > 1 AS shared FROM conversations")
def shared_answers(spark, sf_dir):
    return sequences.shared_answers(read(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), "conv_id", ["turn"], "text").select("conv_id", "turn", "shared")
