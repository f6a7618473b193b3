"""Quality rules by cross-document line frequency, in DataFrame functions only.

Lines are normalised and hashed; the distinct documents of each host that hold a line are counted. Lines in more documents of a
host than its limit, MAX_DOCS or a share of its documents, are removed, and a document that loses more than a set share of its words is
rejected. Rules on word counts and repeated 8-word windows come before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, joined_small, prefix, staged, table

#: A line may be in so many documents of its host, or in this share of them if that is more.
MAX_DOCS, MAX_SHARE = 10, 0.001
#: A document is depleted if fewer of its words than this share are left, or fewer words than MIN_WORDS. Lines of fewer words than
#: LINE_WORDS are removed like others but deplete nothing: ordinary short lines come often on a large host.
MIN_LEFT = 0.5
MIN_WORDS = 20
LINE_WORDS = 4
MAX_REPEAT_PERCENT = 30
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


#: Lines are compared without white space, A-Z lower-cased and each digit as 0: one pass over their characters.
_FROM, _TO = UPPER + "123456789" + BLANKS, LOWER + "000000000"


def lines_of(text: Column) -> Column:
    """The text's \\n-split lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != "")


def normal(line: Column) -> Column:
    return F.translate(line, _FROM, _TO)


def words_of(text: Column) -> Column:
    """Runs of characters that are not ASCII white space."""
    return F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), "")


def base(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed of the whole texts.

    Windows are hashed by doubling: words, pairs, fours, eights. Only where two windows of a text are equal are they sorted by
    (hash, place); those with an equal neighbour, in order of place, cover min(8, distance to the one before) words each."""
    text, p = F.coalesce(F.col("text"), F.lit("")), prefix(docs)
    own = {k: p + k for k in ("hashes", "lines", "twos", "fours", "eights", "sorted", "places", "row")}
    docs = docs.withColumns(
        {
            own["hashes"]: F.transform(words_of(text), lambda x: F.xxhash64(x)),
            own["lines"]: lines_of(text),
            "word_chars": F.length(F.translate(text, BLANKS, "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
        }
    )
    pairs = lambda of, step: F.expr("zip_with({0}, slice({0}, {1}, size({0})), (a, b) -> xxhash64(a, b))".format(own[of], step + 1))
    docs = docs.withColumns(
        {
            "n_words": F.size(own["hashes"]).cast("long"),
            "n_dup_lines": (F.size(own["lines"]) - F.size(F.array_distinct(own["lines"]))).cast("long"),
            own["twos"]: pairs("hashes", 1),
        }
    )
    docs = docs.withColumn(own["fours"], pairs("twos", 2))
    docs = docs.withColumn(own["eights"], F.slice(pairs("fours", 4), F.lit(1), F.greatest(F.size(own["fours"]) - 7, F.lit(0))))
    docs = docs.withColumn(own["sorted"], F.expr("CASE WHEN size(array_distinct({0})) < size({0}) THEN array_sort(transform({0}, (h, i) -> struct(h, i))) ELSE array() END".format(own["eights"])))
    docs = docs.withColumn(
        own["places"],
        F.expr(
            "CASE WHEN size({0}) < 2 THEN array() ELSE array_sort(transform(filter({0}, (x, k) -> "
            "(k > 0 AND x.h = {0}[greatest(k - 1, 0)].h) OR (k + 1 < size({0}) AND x.h = {0}[least(k + 1, size({0}) - 1)].h)), x -> x.i)) END".format(own["sorted"])
        ),
    )
    # a filter isn't pushed below a non-deterministic column: there the expressions above would be substituted into each other
    docs = docs.withColumn(own["row"], F.monotonically_increasing_id())
    docs = docs.withColumn(
        "n_repeat_words",
        F.expr("CASE WHEN {1} >= 0 THEN aggregate({0}, struct(0L AS n, -8 AS p), (s, x) -> struct(s.n + least(8, x - s.p) AS n, x AS p), s -> s.n) END".format(own["places"], own["row"])),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return docs.withColumn("base_failed", failed).drop(*own.values())


def frequent_lines(docs: DataFrame, max_docs: int = MAX_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """(source, line) of the hashed lines that more distinct documents of a host hold than its limit. Exact copies are one
    document, so that copies do not deplete each other: removing copies is another operator's work."""
    text = F.coalesce(F.col("text"), F.lit(""))
    each = docs.select(_host().alias("source"), F.xxhash64(text).alias("copy"), F.array_distinct(F.transform(lines_of(text), lambda x: F.xxhash64(normal(x)))).alias("lines"))
    # a null line stands for the document itself, so one pass counts both
    lines = each.select("source", "copy", F.explode(F.array_append("lines", F.lit(None).cast("long"))).alias("line"))
    counted = lines.distinct().groupBy("source", "line").agg(F.count(F.lit(1)).alias("n_docs"))
    counted = staged(counted.filter((F.col("n_docs") > max_docs) | F.col("line").isNull()), "line-counts")
    limits = staged(counted.filter("line IS NULL").select("source", F.greatest(F.lit(float(max_docs)), F.col("n_docs") * F.lit(max_share)).alias("most")), "line-limits")
    return joined_small(counted.filter("line IS NOT NULL"), limits, ["source"], "inner").filter("n_docs > most").select("source", "line")


def _host() -> Column:
    """The host, and a name that no host has for null."""
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))


_KEY = "same"


def keyed(docs: DataFrame) -> DataFrame:
    """(same, source, text): rows of docs with an equal id, source and text have one key, others do not."""
    return docs.select(F.struct(F.xxhash64("doc_id", "source", "text").alias("a"), F.xxhash64("text", "source", "doc_id").alias("b")).alias(_KEY), "source", "text")


def lost_lines(rows: DataFrame, frequent: DataFrame) -> DataFrame:
    """For each key that loses lines: the words in them, those in lines that deplete, and the lines' hashes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    each = F.transform(lines_of(text), lambda x, i: F.struct(i.alias("i"), F.xxhash64(normal(x)).alias("line"), F.regexp_count(x, F.lit(WORD)).alias("w")))
    lines = rows.select(_KEY, _host().alias("source"), F.explode(each).alias("l")).select(_KEY, "source", "l.i", "l.line", "l.w")
    found = joined_small(lines, frequent, ["source", "line"], "left_semi")
    # a set, for equal rows have equal lines at equal places
    grouped = found.groupBy(_KEY).agg(F.collect_set(F.struct("i", "line", "w")).alias("l"))
    total = lambda least: F.aggregate("l", F.lit(0).cast("long"), lambda s, x: s + F.when(x["w"] >= least, x["w"]).otherwise(0))
    return grouped.select(_KEY, total(0).alias("gone"), total(LINE_WORDS).alias("depleting"), F.array_distinct("l.line").alias("removed"))


def judged(docs: DataFrame, max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT, min_words: int = MIN_WORDS, max_share: float = MAX_SHARE) -> DataFrame:
    """docs(doc_id, text, source, ...) with the base counts, base_failed, n_removed_words, removed and kept.

    Nulls: a null text has no words and fails; documents without source form one host; a null doc_id is a document like
    others. Rows with equal ids are judged separately; exact copies of a text count once among a host's documents. Texts of any length
    are judged whole, each in its own row. A line that is in exactly as many documents as the limit stays. An
    empty table gives none. Other columns are carried along; those with a name of a result are replaced."""
    rows, p = keyed(docs), prefix(docs)
    frequent = staged(frequent_lines(rows, max_docs, max_share), "frequent-lines")
    lost = staged(lost_lines(rows, frequent), "lost-lines")
    names = {_KEY: p + _KEY, "gone": p + "gone", "depleting": p + "depleting"}
    lost = lost.withColumnsRenamed(names)
    mine = docs.drop("n_removed_words", "removed").withColumn(p + _KEY, F.struct(F.xxhash64("doc_id", "source", "text").alias("a"), F.xxhash64("text", "source", "doc_id").alias("b")))
    out = joined_small(base(mine), lost, [p + _KEY], "left")
    gone, depleting = (F.coalesce(names[k], F.lit(0).cast("long")) for k in ("gone", "depleting"))
    left = F.col("n_words") - depleting
    depleted = (depleting > 0) & ((left < min_words) | (left < min_left * F.col("n_words")))
    return out.withColumns({"kept": ~F.col("base_failed") & ~depleted, "n_removed_words": gone}).drop(*names.values())


def cleaned(judged_docs: DataFrame) -> DataFrame:
    """The kept documents, without the removed lines."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rest = F.array_join(F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(F.col("removed"), F.xxhash64(normal(x)))), "\n")
    return judged_docs.filter("kept").withColumn("text", F.when(F.col("removed").isNull(), F.col("text")).otherwise(rest))


COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")


def op7_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(*COLUMNS)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || source, 'null') AS source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (
  SELECT rid, unnest(range(i, i + 8)) AS p FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1) GROUP BY rid),
l AS (SELECT rid, source, t, x, regexp_replace(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'), '[\x20\x09-\x0D]+', '', 'g') AS norm,
             len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS lw
      FROM (SELECT rid, source, t, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
dup AS (SELECT rid, count(*) - count(DISTINCT x) AS n FROM l GROUP BY rid),
most AS (SELECT source, greatest(10, 0.001 * count(DISTINCT t)) AS most FROM d GROUP BY source),
hot AS (SELECT source, norm FROM l JOIN most USING (source) GROUP BY source, norm HAVING count(DISTINCT t) > any_value(most)),
lost AS (SELECT rid, sum(lw) AS n, coalesce(sum(lw) FILTER (lw >= 4), 0) AS deep FROM l JOIN hot USING (source, norm) GROUP BY rid),
b AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
       CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
       CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_removed_words, CAST(coalesce(lost.deep, 0) AS BIGINT) AS deep
      FROM w LEFT JOIN rep USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN lost USING (rid)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (deep > 0 AND (n_words - deep < 20 OR n_words - deep < 0.5 * n_words)) AS kept, n_removed_words
FROM f
"""
