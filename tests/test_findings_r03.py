"""Queries against their SQL on the rows that the findings of round 3 are about."""

import re
import unicodedata
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from paperloom.functions import text as T
from paperloom.operators import figures, formulas, linking


@pytest.fixture
def compared(spark, tmp_path):
    """Of a query over given tables, name=(rows, schema): its rows as a bag, checked to be those of its SQL."""

    def run(query, **tables):
        for name, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        got = entry.queries()[query](spark, str(tmp_path))
        with duckdb.connect() as db:
            for name in tables:
                db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
            told = db.execute(f"SELECT {', '.join(got.columns)} FROM ({entry.oracle_sql()[query]})").fetchall()
        bag = Counter(tuple(r) for r in got.collect())
        assert bag == Counter(told)
        return bag

    return run


_DOCS = "doc_id long, text string, lang string, source string"


def _documents(*texts, lang="en"):
    return [(i, t, lang, "s") for i, t in enumerate(texts)], _DOCS


def test_garble_runs_of_any_length(compared):
    runs = compared("garble_runs", documents=_documents("ab c " * 200_000, "a b c d e f\n", "x a b c d e abc a b c d e f g", "a b c d e f  a b c d e f", "ab cd ef gh ij klm", "", None))
    assert runs[(0, 1)] == runs[(3, 2)] == 1


def test_long_gibberish(compared):
    assert compared("page_issue_tags", documents=_documents("x", "ab c " * 100_000, "ا ب " * 100_000))
    assert compared("local_page_checks", documents=_documents("x", "ا ب " * 100_000))


def test_science_marks_end_at_letters_that_are_not_ascii(compared):
    tags = compared("file_tags", documents=_documents("dé Aé" + " words" * 40, "dé é" + " words" * 40, "１２．x" + " words" * 90))
    assert tags[(1, "NO_SCIENCE_MARKERS")] == 1 and (0, "NO_SCIENCE_MARKERS") not in tags


def test_reversed_years_beside_letters_that_are_not_ascii(compared):
    rows = [(1, "words é3102é words", "en", "s"), (2, "words é13102 words", "en", "s"), (3, "a 3102_ b", "en", "s")]
    tags = compared("page_issue_tags", documents=(rows, _DOCS))
    assert tags[(1, "REVERSED_YEAR")] == 1 and (2, "REVERSED_YEAR") not in tags and (3, "REVERSED_YEAR") not in tags


def test_normal_characters_are_normal():
    seconds = {chr(int(d.split()[1], 16)) for d in map(unicodedata.decomposition, map(chr, range(0x110000))) if d and "<" not in d and " " in d}
    ranges = re.findall(r"\\[xu]([0-9A-F]+)-\\[xu]([0-9A-F]+)", T.NORMAL)
    assert len(ranges) == T.NORMAL.count("-")
    for a, b in ranges:
        for c in map(chr, range(int(a, 16), int(b, 16) + 1)):
            assert unicodedata.combining(c) == 0 and unicodedata.is_normalized("NFKC", c) and c not in seconds


def test_normal_forms_in_pieces(spark):
    """Python sees the pieces that normalizing may change, and no plain text at all."""
    texts = ["plain", "", "é e\u0301 ﬁn ① x", "\u0301 first", "ا\u0653 ب ﻻ", "가\u11a8 한", "½\U0001d400 end", "a\u0323\u0307 b\u0307\u0323", "ｶﾞ", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(T.nfkc(F.col("t")).alias("n")).collect()
    assert [r["n"] for r in rows] == [None if t is None else unicodedata.normalize("NFKC", t) for t in texts]


def test_uneven_tables_of_many_rows(spark):
    """Quadratic before: 60,000 rows of 300 shapes."""
    text = "\n".join("|" * (2 + i % 300) for i in range(60_000))
    row = spark.createDataFrame([(text,), ("|a|\n|b|\n|c|",), ("x",), (None,)], "t string").select(formulas.uneven_table(F.col("t")).alias("t")).collect()
    assert [r["t"] and tuple(r["t"]) for r in row] == [(60_000, 59_800), None, None, None]


def test_counts_of_characters(spark):
    row = spark.createDataFrame([("ab ا بab", "اب\u00a0abc ابc\u3000x")], "a string, b string").select(T.count_of(F.col("a"), T.ARABIC), T.arabic_token_length(F.col("b")), T.arabic_word_length(F.col("b"))).first()
    assert tuple(row) == (2, 2.5, 2.5)


def test_boxes_grow_together_across_batches(spark):
    """Neighbours first, in batches of a few rows, and then the page: the same clusters as of the whole page at once. Counts of earlier clusters add up."""
    boxes = [(page, float(i * 37 % 101), float(i * 53 % 89), float(i * 37 % 101 + 2), float(i * 53 % 89 + 2)) for page in (1, 2) for i in range(200 * page)]
    assert figures.clusters([(0.0, 0.0, 1.0, 1.0), (1.5, 0.0, 2.0, 1.0)], 1.0, [3, 4]) == [((0.0, 0.0, 2.0, 1.0), 7)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = Counter(map(tuple, figures.rect_clusters(spark.createDataFrame(boxes, "page long, x0 double, y0 double, x1 double, y1 double"), 0.5).collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == Counter((page, *box, n) for page in (1, 2) for box, n in figures.clusters([b[1:] for b in boxes if b[0] == page], 0.5))


def test_units_are_shuffled_once(spark, compared, tmp_path, capsys):
    """A unit's solution is of its own document, whatever the tier: one shuffle, by document, where each join and window had one before."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = compared("unit_pairs", orders=([(o,) for o in range(200)], "o_orderkey long"), part=([(1,)], "p_partkey long"))
        capsys.readouterr()
        entry.queries()["unit_pairs"](spark, str(tmp_path)).explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {match for _, _, match in rows} == {"unit", "document_fallback", "none_expected", "solution_is_exam_copy", "none"}
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 1


def test_tiers_of_solutions(spark):
    """Own part and number, the last of two; then the key without a part; then any, in order. A document without a stem has no copy and no first unit."""
    schema = "id string, stem string, subject string, doc_type string, ix int, part string, exercise_index int, section_key string, whole_document boolean"
    exam = [("e1", "P1", 1), ("e2", "P2", 1), ("e3", "P3", 1), ("e4", None, 2), ("e5", "P1", None), ("e6", "P4", 1)]
    key = [("k1", "P2", 1), ("k2", "P9", 1), ("k3", "P2", 1), ("k4", None, 1), ("k5", None, 2), ("k6", "P1", None)]
    rows = [(i, "m" + end, "math", kind, n, p, x, None, None) for kind, end, units in (("exam", "", exam), ("solution", "_solution", key)) for n, (i, p, x) in enumerate(units)]
    rows += [("s1", None, "math", "exam", 1, None, None, "writing", None), ("s2", None, "math", "solution", 2, None, None, "writing", False)]
    units = spark.createDataFrame(rows, schema)
    pairs = {("e1", "k4", 2), ("e2", "k3", 1), ("e3", "k2", 3), ("e4", "k5", 1), ("e5", "k6", 1)}
    assert {tuple(r) for r in linking.paired_exercises(units.filter("section_key IS NULL")).collect()} == pairs
    got = linking.paired(units, spark.createDataFrame([(None,), ("n_solution",)], "stem string")).collect()
    assert {(r["pair_id"], r["solution_id"], r["solution_match"]) for r in got} == {(e, k, "unit") for e, k, _ in pairs} | {("e6", None, "none"), ("s1", None, "none")}
    copied = linking.paired(units, spark.createDataFrame([("m_solution",)], "stem string")).filter("pair_id LIKE 'e%'").collect()
    assert len(copied) == 6 and all(r["solution_id"] is None and r["solution_match"] == "solution_is_exam_copy" for r in copied)


def test_overlapping_boxes_are_joined_in_place_order(spark, capsys):
    """Every pair of a plain loop, whatever the cells. By cells also if small (it was a broadcast), and a cell's pairs in order of the boxes' places (it was that of arrival)."""
    boxes = [(i % 2, i, float(i * 137 % 599), float(i * 71 % 797), float(i * 137 % 599 + 30), float(i * 71 % 797 + 20)) for i in range(900)]
    boxes += [(p, 1000 + 4 * p + k, 10.0, 10.0 + k, 610.0, 790.0) for p in (0, 1) for k in range(4)] + [(0, 2000, None, 1.0, 2.0, 2.0), (None, 2001, 1.0, 1.0, 9.0, 9.0)]
    df = spark.createDataFrame(boxes, "page int, id int, x0 double, y0 double, x1 double, y1 double").repartition(3)
    left, right = df.filter("id % 4 < 2"), df.filter("id % 4 > 1")
    at = {b[1]: b[2:] for b in boxes}
    whole = [b for b in boxes if None not in b]
    pairs = Counter((a[0], a[1], b[1]) for a in whole if a[1] % 4 < 2 for b in whole if b[0] == a[0] and b[1] % 4 > 1 and a[2] < b[4] and b[2] < a[4] and a[3] < b[5] and b[3] < a[5])
    for cell in (200.0, 64.0):
        got = [tuple(r) for r in figures.overlapping(left, right, ["page"], cell).collect()]
        assert Counter(got) == pairs
        cells: dict[tuple, list] = {}
        for page, a, b in got:
            corner = [max(at[a][k], at[b][k]) // cell for k in (0, 1)]
            cells.setdefault((page, *corner), []).append((at[a][:2], at[b][:2]))
        assert all(places == sorted(places) for places in cells.values())
    capsys.readouterr()
    figures.overlapping(left, right, ["page"]).explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and plan.count("Exchange hashpartitioning") == 2
