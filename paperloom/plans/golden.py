"""Queries over a few literal rows that are left of a first round: sections of languages, captions, scored alignment, ratios of texts, boxes in points, sheets.

Their SQL is the table of outcomes, worked out by hand from the formats' rules for these small inputs; it computes nothing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import align, audit, figures, formulas, linking, reports, sequences, units
from .records import ORACLES, QUERIES, query, table, values

__all__ = ["ORACLES", "QUERIES"]


def outcome(rows: list[tuple], schema: str):
    """Registers a query whose result is these rows."""
    return query("SELECT * FROM " + values(rows, schema))


_LONG = "جواب طويل جدا عن السؤال المطروح. " * 15
_PASSAGE = "Un long texte qui parle de beaucoup de choses et qui continue encore. " * 8
_TEXTS = [
    ("bac_svt_2015_sujet1", "[PAGE 1]\nhead\n**التمرين الأول** (4 نقاط)\n1) a\n[FIGURE: x\ny]\nالجزء الأول:\n2) b\n[PAGE 2]\nالجزء الثاني (7 نقاط)\nالتمرين التجريبي\ntext\n[PAGE 3]\nالتمرين التجريبي\nmore"),
    ("bac_math_2012_sujet1_solution", f"[PAGE 1]\n{_LONG}\nالتمرين الثاني\nx\nالموضوع الثاني\nالتمرين الأول\ny"),
    ("bac_math_2013_sujet1_solution", "[PAGE 1]\nonly text\n[PAGE 2]\nmore"),
    ("bac_math_2014_sujet1", "[PAGE 1]\nno heading"),
    ("bac_francais_2015_sujet1", f"[PAGE 1]\nRépublique Algérienne\n{_PASSAGE}\nI. Compréhension de l'écrit (14 points)\n1. Dites\n[PAGE 2]\nII. Production écrite\nR"),
    ("bac_english_2016_sujet1_solution", "[PAGE 1]\nPart one\n1) T (0.5 each) Text exploration: 7 pts 1) a"),
    ("bac_francais_2009_sujet2", f"[PAGE 1]\nProduction écrite\n{_PASSAGE}\n{_PASSAGE}\nCompréhension\n1. a"),
    ("bac_arabe_2015_sujet1", "[PAGE 1]\nx"),
    ("notes", "[PAGE 1]\nالتمرين الأول"),
]


@outcome([
    ("bac_francais_2015_sujet1__s1", "text", None, True), ("bac_francais_2015_sujet1__s2", "comprehension", 14.0, False), ("bac_francais_2015_sujet1__s3", "production", None, False), ("bac_english_2016_sujet1_solution__s1", "reading", None, False),
    ("bac_english_2016_sujet1_solution__s2", "exploration", 7.0, False), ("bac_francais_2009_sujet2__s1", "text", None, True), ("bac_francais_2009_sujet2__s2", "comprehension", None, False), ("bac_arabe_2015_sujet1__s1", "whole", None, False),
], "id string, section_key string, points double, heading_inferred boolean")
def section_units(spark, sf_dir):
    return units.segmented(table(spark, _TEXTS, "stem string, content string")).filter("section_key IS NOT NULL").select("id", "section_key", "points", "heading_inferred")


@outcome([("bac_svt_2015_sujet1__ex1", "c1"), ("bac_svt_2015_sujet1__ex2", "c2,c3")], "id string, captions string")
def unit_captions(spark, sf_dir):
    found = units.segmented(table(spark, _TEXTS[:1], "stem string, content string"))
    captions = table(spark, [("bac_svt_2015_sujet1", 3, "c3", "graph"), ("bac_svt_2015_sujet1", 2, "c2", None), ("bac_svt_2015_sujet1", 1, "c1", "table"), ("bac_svt_2015_sujet1", 1, "p", "full_page_text")], "stem string, page_num int, caption_file string, content_type string")
    return units.with_captions(found, captions).select("id", F.concat_ws(",", "captions").alias("captions"))


_ITEMS = [("1", "1) Calculer la vitesse moyenne du mobile $v_0$"), ("2", "2) Intro:"), ("2.1", "2.1) Donner la masse du solide"), ("2.2", "2.2) Tracer le graphe"), ("3", "3) Citer trois planètes connues")]
_KEY = "1) la vitesse moyenne du mobile est $v_0 = 3$\n2.1) la masse du solide est 4 kg\n2.2) graphe\n9) rien de commun avec cela ici"


@outcome([("u__q1", "1", True), ("u__q2", None, False), ("u__q2.1", "2.1", True), ("u__q2.2", "2.2", True), ("u__q3", None, False), ("w__q1", None, False)], "qid string, answer_label string, answered boolean")
def aligned_questions(spark, sf_dir):
    pairs = spark.createDataFrame([("u", _ITEMS, _KEY), ("w", _ITEMS[:1], None), ("x", [], _KEY)], "unit_id string, items array<struct<label:string,text:string>>, solution string")
    return align.aligned(pairs).select("qid", "answer_label", F.col("match").isin("strong", "good", "label_supported").alias("answered"))


@outcome([("a", "x,-"), ("b", "y,z")], "unit string, answers string")
def label_only_answers(spark, sf_dir):
    rows = [("a", [("1", "q"), ("2", "r")], [("1", "x")]), ("b", [("1", "q"), ("1", "r")], [("1", "y"), ("1", "z")])]
    pairs = spark.createDataFrame(rows, "unit string, items array<struct<label:string,text:string>>, answers array<struct<label:string,text:string>>")
    found = align.answers_by_labels(F.col("items"), F.col("answers"))
    return pairs.select("unit", found.alias("a")).select("unit", F.array_join(F.transform("a", lambda x: F.coalesce(x, F.lit("-"))), ",").alias("answers"))


@outcome([("m_solution",)], "stem string")
def exam_copies(spark, sf_dir):
    return linking.exam_copies(table(spark, [("m", "same text " * 20), ("m_solution", "same text " * 20), ("n", "abc def " * 9), ("n_solution", "zzzz 9999"), ("o_solution", "x")], "stem string, content string"))


_PAGE = "Soit $x^{2} + 3x = 4$ et $\\frac{a}{b} \\approx 2,5$. Note 0,25"
_READ = [("x^2+3x=4", True), ("0.25", True), ("0.75", False), ("\\dfrac{a}{b} = 2.5", True), ("y = sin(z) + 12", False), ("x^2 + 3x = 5", False)]


@outcome(_READ, "item string, found boolean")
def second_readings(spark, sf_dir):
    return table(spark, [(x, _PAGE) for x, _ in _READ], "item string, page string").select("item", formulas.matched(F.col("item"), F.col("page")).alias("found"))


@outcome([("k", "math", 1, True), ("l", "svt", 1, False)], "key string, subject string, n_real long, numeric_only boolean")
def missing_atoms(spark, sf_dir):
    return formulas.missing_atoms(table(spark, [("k", "math", "F = 12 N", "F = 11 N"), ("k", "math", "alpha = 3", "alpha = 3"), ("l", "svt", "beta", "none")], "key string, subject string, item string, page string"))


@outcome([("s", "abc\nلام12")], "stem string, text string")
def character_lines(spark, sf_dir):
    chars = [(0, "c", 3.0, 10.0), (1, "a", 1.0, 10.4), (2, "b", 2.0, 9.9), (3, "1", 1.0, 30.0), (4, "2", 2.0, 30.0), (5, "م", 3.0, 30.0), (6, "ا", 4.0, 30.0), (7, "ل", 5.0, 30.0), (8, " ", 1.0, 50.0)]
    df = table(spark, [("s", 1, *c) for c in chars], "stem string, page_num int, seq int, text string, x0 double, top double")
    return sequences.page_lines(df).select("stem", "text")


@outcome([("b.json", "bad_json"), ("c.json", "broken_reference"), ("c.json", "empty_description"), ("c.json", "other_name")], "caption_file string, problem string")
def caption_checks(spark, sf_dir):
    captions = [("bac_svt_2010_sujet1_page1_img1.json", "d/bac_svt_2010_sujet1_page1_img1.png", "x", "bac_svt_2010_sujet1", 1), ("b.json", None, None, None, None), ("c.json", "d/none.png", " ", "none", 1)]
    rows = table(spark, captions, "caption_file string, image_file string, description string, stem string, page_num int")
    return audit.caption_problems(rows, table(spark, [("bac_svt_2010_sujet1_page1_img1.png",)], "filename string"))


@outcome([("a", 0.0, 0.0, 106.0, 56.0, False), ("b", 0.0, 0.0, 586.0, 786.0, True)], "stem string, x0 double, y0 double, x1 double, y1 double, full_page boolean")
def image_figures(spark, sf_dir):
    images = [("a", 0.0, 0.0, 50.0, 50.0, "GRAPH"), ("a", 60.0, 0.0, 100.0, 50.0, "TEXTUAL"), ("a", 300.0, 300.0, 390.0, 390.0, "LOGO"), ("a", 400.0, 0.0, 420.0, 20.0, "GRAPH"), ("b", 0.0, 0.0, 580.0, 780.0, "TABLE")]
    df = table(spark, [(s, 1, *r, 600.0, 800.0) for s, *r in images], "stem string, page int, x0 double, y0 double, x1 double, y1 double, category string, width double, height double")
    return figures.figures(df).drop("page")


@outcome([("a", 77.0, 77.0, 223.0, 218.0)], "stem string, x0 double, y0 double, x1 double, y1 double")
def drawn_figures(spark, sf_dir):
    paths = [(100.0, 100.0, 200.0, 200.0, 14), (95.0, 95.0, 205.0, 96.0, 0), (400.0, 400.0, 480.0, 480.0, 13), (500.0, 10.0, 560.0, 60.0, 2)]
    known = table(spark, [("a", 1, 390.0, 390.0, 500.0, 500.0)], "stem string, page int, x0 double, y0 double, x1 double, y1 double")
    df = table(spark, [("a", 1, *r, 600.0, 800.0) for r in paths], "stem string, page int, x0 double, y0 double, x1 double, y1 double, weight int, width double, height double")
    return figures.vector_figures(df, known).drop("page", "full_page")


@outcome([("u", "q1 [good] q -> a\n  [0] a1: a")], "unit_id string, text string")
def review_sheets(spark, sf_dir):
    q = table(spark, [("u__q1", "u", 0, "q", "a", "good", 1.0)], "qid string, unit_id string, ix int, question string, answer string, match string, label_agree double")
    return reports.sheet(q, table(spark, [("u", 0, "1", "a")], "unit_id string, block int, label string, text string"))


