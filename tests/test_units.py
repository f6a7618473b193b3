"""Segmentation, labels, alignment on small texts whose outcome was worked out by hand."""

from pyspark.sql import functions as F

from paperloom.operators import align, labels, linking, units


def each(spark, kind, values, *columns):
    """The columns for each value of x, in order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}").repartition(2).select("i", *columns)
    return [r[1] if len(columns) == 1 else tuple(r[1:]) for r in sorted(rows.collect(), key=lambda r: r[0])]


ROWS = "array<struct<label:string,text:string>>"


def test_labels(spark):
    cases = {
        "7.35 - 7.45": None, "7.35 إلى 7.45": "7", "- 7 mai 1933 :": None, "1.5 pt": None, "(1) a (2) b": None, "3-ميثيل بوتان-1-أول": None, "-2 احسب": "2", "-2 text": None, "ج 1 - نعم": "1",
        "2.1) Calculer": "2.1", "١- احسب": "1", "الجواب على السؤال الثالث: نعم": "3", "5 The text is": "5", "12 / 20": None, "صفحة 2 من 4": None, "plain": None, "(2 احسب": "2", ".4 جد": "4", "3 خاطئ لأن": "3", "0,5": None,
    }
    assert dict(zip(cases, each(spark, "string", cases, labels.item_label(F.col("x"))))) == cases


def test_virtual_lines(spark):
    cases = {
        "2.\ntext here": ["2. text here"], "1\n0,5": ["1", "0,5"], "2)\n<table>": ["2. <table>"], "| 2 | خاطئ لأن | 0,5 |\n|---|---|": ["2 خاطئ لأن", "0,5"], "**1**\n**(2** answer": ["**1**", "**(2** answer"],
        "a<br>b<br/>c\n1": ["a", "b", "c", "1"], "": [], "\t| 1 |": ["1"],
    }
    assert dict(zip(cases, each(spark, "string", cases, labels.seen_lines(F.col("x"))))) == cases


def test_items(spark):
    text = "intro\n1) first\nmore\n2) second\n5) fifth\n3) inside\n1) again\n"
    strict = "1. contaminated (§1) a. well\n1. Read it\n2. Answer all of these\n4. Not next"
    loose, tight = each(spark, "string", [text, strict], labels.items(F.col("x"), F.lit(False)), labels.items(F.col("x"), F.lit(True)))
    assert [tuple(x) for x in loose[0]] == [("1", "1) first\nmore"), ("2", "2) second"), ("5", "5) fifth\n3) inside"), ("1", "1) again")]
    assert [x["label"] for x in tight[1]] == ["1", "2"]


def test_items_of_a_long_text_take_linear_time(spark):
    """More labels than one stretch of a scan holds, in 60,000 lines."""
    import time

    text = "\n".join(f"{1 + i % 15}) line {i}\nmore of it, with words" for i in range(30_000))
    began = time.perf_counter()
    (got,) = each(spark, "string", [text], F.size(labels.items(F.col("x"), F.lit(False))))
    assert got == 30_000 and time.perf_counter() - began < 60


def test_blocks_and_clean(spark):
    keys = ["header line here\n1) the answer is long\n2) 0,5\n3) another answer", "one paragraph\nof two lines\n\nanother one"]
    got = each(spark, "string", keys, labels.blocks(F.col("x")))
    assert [b["label"] for b in got[0]] == [None, "1", "3"] and [b["text"] for b in got[1]] == ["one paragraph\nof two lines", "another one"]
    text = "صفحة 1 من 2\n0.5\nالتمرين الأول (4 نقاط)\nالتمرين الأول: 1) lim h(x) = 0 and much more\nkept"
    assert each(spark, "string", [text], labels.cleaned(F.col("x"))) == ["التمرين الأول: 1) lim h(x) = 0 and much more\nkept"]


def test_orientation_legends_stubs(spark):
    plain = lambda *x: [(a, "") for a in x]
    got = each(spark, ROWS, [plain("1.2", "2.2", "3.2"), plain("2.1", "2.2", "3"), []], F.transform(labels.oriented(F.col("x")), lambda r: r["label"]))
    assert got == [["2.1", "2.2", "2.3"], ["2.1", "2.2", "3"], []]
    legend = [("1", "noyau"), ("2", "membrane"), ("1", "Calculer la vitesse."), ("2", "x")]
    assert each(spark, ROWS, [legend, legend[:2], []], labels.legends(F.col("x"))) == [[True, True, False, False], [False, False], []]
    assert each(spark, ROWS, [plain("1", "1.1", "2"), []], labels.stubs(F.col("x"))) == [[True, False, False], []]
    assert each(spark, "string", ["1) a\n2) b", "2) b\nc", "x\nsee (2) there"], labels.block_mentions(F.lit("2"), F.col("x"))) == [True, False, False]


def test_readings_are_native(spark):
    texts = spark.createDataFrame([("bac_svt_2015_sujet1", "[PAGE 1]\nx")], "stem string, content string")
    for df in (units.segmented(texts), texts.select(labels.items(F.col("content"), F.lit(True)), labels.blocks(F.col("content")))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def by_id(spark, *texts):
    return {r["id"]: r for r in units.segmented(spark.createDataFrame(list(texts), "stem string, content string")).collect()}


def test_exercises(spark):
    exam = "[PAGE 1]\nhead\n**التمرين الأول** (4 نقاط)\n1) a\n[FIGURE: x\ny]\nالجزء الأول:\n2) b\n[PAGE 2]\nالجزء الثاني (7 نقاط)\nالتمرين التجريبي\ntext\n[PAGE 3]\nالتمرين التجريبي\nmore"
    got = by_id(spark, ("bac_svt_2015_sujet1", exam), ("notes", exam), ("bac_svt_2015_sujet1_and_sujet2", exam), (None, None), ("bac_svt_2016_sujet1", None))
    assert sorted(got) == ["bac_svt_2015_sujet1__ex1", "bac_svt_2015_sujet1__ex2"]
    a, b = got["bac_svt_2015_sujet1__ex1"], got["bac_svt_2015_sujet1__ex2"]
    assert (a["points"], a["points_source"], a["pages"], a["subparts"], [i["label"] for i in a["items"]], a["figures"]) == (4.0, "heading", [1], ["الجزء الأول"], ["1", "2"], ["[FIGURE: x\ny]"])
    assert (b["part"], b["exercise_index"], b["points"], b["points_source"], b["pages"]) == ("الجزء الثاني", 9, 7.0, "part", [2, 3]) and b["text"].endswith("more")


def test_missing_headings_and_foreign_topics(spark):
    long_ = "جواب طويل جدا عن السؤال المطروح. " * 15
    key = f"[PAGE 1]\n{long_}\nالتمرين الثاني\nx\nالموضوع الثاني\nالتمرين الأول\ny"
    got = by_id(spark, ("bac_math_2012_sujet1_solution", key), ("bac_math_2013_sujet1_solution", "[PAGE 1]\nonly text\n[PAGE 2]\nmore"), ("bac_math_2014_sujet1", "[PAGE 1]\nonly text"))
    assert got["bac_math_2012_sujet1_solution__ex1"]["heading_inferred"] and got["bac_math_2012_sujet1_solution__ex1"]["exercise_index"] == 1
    assert got["bac_math_2012_sujet1_solution__ex2"]["text"] == "التمرين الثاني\nx" and len(got) == 3
    assert got["bac_math_2013_sujet1_solution__ex1"]["whole_document"] and got["bac_math_2013_sujet1_solution__ex1"]["pages"] == [1, 2]


def test_sections(spark):
    passage = "Un long texte qui parle de beaucoup de choses et qui continue encore. " * 8
    french = f"[PAGE 1]\nRépublique Algérienne\n{passage}\nI. Compréhension de l'écrit (14 points)\n1. Dites\n[PAGE 2]\nII. Production écrite : 6 pts\nR"
    english = "[PAGE 1]\nPart One: Reading (15 pts)\n1. Read\nB) Text Exploration\n2. Find\nPart Two: Written Expression\nWrite"
    late = f"[PAGE 1]\nProduction écrite\n{passage}\n{passage}\nCompréhension\n1. a"
    got = by_id(spark, ("bac_francais_2015_sujet1", french), ("bac_english_2015_sujet1", english), ("bac_english_2016_sujet1_solution", "[PAGE 1]\nPart one\n1) T (0.5 each) Text exploration: 7 pts 1) a"), ("bac_francais_2009_sujet2", late), ("bac_arabe_2015_sujet1", "[PAGE 1]\nx"))
    keys = lambda stem: [r["section_key"] for r in sorted((r for r in got.values() if r["stem"] == stem), key=lambda r: r["ix"])]
    assert keys("bac_francais_2015_sujet1") == ["text", "comprehension", "production"] and keys("bac_english_2015_sujet1") == ["reading", "exploration", "writing"]
    assert keys("bac_english_2016_sujet1_solution") == ["reading", "exploration"] and keys("bac_francais_2009_sujet2") == ["text", "comprehension"] and keys("bac_arabe_2015_sujet1") == ["whole"]
    french_ = {r["section_key"]: r for r in got.values() if r["stem"] == "bac_francais_2015_sujet1"}
    assert (french_["comprehension"]["points"], french_["production"]["points"], french_["text"]["heading_inferred"]) == (14.0, None, True)


def test_captions_reports_and_sanity(spark):
    df = units.segmented(spark.createDataFrame([("bac_svt_2015_sujet1", "[PAGE 1]\nالتمرين الأول (4 نقاط)\na\n[PAGE 2]\nb"), ("bac_svt_2015_sujet1_solution", "[PAGE 1]\nالتمرين الأول\na\nالتمرين الثاني\nb")], "stem string, content string")).cache()
    captions = spark.createDataFrame([("bac_svt_2015_sujet1", 2, "c2", "graph"), ("bac_svt_2015_sujet1", 1, "c1", None), ("bac_svt_2015_sujet1", 1, "p", "full_page_text")], "stem string, page_num int, caption_file string, content_type string")
    assert {r["id"]: r["captions"] for r in units.with_captions(df, captions).collect()}["bac_svt_2015_sujet1__ex1"] == ["c1", "c2"]
    assert sorted(tuple(r) for r in units.report(df).collect()) == [("svt", "exam", "1", 1, 1, 0, 0), ("svt", "solution", "2", 1, 2, 0, 0)]
    assert [tuple(r) for r in units.sanity(df).collect()] == [("bac_svt_2015_sujet1", True, 1, 2)]


def test_alignment(spark):
    items = [("1", "1) Calculer la vitesse moyenne du mobile $v_0$"), ("2", "2) Intro:"), ("2.1", "2.1) Donner la masse du solide"), ("2.2", "2.2) Tracer le graphe"), ("3", "3) Citer trois planètes connues")]
    key = "1) la vitesse moyenne du mobile est $v_0 = 3$\n2.1) la masse du solide est 4 kg\n2.2) graphe\n9) rien de commun avec cela ici"
    pairs = spark.createDataFrame([("u", items, key), ("w", items[:1], None), ("x", [], key)], "unit_id string, items array<struct<label:string,text:string>>, solution string")
    got = {r["qid"]: r for r in align.aligned(pairs).collect()}
    assert {q: (r["match"], r["answer_label"]) for q, r in got.items() if r["unit_id"] == "u"} == {
        "u__q1": (got["u__q1"]["match"], "1"), "u__q2": ("parent_stub", None), "u__q2.1": (got["u__q2.1"]["match"], "2.1"), "u__q2.2": (got["u__q2.2"]["match"], "2.2"), "u__q3": ("none", None),
    }
    assert got["u__q1"]["match"] in ("strong", "good") and got["w__q1"]["match"] == "none" and not any(q.startswith("x") for q in got)
    assert each(spark, "double", (0.6, 0.59, 0.4, 0.39, None), align.matched(F.col("x"))) == ["strong", "good", "good", "label_supported", "none"]
    both = each(spark, ROWS, [[("1", "a"), ("2", "b")]], align.answers_by_labels(F.array(*(F.struct(F.lit("1").alias("label"), F.lit(t).alias("text")) for t in "qr")), F.col("x")))
    assert both == [["a", None]]
    again = spark.createDataFrame([("v", items[:2] + items[:1], None)], pairs.schema)
    assert sorted(r["qid"] for r in align.aligned(again).collect()) == ["v__q1", "v__q1#2", "v__q2"]


def test_embeddings_are_cached(spark):
    texts = spark.createDataFrame([("a b",), ("a b",), ("c",), (None,)], "text string")
    first = align.embedded(texts).cache()
    assert first.count() == 2 and align.embedded(texts, first).count() == 0
    assert abs(sum(x * x for x in first.first()["vector"]) - 1) < 1e-5


def test_exam_copies_and_counts(spark):
    texts = spark.createDataFrame([("m", "same text " * 20), ("m_solution", "same text " * 20), ("n", "abc def " * 9), ("n_solution", "zzzz 9999"), ("o_solution", "x")], "stem string, content string")
    assert [r["stem"] for r in linking.exam_copies(texts).collect()] == ["m_solution"]
    n = spark.createDataFrame([("a_session1", "التمرين الأول التمرين الثاني التمرين الثالث"), ("a_solution_session1", "التمرين الأول"), ("b", "التمرين الأول"), ("b_solution", "none")], "stem string, content string")
    assert [tuple(r) for r in linking.exercise_counts(n).collect()] == [("a_session1", "a_solution_session1", 3, 1)]
    overrides = spark.createDataFrame([("u__ex1__q2", None), ("u__ex1__q9", None)], "qid string, blocks array<int>")
    blocks = spark.createDataFrame([("u__ex1", 0, "1", "1) a\n2) b"), ("u__ex2", 0, "9", "9) c")], "unit_id string, block int, label string, text string")
    assert [tuple(r) for r in linking.answers_after_all(overrides, blocks).collect()] == [("u__ex1__q2", "u__ex1", 0)]
    assert linking.answers_after_all(overrides, blocks, True).count() == 2


def test_column_forms(spark):
    df = spark.createDataFrame([("2) احسب", "1) a\n2) b", "2"), (None, None, None)], "line string, text string, label string")
    got = df.select(labels.item_label(F.col("line")).alias("l"), labels.items(F.col("text"), F.lit(False)).alias("i"), labels.blocks(F.col("text")).alias("b"), labels.block_mentions(F.col("label"), F.col("text")).alias("m"), labels.is_question(F.col("text")).alias("q"), labels.cleaned(F.col("text")).alias("c"), labels.seen_lines(F.col("text")).alias("v")).collect()
    assert got[0]["l"] == "2" and len(got[0]["i"]) == 2 and got[0]["m"] and got[0]["v"] == ["1) a", "2) b"] and all(x is None for x in got[1])
