from pyspark.sql import functions as F

from paperloom.operators import formulas, segments


def test_slips(spark):
    rows = [
        ("3 × 4 = 12, and 2,5 * 2 = 6", ["product"]), ("8 / 0 = 1", []), ("10 / 3 = 3.3", []), ("", []), (None, None), (r"\frac{6}{4} = 1.5 and \frac{6 \times 2}{4} \approx 4", ["fraction"]),
        (r"\sqrt{16} = 4, \sqrt{2} = 1.5", ["root"]), (r"2 \times 10^{3} \times 3 = 6 \times 10^3", []), (r"-3 \times 2 = 6", ["product"]), ("0.5 × 0 = 0", []), ("2 × 3 = 0", ["product"]),
    ]
    got = spark.createDataFrame(rows, "t string, kinds array<string>").select(F.transform(formulas.slips(F.col("t")), lambda x: x["kind"]).alias("x"), "kinds").collect()
    assert all(r["x"] == r["kinds"] for r in got), got


def test_sign_variants(spark):
    left = spark.createDataFrame([("u", "y = 3x^2 + 1 - 7z"), ("u", "short"), ("v", "y = 3x^2 + 1 - 7z"), ("u", "y = 4x^2 + 1 - 7z"), ("u", None)], "unit string, f string")
    right = spark.createDataFrame([("u", "y = 3x^2 - 1 - 7z"), ("v", "y = 3x^2 + 1 - 7z"), ("u", "y = 4x^3 + 1 - 7z"), ("u", None)], "unit string, f string")
    got = sorted(tuple(r) for r in formulas.sign_variants(left, right, "unit", "f").collect())
    assert got == [("u", "y = 3x^2 + 1 - 7z", "y = 3x^2 - 1 - 7z", "sign"), ("u", "y = 4x^2 + 1 - 7z", "y = 4x^3 + 1 - 7z", "exponent")]


def test_latex(spark):
    rows = [("$x^2$ {a}", False, 0, False), ("$x^ {", True, 1, False), ("a_", False, 0, True), ("a^ $", True, 0, True), ("$$x$$", False, 0, False), ("x_\ny", False, 0, True)]
    df = spark.createDataFrame(rows, "t string, d boolean, b int, h boolean")
    for r in df.select("d", "b", "h", *(c.alias(n) for n, c in formulas.latex_counts(F.col("t")).items())).collect():
        assert (r["odd_dollars"], r["brace_gap"], r["dangling"]) == (r["d"], r["b"], r["h"])
    issues = spark.createDataFrame([("math", "\\frac12 {{{"), ("arabe", "\\frac12 {{{"), ("svt", "fine")], "s string, t string").select(formulas.latex_issues(F.col("t"), F.col("s")).alias("x")).collect()
    assert [r["x"] for r in issues] == [["braces", "bare_fraction"], [], []]


def test_uneven_tables(spark):
    texts = [("|x|y|\n|x|y|\n|x|y|", None), ("|x|\n|x|\n|x|\n|\n|\n|||", (6, 3)), ("no | row\n| neither", None), (None, None), ("prose\n|a|\n |a|b| \n|a|b|c|", (3, 2))]
    got = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "i int, t string").select("i", formulas.uneven_table(F.col("t")).alias("x")).orderBy("i").collect()
    assert [r["x"] and tuple(r["x"]) for r in got] == [x for _, x in texts]


def test_second_readings(spark):
    page = "Soit $x^{2} + 3x = 4$ et $\\frac{a}{b} \\approx 2,5$. Note 0,25"
    rows = [(i, t, page) for i, t in enumerate(("x^2+3x=4", "0.25", "0.75", r"\dfrac{a}{b} = 2.5", "y = sin(z) + 12", "x^2 + 3x = 5"))]
    df = spark.createDataFrame(rows, "i int, t string, p string")
    got = [r["m"] for r in df.select("i", formulas.matched(F.col("t"), F.col("p")).alias("m")).orderBy("i").collect()]
    assert got == [True, True, False, True, False, False]
    items = spark.createDataFrame([("k", "math", "F = 12 N", "F = 11 N"), ("k", "math", "alpha = 3", "alpha = 3"), ("l", "svt", "beta", "none")], "key string, subject string, item string, page string")
    assert sorted(tuple(r) for r in formulas.missing_atoms(items).collect()) == [("k", "math", 1, True), ("l", "svt", 1, False)]


def test_headings(spark):
    rows = [("u", 1, "## **التمرين الأول: (٤ نقاط)**"), ("u", 2, "x | الجزء الثاني (7,5 نقطة)<br>التمرين الثالث"), ("u", 3, "text التمرين الأول"), ("u", 4, None), ("u", 5, "التمربن الخامس")]
    got = {(r["i"], r["kind"]): (r["number"], r["points"]) for r in segments.headings(spark.createDataFrame(rows, "unit string, i int, line string")).collect()}
    assert got == {(1, "exercise"): (1, 4.0), (2, "part"): (2, 7.5), (2, "exercise"): (3, None), (5, "exercise"): (5, None)}


def test_openings(spark):
    numbers = [14, 2, 3, 30, 15, 1, 9, 4, 40]
    rows = [("u", i, n, n == 40) for i, n in enumerate(numbers)] + [("v", 0, None, False)]
    got = [(r["k"], r["n"]) for r in segments.opened(spark.createDataFrame(rows, "unit string, i int, n int, dotted boolean"), ["i"]).orderBy("k").collect()]
    assert got == [(2, 2), (3, 3), (5, 15), (6, 1), (7, 9), (9, 40)]
