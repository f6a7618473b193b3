import numpy as np
from pyspark.sql import functions as F

from paperloom.functions import text as T
from paperloom.operators import align, catalog, figures, overlay, sequences


def test_manifest(spark):
    names = ["bac_egnlish_٢٠١٩_sujet1.pdf", "bac_math_2016_sujet2_solution_session2.pdf", "bac_svt_2014_sujet1_and_sujet2.pdf", "bac_latin_2014_sujet1.pdf", "notes.pdf"]
    rows = {r["filename"]: r for r in catalog.manifest(spark.createDataFrame([(n,) for n in names], "filename string")).collect()}
    a, b, c, d, e = (rows[n] for n in names)
    assert (a["subject"], a["year"], a["family"], a["type"]) == ("english", 2019, "A", "exam")
    assert (b["family"], b["session"], b["session_type"]) == ("B", 2, "reexam")
    assert (c["family"], c["topic_choice"], c["duplicate"], c["censored"]) == ("C", "both", True, True)
    assert d["subject"] is None and e["subject"] is None and a["era"] == "stable"
    years = catalog.year_regimes(spark)
    assert {r["era"] for r in years.filter("year >= 2023").collect()} == {"modern"} and catalog.training_years(years).count() == 18
    assert {r["year"] for r in catalog.two_sessions(years).collect()} == {2016, 2017} and catalog.year(years, 2020)["completion_pct"] == 65.0


def test_coverage(spark):
    files = spark.createDataFrame([("bac_math_2019_sujet1.pdf",)], "filename string")
    assert catalog.coverage(catalog.manifest(files)).first()["missing"] == ["topic1_solution", "topic2_exam", "topic2_solution"]


def test_scripts_and_normal_form(spark):
    texts = ["", "12 34", "مرحبا", "hello", "éèà"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", T.script(F.col("t")).alias("s")).orderBy("i")
    assert [r["s"] for r in df.collect()] == ["unknown", "unknown", "arabic", "latin", "unknown"]
    one = spark.createDataFrame([("a​bـ  c\n\n\n\nﬁ ",)], "t string").select(T.normalized(F.col("t")).alias("n"), T.restored_digits(F.lit("ab 321 c")).alias("d")).first()
    assert (one["n"], one["d"]) == ("ab c\n\nfi", "ab 123 c")


def test_labels(spark):
    rows = [("2.1", "1.2", 1.0), ("2", "2.2", 0.5), ("3", "4", 0.0), (None, "1", 0.0)]
    got = spark.createDataFrame(rows, "a string, b string, e double").select(T.label_agreement(F.col("a"), F.col("b")).alias("x"), "e").collect()
    assert all(r["x"] == r["e"] for r in got)


def test_verdicts(spark):
    rows = [("SEMANTIC_VERDICT:FAITHFUL", "FAITHFUL"), ("it is CORRUPTED", "CORRUPTED"), ("blah", "UNCLEAR")]
    got = spark.createDataFrame(rows, "t string, e string").select(T.verdict(F.col("t"), "SEMANTIC_VERDICT", "FAITHFUL", "CORRUPTED").alias("v"), "e").collect()
    assert all(r["v"] == r["e"] for r in got)


def test_pages(spark):
    df = spark.createDataFrame([("s", "x\n[PAGE 1]\na\n[PAGE 2]\nb\n[PAGE 1]\nc\nd"), ("t", "none")], "stem string, content string")
    assert {(r["page_num"], r["text"]) for r in sequences.pages_of(df).collect()} == {(1, "c\nd"), (2, "b")}


def test_runs_and_gaps(spark):
    df = spark.createDataFrame([(1, i, n) for i, n in enumerate([1, 2, 5, 3, 1])], "u int, i int, n int")
    assert [r["run"] for r in sequences.runs(df, "u", "i", "n").orderBy("i").collect()] == [1, 1, 1, 2, 3]
    assert [r["after"] for r in sequences.gaps(spark.createDataFrame([(1, 1), (1, 2), (1, 4)], "u int, n int"), "u", "n").collect()] == [2]


def test_upsert(spark):
    prior = spark.createDataFrame([(1, "a", False), (2, "b", False)], "k int, v string, skipped boolean")
    new = spark.createDataFrame([(1, "x", True), (2, "y", False), (3, "z", False)], prior.schema)
    assert {(r["k"], r["v"]) for r in overlay.upsert(prior, new, ["k"], F.col("skipped")).collect()} == {(1, "a"), (2, "y"), (3, "z")}


def monotone(spark, *cases):
    rows = [(i, score.tolist(), (np.zeros(score.shape, bool) if again is None else again).tolist()) for i, (score, again) in enumerate(cases)]
    got = align.monotone(spark.createDataFrame(rows, "i int, score array<array<double>>, again array<array<boolean>>")).collect()
    return [r["k"] for r in sorted(got, key=lambda r: r["i"])]


def test_monotone(spark):
    cases = [([[0.1, 0.9], [0.8, 0.2]], None), ([[0.5, 0.5], [0.0, 0.5]], None), ([[0.6], [0.6]], None), ([[0.6], [0.6]], [[False], [True]]), ([[0.0, 0.0], [0.0, 0.0]], None)]
    got = monotone(spark, *((np.array(a), None if b is None else np.array(b)) for a, b in cases), (np.zeros((1, 0)), None), (np.zeros((0, 0)), None))
    assert got == [[1, -1], [0, 1], [0, -1], [0, 0], [-1, -1], [-1], []]


def test_monotone_against_its_definition(spark):
    from functools import cache

    rng, cases, wanted = np.random.default_rng(3), [], []
    for _ in range(300):
        n, m = int(rng.integers(1, 6)), int(rng.integers(1, 6))
        score = np.where(rng.random((n, m)) < 0.6, rng.integers(1, 9, (n, m)) / 10, 0.0)
        again = rng.random((n, m)) < 0.3

        @cache
        def best(rows, columns, score=score, again=again):
            """(sum, column of the last row or None) over the first rows and columns."""
            if not rows:
                return 0.0, None
            options = [(best(rows - 1, columns)[0], 1, 0, None)]
            for k in range(columns):
                before, last = best(rows - 1, k + 1)
                if score[rows - 1, k] > 0 and (last != k or again[rows - 1, k]):
                    options.append((before + score[rows - 1, k] - align.AGAIN * (last == k), 0, -k, k))
            top = max(options, key=lambda o: (round(o[0], 9), o[1], o[2]))
            return top[0], top[3]

        columns, expected = m, [-1] * n
        for i in range(n, 0, -1):
            k = best(i, columns)[1]
            if k is not None:
                expected[i - 1], columns = k, k + 1
        first = {}
        for i, k in enumerate(expected):
            if k >= 0 and first.setdefault(k, i) != i and not again[i, k]:
                expected[i] = -1
        cases.append((score, again))
        wanted.append(expected)
    assert monotone(spark, *cases) == wanted


def test_clusters(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0), (1, 1.5, 0.0, 2.0, 1.0), (1, 9.0, 9.0, 10.0, 10.0)], "page long, x0 double, y0 double, x1 double, y1 double")
    assert sorted(r["n"] for r in figures.rect_clusters(df, 0.6).collect()) == [1, 2]


def test_stubs_and_shared_answers(spark):
    from paperloom.operators import sequences

    rows = spark.createDataFrame([("u", 1, "2", "same"), ("u", 2, "2.1", "same"), ("u", 3, None, None), ("v", 1, "2", "same"), ("v", 2, "21", None)], "u string, i int, label string, a string")
    stubs = {(r["u"], r["i"]) for r in sequences.parent_stubs(rows, "u", ["i"], "label").collect() if r["stub"]}
    shared = {(r["u"], r["i"]) for r in sequences.shared_answers(rows, "u", ["i"], "a").collect() if r["shared"]}
    assert stubs == {("u", 1)} and shared == {("u", 2)}


def test_nearest_vectors_in_many_blocks(spark, monkeypatch):
    from paperloom.operators import vectors

    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(300, 5)), 1)
    x[10:20] = x[:10]  # ties
    x[7] = 0
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(999, None)], "id long, vector array<double>").repartition(5)
    unit = x / np.where((n := np.linalg.norm(x, axis=1, keepdims=True)) > 0, n, 1)
    want = {}
    for q in range(0, 300, 7):
        if q != 7:
            best = sorted((-round(float(unit[q] @ unit[i]), 6) + 0.0, i) for i in range(300) if i not in (q, 7))[:4]
            want[q] = [i for _, i in best]
    for small, held in ((50_000, 1 << 20), (0, 40)):
        for name, value in (("QUERIES", 5), ("BLOCK", 16), ("BROADCAST_QUERIES", small), ("HELD", held)):
            monkeypatch.setattr(vectors, name, value)
        got = {}
        for r in sorted(vectors.nearest(rows.filter("id % 7 = 0"), rows, 4).collect(), key=lambda r: (r["q"], -r["cos"], r["id"])):
            got.setdefault(r["q"], []).append(r["id"])
        assert got == want
    assert vectors.nearest(rows.limit(0), rows, 4).count() == 0


def test_indexed_candidates_against_all_pairs(spark):
    import random

    rng = random.Random(6)
    common = [f"c{i}" for i in range(6)]
    side = lambda n: [(u, i, sorted({*rng.sample(common, rng.randrange(0, 5)), *(f"w{rng.randrange(40)}" for _ in range(rng.randrange(0, 5)))})) for u in range(3) for i in range(n)]
    a, b = side(40), side(40)
    q, blocks = spark.createDataFrame(a + [(None, 1, ["c0"])], "unit int, q int, words array<string>"), spark.createDataFrame(b, "unit int, b int, words array<string>")
    for least in (0.2, 0.5, 0.8, 1.0):
        want = {(u, i, j) for u, i, x in a for v, j, y in b if u == v and x and y and len({*x} & {*y}) / (len(x) * len(y)) ** 0.5 >= least}
        assert {(r["unit"], r["q"], r["b"]) for r in align.indexed(q, blocks, least).collect()} == want and want
    # pairs that meet are far fewer than the units' products where the threshold is high
    plan = align.indexed(q, blocks, 0.8)
    assert plan.count() < 0.05 * 3 * 40 * 40 and align.indexed(q.limit(0), blocks, 0.5).count() == 0
