import struct

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from paperloom.functions import names, quality, repair, replies
from paperloom.operators import audit, figures, overlay, reports, sequences
from paperloom.sources import files, models, settings


def test_settings(spark, monkeypatch):
    monkeypatch.setenv("MODEL", "from-env")
    spark.conf.set("paperloom.provider", "from-conf")
    got = settings.load(spark, "# note\nPROVIDER=x\nMODEL = y\nBASE_URL=http://z\nbroken")
    spark.conf.unset("paperloom.provider")
    assert (got.provider, got.model, got.base_url, got.embedding_model) == ("from-conf", "from-env", "http://z", "intfloat/multilingual-e5-large")


def test_missing_paths_captions_and_replacement(spark, tmp_path):
    schema = StructType([StructField("n", IntegerType())])
    assert files.json_entries(spark, str(tmp_path / "none"), schema).columns == ["key", "n"]
    (tmp_path / "c").mkdir()
    for name, text in (("a.json", '{"description": "x", "is_decorative": false}'), ("b.json", '{"description": "y", "is_decorative": true}'), ("index.json", '{"description": "z"}'), ("d.json", "{broken")):
        (tmp_path / "c" / name).write_text(text)
    assert [r["caption_file"] for r in files.captions(spark, str(tmp_path / "c"), "description string, is_decorative boolean").collect()] == ["a.json"]
    path = str(tmp_path / "table")
    for n in (3, 5):
        files.replaced(spark.range(n), path)
    files.replaced(spark.read.parquet(path).filter("id > 2"), path)  # onto what it is read from
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [3, 4]
    assert not (tmp_path / "table.new").exists() and not (tmp_path / "table.old").exists()


def test_readers_and_models(spark):
    numbers = spark.createDataFrame([("a", bytearray(struct.pack("3B", 1, 2, 3))), ("b", None)], "path string, content binary")
    assert [tuple(r) for r in models.extracted(numbers, lambda b: [{"page": i, "n": x} for i, x in enumerate(b)], "page int, n int").collect()] == [("a", 0, 1), ("a", 1, 2), ("a", 2, 3)]
    assert bytes(models.rendered(spark.createDataFrame([("x", 2)], "name string, k int"), lambda k: b"p" * k, ["k"]).first()["png"]) == b"pp"
    rows = spark.createDataFrame([(str(i), f"t{i}") for i in range(6)], "key string, text string")

    def call(model, row):
        if model == "first":
            raise RuntimeError("404 gone")
        if row[0] == "t3":
            raise RuntimeError("bad")
        return row[0].upper(), 1_000_000, 0

    got = {r["key"]: (r["status"], r["reply"], r["model"]) for r in models.answered(rows, "key", ["text"], call, ["first", "second"], price_in=1.0, budget=4.0, sleep=lambda s: None).collect()}
    assert sum(s == "OK" for s, _, _ in got.values()) == 4 and {m for s, _, m in got.values() if s == "OK"} == {"second"} and all(s in ("OK", "ERROR", "BUDGET_STOP") for s, _, _ in got.values())
    assert models.wait_after("429 please retry in 7.5 s", 0) == 9.5 and models.wait_after("503", 9) == 30.0 and models.wait_after("400", 0) is None


def test_replies(spark):
    rows = [("```json\n{\"n\": 1}\n```", 1), ('well: {"n": 2} ok', 2), ("none", None), ('{"n": 3, "t": "\\\\frac{a}"}'.replace("\\\\", "\\"), 3), (None, None)]
    got = spark.createDataFrame(rows, "t string, n int").select(replies.json_of(F.col("t"), "n int, t string").alias("j"), "n").collect()
    assert [r["j"] and r["j"]["n"] for r in got] == [r["n"] for r in got]
    waits = spark.createDataFrame([("429 retry in 3 s", 0), ("RESOURCE_EXHAUSTED", 0), ("503", 1), ("400", 0)], "e string, a int").select(replies.retry_after(F.col("e"), F.col("a")).alias("w")).collect()
    assert [r["w"] for r in waits] == [5.0, 62.0, 8.0, None]


def test_figures_in_markup(spark):
    cases = {
        "a ![graph](data:x) b <svg><p>x</p></svg> <img src=q alt=\"Force F\"> ```txt\n|-- Vitesse 12 m --|\n``` \\begin{tikzpicture}node A1 Rayon\\end{tikzpicture}":
            "a [FIGURE] b [FIGURE] [FIGURE: Force F] [FIGURE: ASCII rendition removed; labels: Vitesse, 12 m] [FIGURE: labels: begin, tikzpicture, node, A1, Rayon, end]",
        "x\n```\nAB\n[PAGE 2]\ny\n```\nz": "x\n[FIGURE: ASCII rendition removed; labels: AB]\n[PAGE 2]\ny\n[FIGURE: ASCII rendition removed]",
        "plain": "plain", "": "", "```": "", "a\n```\n![graph](q) bc\n```\nd": "a\n[FIGURE: ASCII rendition removed; labels: graph, bc]\nd", "x ```one``` y": "x [FIGURE: ASCII rendition removed] y", "![](q)![Coupe  A](r)": "[FIGURE][FIGURE: Coupe  A]",
    }
    got = spark.createDataFrame([(t,) for t in cases], "t string").select("t", repair.figures(F.col("t")).alias("f")).collect()
    assert {r["t"]: r["f"] for r in got} == cases
    assert spark.createDataFrame([(None,)], "t string").select(repair.figures(F.col("t")).alias("f")).first()["f"] is None


def test_repeated_lines_of_a_long_text(spark):
    import time

    from paperloom.functions import quality

    text = "\n".join(f"a line of a document that is long enough to count: {i % 15_000}" for i in range(20_000))
    df = spark.createDataFrame([(text,), ("short\nshort",), (None,)], "t string").select(F.size(quality.repeated_lines(F.col("t"))).alias("n"))
    df.collect()
    began = time.perf_counter()
    assert [r["n"] for r in df.collect()][:2] == [5000, 0] and time.perf_counter() - began < 2


def test_boxes(spark):
    def grown(boxes, gap):
        """The same by joining any two until none are near."""
        now = [(b, 1) for b in boxes]
        while True:
            pair = next(((i, j) for i in range(len(now)) for j in range(i + 1, len(now)) if figures._touch(now[i][0], now[j][0], gap)), None)
            if pair is None:
                return sorted(now)
            i, j = pair
            joined = (figures._around(now[i][0], now[j][0]), now[i][1] + now[j][1])
            now = [x for k, x in enumerate(now) if k not in pair] + [joined]

    import random

    rng = random.Random(1)
    for _ in range(40):
        boxes = [(x, y, x + rng.randrange(1, 9), y + rng.randrange(1, 9)) for x, y in ((float(rng.randrange(60)), float(rng.randrange(60))) for _ in range(25))]
        assert figures.clusters(boxes, 2.0) == grown(boxes, 2.0)
    images = [("a", 1, 0.0, 0.0, 50.0, 50.0, "GRAPH"), ("a", 1, 60.0, 0.0, 100.0, 50.0, "TEXTUAL"), ("a", 1, 300.0, 300.0, 390.0, 390.0, "LOGO"), ("a", 1, 400.0, 0.0, 420.0, 20.0, "GRAPH"), ("b", 1, 0.0, 0.0, 580.0, 780.0, "TABLE")]
    df = spark.createDataFrame([(*r, 600.0, 800.0) for r in images], "stem string, page int, x0 double, y0 double, x1 double, y1 double, category string, width double, height double")
    got = sorted(tuple(r) for r in figures.figures(df).collect())
    assert got == [("a", 1, 0.0, 0.0, 106.0, 56.0, False), ("b", 1, 0.0, 0.0, 586.0, 786.0, True)]
    paths = [("a", 1, 100.0, 100.0, 200.0, 200.0, 14), ("a", 1, 95.0, 95.0, 205.0, 96.0, 0), ("a", 1, 400.0, 400.0, 480.0, 480.0, 13), ("a", 1, 500.0, 10.0, 560.0, 60.0, 2)]
    known = spark.createDataFrame([("a", 1, 390.0, 390.0, 500.0, 500.0)], "stem string, page int, x0 double, y0 double, x1 double, y1 double")
    vector = figures.vector_figures(spark.createDataFrame([(*r, 600.0, 800.0) for r in paths], "stem string, page int, x0 double, y0 double, x1 double, y1 double, weight int, width double, height double"), known)
    assert [tuple(r) for r in vector.collect()] == [("a", 1, 77.0, 77.0, 223.0, 218.0, False)]
    segments = [("l", 0.0, 0.0, 5.0, 5.0), ("l", 0.0, 0.0, 5.0, 0.0), ("c", 0.0, 0.0, 1.0, 1.0)]
    w = spark.createDataFrame([(segments, 50.0, 50.0), (segments * 3, 10.0, 10.0), (segments, 590.0, 790.0)], "s array<struct<op:string,x0:double,y0:double,x1:double,y1:double>>, w double, h double")
    assert [r["n"] for r in w.select(figures.graphic_weight(F.col("s"), F.col("w"), F.col("h"), F.lit(600.0), F.lit(800.0)).alias("n")).collect()] == [2, 0, 0]


def test_lines_of_characters(spark):
    chars = [(0, "c", 3.0, 10.0), (1, "a", 1.0, 10.4), (2, "b", 2.0, 9.9), (3, "1", 1.0, 30.0), (4, "2", 2.0, 30.0), (5, "م", 3.0, 30.0), (6, "ا", 4.0, 30.0), (7, "ل", 5.0, 30.0), (8, " ", 1.0, 50.0)]
    df = spark.createDataFrame([("s", 1, i, t, x, y) for i, t, x, y in chars], "stem string, page_num int, seq int, text string, x0 double, top double")
    assert sequences.page_lines(df).first()["text"] == "abc\nلام12"


def test_pages_of_text(spark):
    rows = [("svt", "x", True), ("svt", "كلمة طويلة " * 12, False), ("svt", "plain latin text " * 10, True), ("francais", "plain latin text " * 10, False), ("svt", "ا ب ت ث " * 30, True)]
    got = spark.createDataFrame(rows, "s string, t string, low boolean").select(quality.low_quality(F.col("t"), F.col("s")).alias("x"), "low").collect()
    assert all(r["x"] == r["low"] for r in got)
    runs = spark.createDataFrame([("التمرين 12 في 2015 و 05 و 012 و 4321 و 99",), (None,)], "t string").select(quality.digit_runs(F.col("t")).alias("x")).collect()
    assert [(x["number"], x["reason"]) for x in runs[0]["x"]] == [("12", "near a section"), ("05", "leading zero"), ("012", "leading zero"), ("99", "near a section")] and runs[1]["x"] == []
    marks = spark.createDataFrame([(bytearray(b"\xef\xbb\xbf[PAGE 1]"), "[PAGE 1]\nx [PAGE 9]\n[PAGE 3]"), (bytearray(b""), "[PAGE 1]\n[PAGE 2]")], "r binary, c string").select(F.transform(quality.file_marks(F.col("r"), F.col("c")), lambda x: x["tag"]).alias("x")).collect()
    assert [r["x"] for r in marks] == [["bom", "page_markers", "stray_marker_in_body"], []]
    ends = spark.createDataFrame([("cut off here", True), ("ends here.", False), ("text\nPage 2 / 4", False), ("x" * 200, False), ("", False)], "t string, e boolean").select(quality.truncated(F.col("t")).alias("x"), "e").collect()
    assert all(r["x"] == r["e"] for r in ends)
    side = "ا ب ج\nد ه و\nplain line of words"
    assert abs(spark.createDataFrame([(side,)], "t string").select(quality.suspicious_share(F.col("t")).alias("x")).first()["x"] - 2 / 3) < 1e-9
    assert spark.createDataFrame([(side,)], "t string").select(quality.without_side_bars(F.col("t")).alias("x")).first()["x"].startswith("[PAGE REPROCESS")
    score = spark.createDataFrame([(False, 0.9, 500), (False, 0.7, 100), (True, 0.0, 0)], "f boolean, c double, n int").agg(quality.quality_score(F.col("f"), F.col("c"), F.col("n")).alias("q")).first()["q"]
    assert abs(score - round(0.6 * 0.8 + 0.4 * 0.6, 4)) < 1e-9


def test_crops(spark):
    box = spark.createDataFrame([((10.0, 700.0, 110.0, 790.0),), ((5.0, 5.0, 5.0, 9.0),), ((0.0, 0.0, 600.0, 790.0),)], "b struct<x0:double,y0:double,x1:double,y1:double>")
    got = [r["c"] and tuple(r["c"]) for r in box.select(names.crop(F.col("b"), F.lit(600.0), F.lit(800.0), F.lit(2.0)).alias("c")).collect()]
    assert got == [(20, 20, 220, 200, False), None, (0, 20, 1200, 1600, True)]


def test_images_and_captions(spark):
    images = spark.createDataFrame([("bac_svt_2010_sujet1_page1_img1.png", 5, bytearray(b"\x89PNG")), ("bac_svt_2010_sujet1_page1_img2.png", 0, None), ("other.png", 4, bytearray(b"GIF8"))], "filename string, size_bytes long, magic binary")
    stems = spark.createDataFrame([("bac_svt_2010_sujet1",)], "stem string")
    assert sorted(tuple(r) for r in audit.image_problems(images, stems).collect()) == [("bac_svt_2010_sujet1_page1_img2.png", "zero_size"), ("other.png", "bad_header"), ("other.png", "orphan")]
    captions = [("bac_svt_2010_sujet1_page1_img1.json", "d/bac_svt_2010_sujet1_page1_img1.png", "x", "bac_svt_2010_sujet1", 1), ("b.json", None, None, None, None), ("c.json", "d/none.png", " ", "none", 1)]
    got = sorted(tuple(r) for r in audit.caption_problems(spark.createDataFrame(captions, "caption_file string, image_file string, description string, stem string, page_num int"), images).collect())
    assert got == [("b.json", "bad_json"), ("c.json", "broken_reference"), ("c.json", "empty_description"), ("c.json", "other_name")]
    listed = spark.createDataFrame([("svt", "a.png"), ("svt", "b.png"), ("math", None)], "subject string, image_path string")
    cover = {r["subject"]: (r["n"], r["on_disk"], r["missing"], r["sample"]) for r in audit.image_coverage(listed, spark.createDataFrame([("a.png",)], "image_path string")).collect()}
    assert cover == {"svt": (2, 1, 1, ["b.png"]), "math": (1, 0, 0, None), None: (3, 1, 1, None)}


def test_merges(spark):
    overrides = spark.createDataFrame([("u__q1", [0], "old", "me", None)], "qid string, blocks array<int>, note string, by string, from_unit string")
    new = spark.createDataFrame([("u__q1", None, "gone", "me", None), ("u__q2", [1], "b", "me", "w")], overrides.schema)
    merged, log = overlay.override_set(overrides, spark.createDataFrame([("u__q1", "good", "1", "x")], "qid string, match string, answer_label string, answer string"), new)
    assert {r["qid"]: r["note"] for r in merged.collect()} == {"u__q1": "gone", "u__q2": "b"}
    assert {r["qid"]: (r["match"], r["previous_note"]) for r in log.collect()} == {"u__q1": ("solution_missing", "old"), "u__q2": ("human", None)}
    calls = spark.createDataFrame([(i, 1.0) for i in range(5)], "ts int, usd double")
    assert overlay.within_budget(calls, "ts", "usd", 2.5).count() == 3
    work = spark.createDataFrame([("a",), ("b",), ("c",)], "path string")
    done = spark.createDataFrame([("a", 0.0, False), ("b", None, True), ("c", 0.5, False)], "path string, quality_score double, skipped boolean")
    assert [r["path"] for r in overlay.retry(work, done, "path").collect()] == ["a"]
    first, twice = overlay.first_of_each(spark.createDataFrame([("k", 2, "y"), ("k", 1, "x"), ("l", 1, "z")], "k string, i int, v string"), "k", "i")
    assert sorted(r["v"] for r in first.collect()) == ["x", "z"] and [tuple(r) for r in twice.collect()] == [("k", 2)]
    filled = overlay.with_fallback(work, spark.createDataFrame([("a", "1")], "path string, v string"), spark.createDataFrame([("a", "2"), ("b", "3")], "path string, v string"), "path", "v")
    assert {r["path"]: r["v"] for r in filled.collect()} == {"a": "1", "b": "3", "c": None}
    caption = spark.createDataFrame([(("t", "d"), ("", "new"))], "a struct<k:string,d:string>, b struct<k:string,d:string>").select(repair.merged_fields(F.col("a"), F.col("b"), ["k", "d"]).alias("m")).first()["m"]
    assert tuple(caption) == ("t", "new")


def test_samples_and_orders(spark):
    questions = spark.createDataFrame([(f"q{i}", "math" if i < 30 else "svt", ("strong", "good", "legend")[i % 3]) for i in range(40)], "qid string, subject string, match string")
    seen = spark.createDataFrame([("q0",), ("q1",)], "qid string")
    got = reports.audit_sample(questions, seen, 2, 6)
    rows = [tuple(r) for r in got.collect()]
    assert sorted(rows) == sorted(tuple(r) for r in reports.audit_sample(questions.repartition(3), seen, 2, 6).collect())
    assert not {"q0", "q1"} & {r[0] for r in rows} and all(r[2] != "legend" for r in rows) and sum(r[1] == "math" for r in rows) == 6
    assert min(sum(r[1] == "math" and r[2] == c for r in rows) for c in ("strong", "good")) >= 2
    ranked = reports.tiers(spark.createDataFrame([(i, "full_page_text" if i % 2 else "graph") for i in range(100)], "id int, k string"), "k", {"graph": 0, "full_page_text": 4}, "full_page_text")
    assert ranked.groupBy("tier").count().orderBy("tier").collect()[1]["count"] == 40
    nulls = spark.createDataFrame([(None,), (2,), (-1,)], "n int")
    assert [r["n"] for r in reports.nulls_as(nulls, ["n"]).collect()] == [-1, None, 2] and [r["n"] for r in reports.nulls_last(nulls, ["n"]).collect()] == [-1, 2, None]
    assert [r["n"] for r in reports.head(nulls, [F.desc("n")], 1).collect()] == [2]
    q = spark.createDataFrame([("u__q1", "u", 0, "q", "a", "good", 1.0)], "qid string, unit_id string, ix int, question string, answer string, match string, label_agree double")
    sheet = reports.sheet(q, spark.createDataFrame([("u", 0, "1", "a")], "unit_id string, block int, label string, text string")).first()["text"]
    assert sheet == "q1 [good] q -> a\n  [0] a1: a"
    decided = reports.decisions(q, q.withColumn("answer", F.lit("b")), spark.createDataFrame([("u__q1", [0], "why", "me")], "qid string, blocks array<int>, note string, by string")).first()
    assert decided["changed"] and decided["reason"] == "why"


def test_rolled_up(spark):
    got = {r["name"]: (r["severity"], r["n"]) for r in audit.rolled_up({"a": ("FINDING", spark.range(2)), "b": ("WARN", spark.range(0))}).collect()}
    assert got == {"a": ("FINDING", 2), "b": ("OK", 0)}
    sides = {"m": spark.createDataFrame([("x",), ("y",)], "k string"), "t": spark.createDataFrame([("x",)], "k string")}
    assert [tuple(r) for r in audit.key_differences(sides, "k").collect()] == [("y", True, False)]
