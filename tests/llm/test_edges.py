"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names, operator by operator."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.llm import common, decontaminate, html_tree, jaccard_join, licenses, line_frequency, mixing, toxicity, urls, warc

LONG = "word " * 1_000_000


def words(rng, n, vocabulary=3000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def rows_of(df):
    return sorted(map(str, df.collect()))


# ---- URL filters


def test_urls(spark):
    rows = [(None, "http://bad.org/x", 1), (1, "http://BAD.org/x", 1), (1, "http://BAD.org/x", 1), (2, "", 1), (3, "http://" + "a." * 300 + "bad.org", 1), (4, "ftp://bad.org:80/", 1), (5, "http://ok.org/Page?q", 1), (6, "http://ok.org/page", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict int")
    got = urls.judge(pages, spark.createDataFrame([("bad.org",), ("bad.org",), ("OK.org/Page",), (None,)], "key string")).collect()
    assert Counter((r["page_id"], r["listed"]) for r in got) == Counter([(None, True), (1, True), (1, True), (2, False), (3, True), (4, False), (5, True), (6, False)])
    assert urls.judge(pages.limit(0), pages.select(F.col("url").alias("key")).limit(0)).count() == 0


def test_cascade_of_many_levels(spark):
    universe = spark.range(60_000).select(F.concat(F.lit("h"), F.col("id")).alias("key"))
    listed = universe.filter("crc32(cast(key as binary)) % 16 = 0")
    cascade = urls.build(listed, universe)
    pdf = universe.select("key", F.xxhash64("key").alias("a"), F.xxhash64("key", F.lit("second")).alias("b")).toPandas()
    assert len(cascade.levels) >= 3
    assert set(pdf["key"][cascade.member(pdf["a"].to_numpy(), pdf["b"].to_numpy())]) == {r["key"] for r in listed.collect()}


# ---- HTML


def page_of(rng):
    """A generated page and the blocks of its article."""
    sentence = lambda: " ".join(words(rng, rng.randrange(8, 25))) + rng.choice([".", ", so.", "!"])
    blocks, inner = [], []
    for _ in range(rng.randrange(3, 9)):
        kind = rng.choice(["p", "p", "p", "h2", "ul", "blockquote", "div"])
        if kind == "ul":
            items = [sentence() for _ in range(3)]
            blocks += items
            inner.append("<ul>" + "".join(f"<li>{x}{rng.choice(['', '</li>'])}" for x in items) + "</ul>")
        elif kind == "h2":
            blocks.append(" ".join(words(rng, 4)))
            inner.append(f"<h2 id=x{rng.randrange(99)}>{blocks[-1]}</h2>")
        else:
            parts = [sentence() for _ in range(rng.randrange(2, 5))]
            blocks.append(" ".join(parts).replace("so.", "so & on"))
            text = " ".join(parts).replace("so.", "so &amp; on")
            k = text.index(" ")
            inner.append(f"<{kind}><b>{text[:k]}</b>{text[k:]}</{kind}>")
    links = "".join(f'<li><a href="/{i}">{" ".join(words(rng, 3))}</a>' for i in range(8))
    around = rng.choice(['<div class="content">{}</div>', "<article>{}</article>", '<main><div class="post">{}</div></main>', '<div id="main"><section>{}</section></div>', '<form id="aspnetForm"><div class="entry">{}</div></form>'])
    side = rng.choice(['<div class="sidebar"><p>{}</p></div>', "<aside><p>{}</p></aside>", '<div class="comments"><p>{}</p></div>', '<div class="entry comments"><p>{}</p></div>', '<footer><p>{}</p></footer>', '<div class="cookie-notice"><p>{}</p></div>'])
    body = f"<nav><ul>{links}</ul></nav>" + around.format("\n".join(inner)) + side.format(" ".join(words(rng, 30)))
    return f"<!doctype html><html><head><title>{' '.join(words(rng, 3))}</title><style>p{{}}</style></head><body>{body}<script>var x = '<p>no</p>';</script></body></html>", blocks


def test_generated_pages_give_their_articles(spark):
    rng = random.Random(21)
    pages = [page_of(rng) for _ in range(600)]
    rows = [(i, "u", html, "x") for i, (html, _) in enumerate(pages)]
    got = {r["page_id"]: r for r in html_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    wrong = [i for i, (_, blocks) in enumerate(pages) if got[i]["text"].split("\n") != blocks]
    assert not wrong, (len(wrong), pages[wrong[0]], got[wrong[0]]["text"])
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_html_odd_rows(spark):
    rows = [(None, None, None), (1, "u", ""), (1, "u", ""), (2, None, "<p>" + LONG), (3, "u", "<a" * 500_000), (4, "u", "<b>" * 300_000 + "<h1>x</h1>" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html_tree.extract(pages).collect()
    assert Counter(r["page_id"] for r in got) == Counter(r[0] for r in rows) and {r["page_id"]: r["n_chars"] for r in got}[2] == len(LONG) - 1
    assert html_tree.extract(pages.limit(0)).count() == 0


def test_html_several_mains_and_comments():
    a, b = "First part, with a comma, and words. " * 9, "Second part, with commas, too, and words. " * 9
    assert html_tree.main_text(f"<main><p>{a}</p></main><p>no</p><main><p>{b}</p></main>").split("\n") == [a.strip(), b.strip()]
    assert html_tree.main_text(f'<div class="post"><p>{a}</p></div><div class="entry comments"><p>{b}</p></div>') == a.strip()
    assert html_tree.main_text(f'<form><div><p>{a}</p><input value="x"></div></form>') == a.strip()
    assert html_tree.main_text(f"<div><p>{a}</p><form><p>Your name</p></form></div>") == a.strip()


# ---- toxicity


def test_toxicity_odd_rows_and_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = common.table(spark, sf_dir, "documents").select("doc_id", "text"), common.table(spark, sf_dir, "labels").select("doc_id", "toxic")
    half = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("half")), F.lit(2)) == 0
    model = toxicity.train(docs, labels.filter(half))
    got = toxicity.scored(docs.join(labels.filter(~half).withColumnRenamed("toxic", "truth"), "doc_id"), model).groupBy("truth").agg(F.count("*").alias("n"), F.count_if("toxic").alias("found")).collect()
    found = {r["truth"]: r["found"] / r["n"] for r in got}
    print("held out:", {r["truth"]: (r["found"], r["n"]) for r in got})
    assert found[1] >= 0.9 and found[0] <= 0.03
    odd = spark.createDataFrame([(None, None, "g", 1), (1, "", "g", 1), (2, LONG, "g", 1), (3, "x", "g", 1), (3, "x", "g", 1)], "doc_id long, text string, grade string, _row int")
    out = toxicity.scored(odd, model)
    assert out.count() == 5 and not out.filter("toxic").count() and toxicity.scored(odd.limit(0), model).count() == 0


def test_toxicity_picks_the_same_sample_and_keeps_bounds(spark):
    rng = random.Random(3)
    docs = spark.createDataFrame([(i % 50, " ".join(words(rng, 30))) for i in range(120)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(60)] + [(1, 1), (99, 1)], "doc_id long, toxic int")
    sizes = []
    fitted = toxicity.fitted
    try:
        toxicity.fitted = lambda spark, rows, cols, toxic, *a: sizes.append((len(toxic), len(cols))) or fitted(spark, rows, cols, toxic, *a)
        for parts in (1, 5):
            toxicity.train(docs.repartition(parts), labels.repartition(parts), max_train=20)
            toxicity.train(docs.repartition(parts), labels.repartition(parts), max_features=500)
    finally:
        toxicity.fitted = fitted
    assert len(set(sizes)) > 1 and max(n for n, _ in sizes) <= 50 and sizes[: len(sizes) // 2] == sizes[len(sizes) // 2 :]


# ---- WARC


def test_archives_of_several_ranges(spark):
    rng = random.Random(31)
    inner = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:7>\r\nContent-Length: 30\r\n\r\n" + "x" * 30 + "\r\n\r\n"
    rows = [(i, f"u{i}", rng.choice([inner * rng.randrange(1, 40), "plain " * rng.randrange(1, 900), "é" * rng.randrange(60), "same " * 200, None, "WARC/1.1\r\n" * rng.randrange(1, 300)]), "x") for i in range(400)]
    rows += [rows[5], rows[5], (None, None, "no id " * 40, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type string").repartition(2)
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = warc.round_trip(pages).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    first = {}
    for i, _, html, _ in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    expected = []
    for i, _, html, _ in rows:
        data = (html or "").encode()
        revisit = len(data) >= 100 and i is not None and first[html or ""] != i
        expected.append((str(i), len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first[html or ""] if revisit else None))
    assert Counter((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == Counter(expected)
    assert warc.round_trip(pages.limit(0)).count() == 0


# ---- licenses


def plain_scan(text):
    """Templates of which a share of 0.8 of the grams is in some window, by sets."""
    found, w = set(), decontaminate.words(text.encode())
    for name, template in licenses.TEMPLATES.items():
        t = decontaminate.words(template.encode())
        n = min(5, len(t))
        grams = {tuple(t[i : i + n]) for i in range(len(t) - n + 1)}
        s = 1 << (len(grams) - 1).bit_length()
        mine = [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
        if any(len(grams & set(mine[i : i + 2 * s])) >= 0.8 * len(grams) for i in range(0, len(mine), s)):
            found.add(name)
    return found


def test_licenses_with_edits_against_plain_sets(spark):
    rng, rows, expected = random.Random(41), [], {}
    for name, template in licenses.TEMPLATES.items():
        for k in range(6):
            t = template.split()
            for _ in range(k * len(t) // 60 + (k > 0)):  # up to a tenth of the words: above and below the threshold
                t[rng.randrange(len(t))] = f"edit{rng.randrange(999)}"
            rows.append((len(rows), " ".join(words(rng, rng.randrange(90)) + t + words(rng, rng.randrange(90)))))
            expected[len(rows) - 1] = plain_scan(rows[-1][1])
    both = " ".join(licenses.TEMPLATES.values())
    rows += [(None, None), (9000, ""), (9001, LONG), (9002, both), (9002, both)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, licenses string")
    got = licenses.scan(docs).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: set(r["licenses"]) for r in got}
    assert {i: by_id[i] for i in expected} == expected and not by_id[None] and not by_id[9000] and not by_id[9001]
    assert by_id[9002] == plain_scan(both) and sum(map(bool, expected.values())) > len(licenses.TEMPLATES)
    assert licenses.scan(docs.limit(0)).count() == 0


# ---- quality rules


def test_line_rules_odd_rows(spark):
    rng = random.Random(51)
    text = "\n".join(" ".join(words(rng, 30)) for _ in range(3))
    rows = [(None, None, None), (1, "", "h"), (2, text, "h"), (2, text, "h"), (2, text, None), (3, LONG, "h"), (4, "\n \n\t\n", "h")]
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4, True) for r in rows], "doc_id long, text string, source string, _row int, _id int, _p int, n_words int, Kept boolean")
    got = line_frequency.judged(docs.drop("Kept"))
    assert {"_row", "_id", "_p"} <= set(got.columns) and got.count() == len(rows)
    kept = [r["kept"] for r in got.collect() if r["doc_id"] == 2]
    assert kept == [True] * 3
    assert line_frequency.cleaned(got).count() == 3 and line_frequency.judged(docs.drop("Kept").limit(0)).count() == 0


def test_line_limit_grows_with_the_host(spark):
    rng = random.Random(52)
    line = "one line that stands in many of the documents"
    docs = spark.createDataFrame([(i, " ".join(words(rng, 40)) + ("\n" + line if i < 12 else ""), "h") for i in range(300)], "doc_id long, text string, source string")
    removed = lambda share: line_frequency.judged(docs, max_share=share).filter("n_removed_words > 0").count()
    assert removed(0.001) == 12 and removed(0.039) == 12 and removed(0.04) == 0
    short = spark.createDataFrame([(i, " ".join(words(rng, 21)) + "\nOnly three words", "h") for i in range(12)], "doc_id long, text string, source string")
    assert line_frequency.judged(short).filter("kept AND n_removed_words = 3").count() == 12


# ---- benchmark decontamination


def test_contamination_odd_rows(spark, monkeypatch):
    rng = random.Random(61)
    items = [("a", " ".join(words(rng, 40))), ("a", "same id, other text"), (None, " ".join(words(rng, 20))), ("b", "two words"), ("c", None), ("d", "")]
    tail = " ".join(words(rng, 7, 10**6))
    rows = [(1, items[0][1] + " " + tail), (1, items[0][1] + " " + tail), (None, items[2][1]), (2, "Two WORDS here"), (3, None), (4, ""), (5, LONG), (6, " ".join(words(rng, 38, 10**6)) + " two words"), (7, " ".join(words(rng, 39, 10**6)) + " two words")]
    docs, bench = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, _row int, row string"), spark.createDataFrame(items, "item_id string, text string")
    one = decontaminate.contamination(docs, bench).collect()
    by_id = {r["doc_id"]: r for r in one}
    assert len(one) == len(rows) and by_id[None]["n_items"] == 1 and by_id[None]["items_sha256"] == hashlib.sha256(b"").hexdigest()
    assert by_id[6]["contaminated"] and not by_id[7]["contaminated"] and by_id[5]["n_words"] == 1_000_000 and not by_id[3]["contaminated"]
    clean = rows_of(decontaminate.clean(docs, bench))
    assert len(clean) == 4
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 15)
    assert sorted(map(str, decontaminate.contamination(docs, bench).collect())) == sorted(map(str, one))
    assert rows_of(decontaminate.clean(docs, bench)) == clean and decontaminate.clean(docs, bench).columns == docs.columns
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0


# ---- mixing


def test_targets_against_a_plain_computation(spark):
    rng = random.Random(71)
    docs = spark.createDataFrame([(i, "w " * rng.randrange(0, 60), rng.choice(["b", "a", "é", "C", None])) for i in range(3000)], "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    size = Counter()
    for r in got:
        size[r["source"]] += r["size"]
    weight = dict(zip(["C", "a", "b", "é", None], [3, 1, 2, 3, 1]))
    target, capped = {}, {}
    while True:  # reshare what is above twice a source until nothing is
        rest = 1.5 * sum(size.values()) - sum(capped.values())
        target = {s: rest * weight[s] / sum(weight[x] for x in weight if x not in capped) for s in weight if s not in capped}
        over = [s for s, t in target.items() if t > 2 * size[s]]
        if not over:
            break
        capped |= {s: 2.0 * size[s] for s in over}
    target |= capped
    taken = Counter()
    for r in got:
        assert abs(r["target"] - target[r["source"]]) < 1e-6 and r["taken"] <= 2 * r["size"] and r["source_size"] == size[r["source"]]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 60 for s in target)


def test_mixing_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_ROWS", 20)
    rows = [(None, "same text of six words here", "h", "s", 7)] * 100 + [(1, None, None, "s", 7), (2, "", "h", "s", 7), (3, LONG, "g", "s", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string, _prow int")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows) and abs(sum(r["taken"] for r in got if r["source"] == "h") - next(r["target"] for r in got if r["source"] == "h")) <= 6
    whole = mixing.mixed(docs)
    assert whole.columns == [*docs.columns, "source_size", "target", "taken", "copies"]
    assert whole.count() == len(rows) and {r["size"] for r in whole.collect()} == {"s"} and mixing.mixed(docs.limit(0)).count() == 0


# ---- similarity join


def test_join_odd_rows(spark):
    rng = random.Random(81)
    text = " ".join(words(rng, 80))
    rows = [(None, text), (None, text), (5, text + " x"), (5, text + " x"), (9, None), (9, ""), (7, LONG), (7, LONG), (8, LONG + "end")]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, row int, node int, digest int")
    got = Counter((r["doc_id"], r["class_id"], r["n_links"], r["n_copies"]) for r in jaccard_join.near_duplicates(docs).collect())
    assert got == Counter({(None, 5, 3, 2): 2, (5, 5, 3, 2): 2, (9, 9, 0, 1): 2, (7, 7, 1, 2): 2, (8, 8, 0, 1): 1})


def test_least_connected():
    pairs = np.zeros((6, 6), bool)
    for a, b in ((0, 3), (3, 5), (1, 2)):
        pairs[a, b] = pairs[b, a] = True
    assert jaccard_join.least_connected(pairs, np.array([50, 40, 30, 20, 10, 60])).tolist() == [20, 30, 30, 20, 10, 20]


# ---- shared parts


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(RuntimeError):
        common.shared_dir(Session())


def test_scratch_deletes_what_was_staged(spark):
    with common.scratch(spark):
        inside = common.staged(spark.range(3), "inside")
        assert inside.count() == 3
        paths = inside.inputFiles()
    assert not any(__import__("os").path.exists(p.removeprefix("file://")) for p in paths)
