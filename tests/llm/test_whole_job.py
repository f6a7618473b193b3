"""Cases in which an operator once did less than its whole job."""

import random

import numpy as np

import corpus_pipeline
from paperloom.llm import common, html_tree, toxicity, urls


def labelled(spark, size):
    """Per labelled document of a test table: whether it is toxic, whether it was found to be, its words."""
    sf_dir = f"/root/testdata/{size}"
    docs, labels = common.table(spark, sf_dir, "documents").select("doc_id", "text"), common.table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels)
    truth = {r["doc_id"]: r["toxic"] for r in labels.select("doc_id", "toxic").dropna().collect()}
    got = toxicity.scored(docs, model).collect()
    return model, [(truth[r["doc_id"]] > 0, r["toxic"]) for r in got if r["doc_id"] in truth], got


def test_toxicity_learns_from_few_labels(spark):
    for size, least in (("sf0.001", 0.5), ("sf0.01", 0.7)):
        model, pairs, got = labelled(spark, size)
        assert model.weights.any(), size
        toxic, clean = [found for is_toxic, found in pairs if is_toxic], [found for is_toxic, found in pairs if not is_toxic]
        assert sum(toxic) >= least * len(toxic) and sum(clean) <= 0.1 * len(clean), (size, sum(toxic), len(toxic), sum(clean), len(clean))
        print(size, sum(toxic), len(toxic), sum(clean), len(clean), sum(r["toxic"] for r in got), len(got))


def test_no_features_is_not_toxic(spark):
    docs = spark.createDataFrame([(i, f"only{i} words{i}") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 5)) for i in range(20)], "doc_id long, toxic int")
    got = toxicity.scored(docs.union(spark.createDataFrame([(50, "")], docs.schema)), toxicity.train(docs, labels)).collect()
    assert len(got) == 21 and not any(r["toxic"] or r["grade"] for r in got)


def test_only_true_copies_are_collapsed():
    common_ = [1, 2, 3]  # the least features of unrelated texts
    sets = [[*common_, *range(100, 140)], [*common_, *range(200, 240)], [*common_, *range(100, 140)], [*common_, *range(200, 239)], [*common_, *range(200, 238)], []]
    cols = [np.array(s, np.int32) for s in sets]
    stay, toxic = toxicity.distinct(cols, np.array([0, 0, 1, 0, 1, 0]))
    assert stay == [0, 1, 4, 5] and toxic[stay].tolist() == [1, 0, 1, 0]
    assert toxicity.distinct([], np.array([], np.int64))[0] == []


def test_toxicity_learns_from_unrelated_texts(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(toxicity, "fitted", lambda spark, rows, cols, toxic, *a, fitted=toxicity.fitted: sizes.append(len(toxic)) or fitted(spark, rows, cols, toxic, *a))
    labelled(spark, "sf0.1")
    assert sizes[-1] > 3700


def test_html_keeps_what_stands_beside_the_best_container():
    long_ = ["Long text, with commas, and more, words here. " * 8, "Second text, with commas, and more, too. " * 8]
    section = "".join(f"<p>{x}</p>" for x in long_)
    page = (
        '<div id="top"><a href="/">Home</a> <a href="/b">All pages</a></div><h1>Title</h1><div><p>Short intro.</p>Bare text with a <a href="x">link</a> inside it'
        f'<div class="section">{section}</div><nav>no</nav><ul><li>one<li>two</ul><ul><li><a href="1">elsewhere</a><li><a href="2">and there</a></ul><h3>End</h3><p>Short end.</p></div><div class="footer"><p>no</p></div>'
    )
    assert html_tree.main_text(page).split("\n") == ["Title", "Short intro.", "Bare text with a link inside it", *(x.strip() for x in long_), "one", "two", "End", "Short end."]
    assert html_tree.main_text("<div>some text, here " * 20000 + "deep").count("some") == 20000


def test_listed_hosts_of_many_labels(spark):
    long_ = ".".join(f"l{i}" for i in range(200)) + ".org"
    hosts = [long_, "m." + long_, "x" + long_, long_.split(".", 1)[1], "b.com", "a.b.com"]
    pages = spark.createDataFrame([(i, f"http://{h}/") for i, h in enumerate(hosts)], "page_id long, url string")
    got = {r["page_id"]: r["listed"] for r in urls.judge(pages, spark.createDataFrame([(long_,), ("b.com",), (None,)], "key string")).collect()}
    assert got == {0: True, 1: True, 2: False, 3: False, 4: True, 5: True}


def test_one_row_of_each_class_of_near_copies(spark):
    rng = random.Random(9)
    a, b, c = (" ".join(f"w{rng.randrange(3000)}" for _ in range(200)) for _ in range(3))
    rows = [(None, a + " x"), (7, a), (7, a), (3, a + " y"), (3, b), (None, c), (None, c + " z"), (None, None), (9, "short"), (9, "short")]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, k int")
    got = corpus_pipeline.join_near_copies(spark, docs, "")
    assert got.columns == docs.columns
    kept = sorted(r["k"] for r in got.collect())
    assert kept[:2] == [3, 4] and len(set(kept) & {5, 6}) == 1 and set(kept) >= {7} and not set(kept) & {0, 1, 2}
    assert corpus_pipeline.join_near_copies(spark, docs.limit(0), "").count() == 0
