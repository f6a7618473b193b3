"""The pipeline's stages over odd tables, and the whole of it against a plain reading of its rules."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paperloom.llm import common, line_frequency, mixing, toxicity

CLASHING = "doc_id long, text string, lang string, source string, n_chars long, _row int, _id int, grade string, kept string, n_words string, toxic int, removed int, carried_columns int, size string, `a.b` int, row int, class_id int"


def words(rng, n, vocabulary=3000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(1)
    text = " ".join(words(rng, 60))
    more = ("l", "h", 5, 1, 2, "mine", "mine", "mine", 3, 4, 5, "mine", 6, 7, 8)
    rows = [(1, text), (1, text), (None, text + " x"), (2, None), (None, None), (3, ""), (4, " ".join(words(rng, 50))), (5, " ".join(words(rng, 900, 10**6)) * 200), (None, " ".join(words(rng, 45)))]
    return spark.createDataFrame([(i, t, *more) for i, t in rows], CLASHING)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory, odd):
    """A folder of tables with odd rows and columns, and a toxic vocabulary."""
    rng = random.Random(2)
    path = str(tmp_path_factory.mktemp("tables"))
    toxic = [(1000 + i, " ".join(words(rng, 40) + ["vile", "nasty"]), "l", "h", 5, 1, 2, "mine", "mine", "mine", 3, 4, 5, "mine", 6, 7, 8) for i in range(60)]
    clean = [(2000 + i, " ".join(words(rng, 60)), "l", f"s{i % 3}", 5, 1, 2, "mine", "mine", "mine", 3, 4, 5, "mine", 6, 7, 8) for i in range(200)]
    item = " ".join(words(rng, 30, 10**6))
    hit = [(3000, item + " " + " ".join(words(rng, 40)), "l", "h", 5, 1, 2, "mine", "mine", "mine", 3, 4, 5, "mine", 6, 7, 8)]
    odd.unionByName(spark.createDataFrame([*toxic, *clean, *hit], odd.schema)).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1000 + i, int(i < 60), 1) for i in range(60)] + [(2000 + i, 0, 1) for i in range(150)] + [(None, 1, 1), (4, None, 1)], "doc_id long, toxic int, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([("a", item), (None, None)], "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_keep_all_columns_and_rows_like_others(spark, odd, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, sf_dir)
        assert got.columns[: len(docs.columns)] == docs.columns, name
        rows = got.collect()
        assert {(r["grade"], r["kept"], r["n_words"], r["size"], r["_row"], r["a.b"], r["removed"], r["class_id"]) for r in rows} == {("mine", "mine", "mine", "mine", 1, 6, 4, 8)}, name
        assert stage(spark, docs.limit(0), sf_dir).count() == 0, name
        if name.startswith("mixing"):
            plain = mixing.mix(docs).collect()
            assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in plain) == Counter(r["doc_id"] for r in docs.collect())


def test_whole_pipeline_against_its_rules(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    model = toxicity.train(docs, common.table(spark, sf_dir, "labels"))
    kept = [r for r in toxicity.scored(docs.select("doc_id", "text"), model).collect() if not r["toxic"]]
    assert not any(1000 <= (r["doc_id"] or 0) < 2000 for r in kept) and sum(2000 <= (r["doc_id"] or 0) < 3000 for r in kept) == 200
    good = line_frequency.judged(spark.createDataFrame([(r["doc_id"], r["text"]) for r in kept], "doc_id long, text string").withColumn("source", F.lit(None).cast("string"))).filter("kept")
    texts = [(r["doc_id"], r["text"]) for r in good.collect()]
    item = common.table(spark, sf_dir, "benchmark").filter("item_id = 'a'").first()["text"]
    expected, seen = [], []
    for i, t in sorted(texts, key=lambda x: (x[0] is None, x[0] or 0)):
        w = t.split()
        grams = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        if any(len(grams & s) >= 0.8 * len(grams | s) for s in seen):
            continue
        seen.append(grams)
        if item not in t:
            expected.append(i)
    got = corpus_pipeline.run(spark, sf_dir)
    rows = got.collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(expected)
    assert {(r["doc_id"], r["text"]) for r in rows} <= set(texts)  # whole, as the quality rules left them
    size = Counter()
    for i, t in texts:
        size[i] = len((t or "").split())
    # the documents have a column of their own that is called size
    own = lambda r: len((r["text"] or "").split())
    assert all(r["taken"] == r["copies"] * own(r) and own(r) == size[r["doc_id"]] and r["copies"] <= 2 for r in rows if r["doc_id"] is not None)
    assert abs(sum(r["taken"] for r in rows) - 1.5 * sum(map(own, rows))) < 0.05 * sum(map(own, rows))


def test_pipeline_deletes_what_it_staged(spark, sf_dir):
    import os

    folder = common.shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    corpus_pipeline.run(spark, sf_dir).count()
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before}
    assert all(x.startswith(("pipeline-3", "mix-", "join-", "components", "edges", "least")) or x == "" for x in left), left
