import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.llm import common, decontaminate, html_tree, jaccard_join, licenses, line_frequency, maxent_lm, mixing, toxicity, urls, warc

DOCS = "doc_id long, text string, source string, n_words string"
ODD = [(1, None, None, "x"), (2, "", "a", "x"), (None, "word " * 30, "a", None), (3, "tie tie tie", "a", "x"), (3, "tie tie tie", "a", "x")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


def words(rng, n, vocabulary=3000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def test_cascade_is_exact(spark):
    keys = [f"h{i}.example.org" for i in range(5000)]
    listed, universe = spark.createDataFrame([(k,) for k in keys[:700]], "key string"), spark.createDataFrame([(k,) for k in keys], "key string")
    cascade = urls.build(listed, universe)
    pdf = universe.select("key", F.xxhash64("key").alias("a"), F.xxhash64("key", F.lit("second")).alias("b")).toPandas()
    assert len(cascade.levels) > 1
    assert set(pdf["key"][cascade.member(pdf["a"].to_numpy(), pdf["b"].to_numpy())]) == set(keys[:700])


def test_url_rules(spark):
    rows = [(1, "http://WWW.example.com/en/x", None), (2, "https://m.example.com/en/", None), (3, "http://a.net/es/1?x", None), (4, "http://casino-win.example.org/", None), (5, None, None), (6, "nothing", None), (7, "http://a.com", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    blocked = spark.createDataFrame([("example.org",)], "key string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge(pages, blocked).collect()}
    assert got == {1: ("www.example.com/en/", "allow"), 2: ("example.com/en/", "block"), 3: ("net/es/", "block"), 4: (None, "block"), 5: (None, "allow"), 6: (None, "allow"), 7: (None, "allow")}
    assert urls.judge(pages.limit(0), blocked.limit(0)).count() == 0


def test_html():
    page = '<nav><p>a, b</p></nav><div class="content has-sidebar"><h2>T</h2><p>Hello,&nbsp;world &amp; more<br>x</p><div class="sidebar"><p>no, no, no</p></div><ul><li>one<li>two</ul></div><div id="comments"><p>bad, bad, bad</p></div><script>"</p>"</script>'
    assert html_tree.main_text(page) == "T\nHello, world & more x\none\ntwo"
    assert html_tree.main_text(None) == html_tree.main_text("") == "" and html_tree.main_text("1 < 2") == "1 < 2"
    assert html_tree.main_text("<div>" * 20000 + "deep") == "deep"


def test_toxicity(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(words(rng, 40) + (["vile"] * (i % 5 == 0))), "x") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    got = toxicity.scored(docs, toxicity.train(docs, labels)).toPandas()
    held = got[got["doc_id"] >= 300]
    assert (held["toxic"] == (held["doc_id"] % 5 == 0)).all()
    empty = toxicity.train(docs.limit(0), labels.limit(0))
    assert toxicity.scored(spark.createDataFrame(ODD, DOCS), empty).count() == len(ODD)


def test_warc_rejects_magic_in_payloads(spark):
    inner = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(1, "u", "x" * 200), (2, None, "x" * 200), (3, "u\r\nv", inner * 3 + "é"), (4, "u", None), (5, "u", "small"), (6, "u", "small"), (None, "u", "WARC/1.1\r\n" * 4)]
    got = {r["page_id"]: r for r in warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    import hashlib

    assert set(got) == {r[0] for r in rows}
    for page_id, _, html in rows:
        data = (html or "").encode()
        assert (got[page_id]["payload_bytes"], got[page_id]["payload_digest"]) == (len(data), hashlib.sha256(data).hexdigest())
    assert (got[2]["record_type"], got[2]["refers_to"]) == ("revisit", 1)
    assert all(got[k]["record_type"] == "response" for k in (1, 3, 4, 5, 6, None))


def plain_log10(model, head, text, counts, others):
    """score() of a text by its definition: softmaxes in plain loops, in doubles."""
    import math

    ids = maxent_lm.Ids(head)
    flat = np.array([ids[t] for t in text], np.int32)
    context, total = maxent_lm.contexts(flat, np.array([0])), 0.0
    for i, (token, item) in enumerate(zip(text, flat.tolist())):
        table = 0
        for level, features in enumerate(maxent_lm.FEATURES):
            node = int(model.classes.node[level, item])
            if node < 0:
                break
            at = (node + 1) * int(maxent_lm._TWO) & 0xFFFFFFFF
            x = model.classes.bias[node].astype(float)
            for k in range(features):
                row = ((int(context[k, i]) ^ at) * int(maxent_lm._THREE) & 0xFFFFFFFF) >> (32 - model.bits)
                x = x + model.weights[table + k, row]
            total += (x[model.classes.place[level, item]] - math.log(sum(math.exp(v) for v in x))) / math.log(10)
            table += features
        total += model.classes.last[item] / math.log(10)
        if item >= len(head):
            total += math.log10((counts[token] + 0.1) / others[item - len(head)])
    return total


def test_language_model(spark, monkeypatch):
    import math
    from collections import Counter

    models, trained = [], maxent_lm.train
    monkeypatch.setattr(maxent_lm, "train", lambda *a: models.append(trained(*a)) or models[-1])
    monkeypatch.setattr(maxent_lm, "LEAST", 20)
    rng = random.Random(2)
    rows = [(i, " ".join(words(rng, rng.randrange(60), 50) + [f"rare{i}"] * (i % 3)) if i else None) for i in range(120)] + [(None, "no id"), (7, "twice"), (7, "twice")]
    got = maxent_lm.score(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, row string")).collect()
    assert len(got) == len(rows)
    text = {i: maxent_lm.tokens((t or "").encode()) for i, t in rows[:120] if i != 7}
    learned = [maxent_lm.tokens((t or "").encode()) for i, t in rows if zlib.crc32(str("" if i is None else i).encode()) % 10]
    c = Counter(t for d in learned for t in d)
    n, v = sum(c.values()), len(c)
    head = [t for t, k in sorted(c.items(), key=lambda x: (-x[1], x[0])) if k >= maxent_lm.HEAD_COUNT]
    others = np.full(maxent_lm.OTHERS, maxent_lm.SMOOTH)
    for t in set(c) - set(head):
        others[maxent_lm.other(t)] += c[t] + maxent_lm.SMOOTH
    assert models[0].weights.any()
    for r in got:
        if r["doc_id"] in text:
            d = text[r["doc_id"]]
            assert r["train_tokens"] == n and r["n_tokens"] == len(d) and r["n_known"] == sum(t in c for t in d)
            assert abs(r["base_score"] - sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in d)) < 1e-6
            # score() sends weights in half precision, as train() averages them
            assert abs(r["score"] - plain_log10(models[0], head, d, c, others)) < 2e-3 * len(d)


def test_model_learns_from_contexts_and_survives_odd_tables(spark):
    rng = random.Random(3)
    after = {f"w{i}": f"w{(7 * i + 3) % 40}" for i in range(40)}

    def chain(k):
        out = [f"w{rng.randrange(40)}"]
        while len(out) < k:
            out.append(after[out[-1]] if rng.random() < 0.9 else f"w{rng.randrange(40)}")
        return " ".join(out)

    rows = [(i, chain(80)) for i in range(400)]
    held = [r for r in maxent_lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r["held_out"]]
    assert held and all(r["score"] > 0.75 * r["base_score"] for r in held)  # nearer to 0 by a quarter
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert maxent_lm.score(empty).count() == 0
    none = maxent_lm.score(spark.createDataFrame([(None, "never learned"), (None, None)], "doc_id long, text string")).collect()
    assert all(r["train_tokens"] == r["n_known"] == 0 and r["held_out"] and r["score"] < 0 for r in none)
    long_ = maxent_lm.score(spark.createDataFrame([(1, "w " * 1_000_000), (2, "w")], "doc_id long, text string")).collect()
    assert {r["n_tokens"] for r in long_} == {1_000_001, 2}


def test_probabilities_of_all_words_sum_to_one():
    rng = np.random.default_rng(0)
    head = [f"w{i}".encode() for i in range(900)]
    mass = np.concatenate([np.sort(rng.pareto(1.0, 900))[::-1] * 300 + 3, rng.random(maxent_lm.OTHERS) * 100])
    classes = maxent_lm.Classes(head, mass)
    model = maxent_lm.Model(classes, 12, rng.normal(size=(sum(maxent_lm.FEATURES) << 12, maxent_lm.FANOUT)))
    items = np.arange(len(mass), dtype=np.int32)
    context = np.repeat(maxent_lm.contexts(np.array([5, 9, 0], np.int32), np.array([0]))[:, 2:], len(mass), axis=1)
    assert (classes.node[1] >= 0).any() and abs(np.exp(model.log_probs(items, context)).sum() - 1) < 1e-4
    assert np.allclose(np.exp(maxent_lm.Model(classes, 12).log_probs(items, context)), mass / mass.sum(), rtol=1e-3)


def test_sums_by_row():
    rng = np.random.default_rng(1)
    rows, x = rng.integers(0, 40, 3000).astype(np.uint16) ** 2 % 97, rng.normal(size=(3000, 16)).astype(np.float32)
    row, n, sums = maxent_lm.summed(rows, x)
    assert n.sum() == 3000 and all(np.allclose(s, x[rows == r].sum(axis=0), atol=1e-3) and k == (rows == r).sum() for r, k, s in zip(row, n, sums))


def test_licenses(spark):
    rng = random.Random(3)
    names = sorted(licenses.TEMPLATES)
    rows = [(i, " ".join(words(rng, 100)) + " " + licenses.TEMPLATES[n] + " " + " ".join(words(rng, 90))) for i, n in enumerate(names)] + [(100, " ".join(words(rng, 300))), (101, None)]
    got = {r["doc_id"]: set(r["licenses"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(n in got[i] for i, n in enumerate(names)) and not got[100] and not got[101]


def test_line_rules(spark, odd):
    shared = "the very same line again and again here"
    rng = random.Random(4)
    rows = [(i, shared + "\n" + " ".join(words(rng, 30 if i else 5)), "h") for i in range(12)] + [(50, " ".join(words(rng, 30)) + "\n" + shared, "other"), (51, " ".join(["a b c d e f g h i"] * 9), "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in line_frequency.judged(docs).collect()}
    assert not got[0]["kept"] and got[0]["n_removed_words"] == 8 and got[1]["kept"] and got[50]["n_removed_words"] == 0
    assert got[51]["n_repeat_words"] == 81 and got[51]["base_failed"]
    assert shared not in {r["doc_id"]: r["text"] for r in line_frequency.cleaned(line_frequency.judged(docs)).collect()}[1]
    assert line_frequency.judged(odd).count() == len(ODD) and line_frequency.judged(odd.limit(0)).count() == 0


def test_winnowing_finds_every_span():
    rng = random.Random(5)
    item = words(rng, 60)
    index = decontaminate.Index([("a", " ".join(item).encode()), ("b", b"only three words")])
    for start in range(0, 47):
        doc = [x.encode() for x in words(rng, 20, 10**6) + item[start : start + 13] + words(rng, 20, 10**6)]
        spans, items = index.scan([doc], common.Hashes())[0]
        assert decontaminate.merged(spans) == [(20, 33)] and items == {0}
    assert index.scan([[b"x", b"only", b"three", b"words"]], common.Hashes())[0] == ([(1, 4)], {1})


def test_contamination_in_blocks(spark, odd, monkeypatch):
    rng = random.Random(6)
    items = [(str(i), " ".join(words(rng, 40))) for i in range(6)] + [(None, None)]
    docs = spark.createDataFrame([(i, items[i][1] + " tail") for i in range(6)] + [(10, " ".join(words(rng, 80)))], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    one = sorted(decontaminate.contamination(docs, bench).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 90)
    assert sorted(decontaminate.contamination(docs, bench).collect()) == one and sum(r["contaminated"] for r in one) == 6
    assert decontaminate.clean(docs, bench).count() == 1 and decontaminate.contamination(odd, bench.limit(0)).count() == len(ODD)


def test_mixing(spark, odd, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_ROWS", 50)
    monkeypatch.setattr(mixing, "FAN_IN", 2)
    rng = random.Random(7)
    docs = spark.createDataFrame([(i, "w " * rng.randrange(1, 80), None if i % 7 == 0 else f"s{i % 3}") for i in range(900)], "doc_id long, text string, source string")
    rows = mixing.mix(docs).collect()
    assert len(rows) == 900 and sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs).collect()))
    for source in {r["source"] for r in rows}:
        mine = [r for r in rows if r["source"] == source]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 80 and all(r["taken"] <= 2 * r["size"] for r in mine)
    assert mixing.mix(odd).count() == len(ODD) and mixing.mix(odd.limit(0)).count() == 0


def brute_classes(texts):
    """(links, class, copies) of each text by all pairs; class is the least place of the connected ones."""
    sets = [frozenset(tuple(t[i : i + 5]) for i in range(max(1, len(t) - 4))) if t else frozenset() for t in texts]
    links, up = [0] * len(sets), list(range(len(sets)))

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= 0.8 * len(a | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                x, y = sorted((root(i), root(j)))
                up[y] = x
    copies = Counter(sets)
    return [(root(i), links[i], copies[s] if s else 1) for i, s in enumerate(sets)]


def test_jaccard_join_is_exact(spark, odd):
    rng = random.Random(8)
    texts = [words(rng, 60) for _ in range(60)]
    for k in range(140):
        base = list(texts[0] if k < 60 else texts[rng.randrange(60)])
        base[rng.randrange(len(base))] = f"n{k}"
        texts.append(base)
    texts += texts[:20] + [["just", "four", "words", "here"]] * 3 + [[]] * 2
    docs = spark.createDataFrame([(i, " ".join(t), "x") for i, t in enumerate(texts)], "doc_id long, text string, row string")
    expected = brute_classes(texts)
    for small, block in ((16, 7), (400, 1000)):
        got = {r["doc_id"]: (r["class_id"], r["n_links"], r["n_copies"]) for r in jaccard_join.near_duplicates(docs, small=small, block=block).collect()}
        assert [got[i] for i in range(len(texts))] == expected
    assert jaccard_join.near_duplicates(odd).count() == len(ODD) and jaccard_join.near_duplicates(odd.limit(0)).count() == 0


def test_jaccard_join_loses_nothing_in_deep_splits(spark):
    rng = random.Random(18)
    base, texts = words(rng, 200, 10**6), []
    for _ in range(300):  # one group around a text, and clusters that lie apart but share a passage
        t = list(base)
        for _ in range(rng.randrange(1, 5)):
            t[rng.randrange(200)] = f"n{rng.randrange(10**9)}"
        texts.append(t)
    passage = words(rng, 40, 10**6)
    for _ in range(20):
        own = words(rng, 60, 10**6)
        for k in range(6):
            t = own + passage
            t[rng.randrange(60)] = f"m{rng.randrange(10**9)}"
            texts.append(t)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: (r["class_id"], r["n_links"], r["n_copies"]) for r in jaccard_join.near_duplicates(docs, small=12, block=50).collect()}
    assert [got[i] for i in range(len(texts))] == brute_classes(texts)


def test_small_sides_are_broadcast_and_others_are_not(spark, monkeypatch):
    left = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    right = common.staged(spark.range(5).select(F.col("id").alias("k"), F.lit("x" * 1000).alias("v")), "side")
    wide = sorted(map(tuple, common.joined_small(left, right, ["k"], "left").collect()))
    assert common.is_small(right) and not common.is_small(right, rows=4) and not common.is_small(right, most_bytes=5000)
    monkeypatch.setattr(common, "BROADCAST_BYTES", 1)
    assert sorted(map(tuple, common.joined_small(left, right, ["k"], "left").collect())) == wide


def test_operators_without_any_broadcast(spark, monkeypatch):
    """What joined_small does beyond its bounds, in each operator that uses it."""
    docs, pages = common.table(spark, "/root/testdata/sf0.001", "documents"), common.table(spark, "/root/testdata/sf0.001", "pages")
    run = lambda: [sorted(map(str, df.collect())) for df in (line_frequency.judged(docs), jaccard_join.near_duplicates(docs), warc.round_trip(pages))]
    first = run()
    monkeypatch.setattr(common, "BROADCAST_ROWS", -1)
    assert run() == first
