"""Spelling variants, repair of conversations and secret scans against plain versions, with nulls, long texts, ties, repeats and empty tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paperloom.llm import conversations, secrets_scan, spelling

# ---- spelling variants


def plain_variants(counts):
    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out = {}
    for w, n in counts.items():
        around = [x for x in counts if near(w, x)]
        best = min(around, key=lambda x: (-counts[x], x), default=None)
        out[w] = (n, len(around), best if best and counts[best] >= 10 * n else None)
    roots = {}
    for w in out:
        r = w
        while out[r][2]:
            r = out[r][2]
        roots[w] = r
    return {w: (n, k, form, form and counts[form], roots[w]) for w, (n, k, form) in out.items()}


def grouped(spark, counts):
    rows = spelling.grouped(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}


def test_neighbours_are_distinct_and_complete():
    class Everything:
        def passes(self, h):
            return h == h

    for word in (b"aabbbc", b"aaaa", b"\xe9a\xe9", b"x"):
        letters = b"abc\xe9"
        got = [w for _, w in spelling.neighbours([word], letters, Everything())]
        cuts = {word[:i] + word[i + 1 :] for i in range(len(word))}
        swaps = {word[:i] + bytes([c]) + word[i + 1 :] for i in range(len(word)) for c in letters} - {word}
        more = {word[:i] + bytes([c]) + word[i:] for i in range(len(word) + 1) for c in letters}
        assert len(got) == len(set(got)) and set(got) == cuts | swaps | more


def test_hashes_follow_the_changes(monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 64)  # in many small ranges of places

    class Recorder:
        def __init__(self):
            self.seen = []

        def passes(self, h):
            self.seen += h.tolist()
            return h == h

    r = Recorder()
    got = [w for _, w in spelling.neighbours([b"abcabcabcabcabcabcabcabc", b"bcabcabcabcabcabcabcabca"], b"abcde\xff", r)]
    assert r.seen == spelling.hashes(got).tolist()


def test_variants_against_all_pairs(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abé") for _ in range(7)) for _ in range(150)]
    counts = {w: rng.choice([2, 3, 20, 200, 2000]) for w in base}
    counts |= {"ties" * 2 + c: 30 for c in "xy"} | {"ties" * 2: 3}
    counts["long" * 3000] = 50
    counts["long" * 3000 + "x"] = 2
    assert grouped(spark, counts) == plain_variants(counts)


def test_variants_of_documents(spark):
    docs = [(i, "Straßes Déjàvus motherly " * 40 + "ignored short x" + "÷" * 8, "extra") for i in range(40)] + [(None, None, None), (7, "", None), (8, "motherly", None), (8, "motherly", None), (9, "q" * 200_000 + " " + "q" * 200_000, None)]
    words = Counter()
    for i, text, _ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            words[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    counts = {w: n for w, n in words.items() if len(w) >= 7 and n >= 2}
    frame = spark.createDataFrame(docs, "doc_id long, text string, word string")
    got = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in spelling.variants(frame).collect()}
    assert got == plain_variants(counts)
    assert spelling.variants(frame.limit(0)).count() == 0
    assert grouped(spark, {"ab": 2}) == {"ab": (2, 0, None, None, "ab")}


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(spelling, "MOST_BITS", 128)
    rng = random.Random(6)
    counts = {"".join(rng.choice("ab") for _ in range(9)): rng.randrange(2, 400) for _ in range(200)}
    assert grouped(spark, counts) == plain_variants(counts)


def test_long_chains(spark):
    counts = {"a" * (20 - i): 10**i for i in range(12)}
    got = grouped(spark, counts)
    assert {v[4] for v in got.values()} == {"a" * 9} and got == plain_variants(counts)


# ---- conversations


def plain_repair(rows):
    """(blank, duplicate, truncated, illegal, cost, audit, repaired) of ordered (role, text)."""
    seen, states, faults = set(), {0: (0, "", ())}, Counter()
    never = (10**9, "", ())

    def opened(states):
        states = dict(states)
        for _ in range(3):
            for s, (c, a, r) in list(states.items()):
                t = conversations.MADE[s]
                states[t] = min(states.get(t, never), (c + 2, a + "I", (*r, conversations.ROLES[t] + ":")))
        return states

    for role, text in rows:
        words = text.strip(conversations.BLANKS)
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None
        faults[fault] += 1
        seen.add((role, text))
        new = {}
        for s, (c, a, r) in opened(states).items():
            ways = [(s, (c + 3, a + "D", r))]
            if fault not in ("blank", "duplicate"):
                more, kept, t = int(fault == "truncated"), conversations.KEEP.get(role[:1], (None,) * 4)[s], conversations.MADE[s]
                ways.append((t, (c + 2 + more, a + "R", (*r, f"{conversations.ROLES[t]}:{text}"))))
                if kept is not None:
                    ways.append((kept, (c + more, a + "K", (*r, f"{role}:{text}"))))
            for t, way in ways:
                new[t] = min(new.get(t, never), way)
        states = new
    cost, audit, turns = min(opened(states).get(s, never) for s in (0, 3))
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(turns).encode()).hexdigest()


def check_repair(spark, data):
    found, turns = conversations.repair(spark.createDataFrame(data, "conv_id long, turn long, role string, text string").repartition(3))
    digests = {tuple(r["conv"]): r["repaired_sha256"] for r in conversations.digests(turns).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    got = {r["conv"]["b"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], digests.get(tuple(r["conv"]), empty)) for r in found.collect()}
    order = lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or 0, *((y or " " if y is None else y).encode() for y in x[2:]))
    want = {}
    for conv, rows in itertools.groupby(sorted(data, key=order), key=lambda x: x[0]):
        rows = list(rows)
        numbers = {t for _, t, _, _ in rows if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        want["" if conv is None else str(conv)] = (gaps, *plain_repair([(" " if r is None else r, " " if x is None else x) for _, _, r, x in rows]))
    assert got == want


def generated(rng, conv, n):
    for t in range(n):
        role = rng.choice(["user", "assistant", "system", "tool", "", None]) if rng.random() < 0.4 else ("user", "assistant")[t % 2]
        yield conv, rng.choice([t, t, t, t + 5, None]) if rng.random() < 0.2 else t, role, rng.choice(["a.", "b", "c!\n", "", " \t", None, f"d{t}. ", f"é{t}?", f"f{t}.", f"g{t}"])


def test_repair_of_short_conversations(spark):
    rng = random.Random(1)
    data = [r for conv in range(80) for r in generated(rng, conv, rng.randrange(1, 15))] + [r for r in generated(rng, None, 9)]
    check_repair(spark, data + data[:40])


@pytest.mark.parametrize("block,group", [(3, 2), (128, 1024)])
def test_repair_of_long_conversations(spark, monkeypatch, block, group):
    monkeypatch.setattr(conversations, "BLOCK", block)
    monkeypatch.setattr(conversations, "GROUP", group)
    rng = random.Random(2)
    sizes = (1, 3, 4, 20) if block == 3 else (700, 129, 5)
    check_repair(spark, [r for conv, n in enumerate(sizes) for r in generated(rng, conv, n)] + [(77, 1, "user", "same.")] * 500 + [(78, t, "tool", "same.") for t in range(60)])


def test_repair_of_nothing_and_of_long_texts(spark):
    check_repair(spark, [(1, 0, "user", "word " * 200_000), (1, 1, "assistant", "." * 1_000_000)])
    found, turns = conversations.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string, blank string"))
    assert found.count() == 0 and turns.count() == 0


def test_damage_and_query(spark, tmp_path):
    rng = random.Random(3)
    rows = [r for conv in range(120) for r in generated(rng, conv, 1 + conv % 3)] + [(None, None, None, None)]
    rows.append((next(c for c in range(1000, 9999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0), 0, "user", "goes."))
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in conversations.op12_conversations(spark, str(tmp_path)).collect()}
    assert set(got) == {r[0] for r in rows}
    damaged = {}
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h:
            damaged.setdefault(conv, []).extend([(turn is not None, turn or 0, "user" if h == 4 else role, "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text)] * (2 if h == 3 else 1))
    assert len(damaged) < len(got)  # a conversation lost all its turns
    for conv, r in got.items():
        own = sorted(damaged.get(conv, []), key=lambda x: (x[:2], x[2].encode(), x[3].encode()))
        assert (r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], r["repaired_sha256"]) == plain_repair([x[2:] for x in own])


# ---- secrets


def plain_spans(text, rules=secrets_scan.RULES):
    return sorted((m.start(), i, m.end()) for i, r in enumerate(rules) for m in re.finditer(r.regex, text or "", re.ASCII) if len(m[r.group]) >= r.least)


def test_trigram_queries():
    q = secrets_scan.trigram_query
    assert q("AKIA[A-Z0-9]+") == {frozenset({"aki", "kia"})}
    assert q("[0-9a-f]{24,}") is None and q("a?b*") is None and q("(abc)?x") is None
    assert q("abc|xyzw") == {frozenset({"abc"}), frozenset({"xyz", "yzw"})}
    assert q("api_?key") == {frozenset({"api", "pik", "ike", "key"}), frozenset({"api", "pi_", "i_k", "_ke", "key"})}
    assert q("abc.*def") == {frozenset({"abc", "def"})} and q("(abcd)+") == {frozenset({"abc", "bcd"})} and q("abc|.") is None
    by_kind = {r.kind: q(r.regex) for r in secrets_scan.RULES}
    assert [k for k, x in by_kind.items() if x is None] == ["hex"]


def test_what_matches_holds_its_trigrams():
    rng = random.Random(4)
    for rule in secrets_scan.RULES:
        for text in samples(rng):
            for m in re.finditer(rule.regex, text):
                query = secrets_scan.trigram_query(rule.regex)
                assert query is None or any(all(t in m[0].lower() for t in a) for a in query)


def samples(rng):
    letters = "abcdef0123456789XYZ_"
    some = lambda n, of=letters: "".join(rng.choice(of) for _ in range(n))
    parts = [
        lambda: f"{rng.choice(['password', 'PassWd', 'api_key', 'APIKEY', 'tokens', 'secret', 'token'])}{rng.choice(['', chr(34)])}{' ' * rng.randrange(3)}{rng.choice(':=')}{rng.choice(['', ' ', chr(39)])}{some(rng.randrange(1, 12))}",
        lambda: "AKIA" + some(rng.randrange(10, 20), "ABC09"), lambda: some(rng.randrange(18, 40), "0123456789abcdef"), lambda: "-----BEGIN RSA PRIVATE KEY-----",
        lambda: "ghp_" + some(36, "abcXYZ09"), lambda: f"eyJ{some(12)}.eyJ{some(9)}.{some(8)}", lambda: f"https://{some(4)}:{some(5)}@host", lambda: "xoxb-" + some(14, "09-a"),
        lambda: "AIza" + some(35), lambda: "sk_live_" + some(24, "aB9"), lambda: "é😀ü ", lambda: "token=secret=abcdefgh password: token: abcdef ", lambda: "\n",
    ]
    for _ in range(60):
        yield "".join(rng.choice(parts)() + rng.choice(["", " ", "\n", "é", "😀"]) for _ in range(rng.randrange(0, 12)))


def test_scan_against_plain_regexes(spark):
    rng = random.Random(8)
    texts = [*samples(rng), None, "", "plain text", "token = abcdef"] + ["token = abcdef"] * 3 + ["x" * 2_000_000 + " AKIA" + "A" * 20]
    rows = [(i if i % 7 else None, x, "own", True) for i, x in enumerate(texts)]
    got = secrets_scan.scanned(spark.createDataFrame(rows, "doc_id long, text string, spans string, kinds boolean").repartition(3)).collect()
    name = lambda i, x, s: str((i, hash(x), s))
    assert sorted(name(r["doc_id"], r["text"], [tuple(s) for s in r["spans"]]) for r in got) == sorted(name(i, x, plain_spans(x)) for i, x, _, _ in rows)


def test_scan_in_many_blocks_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(secrets_scan, "BLOCK", 2)
    monkeypatch.setattr(secrets_scan, "is_small", lambda df: False)
    rows = list(enumerate(samples(random.Random(9))))
    got = secrets_scan.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in got} == {i: plain_spans(x) for i, x in rows}


def test_scan_of_nothing_and_of_unindexed_rules(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert secrets_scan.scanned(empty).count() == 0
    rules = (secrets_scan.Rule("digits", "[0-9]{3,}"),)
    got = secrets_scan.scanned(spark.createDataFrame([(1, "a123 45 6789")], "doc_id long, text string"), rules)
    assert [tuple(s) for s in got.first()["spans"]] == [(1, 0, 4), (8, 0, 12)]


def test_scan_runs_no_python(spark):
    plan = secrets_scan.scanned(spark.createDataFrame([(1, "a")], "doc_id long, text string").select(F.col("doc_id"), F.col("text")))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
