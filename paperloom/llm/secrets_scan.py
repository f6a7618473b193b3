"""Secret scans over a trigram inverted index, in DataFrame functions only.

From each rule's regex follows a Boolean query of the trigrams that every match must hold. Postings say which texts hold a trigram; the
query's lists are united and intersected, and only the texts that are left are matched against the regex. Rules whose regex needs no
trigram are matched against all texts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as sre  # the tags of a parsed regex
from re import _parser as sre_parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import let
from .common import ascii_lower, is_small, prefix, staged, table

#: A query is a set of alternatives, each a set of trigrams that must all be there; None says nothing.
Query = frozenset[frozenset[str]] | None


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a regex that never matches nothing, and the least code points of its group (0: the whole match)."""

    kind: str
    regex: str
    group: int = 0
    least: int = 0


def any_case(words: str) -> str:
    """Its letters in either case, without a flag, for engines fold differently beyond A-Z."""
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", words)


# Forms of well-known credentials.
BASE_RULES = (
    Rule("assign", "(" + any_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "[0-9a-f]{24,}", 0, 24),  # a run of 24 or more: what a plain run gives after its shorter ones are dropped
)
RULES = BASE_RULES + (
    Rule("private_key", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("github", "gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", "[rs]k_live_[0-9A-Za-z]{24,}"),
    Rule("url_login", r"[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s/:@]{1,64}:[^\s/:@]{1,64}@"),
)

#: A class of more letters than this, or more than so many strings, is not spelled out.
MOST_LETTERS, MOST_STRINGS = 6, 64


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    return _least({x | y for x in a for y in b})


def _either(a: Query, b: Query) -> Query:
    return None if a is None or b is None else _least(a | b)


def _least(alternatives) -> Query:
    """Without alternatives that ask for more than another one does."""
    return frozenset(a for a in alternatives if not any(b < a for b in alternatives))


def _needed(strings: set[str]) -> Query:
    """What a text that holds one of these strings must hold."""
    each = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings]
    return None if not each or not all(each) else _least(set(each))


def _walk(parsed) -> tuple[set[str] | None, Query]:
    """(all strings that a part of a regex matches, if they are few; else None, and what it needs), lower-cased."""
    strings: set[str] | None = {""}  # what the last pieces match
    query: Query = None
    whole = True

    def closed():
        nonlocal strings, query, whole
        if strings is not None:
            query = _both(query, _needed(strings))
        strings, whole = {""}, False

    for kind, value in parsed:
        if kind is sre.LITERAL:
            piece, own = {chr(value).lower()}, None
        elif kind is sre.IN:
            letters = _letters(value)
            piece, own = letters, None
        elif kind is sre.SUBPATTERN:
            piece, own = _walk(value[-1])
        elif kind is sre.BRANCH:
            each = [_walk(x) for x in value[1]]
            if all(s is not None for s, _ in each):
                piece, own = set().union(*(s for s, _ in each)), None
            else:
                piece, own = None, frozenset()
                for s, q in each:
                    own = _either(own, q if s is None else _needed(s))
        elif kind is sre.MAX_REPEAT:
            low, high, inner = value
            s, q = _walk(inner)
            if s is not None and (low, high) == (0, 1):
                piece, own = s | {""}, None
            else:
                piece, own = None, None if low == 0 else q if s is None else _needed(s)
        else:  # anchors and the like match no letter, anything else needs nothing
            piece, own = ({""}, None) if kind is sre.AT else (None, None)
        joined = None if piece is None else {a + b for a in strings for b in piece}
        if joined is not None and len(joined) <= MOST_STRINGS:
            strings = joined
        else:
            closed()
            query = _both(query, own)
            strings = piece if piece is not None and len(piece) <= MOST_STRINGS else {""}
    if whole:
        return strings, _needed(strings)
    return None, _both(query, _needed(strings))


def _letters(members) -> set[str] | None:
    out: set[str] = set()
    for kind, value in members:
        if kind is sre.LITERAL:
            out.add(chr(value).lower())
        elif kind is sre.RANGE and value[1] - value[0] < MOST_LETTERS:
            out.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return None
    return out if len(out) <= MOST_LETTERS else None


def trigram_query(regex: str) -> Query:
    """The Boolean query that a regex implies for the lower-cased trigrams of a text: alternatives of trigrams that must all be there."""
    return _walk(sre_parser.parse(regex))[1]


def thinned(query: Query, most: int) -> Query:
    """The query with at most so many trigrams an alternative, spread over those in code-point order. It asks for less, so it leaves no fewer texts."""
    spread = lambda ts: ts if len(ts) <= most else [ts[i * (len(ts) - 1) // (most - 1)] for i in range(most)]
    return _least({frozenset(spread(sorted(a))) for a in query})


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _key() -> Column:
    """A 128-bit name of a row; rows of an equal id and text share it."""
    return F.struct(F.xxhash64("doc_id", "text").alias("a"), F.xxhash64("text", "doc_id").alias("b"))


#: Texts whose postings are kept together.
BLOCK = 1024
#: Trigrams that the index holds for an alternative at most: each costs a search of every text, and a few leave hardly more texts than all.
MOST_TRIGRAMS = 3


def postings(docs: DataFrame, trigrams: list[str], n_docs: int) -> DataFrame:
    """(block, trigram, keys): of docs(doc_id, text), in blocks of about BLOCK texts by a hash, which of them hold each of the trigrams. A trigram
    that all texts hold has a short list in every block, so no list grows with the corpus. Equal rows are one entry."""
    blocks = max(1, n_docs // BLOCK)
    found = lambda low: F.array_compact(F.array(*(F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in trigrams)))
    there = docs.select(_key().alias("key"), let(ascii_lower(_text()), found).alias("t"))  # lower-cased once, not for each trigram
    # explode() would ask for the array's size first, and so for the array twice
    each = there.select(F.pmod("key.a", F.lit(blocks)).alias("block"), F.explode_outer("t").alias("trigram"), "key").filter("trigram IS NOT NULL")
    return each.groupBy("block", "trigram").agg(F.collect_set("key").alias("keys"))


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """(key, kinds): the texts that each kind's query leaves, of an index by postings(). In each block lists are intersected and united."""
    lists = index.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "keys"))).alias("of"))
    none = F.array().cast("array<struct<a:bigint,b:bigint>>")

    def left(query: Query) -> Column:
        out = None
        for alternative in sorted(map(sorted, query)):
            met = None
            for t in alternative:
                got = F.coalesce(F.element_at("of", F.lit(t)), none)
                met = got if met is None else F.array_intersect(met, got)
            out = met if out is None else F.array_union(out, met)
        return out

    each = F.array(*(F.struct(F.lit(kind).alias("kind"), left(q).alias("keys")) for kind, q in sorted(queries.items())))
    rows = lists.select(F.explode(each).alias("c")).select("c.kind", F.explode("c.keys").alias("key"))
    return rows.groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def matches(text: Column, rule: Rule, number: int) -> Column:
    """The rule's spans in a text: structs of start, number, end, by start. The pieces between matches say where these are, in code points."""
    found = F.regexp_extract_all(text, F.lit(f"({rule.regex})"), F.lit(1))
    least = F.regexp_extract_all(text, F.lit(f"({rule.regex})"), F.lit(rule.group + 1)) if rule.group else found
    rows = F.arrays_zip(F.transform(F.split(text, rule.regex, -1), lambda x: F.length(x)).alias("gap"), F.transform(found, lambda x: F.length(x)).alias("n"), F.transform(least, lambda x: F.length(x)).alias("g"))
    span = "struct<start:int,number:int,end:int>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("spans"))

    def step(s, x):
        start = s["at"] + x["gap"]
        one = F.array(F.struct(start.alias("start"), F.lit(number).alias("number"), (start + x["n"]).alias("end")))
        return F.struct((start + F.coalesce(x["n"], F.lit(0))).alias("at"), F.when(x["g"] >= rule.least, F.concat(s["spans"], one)).otherwise(s["spans"]).alias("spans"))

    placed = F.aggregate(rows, zero, step, lambda s: s["spans"])
    return F.when(text.rlike(rule.regex), placed).otherwise(F.array().cast(f"array<{span}>"))


def scanned(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs(doc_id, text, ...) with spans: array of (start, number of the rule, end) of all rules' matches, by start and rule, in code points.

    A null or empty text has none. Rows are scanned each, equal ones as others; texts of any length whole, in their own row. Matches of one rule
    don't overlap, those of several may. An empty table gives none. Other columns are carried along; one named spans is replaced."""
    p = prefix(docs)
    queries = {r.kind: trigram_query(r.regex) for r in rules}
    indexed = {k: thinned(q, MOST_TRIGRAMS) for k, q in queries.items() if q}
    out = docs.drop("spans").withColumn(p + "key", _key())
    kinds = F.array().cast("array<string>")
    if indexed:
        trigrams = sorted({t for q in indexed.values() for a in q for t in a})
        index = staged(postings(docs.select("doc_id", "text"), trigrams, docs.count()), "trigram-postings")
        found = staged(candidates(index, indexed).select(F.col("key").alias(p + "key"), F.col("kinds").alias(p + "kinds")), "trigram-candidates")
        out = out.join(F.broadcast(found) if is_small(found) else found, [p + "key"], "left")
        kinds = F.coalesce(F.col(p + "kinds"), kinds)
    out = out.withColumn(p + "text", _text())
    each = [m if queries[r.kind] is None else F.when(F.array_contains(kinds, r.kind), m).otherwise(F.array().cast("array<struct<start:int,number:int,end:int>>")) for i, r in enumerate(rules) for m in [matches(F.col(p + "text"), r, i)]]
    return out.withColumn("spans", F.array_sort(F.concat(*each))).drop(p + "key", p + "kinds", p + "text")


def listed(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["number"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scanned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda i: F.size(F.filter("spans", lambda x: x["number"] == i)).cast("long")
    base = F.filter("spans", lambda x: x["number"] < len(BASE_RULES))
    return found.select("doc_id", *(count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE_RULES)), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def _oracle() -> str:
    quoted = lambda r: r.replace("'", "''")
    each = " UNION ALL ".join(
        f"SELECT rid, {i} AS number, '{r.kind}' AS kind, string_split_regex(t, '{quoted(r.regex)}') AS p, regexp_extract_all(t, '{quoted(r.regex)}') AS m, regexp_extract_all(t, '{quoted(r.regex)}', {r.group}) AS g, {r.least} AS least FROM d WHERE regexp_matches(t, '{quoted(r.regex)}')"
        for i, r in enumerate(RULES)
    )
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
e AS ({each}),
x AS (SELECT rid, number, kind, least, m, g, k, list_sum(list_transform(p[:k], lambda s: length(s))) + coalesce(list_sum(list_transform(m[:k - 1], lambda s: length(s))), 0) AS s
      FROM (SELECT *, unnest(range(1, len(m) + 1)) AS k FROM e)),
s AS (SELECT rid, number, kind, CAST(s AS BIGINT) AS s, CAST(s + length(m[k]) AS BIGINT) AS e FROM x WHERE length(g[k]) >= least),
a AS (SELECT rid, count_if(number = 0) AS n_assign, count_if(number = 1) AS n_access, count_if(number = 2) AS n_hex,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, number) FILTER (number < 3) AS base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, number) AS spans FROM s GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (rid)
"""


ORACLE = _oracle()
