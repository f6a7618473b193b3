"""URL filters: host and path rules, and a Bloom filter cascade over a list of blocked hosts and addresses.

Level 0 encodes the listed keys; level 1 encodes the keys of the corpus that level 0 passes by mistake; level 2 the
listed keys that level 1 passes, and so on until no mistake is left. The keys of the whole corpus are known, so a key
is a member exactly if the first level that rejects it is an odd one. Filters are as large as the list, whatever the
corpus's size; URLs are judged by reading them once, without a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ascii_lower, dropped, mix64, staged, table

#: (verdict, host, path) of the contract.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Hosts that are blocked with their subdomains where no rule fits. The registered query's list also has the corpus's own addresses
#: (host and path) whose md5 begins with LISTED: in place of an external list, so that the cascade has thousands of keys and several levels.
BLOCKED_HOSTS = ("ads-track.example.org", "casino-win.example.org", "cheap-pills.example.com", "free-bets.example.com", "spam-farm.example.org")
LISTED = "7"
#: Bits of a level at most (2 GB of keys' worth); a longer list raises ValueError.
MAX_BITS = 1 << 31
#: Words of a filter that are put together at once.
CHUNK_WORDS = 1 << 12
FIRST_BITS, FIRST_PROBES, NEXT_BITS, NEXT_PROBES = 12, 6, 3, 2


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without one."""
    return F.coalesce(ascii_lower(F.regexp_extract(_after(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (host + path; a longer host first among equals) and its verdict; null if none does."""
    rule = verdict = None
    for what, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, h + p) if rule is None else F.when(fits, h + p).otherwise(rule)
        verdict = F.when(fits, what) if verdict is None else F.when(fits, what).otherwise(verdict)
    return (rule, verdict) if rule is not None else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def n_labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def host_keys(host: Column, most: int) -> Column:
    """The host and its parent domains, those of at most `most` labels; empty for no host."""
    labels = F.least(n_labels(host), F.lit(most))
    keys = F.transform(F.sequence(F.lit(1), labels), lambda i: F.call_function("substring_index", host, F.lit("."), -i))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(keys)


def hashed(key: Column) -> Column:
    """A 128-bit name of a key."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(key, F.lit("second")).alias("b"))


class Cascade:
    """levels: (bits, probes, words); immutable and small enough to be broadcast."""

    def __init__(self, levels: list[tuple[int, int, np.ndarray]]):
        self.levels = levels

    def member(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Exact for keys of the list and of the corpus that it was built over."""
        result = np.zeros(len(a), bool)
        going = np.arange(len(a))
        for number, (bits, probes, words) in enumerate(self.levels):
            if not len(going):
                return result
            hit = passes(a[going], b[going], number, bits, probes, words)
            result[going[~hit]] = number % 2 == 1
            going = going[hit]
        result[going] = len(self.levels) % 2 == 1
        return result


def positions(a: np.ndarray, b: np.ndarray, level: int, bits: int, probes: int) -> np.ndarray:
    a, b = mix64(a.view(np.uint64), level), mix64(b.view(np.uint64), level + 7919)
    with np.errstate(over="ignore"):
        return np.stack([(a + np.uint64(j) * b) % np.uint64(bits) for j in range(probes)], axis=1)


def passes(a, b, level, bits, probes, words) -> np.ndarray:
    at = positions(a, b, level, bits, probes)
    return (((words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)) == 1).all(axis=1)


def _level(keys: DataFrame, n: int, level: int) -> tuple[int, int, np.ndarray]:
    per, probes = (FIRST_BITS, FIRST_PROBES) if level == 0 else (NEXT_BITS, NEXT_PROBES)
    bits = -(-max(n * per, 64) // 64) * 64
    if bits > MAX_BITS:
        raise ValueError(f"level {level} needs {bits} bits, more than {MAX_BITS}")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bits of each chunk of the filter that the task's keys set."""
        for batch in batches:
            at = np.unique(positions(batch.column(0).to_numpy(), batch.column(1).to_numpy(), level, bits, probes).ravel())
            chunks, first = np.unique(at // np.uint64(64 * CHUNK_WORDS), return_index=True)
            places = (at % np.uint64(64 * CHUNK_WORDS)).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array(chunks.astype(np.int32)), pa.array([x.tobytes() for x in np.split(places, first[1:])] if len(at) else [], pa.binary())], names=["chunk", "places"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}  # a share of the filter
        for batch in batches:
            for chunk, places in zip(*(c.to_pylist() for c in batch.columns)):
                made.setdefault(chunk, np.zeros(64 * CHUNK_WORDS, bool))[np.frombuffer(places, np.uint32)] = True
        for chunk, x in made.items():
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([np.packbits(x, bitorder="little").tobytes()], pa.binary())], names=["chunk", "words"])

    words = np.zeros(-(-bits // (64 * CHUNK_WORDS)) * CHUNK_WORDS, np.uint64)
    for row in keys.mapInArrow(spread, "chunk int, places binary").repartition("chunk").mapInArrow(packed, "chunk int, words binary").collect():  # MAX_BITS at most
        words[row["chunk"] * CHUNK_WORDS :][:CHUNK_WORDS] = np.frombuffer(row["words"], np.uint64)
    return bits, probes, words[: bits // 64]


def build(listed: DataFrame, universe: DataFrame) -> Cascade:
    """The cascade of listed(key string) over universe(key string), the complete keys of the corpus. Nulls are ignored."""
    two = lambda df: df.where(F.col("key").isNotNull()).select(hashed(F.col("key")).alias("h")).select("h.a", "h.b").distinct()
    include = staged(two(listed), "cascade-listed")
    exclude = staged(two(universe).join(include, ["a", "b"], "left_anti"), "cascade-others")
    spark, levels = listed.sparkSession, []
    while n := include.count():
        number = len(levels)
        if number >= 64:
            raise RuntimeError("two keys have the same 128-bit hash")
        levels.append(made := _level(include, n, number))
        shared = spark.sparkContext.broadcast(made)  # MAX_BITS at most

        def run(batches: Iterator[pa.RecordBatch], shared=shared, number=number) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = passes(batch.column(0).to_numpy(), batch.column(1).to_numpy(), number, *shared.value)
                yield batch.filter(pa.array(hit))

        passing = staged(exclude.mapInArrow(run, "a long, b long"), "cascade-pass")
        dropped(spark, exclude)
        include, exclude = passing, include
    for df in (include, exclude):
        dropped(spark, df)
    return Cascade(levels)


def judge(pages: DataFrame, blocked: DataFrame, rules=RULES) -> DataFrame:
    """One row per row of pages(page_id, url): page_id, host, path, rule, verdict, listed.

    A rule's verdict comes first; else the page is blocked if its host, a parent domain or its address (host and path) is in
    blocked(key), and allowed if not. A null url, and one without ://, has empty host and path, fits no rule and is allowed. Hosts and
    paths of any length are looked up whole. Of rules of equal length that with the longer host wins. Repeated rows are judged each, keys
    that are listed twice count once;
    rows without page_id are judged too. Empty tables and lists are allowed; other columns are ignored."""
    spark = pages.sparkSession
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    # the host of a listed key is lower-cased, a path is as it is
    at = F.instr("key", "/")
    key = F.when(at > 0, F.concat(ascii_lower(F.substring("key", F.lit(1), at - 1)), F.substring("key", at, F.length("key")))).otherwise(ascii_lower(F.col("key")))
    listed = blocked.select(key.alias("key"))
    # no key has more labels than the longest that is listed
    most = listed.filter(F.col("key").isNotNull() & ~F.contains("key", F.lit("/"))).agg(F.max(n_labels(F.col("key")))).first()[0] or 1
    address = F.when(F.col("host") != "", F.concat("host", "path"))
    keyed = base.withColumn("keys", F.array_compact(F.array_append(host_keys(F.col("host"), most), F.when(F.col("path") != "", address))))
    cascade = spark.sparkContext.broadcast(build(listed, keyed.select(F.explode("keys").alias("key"))))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ready = keyed.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("_verdict"), F.transform("keys", hashed).alias("h")).select(
        "page_id", "host", "path", "rule", "_verdict", F.col("h.a").alias("a"), F.col("h.b").alias("b")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(5), batch.column(6)
            rows = np.repeat(np.arange(len(a)), np.diff(a.offsets.to_numpy()))
            hit = cascade.value.member(a.flatten().to_numpy(zero_copy_only=False), b.flatten().to_numpy(zero_copy_only=False))
            listed = np.bincount(rows[hit], minlength=len(a)) > 0
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(listed)], names=["page_id", "host", "path", "rule", "_verdict", "listed"])

    judged = ready.mapInArrow(run, "page_id long, host string, path string, rule string, _verdict string, listed boolean")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("_verdict", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    address = F.concat(host_of(F.col("url")), path_of(F.col("url")))
    own = pages.select(address.alias("key")).filter(F.contains("key", F.lit("/")) & F.md5(F.col("key").cast("binary")).startswith(LISTED))
    return judge(pages, spark.createDataFrame([(h,) for h in BLOCKED_HOSTS], "key string").unionByName(own))


def _oracle() -> str:
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    ranked = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), -len(r[1])))
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in ranked)
    verdict = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in ranked)
    listed = " OR ".join(f"host = '{h}' OR ends_with(host, '.{h}')" for h in BLOCKED_HOSTS)
    listed += f" OR (host <> '' AND contains(host || path, '/') AND starts_with(md5(host || path), '{LISTED}'))"
    return f"""
WITH a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), '{UPPER}', '{LOWER}') AS host,
             coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM a)
SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict} WHEN {listed} THEN 'block' ELSE 'allow' END AS verdict, ({listed}) AS listed
FROM u
"""


ORACLE = _oracle()
