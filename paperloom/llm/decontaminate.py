"""Benchmark decontamination by winnowing.

Of every `WINDOW` consecutive K-grams of words the one with the least hash is a fingerprint. Test items and documents
that share a span of K + WINDOW - 1 = 13 words therefore share a fingerprint inside it; each shared fingerprint is a
seed that is extended word by word, and runs of 13 or more equal words are hits. Items of fewer than 13 words, for
which winnowing promises nothing, are one window as a whole and are looked up at every position by their length.

The fingerprints of the test items are joined with the documents' in blocks: each block holds about BLOCK_WORDS words of
items, so what executors get has a bound whatever the benchmark's size; documents are never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Hashes, columns, mix64, packed, prefix, slices, staged, table, texts_of, unpacked

SPAN, K = 13, 7
WINDOW = SPAN - K + 1
#: Words of benchmark items that are held by executors at once.
BLOCK_WORDS = 2_000_000
#: The contract's rule: a document is contaminated if SHARE * n_hit >= n_words.
SHARE = 20

_WORD = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() and b < 128 else 32 for b in range(256))


def words(text: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and non-ASCII characters."""
    return text.translate(_WORD).split()


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive entries."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out *= np.uint64(0x9E3779B97F4A7C15)
            out += h[j : j + n]
    return mix64(out)


def winnow(g: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Whether each K-gram is the least of a window that it is in (all of them if several are equal)."""
    n = len(g) - window + 1
    chosen = np.zeros(len(g), bool)
    if n <= 0:
        return chosen
    least = g[:n].copy()
    for j in range(1, window):
        np.minimum(least, g[j : j + n], out=least)
    for j in range(window):
        chosen[j : j + n] |= g[j : j + n] == least
    return chosen


class Index:
    """Fingerprints of a block of items: hash -> [(item number, position)]; short items by their number of words."""

    BITS = 22

    def __init__(self, items: list[tuple[str | None, bytes]]):
        hashes = Hashes()
        self.ids, self.words, self.seeds, self.short = [], [], {}, {}
        for item_id, text in items:
            w = words(text)
            if not w:
                continue
            number = len(self.ids)
            self.ids.append(item_id)
            self.words.append(w)
            h = hashes.of(w)
            if len(w) < SPAN:
                self.short.setdefault(len(w), {}).setdefault(int(grams(h, len(w))[0]), []).append(number)
            else:
                g = grams(h, K)
                for q in np.flatnonzero(winnow(g)).tolist():
                    self.seeds.setdefault(int(g[q]), []).append((number, q))
        self.maps = {0: self._map(self.seeds)} | {n: self._map(x) for n, x in self.short.items()}

    def _map(self, keys) -> np.ndarray:
        bits = np.zeros(1 << self.BITS, bool)
        if keys:
            bits[(np.fromiter(keys, np.uint64, len(keys)) >> np.uint64(64 - self.BITS)).astype(np.int64)] = True
        return bits

    def _likely(self, g: np.ndarray, which: int) -> np.ndarray:
        return self.maps[which][(g >> np.uint64(64 - self.BITS)).astype(np.int64)]

    def scan(self, docs: list[list[bytes]], hashes: Hashes) -> list[tuple[list[tuple[int, int]], set[int]]]:
        """For each document the hit spans of word positions and the item numbers."""
        found: list = [([], set()) for _ in docs]
        lengths = np.fromiter(map(len, docs), np.int64, len(docs))
        starts = np.concatenate([[0], np.cumsum(lengths)])
        flat = [w for d in docs for w in d]
        if not flat:
            return found
        h = hashes.of(flat)
        owner = np.repeat(np.arange(len(docs)), lengths)

        def inside(p: np.ndarray, k: int) -> np.ndarray:
            return p[owner[p] == owner[p + k - 1]]

        if self.seeds:
            g = grams(h, K)
            if len(g):
                # the least over windows that lie in one document: others are ignored by masking their grams
                reached: dict = {}  # (document, item, diagonal) -> end of the run found there, so that each run is extended once
                whole = owner[: len(g)] == owner[K - 1 : K - 1 + len(g)]
                masked = np.where(whole, g, np.uint64(0xFFFFFFFFFFFFFFFF))
                for p in np.flatnonzero(winnow(masked) & whole & self._likely(g, 0)).tolist():
                    for number, q in self.seeds.get(int(g[p]), ()):
                        d = int(owner[p])
                        lo, hi, item = int(starts[d]), int(starts[d + 1]), self.words[number]
                        if reached.get((d, number, p - q), -1) >= p + K or flat[p : p + K] != item[q : q + K]:
                            continue
                        left = 0
                        while p - left > lo and q - left > 0 and flat[p - left - 1] == item[q - left - 1]:
                            left += 1
                        right = K
                        while p + right < hi and q + right < len(item) and flat[p + right] == item[q + right]:
                            right += 1
                        reached[d, number, p - q] = p + right
                        if left + right >= SPAN:
                            found[d][0].append((p - left - lo, p + right - lo))
                            found[d][1].add(number)
        for n, keys in self.short.items():
            g = grams(h, n)
            if not len(g):
                continue
            for p in inside(np.flatnonzero(self._likely(g, n)), n).tolist():
                for number in keys.get(int(g[p]), ()):
                    if flat[p : p + n] == self.words[number]:
                        d = int(owner[p])
                        found[d][0].append((p - int(starts[d]), p + n - int(starts[d])))
                        found[d][1].add(number)
        return found


def merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


_HITS = "doc_id long, n_words long, starts array<long>, ends array<long>, items array<string>"


def _hits(docs: DataFrame, items: list[tuple[str | None, bytes]]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, hashes = Index(shared.value), Hashes()
        for batch in slices(batches, "text"):
            tokens = [words(t) for t in texts_of(batch, "text")]
            found = index.scan(tokens, hashes)
            spans = [merged(s) for s, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t) for t in tokens], pa.int64()),
                    pa.array([[a for a, _ in s] for s in spans], pa.list_(pa.int64())),
                    pa.array([[b for _, b in s] for s in spans], pa.list_(pa.int64())),
                    pa.array([list({index.ids[i] for i in n}) for _, n in found], pa.list_(pa.string())),
                ],
                names=["doc_id", "n_words", "starts", "ends", "items"],
            )

    return docs.mapInArrow(run, _HITS)


_OUT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        spans = [merged(zip(r["starts"], r["ends"])) for r in rows]
        hit = [sum(b - a for a, b in s) for s in spans]
        items = [set(r["items"]) for r in rows]
        names = [sorted((x for x in i if x is not None), key=lambda x: x.encode()) for i in items]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(hit, pa.int64()),
                pa.array([len(i) for i in items], pa.int64()),
                pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in names]),
                pa.array([h > 0 and SHARE * h >= r["n_words"] for h, r in zip(hit, rows)]),
            ],
            names=[x.split()[0] for x in _OUT.split(", ")],
        )


def _blocks(benchmark: DataFrame) -> tuple[DataFrame, int]:
    items = staged(benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")), "benchmark")
    total = items.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")))).first()[0] or 0
    return items, max(1, -(-total // BLOCK_WORDS))


def _block(items: DataFrame, blocks: int, number: int) -> list[tuple[str | None, bytes]]:
    """A block's items; each has about BLOCK_WORDS words."""
    return [(r["item_id"], r["text"].encode()) for r in items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect()]


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs(doc_id, text, ...) that are not contaminated, with all their columns. Each row is judged by its own text."""
    items, blocks = _blocks(benchmark)
    if blocks > 1:
        row = prefix(docs) + "row"
        rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "decontam-rows")
        judged = contamination(rows.select(F.col(row).alias("doc_id"), "text"), benchmark)
        bad = staged(judged.filter("contaminated").select(F.col("doc_id").alias(row)), "decontam-bad")
        return rows.join(bad, row, "left_anti").select(*columns(docs))
    shared = docs.sparkSession.sparkContext.broadcast(_block(items, blocks, 0))
    mine = packed(docs, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, hashes = Index(shared.value), Hashes()
        for batch in slices(batches, "text"):
            tokens = [words(t) for t in texts_of(batch, "text")]
            hit = [sum(b - a for a, b in merged(s)) for s, _ in index.scan(tokens, hashes)]
            yield batch.filter(pa.array([not (h > 0 and SHARE * h >= len(t)) for h, t in zip(hit, tokens)], pa.bool_()))

    return unpacked(mine.mapInArrow(run, mine.schema), docs, "text")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of docs(doc_id, text): n_words, n_hit, n_items, items_sha256, contaminated.

    Nulls: a null text has no words; a null item text has none; items without an id hit words and are together one nameless item.
    Texts without words are never contaminated. Texts of any length are scanned whole. A document with exactly a 20th of its words hit is
    contaminated. Rows with equal ids stay separate rows. Items with equal ids count once. Empty tables give empty or clean
    results. Other columns are ignored."""
    items, blocks = _blocks(benchmark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    block = lambda b: _block(items, blocks, b)
    if blocks == 1:
        hits = _hits(docs, block(0))
    else:
        # one pass over the documents for each block of items; rows are told apart by a number that is staged with them
        rows = staged(docs.withColumn("row", F.monotonically_increasing_id()), "decontam-ids")
        parts = None
        for b in range(blocks):
            found = _hits(rows.select(F.col("row").alias("doc_id"), "text"), block(b))
            parts = found if parts is None else parts.unionByName(found)
        hits = (
            parts.groupBy("doc_id")
            .agg(F.max("n_words").alias("n_words"), *(F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends", "items")))
            .withColumnRenamed("doc_id", "row")
            .join(rows.select("row", "doc_id"), "row")
            .select("doc_id", "n_words", "starts", "ends", "items")
        )
    return hits.mapInArrow(_summary, _OUT)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Windows as strings: every 13-word window (or whole short item) against every window of the same length of a document.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), b AS (
  SELECT item_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), lens AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN lens WHERE len(w) >= n)
), hits AS (SELECT rid, dw.n, i, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid)
"""
