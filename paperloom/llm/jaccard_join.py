"""Similarity self-join of documents on word 5-grams (Jaccard >= 0.8) by chosen paths.

In each of several runs a set goes into the buckets of its CHOICES least tokens under the run's hash: sampled tokens
that similar sets share. Buckets of more than SMALL sets are split on further tokens sampled from the whole sets, up to DEPTH levels; what
stays large then is a group of sets that share a whole path, and is compared block by block. The number of runs is the
least that reaches RECALL for a pair at the threshold whose buckets are split on all levels. Inside a bucket, sketches rule out pairs that are far from
similar; the rest is decided by exact intersections of whole sets. A pair is compared in the first bucket it shares only, so
counts of links are exact, and no pair is ever a row: buckets give each set its number of links and a spanning forest.

Equal sets are joined first (by a 128-bit digest), so copies cost one set. Rows are told apart by a number of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Hashes, dropped, joined_small, mix64, slices, staged, table, texts_of

N, THRESHOLD, RECALL = 5, 0.8, 0.9999
CHOICES, SMALL, DEPTH = 2, 400, 3
#: A bucket that kept more than this share of the one above it holds near copies, which no token tells apart: it is split no further.
SHRINK = 0.7
#: Sets of a block of a group that stays large.
BLOCK = 1000
SKETCH = 64
#: Common sketch entries of a pair at the threshold: 51 of 64 expected, 3.2 standard deviation.
SKETCH_SHARE = 0.5


def runs_for(recall: float = RECALL, threshold: float = THRESHOLD, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has shared a bucket with this probability, if a level is passed with about 1 - (1 - t)^CHOICES
    and its buckets are split on all levels."""
    once = (1 - (1 - threshold) ** CHOICES) ** (depth + 1)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - once)))


def shingles(text: bytes, hashes: Hashes) -> np.ndarray:
    """Sorted distinct hashes of the text's word 5-grams (ASCII white space between words, A-Z lower-cased); a shorter text is one."""
    tokens = text.lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    h, n = hashes.of(tokens), min(N, len(tokens))
    out = np.zeros(len(h) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + len(out)]
        if n < N:
            out += np.uint64(n)
    return np.unique(mix64(out))


def digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def choose(tokens: np.ndarray, salt: int, path: int) -> list[int]:
    """Ids of the buckets below a path: its hash with each of the CHOICES least tokens."""
    h = mix64(tokens ^ np.uint64(path), salt)
    least = np.sort(np.partition(h, CHOICES - 1)[:CHOICES]) if len(h) > CHOICES else h
    return mix64(least, 977 + salt).view(np.int64).tolist()


_SETS = "row long, doc_id long, node long, digest binary, n int, sketch binary, buckets array<long>"


def describe(rows: DataFrame, runs: int) -> DataFrame:
    """rows(row, doc_id, text) with a node, the mixed row number, and the digest, size, sketch and first buckets of their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in slices(batches, "text"):
            sets = [shingles(t, hashes) for t in texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array(mix64(batch.column(0).to_numpy().view(np.uint64)).view(np.int64)),
                    pa.array([digest(s) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([(s[:SKETCH] >> np.uint64(32)).astype(np.uint32).tobytes() for s in sets], pa.binary()),
                    pa.array([sorted({b for r in range(runs) for b in choose(s, r, 0)}) if len(s) else [] for s in sets], pa.list_(pa.int64())),
                ],
                names=["row", "doc_id", "node", "digest", "n", "sketch", "buckets"],
            )

    return rows.mapInArrow(run, _SETS)


def whole_sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, set) of wanted(node, row), from the texts of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in slices(batches, "text"):
            found = [shingles(t, hashes).tobytes() for t in texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["node", "set"])

    return joined_small(rows.select("row", "text"), wanted.select("node", "row"), ["row"], "inner").select("node", "text").mapInArrow(run, "node long, set binary")


def _split(large: DataFrame, level: int) -> DataFrame:
    """(node, bucket, above) below the buckets of large(set, node, buckets array<struct<bucket,c>>), above being the size of the bucket split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "set"):
            nodes, found, above = [], [], []
            for data, node, buckets in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = np.frombuffer(data, np.uint64)
                below = {b: x["c"] for x in buckets for b in choose(tokens, 100 + level, x["bucket"] & 0xFFFFFFFFFFFFFFFF)}
                nodes += [node] * len(below)
                found += below
                above += below.values()
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(found, pa.int64()), pa.array(above, pa.int64())], names=["node", "bucket", "above"])

    return large.select("set", "node", "buckets").mapInArrow(run, "node long, bucket long, above long")


def paths(classes: DataFrame, rows: DataFrame, small: int = SMALL, depth: int = DEPTH) -> DataFrame:
    """(node, bucket, c): the buckets of two or more sets at which the recursion ends, with their sizes."""
    spark = classes.sparkSession
    live_rows, done, sets = classes.select("node", F.explode("buckets").alias("bucket"), F.lit(None).cast("long").alias("above")), None, None
    for level in range(depth + 1):
        counts = staged(live_rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "join-counts")
        live = staged(joined_small(live_rows, counts, ["bucket"], "inner"), "join-rows")
        dropped(spark, counts)
        if level:
            dropped(spark, live_rows)
        large = (F.col("c") > small) & (F.col("above").isNull() | (F.col("c") <= SHRINK * F.col("above")))
        ended = (live if level == depth else live.filter(~large)).select("node", "bucket", "c")
        done = ended if done is None else done.unionByName(ended)
        if level == depth or not live.filter(large).take(1):
            break
        split = staged(live.filter(large).groupBy("node").agg(F.collect_list(F.struct("bucket", "c")).alias("buckets")), "join-large")
        if sets is None:
            wanted = staged(split.select("node").join(classes.select("node", "row"), "node"), "join-large-rows")
            sets = staged(whole_sets(rows, wanted), "join-large-sets")
            dropped(spark, wanted)
        live_rows = staged(_split(sets.join(split, "node"), level), "join-split")
        dropped(spark, split)
    if sets is not None:
        dropped(spark, sets)
    return done


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The runs of equal keys of sorted batches, each whole."""
    rest = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        part = part if rest is None else pa.concat_tables([rest, part])
        if not part.num_rows:
            continue
        keys = part.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist()]
        part = part.combine_chunks()
        for a, b in zip(cuts, cuts[1:]):
            yield part.slice(a, b - a)
        rest = part.slice(cuts[-1])
    if rest is not None and rest.num_rows:
        yield rest


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections."""
    m = len(sets)
    if m == 2:
        c = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), c], [c, len(sets[1])]])
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    out = np.zeros((m, m), np.float32)
    shared = times[token] > 1
    owner, token = owner[shared], token[shared]
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    if len(token):
        token = np.concatenate([[0], np.cumsum(token[1:] != token[:-1])])
        step = max(256, (1 << 22) // m)
        for a in range(0, int(token[-1]) + 1, step):
            lo, hi = np.searchsorted(token, [a, a + step])
            x = np.zeros((m, min(step, int(token[-1]) + 1 - a)), np.float32)
            x[owner[lo:hi], token[lo:hi] - a] = 1
            out += x @ x.T
    out[np.arange(m), np.arange(m)] = [len(s) for s in sets]
    return out


def owned(part: pa.Table) -> np.ndarray:
    """Which pairs of a group's rows belong to it: those whose first common bucket this is, largest buckets first, and in it those of the
    group's two blocks. The pairs of a group of near copies so meet in few of the group's buckets."""
    m, bucket = part.num_rows, part.column("bucket")[0].as_py()
    before: dict[int, list[int]] = {}
    for i, where in enumerate(part.column("paths").to_pylist()):
        for b in where[: where.index(bucket)]:
            before.setdefault(b, []).append(i)
    out = np.ones((m, m), bool)
    for rows in before.values():
        if len(rows) > 1:
            out[np.ix_(rows, rows)] = False
    if part.column("x")[0].as_py() != part.column("y")[0].as_py():
        block = part.column("block").to_numpy()
        out &= block[:, None] != block[None, :]
    out[np.arange(m), np.arange(m)] = False
    return out


def least_connected(pairs: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """For each row the least node that it is connected with."""
    order = np.argsort(nodes)
    rank = np.empty(len(nodes), np.int32)
    rank[order] = np.arange(len(nodes))
    while True:
        least = np.minimum(rank, np.where(pairs, rank[None, :], len(nodes)).min(axis=1)).astype(np.int32)
        least = np.minimum(least, least[order][least])  # what its least neighbour has
        if (least == rank).all():
            return nodes[order][rank]
        rank = least


_ROW = "group string, bucket long, x int, y int, block int, node long, n int, sketch binary, paths array<long>"


def _dealt(final: DataFrame, classes: DataFrame, small: int, block: int = BLOCK) -> DataFrame:
    """Rows for each bucket; those of large ones for each pair of blocks that theirs is in."""
    listed = final.groupBy("node").agg(F.sort_array(F.collect_set(F.struct("c", "bucket")), asc=False).alias("p"))
    rows = classes.select("node", "n", "sketch").join(listed, "node").select("node", "n", "sketch", F.col("p.bucket").alias("paths"), F.explode("p").alias("b"))
    blocks = F.when(F.col("b.c") <= small, 1).otherwise(F.ceil(F.col("b.c") / block)).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    x, y = F.least("block", "other").cast("int"), F.greatest("block", "other").cast("int")
    return rows.select(F.concat_ws(":", F.col("b.bucket"), x, y).alias("group"), F.col("b.bucket").alias("bucket"), x.alias("x"), y.alias("y"), "block", "node", "n", "sketch", "paths")


def candidates(dealt: DataFrame, threshold: float) -> DataFrame:
    """(node, group, bucket, x, y, block, paths) of the sets with a partner in a group that sketches do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in groups(batches, "group"):
            m = part.num_rows
            if m < 2:
                continue
            n = part.column("n").to_numpy()
            sketches = [np.frombuffer(x, np.uint32) for x in part.column("sketch").to_pylist()]
            small, large = np.minimum(n[:, None], n[None, :]), np.maximum(n[:, None], n[None, :])
            near = small >= threshold * large
            if not (near.sum() > m):
                continue
            least = np.minimum(small, SKETCH)
            near &= overlaps([np.unique(s) for s in sketches]) >= SKETCH_SHARE * least
            near[np.arange(m), np.arange(m)] = False
            if not near.any():
                continue
            needed = np.flatnonzero((near & owned(part)).any(axis=1))
            if len(needed):
                yield from part.take(pa.array(needed)).select(["node", "group", "bucket", "x", "y", "block", "paths"]).combine_chunks().to_batches()

    return dealt.repartition("group").sortWithinPartitions("group").mapInArrow(run, "node long, group string, bucket long, x int, y int, block int, paths array<long>")


_LINK = "node long, root long, n_links long"


def verified(rows: DataFrame, threshold: float) -> DataFrame:
    """(node, root, n_links) for each set of each group: the least set it is connected with there, and the copies of the sets it is linked with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in groups(batches, "group"):
            m = part.num_rows
            if m < 2:
                continue
            sets = [np.frombuffer(x, np.uint64) for x in part.column("set").to_pylist()]
            n = np.array([len(s) for s in sets])
            common = overlaps(sets)
            near = common >= threshold * (n[:, None] + n[None, :] - common) - 1e-6
            near &= owned(part)
            copies, nodes = part.column("copies").to_numpy(), part.column("node").to_numpy()
            keep = np.flatnonzero(near.any(axis=1))
            if len(keep):
                roots = least_connected(near, nodes)[keep]
                yield pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(roots), pa.array([int(copies[near[a]].sum()) for a in keep.tolist()], pa.int64())], names=["node", "root", "n_links"])

    return rows.repartition("group").sortWithinPartitions("group").mapInArrow(run, _LINK)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of edges(a, b): each round maps nodes to their least neighbour and contracts; ids are hashes, so few rounds do."""
    spark = edges.sparkSession
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    roots = staged(nodes.withColumn("root", F.col("node")), "components")
    edges = staged(edges.filter("a <> b").distinct(), "edges")
    while edges.take(1):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least")
        moved = staged(roots.join(least, roots["root"] == least["a"], "left").select("node", F.coalesce("m", "root").alias("root")), "components")
        ends = edges.join(least.withColumnRenamed("m", "ma"), "a").join(least.select(F.col("a").alias("b"), F.col("m").alias("mb")), "b")
        fewer = staged(ends.filter("ma <> mb").select(F.least("ma", "mb").alias("a"), F.greatest("ma", "mb").alias("b")).distinct(), "edges")
        for old in (roots, edges, least):
            dropped(spark, old)
        roots, edges = moved, fewer
    return roots


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, small: int = SMALL, depth: int = DEPTH, block: int = BLOCK, numbered: bool = False) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, class_id, n_links, n_copies. `numbered` says that docs is staged and its ids
    are unique and not null; else rows are numbered in a staged copy.

    class_id is the least doc_id of the documents connected by links, n_links the number of other documents with a Jaccard
    similarity of at least `threshold`, exact copies among them; n_copies the number of documents with the same set.
    A null text has no words; documents without words have no links and are classes of their own. Rows without doc_id take part, and a class of such rows only has a
    null class_id; rows with equal ids are separate documents. A pair exactly at the threshold is linked. Texts of any length are compared
    whole. An empty table gives none; other columns are ignored.

    Distinct texts of one group of near copies are compared with each other once, in blocks, for the numbers of links are exact: this grows with the
    square of such a group's distinct texts, spread over many tasks."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = docs.withColumn("row", F.col("doc_id")) if numbered else staged(docs.withColumn("row", F.monotonically_increasing_id()), "join-numbered")
    rows = rows.select("row", "doc_id", "text")
    sets = staged(describe(rows, runs_for(recall, threshold, depth)), "join-sets")
    grouped = sets.filter("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.min(F.struct("node", "row")).alias("r"), F.count(F.lit(1)).alias("copies"), *(F.first(c).alias(c) for c in ("n", "sketch", "buckets"))
    )
    classes = staged(grouped.select("digest", "first", "r.node", "r.row", "copies", "n", "sketch", "buckets"), "join-classes")
    ended = paths(classes, rows, small, depth)
    used = [staged(ended, "join-paths")]
    dropped(spark, ended)
    dealt = _dealt(used[0], classes, small, block)
    wanted = staged(candidates(dealt, threshold), "join-candidates")
    for df in used:
        dropped(spark, df)
    per_node = wanted.groupBy("node").agg(F.first("paths").alias("paths"), F.collect_list(F.struct("group", "bucket", "x", "y", "block")).alias("groups"))
    needed = staged(per_node.join(classes.select("node", "row", "copies"), "node"), "join-needed")
    dropped(spark, wanted)
    made = whole_sets(rows, staged(needed.select("node", "row"), "join-needed-rows"))
    spread = made.join(needed.select("node", "copies", "paths", "groups"), "node").select("node", "paths", "copies", "set", F.explode("groups").alias("g"))
    links = staged(verified(spread.select("node", "paths", "copies", "set", "g.*"), threshold), "join-links")
    dropped(spark, needed)
    if not numbered:
        dropped(spark, rows)
    roots = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    degree = links.groupBy("node").agg(F.sum("n_links").alias("linked"))
    named = roots.join(degree, "node", "left").join(classes.select("node", "digest", "first", "copies"), "node")
    least = named.groupBy("root").agg(F.min("first").alias("class_id"))
    linked = named.join(least, "root").select("digest", "class_id", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "copies")
    alone = classes.filter("copies > 1").join(linked.select("digest"), "digest", "left_anti").select("digest", F.col("first").alias("class_id"), (F.col("copies") - 1).alias("n_links"), "copies")
    result = staged(linked.unionByName(alone), "join-result")
    out = joined_small(sets.select("doc_id", "digest", "n"), result, ["digest"], "left")
    known = F.col("copies").isNotNull()
    return out.select(
        "doc_id",
        F.when(known, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
    )


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
