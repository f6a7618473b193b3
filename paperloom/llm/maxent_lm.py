"""Scoring text with a hashed maximum-entropy model, class-factored.

The words are the leaves of nested classes: P(word | history) is the product, over the levels down to the word, of
P(class | class above, history), each a softmax over FANOUT classes. All of them, down to the single word, have hashed
n-gram and skip features with trained weights: the word before, the one before that alone, and, on the upper levels, both.
A feature's row of weights is a hash of the history and of the class above. Training is by rounds of distributed gradient
updates: every task takes AdaGrad steps from the round's weights over its documents, and the tasks' rows are averaged, each
by how often it was met. Every document takes part in each round, with another share of its words.

Classes come from exact counts over all training text: words are ordered by their spelling from the end, and a class is cut into
parts of about equal mass, frequent words being parts of their own. Words beyond the most frequent ones (HEAD at most) form
OTHERS classes by their endings, in which they have their smoothed relative frequency; so have words in classes of less mass
than LEAST, in which there is nothing to learn. Vocabulary, classes and rows of weights grow with the corpus.

Text is tokenised twice, for the counts and for ids, which are staged; training and scoring read ids only.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, staged, table, texts_of

END = b"\n"  # after each text; no word has white space
HEAD, HEAD_COUNT = 1 << 18, 3
OTHERS = 16
FANOUT, LEVELS, LEAST = 16, 5, 256
#: Features on each level: the last one is the pair of words.
FEATURES = (3, 3, 2, 2, 2)
#: Rows of weights of each feature of a level: about one for each so many training tokens, within bounds.
ROW_TOKENS, LEAST_BITS, MOST_BITS = 128, 12, 16
ROUNDS, RATE, BATCH = 2, 0.5, 16_384
#: Training tokens of a task at least, so that the weights that tasks exchange are small beside the text.
TASK_TOKENS = 16_000_000
#: Rows of weights that are exchanged together.
CHUNK = 64
SMOOTH = 0.1
MEMO = 1 << 18


def part_of(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def bare(word: bytes) -> bytes:
    return word.rstrip(b".,;:!?)\"'") or word


def other(word: bytes) -> int:
    """The class of a word that is not frequent: by its last two bytes before punctuation."""
    return zlib.crc32(bare(word)[-2:]) % OTHERS


def count(docs: DataFrame) -> DataFrame:
    """(token binary, c) of docs(text), exact; tasks count before the shuffle and hold a million words at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["token", "c"])

        for batch in slices(batches, "text"):
            for text in texts_of(batch, "text"):
                seen.update(text.lower().split())
                seen[END] += 1
            if len(seen) > 1_000_000:
                yield out()
                seen.clear()
        if seen:
            yield out()

    return docs.select("text").mapInArrow(run, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


def head_words(counts: DataFrame, most: int = HEAD, at_least: int = HEAD_COUNT) -> tuple[list[bytes], list[int]]:
    """The most frequent words, `most` at most: all above a count that a histogram over logarithmic bins gives."""
    step = F.floor(F.log2("c") * 16).cast("int")
    often = counts.filter(F.col("c") >= at_least)
    bins = sorted(((r["b"], r["n"]) for r in often.groupBy(step.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    total, least = 0, None
    for b, n in bins:
        if total + n > most:
            break
        total, least = total + n, b
    if least is None:
        return [], []
    rows = sorted(((-r["c"], bytes(r["token"])) for r in often.filter(step >= least).collect()))
    return [t for _, t in rows], [-c for c, _ in rows]


class Ids(dict):
    """token -> its rank, or the number of ranks + class for other words."""

    def __init__(self, head: list[bytes]):
        super().__init__((t, i) for i, t in enumerate(head))
        self.size, self.memo = len(head), {}

    def __missing__(self, token: bytes) -> int:
        found = self.memo.get(token)
        if found is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            found = self.memo[token] = self.size + other(token)
        return found


class Classes:
    """Nested classes of items, the frequent words by rank and then the OTHERS classes: by level and item its node (-1 below
    its last) and its place there, log P(item | last class), and the logarithms of the places' masses by node."""

    def __init__(self, head: list[bytes], mass: np.ndarray):
        n = len(mass)
        self.node, self.place, self.last = np.full((LEVELS, n), -1, np.int32), np.zeros((LEVELS, n), np.uint8), np.zeros(n)
        biases = []
        order = sorted(range(len(head)), key=lambda i: bare(head[i])[::-1])
        todo = [(np.array(order + list(range(len(head), n)), np.int64), 0)]
        while todo:
            items, level = todo.pop()
            m = mass[items]
            if len(items) == 1:
                continue
            if level == LEVELS or m.sum() < LEAST:
                self.last[items] = np.log(m / m.sum())
                continue
            part = self.parts(m)
            bias = np.full(FANOUT, -30.0, np.float32)
            shares = np.bincount(part, m) / m.sum()
            bias[: len(shares)] = np.log(shares)
            self.node[level, items], self.place[level, items] = len(biases), part
            biases.append(bias)
            todo += [(items[part == k], level + 1) for k in range(len(shares))]
        self.bias = np.array(biases or np.zeros((1, FANOUT)), np.float32)

    @staticmethod
    def parts(m: np.ndarray) -> np.ndarray:
        """The part of each of a class's items of these masses."""
        if len(m) <= FANOUT:
            return np.arange(len(m))
        heavy = np.flatnonzero(m >= m.sum() / FANOUT)
        heavy = heavy[np.argsort(-m[heavy], kind="stable")][: FANOUT - 1]
        part, light = np.empty(len(m), np.int64), np.ones(len(m), bool)
        part[heavy], light[heavy] = np.arange(len(heavy)), False
        middle = np.cumsum(m[light]) - m[light] / 2
        cut = (middle / m[light].sum() * (FANOUT - len(heavy))).astype(np.int64)
        part[light] = len(heavy) + np.unique(cut, return_inverse=True)[1]
        return part


_ONE, _TWO, _THREE = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)
_ONES = np.ones(FANOUT, np.float32)


def contexts(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashes of each token's history: before, before that (skip), both. A document's first tokens have none before them."""
    none = np.uint32(0xFFFFFF)
    one, two = np.full(len(ids), none), np.full(len(ids), none)
    one[1:], two[2:] = ids[:-1], ids[:-2]
    one[starts] = two[starts] = none
    second = starts + 1
    two[second[second < len(ids)]] = none
    one *= _ONE
    one ^= one >> np.uint32(15)
    two *= _TWO
    two ^= two >> np.uint32(13)
    return np.stack([one, two, (one * _THREE) ^ (two * _ONE)])


class Model:
    """weights: for each feature of each level 2^bits rows of FANOUT numbers."""

    def __init__(self, classes: Classes, bits: int, weights: np.ndarray | None = None):
        self.classes, self.bits = classes, bits
        shape = (sum(FEATURES), 1 << bits, FANOUT)
        self.weights = np.zeros(shape, np.float32) if weights is None else weights.astype(np.float32).reshape(shape)

    def start(self) -> None:
        """Begins a round."""
        self.gathered = np.ones(self.weights.shape[:2], np.float32)
        self.met = np.zeros(self.weights.shape[:2], np.int32)

    def levels(self, ids: np.ndarray, context: np.ndarray) -> Iterator[tuple[slice | np.ndarray, np.ndarray, list[tuple[int, np.ndarray]], np.ndarray]]:
        """For each level: which tokens reach it, their places there, (table, row) of their features, and the classes' scores."""
        which: slice | np.ndarray = slice(None)
        table_ = 0
        for level, features in enumerate(FEATURES):
            node = np.take(self.classes.node[level], ids[which])
            on = np.flatnonzero(node >= 0)
            if not len(on):
                return
            if len(on) < len(node):
                node, which = node[on], on if isinstance(which, slice) else which[on]
            at = (node.astype(np.uint32) + np.uint32(1)) * _TWO
            rows = [(table_ + k, (((context[k][which] ^ at) * _THREE) >> np.uint32(32 - self.bits)).astype(np.uint16)) for k in range(features)]
            x = np.take(self.classes.bias, node, axis=0, mode="clip")
            for t, r in rows:
                x += np.take(self.weights[t], r, axis=0, mode="clip")
            np.clip(x, -60, 60, out=x)
            yield which, np.take(self.classes.place[level], ids[which]), rows, x
            table_ += features

    def log_probs(self, ids: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Natural log P(item | history) of each token."""
        out = self.classes.last[ids]
        for which, place, _, x in self.levels(ids, context):
            mine = x[np.arange(len(place)), place]
            np.exp(x, out=x)
            out[which] += mine - np.log(x @ _ONES)
        return out

    def learn(self, ids: np.ndarray, context: np.ndarray) -> None:
        """One gradient step over a batch."""
        for _, place, rows, x in self.levels(ids, context):
            np.exp(x, out=x)
            x /= (x @ _ONES)[:, None]
            x[np.arange(len(place)), place] -= 1
            for t, r in rows:
                row, n, step = summed(r, x)
                g = np.take(self.gathered[t], row)
                g += np.einsum("ij,ij->i", step, step) / 4
                self.gathered[t][row] = g
                self.met[t][row] += n
                step *= (-RATE / np.sqrt(g))[:, None]
                w = self.weights[t]
                step += np.take(w, row, axis=0, mode="clip")
                # a row is one value for the assignment
                w.view(f"V{4 * FANOUT}").ravel()[row] = step.view(f"V{4 * FANOUT}").ravel()


def summed(rows: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows, how often each comes, and the sums of x over each. Short runs are added place by place, long ones at once."""
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    first = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1])
    n = np.diff(first, append=len(ordered))
    out = np.take(x, order[first], axis=0, mode="clip")
    more, k = np.flatnonzero(n > 1), 1
    while len(more) and k < 4:
        out[more] += np.take(x, order[first[more] + k], axis=0, mode="clip")
        k += 1
        more = more[n[more] > k]
    if len(more):
        rest = n[more] - k
        base = np.cumsum(rest) - rest
        at = np.arange(rest.sum()) + np.repeat(first[more] + k - base, rest)
        out[more] += np.add.reduceat(np.take(x, order[at], axis=0, mode="clip"), base, axis=0)
    return ordered[first].astype(np.int64), n, out


def _ids_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch's documents and their lengths."""
    texts = texts_of(batch, "ids")
    return np.frombuffer(b"".join(texts), np.int32), np.fromiter(map(len, texts), np.int64, len(texts)) // 4


def train(ids: DataFrame, classes: Classes, n_tokens: int, rounds: int = ROUNDS) -> Model:
    """Learns from ids(ids binary). Round r takes the words whose place in their document is r modulo the rounds."""
    spark = ids.sparkSession
    bits = min(MOST_BITS, max(LEAST_BITS, int(n_tokens // ROW_TOKENS).bit_length()))
    model, shape = Model(classes, bits), (sum(FEATURES) << bits, FANOUT)
    tasks = max(1, -(-n_tokens // TASK_TOKENS))
    fixed = spark.sparkContext.broadcast(classes)
    for r in range(rounds if n_tokens else 0):
        shared = spark.sparkContext.broadcast(model.weights.astype(np.float16))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, r=r) -> Iterator[pa.RecordBatch]:
            mine = Model(fixed.value, bits, shared.value)
            mine.start()
            for batch in slices(batches, "ids"):
                flat, lengths = _ids_of(batch)
                starts = np.cumsum(lengths) - lengths
                turn = np.flatnonzero((np.arange(len(flat)) - np.repeat(starts, lengths)) % rounds == r)
                context, flat = contexts(flat, starts)[:, turn], flat[turn]
                for a in range(0, len(flat), BATCH):
                    mine.learn(flat[a : a + BATCH], context[:, a : a + BATCH])
            w, met = mine.weights.reshape(-1, CHUNK, FANOUT), mine.met.reshape(-1, CHUNK)
            some = np.flatnonzero(met.any(axis=1))
            for a in range(0, len(some), 1024):
                part = some[a : a + 1024]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.astype(np.int32)), pa.array([x.tobytes() for x in met[part]], pa.binary()), pa.array([x.tobytes() for x in w[part].astype(np.float16)], pa.binary())],
                    names=["chunk", "n", "w"],
                )

        def averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # a share of the model's chunks
            for batch in batches:
                for chunk, n, w in zip(*(c.to_pylist() for c in batch.columns)):
                    n, w = np.frombuffer(n, np.int32).astype(np.float64)[:, None], np.frombuffer(w, np.float16).reshape(CHUNK, FANOUT)
                    if chunk in sums:
                        sums[chunk][0][:] += n
                        sums[chunk][1][:] += n * w
                    else:
                        sums[chunk] = (n.copy(), n * w)
            for chunk, (n, w) in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([(w / np.maximum(n, 1)).astype(np.float16).tobytes()], pa.binary())], names=["chunk", "w"])

        learned = ids.select("ids").coalesce(tasks).mapInArrow(run, "chunk int, n binary, w binary")
        w = model.weights.reshape(-1, CHUNK, FANOUT)
        for row in learned.repartition("chunk").mapInArrow(averaged, "chunk int, w binary").collect():  # the model, sum(FEATURES) << MOST_BITS rows at most
            # rows that no task met are zero in all of them
            w[row["chunk"]] = np.frombuffer(row["w"], np.float16).reshape(CHUNK, FANOUT)
        shared.unpersist()
    return model


_IDS = "doc_id long, held_out boolean, n_tokens long, ids binary, rare array<binary>"
_SCORED = "doc_id long, held_out boolean, n_tokens long, row long, known long, base double, model double"


def score(docs: DataFrame) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A null text is empty and has its end token only; a null doc_id counts as the empty text in the hash, so such rows are held out. Repeated
    rows count and are scored each. Texts of any length are read whole. Without training text every token is unknown. An empty table gives none; other
    columns are ignored."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.pmod(part_of(F.col("doc_id")), F.lit(10)) == 0).alias("held_out"), F.col("text").cast("string").alias("text"))
    counts = staged(count(docs.filter(~F.col("held_out"))), "lm-counts")
    head, head_counts = head_words(counts)
    vocabulary = spark.sparkContext.broadcast(head)

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, c, v = Ids(vocabulary.value), np.zeros(OTHERS + 1), np.zeros(OTHERS + 1)
        for batch in batches:
            which = np.maximum(np.fromiter(map(ids.__getitem__, batch.column(0).to_pylist()), np.int64, batch.num_rows) - ids.size, -1)
            c += np.bincount(which + 1, batch.column(1).to_numpy(), OTHERS + 1)
            v += np.bincount(which + 1, minlength=OTHERS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(OTHERS + 1, dtype=np.int32)), pa.array(c.astype(np.int64)), pa.array(v.astype(np.int64))], names=["class", "c", "v"])

    size, distinct = np.zeros(OTHERS + 1), np.zeros(OTHERS + 1)
    for r in counts.mapInArrow(grouped, "class int, c long, v long").groupBy("class").agg(F.sum("c").alias("c"), F.sum("v").alias("v")).collect():
        size[r["class"]], distinct[r["class"]] = r["c"], r["v"]
    n, v = int(size.sum()), int(distinct.sum())
    others = size[1:] + SMOOTH * (distinct[1:] + 1)
    classes = Classes(head, np.concatenate([np.array(head_counts, float), others]))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids(vocabulary.value)
        for batch in slices(batches, "text"):
            texts = [tokens(t) for t in texts_of(batch, "text")]
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            words = list(chain.from_iterable(texts))
            flat = np.fromiter(map(ids.__getitem__, words), np.int32, len(words))
            ends = np.concatenate([[0], np.cumsum(lengths)])
            rare = np.flatnonzero(flat >= ids.size)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(lengths),
                    pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(flat)]),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(rare, ends).astype(np.int32)), pa.array([words[i] for i in rare.tolist()], pa.binary())),
                ],
                names=["doc_id", "held_out", "n_tokens", "ids", "rare"],
            )

    ids = staged(docs.mapInArrow(numbered, _IDS).withColumn("row", F.monotonically_increasing_id()), "lm-ids")
    model = train(ids.filter(~F.col("held_out")), classes, n)
    log_counts = np.concatenate([np.log10(np.array(head_counts, float) + SMOOTH), np.zeros(OTHERS)])
    log_others = np.concatenate([np.zeros(len(head)), np.log10(others)])
    shared = spark.sparkContext.broadcast((classes, model.bits, model.weights.astype(np.float16), log_counts, log_others))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, bits, weights, log_counts, log_others = shared.value
        model, n_head = Model(classes, bits, weights), len(log_counts) - OTHERS
        for batch in slices(batches, "ids"):
            flat, lengths = _ids_of(batch)
            starts = np.cumsum(lengths) - lengths
            context, got = contexts(flat, starts), np.empty(len(flat))
            for a in range(0, len(flat), BATCH):
                got[a : a + BATCH] = model.log_probs(flat[a : a + BATCH], context[:, a : a + BATCH])
            got = got / np.log(10) - log_others[flat]
            sums = [np.add.reduceat(x, starts) for x in ((flat < n_head).astype(np.int64), log_counts[flat], got)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *map(pa.array, sums)], names=["doc_id", "held_out", "n_tokens", "row", "known", "base", "model"])

    scored = ids.select("doc_id", "held_out", "n_tokens", "row", "ids").mapInArrow(run, _SCORED)
    # of a word among OTHERS the counts are met in a shuffle join, in which no word is frequent
    rare = ids.select("row", F.explode("rare").alias("token")).join(counts, "token", "left")
    log_c = F.log10(F.coalesce("c", F.lit(0)) + F.lit(SMOOTH))
    tail = rare.groupBy("row").agg(F.sum(log_c).alias("tail"), F.count("c").alias("tail_known"))
    whole = scored.join(tail, "row", "left")
    words, rest = F.col("base") + F.coalesce("tail", F.lit(0.0)), F.coalesce("tail", F.lit(0.0))
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("tail_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (words - F.col("n_tokens") * F.lit(float(np.log10(n + SMOOTH * (v + 1))))).alias("base_score"),
        (F.col("model") + rest).alias("score"),
    )


def op5_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
