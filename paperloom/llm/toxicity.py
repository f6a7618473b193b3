"""Toxicity by cumulative-link ordinal regression on sparse text features.

P(grade > k) = sigmoid(w . x - cut_k): one weight vector serves all ordered cuts. Features are hashed words, present or
not, and the words' first 4 and 5 bytes, which inflected and compound words share. The model is fitted on a bounded sample of labelled documents (MAX_TRAIN); every document is scored over its whole
text. The output is the expected severity, the sum of P(grade > k) over the cuts.

The labels at hand say toxic or not. Grades above 0 are made from them: words much more frequent in toxic than in
other sampled documents are marked, and toxic documents are graded by how many different marked words they hold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import slices, staged, table, texts_of
from .decontaminate import words

#: Labelled documents that a model is fitted on, at most; a hash of their ids picks them.
MAX_TRAIN = 12_000
#: ... and features that they hold together, so that very long texts don't fill the driver.
MAX_FEATURES = 16_000_000
BITS = 20
#: Features in fewer sampled documents than this, or with a smaller correlation (phi) of presence with a grade above 0, get
#: no weight: thousands of rare words would else drown the telling ones in long texts. The least phi, which doesn't depend on
#: the sample's size, is picked from these by held-out labels, and without any that can be held out it is the last.
MIN_DOCS = 4
PHIS = (0.03, 0.05, 0.07, 0.1, 0.13, 0.17, 0.22, 0.3, 0.4, 0.6)
#: ... or if they are less than e^1 times as frequent there as elsewhere: common words only tell a text's length.
MIN_LOG_RATIO = 1.0
GRADES = 3
#: Documents with one label are copies from this Jaccard similarity of their feature sets on.
COPY = 0.8
PREFIXES = (4, 5)
#: A document is toxic from this P(grade > 0) on, if held-out labels don't speak for a larger one of CUTS, and if it holds a
#: feature with a weight.
TOXIC = 0.25
CUTS = (TOXIC, 0.5, 0.75)
FOLDS, FOLD_ROUNDS = 5, 300
L2, ROUNDS, RATE = 1e-5, 1500, 0.05


def feature(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) >> (64 - BITS)


def features(word: bytes) -> tuple[int, ...]:
    """Of a word and of its beginnings."""
    return (feature(word), *(feature(word[:k] + b"*") for k in PREFIXES if len(word) > k))


class Ordinal:
    """weights by feature, ordered cuts, and the P(grade > 0) that makes a document toxic."""

    def __init__(self, weights: np.ndarray, cuts: np.ndarray, toxic: float = TOXIC):
        self.weights, self.cuts, self.toxic = weights, cuts, toxic

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each row and cut."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.cuts[None, :], -40, 40)))


def _odds(df: np.ndarray, on: np.ndarray, n: int, total: float) -> np.ndarray:
    """Log of how much more frequent features are among `total` of n documents than among the others."""
    return np.log((on + 0.5) / (total + 1)) - np.log((df - on + 0.5) / (n - total + 1))


def _telling(df: np.ndarray, on: np.ndarray, n: int, total: float, phi: float) -> np.ndarray:
    """The features that get a weight."""
    spread = np.maximum(df * (n - df) * total * (n - total), 1e-9)
    return (df >= MIN_DOCS) & (_odds(df, on, n, total) >= MIN_LOG_RATIO) & ((on * n - df * total) ** 2 / spread >= phi * phi)


def _marked(df: np.ndarray, on: np.ndarray, n: int, total: float) -> np.ndarray:
    """The features by which toxic documents are graded."""
    return (_odds(df, on, n, total) > 2.0) & (on >= 2 * MIN_DOCS)


#: Features that are counted at once.
PART = 1 << 20


def asked_for(rows: np.ndarray, cols: np.ndarray, toxic: np.ndarray, size: int) -> np.ndarray:
    """Which features any fit of a fold or of all asks for; the others change nothing."""
    out, fold = np.zeros(size, bool), _folds(toxic)
    for k in range(-1, FOLDS):
        learned, df, on = fold != k, np.zeros(size), np.zeros(size)
        for a in range(0, len(cols), PART):  # in parts, for counting makes wider copies
            r, c = rows[a : a + PART], cols[a : a + PART]
            r, c = r[learned[r]], c[learned[r]]
            df += np.bincount(c, minlength=size)
            on += np.bincount(c, toxic[r], minlength=size)
        n, total = int(learned.sum()), float(toxic[learned].sum())
        out |= _telling(df, on, n, total, min(PHIS)) | _marked(df, on, max(1, n - total) + max(1, total), max(1, total))
    return out


def fit(rows: np.ndarray, cols: np.ndarray, grades: np.ndarray, n_grades: int = GRADES, phi: float = PHIS[-1], rounds: int = ROUNDS, size: int = 1 << BITS) -> Ordinal:
    """Maximum likelihood with L2 by full gradients with Adam's steps; rows and cols list the present features, sorted by row."""
    n, k = len(grades), n_grades - 1
    high = (grades > 0).astype(float)
    telling = _telling(np.bincount(cols, minlength=size), np.bincount(cols, high[rows], minlength=size), n, high.sum(), phi)
    used, keep = np.flatnonzero(telling), telling[cols]
    rows, index = rows[keep], (np.cumsum(telling) - 1)[cols[keep]]
    w, cuts = np.zeros(len(used)), np.linspace(0.0, 1.0, k) if k else np.zeros(0)
    first, second = np.zeros(len(used) + k), np.zeros(len(used) + k)
    # severity classes are uneven: each counts the same in all, up to a factor
    counts = np.bincount(grades, minlength=n_grades)
    weight = np.sqrt(n / np.maximum(1, counts))[grades]
    weight = weight / weight.mean() if n else weight
    for step in range(rounds if n else 0):
        score = np.bincount(rows, w[index], minlength=n)
        tail = 1 / (1 + np.exp(-np.clip(score[:, None] - cuts[None, :], -40, 40)))
        # P(grade) = tail[grade - 1] - tail[grade]
        upper = np.concatenate([np.ones((n, 1)), tail], axis=1)[np.arange(n), grades]
        lower = np.concatenate([tail, np.zeros((n, 1))], axis=1)[np.arange(n), grades]
        p = np.maximum(upper - lower, 1e-9)
        slope = tail * (1 - tail)
        is_up, is_low = np.arange(k)[None, :] == grades[:, None] - 1, np.arange(k)[None, :] == grades[:, None]
        by_cut = (is_up * slope - is_low * slope) / p[:, None] * weight[:, None]
        g = by_cut.sum(axis=1)
        dw = np.bincount(index, g[rows], minlength=len(used)) / n - L2 * w
        dc = -by_cut.sum(axis=0) / n
        both = np.concatenate([dw, dc])
        first = 0.9 * first + 0.1 * both
        second = 0.999 * second + 0.001 * both * both
        move = RATE * first / (1 - 0.9 ** (step + 1)) / (np.sqrt(second / (1 - 0.999 ** (step + 1))) + 1e-9)
        w += move[: len(used)]
        cuts = np.maximum.accumulate(cuts + move[len(used) :] + np.arange(k) * 1e-6)
    weights = np.zeros(size, np.float32)
    weights[used] = w
    return Ordinal(weights, cuts)


def severity(rows: np.ndarray, cols: np.ndarray, toxic: np.ndarray, n_grades: int = GRADES, size: int = 1 << BITS) -> np.ndarray:
    """Grades 0..n_grades-1 from 0/1 labels: toxic documents by quantiles of their number of marked features."""
    n_toxic = max(1, int(toxic.sum()))
    n_clean = max(1, len(toxic) - n_toxic)
    marked = _marked(np.bincount(cols, minlength=size), np.bincount(cols, toxic[rows], minlength=size), n_clean + n_toxic, n_toxic)
    count = np.bincount(rows, marked[cols], minlength=len(toxic))
    grades = np.zeros(len(toxic), np.int64)
    which = toxic > 0
    if which.any():
        steps = np.quantile(count[which], np.arange(1, n_grades - 1) / (n_grades - 1)) if n_grades > 2 else []
        grades[which] = 1 + np.searchsorted(np.asarray(steps), count[which], side="left")
    return grades


def _folds(toxic: np.ndarray) -> np.ndarray:
    fold = np.empty(len(toxic), np.int64)
    for value in (0, 1):
        mine = np.flatnonzero(toxic == value)
        fold[mine] = np.arange(len(mine)) % FOLDS
    return fold


def held_out_tails(rows: np.ndarray, cols: np.ndarray, toxic: np.ndarray, k: int, phi: float, n_grades: int = GRADES, size: int = 1 << BITS) -> np.ndarray:
    """P(grade > 0) of fold k's documents, in order, by a model that is fitted without them. Features are numbers below `size`."""
    learned = _folds(toxic) != k
    at, mine = np.cumsum(learned, dtype=np.int32) - 1, learned[rows]
    r, c = at[rows[mine]], cols[mine]
    model = fit(r, c, severity(r, c, toxic[learned], n_grades, size), n_grades, phi, FOLD_ROUNDS, size)
    w = model.weights[cols[~mine]]
    score = np.bincount(rows[~mine], w, minlength=len(toxic))
    holds = np.bincount(rows[~mine], w != 0, minlength=len(toxic)) > 0
    return (model.tails(score)[:, 0] * holds)[~learned]


def choice(toxic: np.ndarray, tails: dict[tuple[int, float], np.ndarray]) -> tuple[float, float]:
    """The least phi and the toxic P(grade > 0), of held_out_tails() for each fold and phi.

    Of all pairs whose F1 is within a standard error of the best, the one that finds the most toxic documents; of equal ones
    that with the better F1, then the larger phi and the smaller P."""
    n_toxic, fold, found = int(toxic.sum()), _folds(toxic), []
    for phi in PHIS:
        tail = np.zeros(len(toxic))
        for k in range(FOLDS):
            tail[fold == k] = tails[k, phi]
        for cut in CUTS:
            marked = tail >= cut
            hits = int((marked & (toxic > 0)).sum())
            found.append((2 * hits / (int(marked.sum()) + n_toxic), hits, phi, cut))
    best = max(f for f, *_ in found)
    if not best:
        return PHIS[-1], TOXIC
    least = best - np.sqrt(best * (1 - best) / n_toxic)
    _, _, phi, cut = max((x for x in found if x[0] >= least), key=lambda x: (x[1], x[0], x[2], -x[3]))
    return phi, cut


def fitted(spark: SparkSession, rows: np.ndarray, cols: np.ndarray, toxic: np.ndarray, n_grades: int = GRADES) -> Ordinal:
    """The model of a bounded sample. Its fits, those without a fold and then the last one, are tasks that share the sample; the driver gets held-out
    probabilities and the weights that aren't 0."""
    asked = asked_for(rows, cols, toxic, 1 << BITS)
    rows, cols, known = rows[asked[cols]], cols[asked[cols]], np.flatnonzero(asked)
    own, size = (np.cumsum(asked) - 1)[cols], len(known)  # numbered: a fit's arrays are as long as these are many
    shared = spark.sparkContext.broadcast((rows, own.astype(np.int32), toxic))  # MAX_TRAIN documents and MAX_FEATURES numbers at most

    def each(jobs: list[tuple[int, float]]) -> dict:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k, phi in zip(*(c.to_pylist() for c in batch.columns)):
                    r, c, labels = shared.value
                    if k >= 0:
                        at, values = np.zeros(0, np.int64), held_out_tails(r, c, labels, k, phi, n_grades, size)
                    else:
                        model = fit(r, c, severity(r, c, labels, n_grades, size), n_grades, phi, ROUNDS, size)
                        at = np.flatnonzero(model.weights)
                        values = np.concatenate([model.weights[at].astype(float), model.cuts])
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([phi]), pa.array([at.tobytes()], pa.binary()), pa.array([values.tobytes()], pa.binary())], names=["k", "phi", "at", "found"])

        made = spark.createDataFrame(jobs, "k int, phi double").repartition(len(jobs), "k", "phi").mapInArrow(run, "k int, phi double, at binary, found binary")
        return {(r["k"], r["phi"]): (np.frombuffer(r["at"], np.int64), np.frombuffer(r["found"], float)) for r in made.collect()}

    phi, cut = PHIS[-1], TOXIC
    if min(int(toxic.sum()), len(toxic) - int(toxic.sum())) >= 2:
        phi, cut = choice(toxic, {job: tail for job, (_, tail) in each([(k, phi) for k in range(FOLDS) for phi in PHIS]).items()})
    ((at, values),) = each([(-1, phi)]).values()
    shared.unpersist()
    weights = np.zeros(1 << BITS, np.float32)
    weights[known[at]] = values[: len(at)]
    return Ordinal(weights, values[len(at) :], cut)


def distinct(cols: list[np.ndarray], toxic: np.ndarray) -> tuple[list[int], np.ndarray]:
    """The documents to learn from, and all labels as resolved: of documents with one and the same feature set the first stays,
    toxic if any is; of those with one label, every later one whose sets' Jaccard similarity to one that stays is COPY or more
    goes. Documents that are only alike and differ in their label all stay, for what tells them apart is what is to be learned.

    Two such sets share one of each set's rarest (1 - COPY) features, so only those that other documents hold too are looked up; every pair found is counted out."""
    labels, first = np.array(toxic, np.int64), {}
    for i, c in enumerate(cols):
        j = first.setdefault(c.tobytes(), i)
        labels[j] = max(labels[j], labels[i])
    df = np.zeros(1 << BITS, np.int64)
    for c in cols:
        df[c] += 1  # a set holds each feature once
    stay, holders = [], {}
    for i in first.values():
        c, n, label = cols[i], len(cols[i]), int(labels[i])
        rarest = c[np.lexsort((c, df[c]))][: n - int(np.ceil(COPY * n - 1e-9)) + 1]
        rarest = ((rarest[df[rarest] > 1].astype(np.int64) << 1) | min(label, 1)).tolist()  # a feature of one document is shared with none
        near = False
        for j in {j for f in rarest for j in holders.get(f, ())}:
            m = len(cols[j])
            if COPY * n <= m and COPY * m <= n:
                both = len(np.intersect1d(c, cols[j], assume_unique=True))
                if near := both >= COPY * (n + m - both):
                    break
        if not near:
            stay.append(i)
            for f in rarest:
                holders.setdefault(f, []).append(i)
    return stay, labels


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, n_grades: int = GRADES, max_features: int = MAX_FEATURES) -> Ordinal:
    """Fits on the labelled documents that come first by a hash of their ids: max_train and max_features of their words' features at
    most. Labels without id or value are ignored; of several labels of one document the most toxic counts, of several texts the
    least; labels of documents that aren't there take no place. Reruns pick the same."""
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    there = known.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    chosen = staged(there.orderBy(*order).limit(max_train), "toxicity-labels")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")  # max_train rows
    sample = texts.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            tokens = [words(t) for t in texts_of(batch, 2)]
            found = [np.array(sorted({f for w in set(t) for f in features(w)}), np.int32).tobytes() for t in tokens]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([len(f) // 4 for f in found], pa.int64()), pa.array(found, pa.binary())], names=["doc_id", "toxic", "n", "cols"])

    made = staged(sample.mapInArrow(run, "doc_id long, toxic int, n long, cols binary"), "toxicity-features")
    sizes = [(r["doc_id"], r["n"]) for r in made.select("doc_id", "n").orderBy(*order).collect()]  # max_train rows
    within = np.cumsum([n for _, n in sizes]) <= max_features
    if len(sizes) and not within.all():
        picked = spark.createDataFrame([(d,) for (d, _), ok in zip(sizes, within) if ok] or [(None,)], "doc_id long")
        made = made.join(F.broadcast(picked), "doc_id", "left_semi")
    got = sorted(made.select("doc_id", "toxic", "cols").collect(), key=lambda r: r["doc_id"])  # max_features numbers
    cols = [np.frombuffer(r["cols"], np.int32) for r in got]
    # of copies and near copies one is learned from: else their rare words look telling
    stay, toxic = distinct(cols, np.array([int(r["toxic"] > 0) for r in got], np.int64))
    cols, toxic = [cols[i] for i in stay], toxic[stay]
    rows = np.repeat(np.arange(len(cols), dtype=np.int32), [len(c) for c in cols])
    flat = np.concatenate(cols).astype(np.int32) if cols else np.zeros(0, np.int32)
    del got, cols
    return fitted(spark, rows, flat, toxic, n_grades)


_RESULTS = {"n_words": "long", "expected_severity": "double", "grade": "integer", "toxic": "boolean"}


def scored(docs: DataFrame, model: Ordinal) -> DataFrame:
    """docs(text, ...) with n_words, expected_severity, grade and toxic (P(grade > 0) from the model's cut on); columns of these names are replaced.

    A null or empty text has no features, and no text without features that have a weight is toxic; the grade of those that aren't toxic is 0.
    A document exactly at the cut is toxic. Texts of any length are read whole. Repeated rows are scored each, null ids are kept, an empty table gives none."""
    docs = docs.drop(*_RESULTS)
    schema, at = StructType(list(docs.schema.fields)), docs.columns.index("text")
    for name, kind in _RESULTS.items():
        schema = schema.add(name, kind)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.cuts, model.toxic))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, cuts, cut = shared.value
        ordinal = Ordinal(weights, cuts)

        class Telling(dict):
            """word -> its features that have a weight"""

            def __missing__(self, word: bytes) -> tuple[int, ...]:
                if len(self) >= 1 << 18:
                    self.clear()
                x = self[word] = tuple(f for f in features(word) if weights[f])
                return x

        telling = Telling()
        for batch in slices(batches, at):
            tokens = [words(t) for t in texts_of(batch, at)]
            found = [{f for x in map(telling.__getitem__, set(t)) if x for f in x} for t in tokens]
            tails = ordinal.tails(np.array([sum(float(weights[f]) for f in sorted(x)) for x in found], np.float64))
            holds = np.array([bool(x) for x in found])
            toxic = (tails[:, 0] >= cut) & holds
            grade = np.where(toxic, np.maximum((tails >= 0.5).sum(axis=1), 1), 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([len(t) for t in tokens], pa.int64()), pa.array(tails.sum(axis=1)), pa.array(grade.astype(np.int32)), pa.array(toxic)],
                names=[*batch.schema.names, *_RESULTS],
            )

    return docs.mapInArrow(run, schema)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs.select("doc_id", "text"), train(docs, table(spark, sf_dir, "labels")))
