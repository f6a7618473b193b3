"""Grouping of spelling variants by full neighbourhood generation.

Every distinct deletion, replacement and insertion of every word over the alphabet of the vocabulary is generated, as a hash of the
changed word that follows from prefix sums. Those that a filter over the vocabulary lets through become strings and meet the vocabulary
in a hash join; what joins is a neighbour by construction, so no distance is ever computed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, dropped, mix64, staged, table

#: Words are runs of these code points, all below 256.
LETTERS = r"A-Za-zÀ-ÿ"
MIN_LENGTH, MIN_COUNT = 7, 2
#: A word's form is a neighbour with so many times its count.
DOMINANCE = 10
#: Bits of the filter for each word, and at most. Beyond, more candidates pass it and the join, which decides, gets more rows.
BITS_A_WORD, MOST_BITS = 32, 1 << 29
#: Words (of 64 bits) of the filter that one row carries, and hashes of neighbours that are held at once.
CHUNK, HELD = 1 << 15, 1 << 19
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)


def runs_of(docs: DataFrame, least: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, run): the maximal runs of letters of at least `least` code points, A-Z lower-cased. A null text has none."""
    return docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"([{LETTERS}]{{{least},}})"), F.lit(1))).alias("run")).select("doc_id", ascii_lower(F.col("run")).alias("run"))


def with_slips(runs: DataFrame, every: int = 31) -> DataFrame:
    """(word): runs, of which those whose crc32 with the document's id is divisible by `every` lose a letter."""
    runs = runs.select("run", F.crc32(F.encode(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")), "utf-8")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    slipped = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return runs.select(F.when(F.col("h") % every == 0, slipped).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of words(word) with at least so many code points and occurrences, counted over all rows; tasks count before they shuffle."""
    counted = words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= min_count)


def alphabet(words: DataFrame) -> bytes:
    """The letters of words(word), 255 at most."""
    if words.filter(~F.col("word").rlike(r"^[\u0001-ÿ]+$")).limit(1).count():
        raise ValueError("words have code points of U+0001 to U+00FF only")
    letters = words.select(F.array_distinct(F.split("word", "")).alias("l")).select(F.explode("l").alias("l")).distinct()
    return "".join(sorted(r["l"] for r in letters.collect() if r["l"])).encode("latin-1")


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _STEP, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def _slots(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The filter's word of a hash, and the four bits of it."""
    h = mix64(h)
    one = np.uint64(1)
    mask = np.zeros(len(h), np.uint64)
    for j in range(4):
        mask |= one << ((h >> np.uint64(6 * j)) & np.uint64(63))
    return (h >> np.uint64(64 - (bits.bit_length() - 7))).astype(np.int64), mask


class Filter:
    """bits is a power of two from 128 on."""

    def __init__(self, bits: int, words: np.ndarray):
        self.bits, self.words = bits, words

    def passes(self, h: np.ndarray) -> np.ndarray:
        slot, mask = _slots(h, self.bits)
        return (self.words[slot] & mask) == mask


def _by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the words of each length, and their letters as a matrix."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield at, np.frombuffer(b"".join(words[i] for i in at), np.uint8).reshape(len(at), n)


def hashes(words: list[bytes]) -> np.ndarray:
    out = np.zeros(len(words), np.uint64)
    with np.errstate(over="ignore"):
        for at, m in _by_length(words):
            out[at] = (m.astype(np.uint64) * _powers(m.shape[1])).sum(axis=1, dtype=np.uint64)
    return out


def build_filter(words: DataFrame, n: int) -> Filter:
    """A filter over n words(word): each task marks its words, then each chunk is put together in one task. The driver gets MOST_BITS at most."""
    bits = min(max(1 << (max(n * BITS_A_WORD, 1) - 1).bit_length(), 128), MOST_BITS)

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot, mask = _slots(hashes([x.encode("latin-1") for x in batch.column(0).to_pylist()]), bits)
            order = np.argsort(slot, kind="stable")
            slot, mask = slot[order], mask[order]
            chunks, first = np.unique(slot // CHUNK, return_index=True)
            ends = [*first[1:].tolist(), len(slot)]
            part = [(slot[a:b] % CHUNK).astype(np.int32).tobytes() for a, b in zip(first, ends)]
            yield pa.RecordBatch.from_arrays([pa.array(chunks.astype(np.int32)), pa.array(part, pa.binary()), pa.array([mask[a:b].tobytes() for a, b in zip(first, ends)], pa.binary())], names=["chunk", "slots", "masks"])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}  # a share of the filter
        for batch in batches:
            for chunk, slots, masks in zip(*(c.to_pylist() for c in batch.columns)):
                np.bitwise_or.at(made.setdefault(chunk, np.zeros(CHUNK, np.uint64)), np.frombuffer(slots, np.int32), np.frombuffer(masks, np.uint64))
        for chunk, x in made.items():
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["chunk", "words"])

    out = np.zeros(max(bits // 64, CHUNK), np.uint64)
    for row in words.select("word").mapInArrow(marks, "chunk int, slots binary, masks binary").repartition("chunk").mapInArrow(together, "chunk int, words binary").collect():
        out[row["chunk"] * CHUNK :][:CHUNK] = np.frombuffer(row["words"], np.uint64)
    return Filter(bits, out[: bits // 64])


def neighbours(words: list[bytes], letters: bytes, known: Filter) -> Iterator[tuple[int, bytes]]:
    """(place of a word, changed word) for each distinct change of one letter whose hash the filter knows. A letter inserted beside an equal
    one, and one deleted from a run of equal ones, count at the first place only; a replacement has another letter."""
    x = np.frombuffer(letters, np.uint8)
    for places, matrix in _by_length(words):
        length = matrix.shape[1]
        power = _powers(length + 1)
        step = max(1, HELD // ((length + 1) * max(len(x), 1)))
        for a in range(0, len(places), step):
            part = matrix[a : a + step]
            yield from _changed(part, places[a : a + step], x, power, known)


def _changed(m: np.ndarray, places: np.ndarray, x: np.ndarray, power: np.ndarray, known: Filter) -> Iterator[tuple[int, bytes]]:
    """A block of words of one length; of a very long word a range of places at a time."""
    n, length = m.shape
    with np.errstate(over="ignore"):
        terms = m.astype(np.uint64) * power[:length]
        before = np.zeros((n, length + 1), np.uint64)
        np.cumsum(terms, axis=1, out=before[:, 1:])
        whole = before[:, -1:]
        after_cut = before[:, :length] + (whole - before[:, 1:]) * np.uint64(_BACK)
        after_gap = before + (whole - before) * np.uint64(_STEP)
        first = np.ones((n, length), bool)  # not equal to the letter before
        first[:, 1:] = m[:, 1:] != m[:, :-1]
        row, i = np.nonzero(first)
        hit = known.passes(after_cut[row, i])
        for r, k in zip(row[hit].tolist(), i[hit].tolist()):
            w = m[r].tobytes()
            yield places[r], w[:k] + w[k + 1 :]
        wide = max(1, HELD // max(len(x) * n, 1))
        for a in range(0, length + 1, wide):
            gap = after_gap[:, a : a + wide, None] + x.astype(np.uint64) * power[a : a + wide, None]
            fresh = np.ones(gap.shape, bool)
            start = max(a, 1)
            fresh[:, start - a :, :] = x != m[:, start - 1 : a + gap.shape[1] - 1, None]
            for kind, h, allowed in (("gap", gap, fresh), ("same", None, None)):
                if kind == "same":
                    b = min(a + wide, length)
                    if b <= a:
                        continue
                    h = (whole - terms[:, a:b])[:, :, None] + x.astype(np.uint64) * power[a:b, None]
                    allowed = x != m[:, a:b, None]
                row, i, k = np.nonzero(allowed)
                hit = np.flatnonzero(known.passes(h[row, i, k]))
                skip = 0 if kind == "gap" else 1
                for r, p, c in zip(row[hit].tolist(), (i[hit] + a).tolist(), x[k[hit]].tolist()):
                    w = m[r].tobytes()
                    yield places[r], w[:p] + bytes((c,)) + w[p + skip :]


def near_words(words: DataFrame, n_words: int) -> DataFrame:
    """(word, n_near, best): of words(word, n) those with neighbours, their number, and -n and word of the one that comes most often."""
    spark = words.sparkSession
    shared = spark.sparkContext.broadcast((alphabet(words), build_filter(words, n_words)))  # 255 letters and MOST_BITS at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, known = shared.value
        for batch in batches:
            texts, counts = [x.encode("latin-1") for x in batch.column(0).to_pylist()], batch.column(1)
            found: list[tuple[int, bytes]] = []

            def flushed():
                at = pa.array(np.fromiter((i for i, _ in found), np.int64, len(found)))
                return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for _, w in found], pa.string()), batch.column(0).take(at), counts.take(at)], names=["candidate", "word", "n"])

            for one in neighbours(texts, letters, known):
                found.append(one)
                if len(found) >= 1 << 16:
                    yield flushed()
                    found = []
            yield flushed()

    candidates = words.select("word", "n").mapInArrow(run, "candidate string, word string, n long")
    # being neighbours is mutual, so a word's neighbours are those that generate it
    met = candidates.groupBy("candidate").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("m"), F.col("word").alias("w"))).alias("best"))
    return met.withColumnRenamed("candidate", "word")


def rooted(forms: DataFrame) -> DataFrame:
    """(word, root) of forms(word, form): the end of each word's chain, by pointer jumping. A form comes at least twice as often as its word,
    so chains have no circles and fewer than 64 steps: six doublings at most."""
    going = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = going.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = staged(going.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        dropped(forms.sparkSession, going)
        going = jumped
        if not going.filter("moved").limit(1).count():
            return going.select("word", "root")


def grouped(words: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """words(word, n), distinct words, as (word, n, n_near, form, form_n, root).

    Neighbours differ by one inserted, deleted or replaced code point; a word's form is the one of largest n (of equal ones the least by code points) if that
    is at least `dominance` (2 or more) times its own; the root is the end of the chain of forms, the word itself if it has none. Null words are no
    words; words of any length are changed at every place. An empty table gives none; other columns are ignored."""
    if dominance < 2:
        raise ValueError("forms must come at least twice as often")
    words = staged(words.filter("word IS NOT NULL").select("word", "n"), "spelling-words")
    near = near_words(words, words.count())
    dominant = F.col("best.m") <= -dominance * F.col("n")
    mine = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(dominant, F.col("best.w")).alias("form"), F.when(dominant, -F.col("best.m")).alias("form_n"))
    mine = staged(mine, "spelling-forms")
    roots = rooted(mine.filter("form IS NOT NULL"))
    return mine.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame) -> DataFrame:
    """Variants among the words of docs(doc_id, text), a slip in every 31st occurrence: grouped() of their vocabulary.

    A null or empty text has no words, a null doc_id counts as an empty one, repeated rows count each, texts of any length are read whole."""
    return grouped(vocabulary(with_slips(runs_of(docs.select("doc_id", "text")))))


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents")).select(*COLUMNS)


#: crc32 of a string's UTF-8 in DuckDB: `bytes` of a hex string, and the table of the 256 remainders.
CRC_TABLE = "SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)"


def crc_sql(text: str, crc_table: str = "crc.t") -> str:
    hexed = f"hex(encode({text}))"
    byte = f"16 * (instr('0123456789ABCDEF', {hexed}[2 * k + 1]) - 1) + instr('0123456789ABCDEF', {hexed}[2 * k + 2]) - 1"
    bytes_ = f"list_transform(range(length({hexed}) // 2), lambda k: {byte})"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {bytes_}), lambda c, b: xor(c >> 8, {crc_table}[CAST(xor(c & 255, b) AS BIGINT) + 1])))"


ORACLE = f"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
r AS (SELECT doc_id, translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
      FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS x FROM documents) WHERE length(x) >= 7),
o AS (SELECT doc_id, run, count(*) AS n FROM r GROUP BY ALL),
h AS (SELECT run, n, {crc_sql("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM o, crc),
s AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM s WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
pair AS (SELECT a.word AS w, b.word AS x FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
         UNION SELECT word, rest FROM cut SEMI JOIN (SELECT word AS rest FROM v) USING (rest)
         UNION SELECT rest, word FROM cut SEMI JOIN (SELECT word AS rest FROM v) USING (rest)),
near AS (SELECT w, x, v.n, row_number() OVER (PARTITION BY w ORDER BY v.n DESC, encode(x)) AS k, count(*) OVER (PARTITION BY w) AS n_near FROM pair JOIN v ON v.word = x),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near.n >= 10 * v.n THEN x END AS form, CASE WHEN near.n >= 10 * v.n THEN near.n END AS form_n FROM v LEFT JOIN near ON w = word AND k = 1),
up AS (SELECT word, word AS root FROM f UNION ALL SELECT up.word, f.form FROM up JOIN f ON f.word = up.root WHERE f.form IS NOT NULL),
top AS (SELECT up.word, up.root FROM up JOIN f ON f.word = up.root WHERE f.form IS NULL)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN top USING (word)
"""
