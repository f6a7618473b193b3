"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source starts with the same expected number of copies, target / source size. The whole part is
taken; the fractional parts are rounded pairwise: two documents exchange mass, in words, until one of them has a
whole number of copies, so a group keeps its expected number of words up to one unsettled document. Groups of bounded
size do so in parallel; their unsettled documents go up a reduction tree, `FAN_IN` groups to one, until each source
has one left, which is rounded at random. The random choices are hashes of ids, so reruns agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import columns, joined_small, mix64, prefix, staged, table

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_COPIES = 2.0
#: Documents of a group at most, about, and groups whose unsettled documents go into one of the next level.
GROUP_ROWS = 2_000
FAN_IN = 256
MAX_SOURCES = 1_000_000

ORACLE = None


def n_words(text: Column) -> Column:
    """Words of any characters but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: dict, weights=WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> dict:
    """Words each source should give: `share` of all words by weight, dealt cyclically over the sources in code-point
    order with null last; a target stops at `most` times its source and the excess is shared anew by weight."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-8", "surrogatepass")) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, got = share * sum(sizes.values()), list(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not over:
            got |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            got[s] = most * sizes[s]
        left -= sum(got[s] for s in over)
        open_ = [s for s in open_ if s not in got]
    return got


def _uniform(x: np.ndarray, salt: int) -> np.ndarray:
    return (mix64(x, salt) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def settle(pdf: pd.DataFrame, level: int, last: bool = False) -> pd.DataFrame:
    """Pivotal rounding inside one group: at most one row keeps a fraction p in (0, 1); p of the others becomes null
    and their copies are final. Large documents go first, so that what stays unsettled is small. Order and random
    numbers depend on (size, key) alone; equal rows are interchangeable."""
    pdf = pdf.sort_values(["size", "key"], ascending=[False, True], kind="mergesort").reset_index(drop=True)
    size, p, copies = pdf["size"].to_numpy(float), pdf["p"].to_numpy(float).copy(), pdf["copies"].to_numpy(np.int64).copy()
    u = _uniform(pdf["key"].to_numpy(np.int64).view(np.uint64), 1000 + level)
    held = -1
    for j in range(len(pdf)):
        if not 1e-12 < p[j] < 1 - 1e-12:
            copies[j] += int(p[j] >= 0.5)
            p[j] = np.nan
            continue
        if held < 0:
            held = j
            continue
        a, b = held, j
        s, t = max(size[a], 1e-9), max(size[b], 1e-9)
        up, down = min(1 - p[a], p[b] * t / s), min(p[a], (1 - p[b]) * t / s)
        step = up if u[j] * (up + down) < down else -down
        pa_, pb = p[a] + step, p[b] - step * s / t
        held = -1
        for i, x in ((a, pa_), (b, pb)):
            if 1e-9 < x < 1 - 1e-9:
                p[i] = x
                held = i
            else:
                copies[i] += int(x >= 0.5)
                p[i] = np.nan
    if last and held >= 0:
        copies[held] += int(u[held] < p[held])
        p[held] = np.nan
    return pdf.assign(p=p, copies=copies)


def _settler(level: int, last: bool):
    return lambda pdf: settle(pdf, level, last)


_COPIES = ("size", "source", "source_size", "target", "taken", "copies")


def _rounded(rows: DataFrame, weights, share: float, most: float) -> DataFrame:
    """Staged rows(row, source, size, key) with source_size, target, taken and copies."""
    spark = rows.sparkSession
    found = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = {r["source"]: r["source_size"] for r in found}
    target = targets(sizes, weights, share, most)
    plan = [(r["source"], r["source_size"], float(target[r["source"]]), max(1, -(-r["n"] // GROUP_ROWS))) for r in found]
    catalogue = spark.createDataFrame(plan, "source string, source_size long, target double, groups long")
    side = F.broadcast(catalogue.withColumnRenamed("source", "_source"))  # MAX_SOURCES rows at most
    joined = rows.join(side, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    level0 = (
        joined.withColumn("_x", F.least(expected, F.lit(float(most))))
        .withColumn("copies", F.floor("_x").cast("long"))
        .withColumn("p", F.col("_x") - F.col("copies"))
        # rows without an id are dealt by their place as well: a third of all rows may be such rows with one text
        .withColumn("node", F.pmod(F.xxhash64("key", F.when(F.col("spread"), F.col("row"))), F.col("groups")))
        .drop("_x", "spread")
    )
    schema = level0.schema
    final, level, widest = [], 0, max((p[3] for p in plan), default=1)
    current = level0
    while True:
        last = widest == 1
        current = staged(current.groupBy("source", "node").applyInPandas(_settler(level, last), schema), f"mix-level{level}")
        unsettled = F.col("p").isNotNull() & ~F.isnan("p")
        final.append(current.filter(~unsettled))
        if last:
            break
        current = current.filter(unsettled).withColumn("node", F.floor(F.col("node") / FAN_IN).cast("long"))
        widest, level = -(-widest // FAN_IN), level + 1
    out = final[0]
    for more in final[1:]:
        out = out.unionByName(more)
    return out.withColumn("taken", F.col("copies") * F.col("size"))


def _sized(docs: DataFrame, row: Column) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(
        row.alias("row"),
        F.col("doc_id"),
        F.col("source").cast("string").alias("source"),
        n_words(text).alias("size"),
        F.xxhash64("doc_id", "source", text).alias("key"),
        F.col("doc_id").isNull().alias("spread"),
    )


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> DataFrame:
    """One row per row of docs(doc_id, text, source): doc_id, size, source, source_size, target, taken, copies.

    Nulls: a null text has size 0, a null source is a source of its own, a null doc_id is a document like others.
    Rows with equal ids are separate documents. Documents without words take nothing. Texts of any length count whole. Ties:
    equal rows are interchangeable, others are ordered by a hash of id, source and text. An empty table gives none.
    Other columns are ignored. Sources are a catalogue: more than MAX_SOURCES of them raise ValueError."""
    rows = staged(_sized(docs, F.monotonically_increasing_id()), "mix-sizes")
    return _rounded(rows, weights, share, most).select("doc_id", *_COPIES)


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> DataFrame:
    """The rows of docs as in mix(), with all their columns and size, source_size, target, taken and copies; a column of docs with
    one of these names keeps its name and its value, and the result's is left out."""
    row = prefix(docs) + "row"
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "mix-rows")
    own = {c.lower() for c in docs.columns}
    more = [c for c in _COPIES if c.lower() not in own]
    result = _rounded(staged(_sized(rows, F.col(row)), "mix-sizes"), weights, share, most).select(F.col("row").alias(row), *more)
    # the narrow side is staged, so that its size is known: while it is small, texts stay where they are
    return joined_small(rows, staged(result, "mix-result"), [row], "inner").select(*columns(docs), *more)


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")
