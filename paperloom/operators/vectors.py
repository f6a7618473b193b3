"""Nearest vectors, exactly: vectors packed into blocks, a matrix product for each pair of blocks, and the best few of each block before anything is shuffled."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vectors of a block of queries, and of one of all vectors: a product has so many numbers at once.
QUERIES, BLOCK = 1024, 4096
#: Candidates that a task holds before it keeps the best of them only.
HELD = 1 << 20
#: Queries whose blocks are broadcast at most; beyond, blocks of both sides meet in a join.
BROADCAST_QUERIES = 50_000


def _packed(rows: DataFrame, size: int, name: str) -> DataFrame:
    """rows(id, vector) as (name, ids, vectors): `size` unit vectors at most side by side in one row. Null vectors and vectors of length 0 are left out. Packed where they are read, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column(1)))
            for a in range(0, batch.num_rows, size):
                part = batch.slice(a, size)
                x = np.stack([np.asarray(v, np.float64) for v in part.column(1).to_pylist()])
                norm = np.sqrt((x * x).sum(axis=1))
                ids, x = np.asarray(part.column(0).to_pylist(), np.int64)[norm > 0], x[norm > 0] / norm[norm > 0, None]
                if len(ids):
                    yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([ids.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary()), pa.array([x.shape[1]], pa.int32())], names=["n", "ids", "x", "wide"])
                    number += 1

    made = rows.select(F.col("id").cast("long").alias("id"), "vector").mapInArrow(run, "n long, ids binary, x binary, wide int")
    return made.select(F.struct(F.spark_partition_id().alias("p"), "n").alias(name), F.col("ids").alias(f"{name}_ids"), F.col("x").alias(f"{name}_x"), "wide")


def _best(found: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    """The k nearest of each query of (q, id, cos)."""
    q, ids, cos = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((ids, -cos, q))
    q, ids, cos = q[order], ids[order], cos[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[keep], ids[keep], cos[keep]


def nearest(queries: DataFrame, rows: DataFrame, k: int, digits: int = 6) -> DataFrame:
    """(q, id, cos): for each of queries(id, vector) the k of rows(id, vector), another id each, with the largest cosine, rounded; of equal ones the least id. A stated set of queries is
    held against all rows, in blocks: a task keeps the k best of a query over its blocks, so what is shuffled is k rows a query and task. Ids are numbers, one row each; vectors have one
    length. Without rows or queries there are none."""
    left, right = _packed(queries, QUERIES, "l"), _packed(rows, BLOCK, "r").drop("wide")
    small = queries.count() <= BROADCAST_QUERIES  # counted: so many vectors are broadcast at most
    pairs = right.crossJoin(F.broadcast(left) if small else left)  # of blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []  # of the task's blocks so far
        for batch in batches:
            for l_ids, l_x, r_ids, r_x, wide in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("l_ids", "l_x", "r_ids", "r_x", "wide"))):
                q, ids = np.frombuffer(l_ids, np.int64), np.frombuffer(r_ids, np.int64)
                cos = np.round(np.frombuffer(l_x).reshape(-1, wide) @ np.frombuffer(r_x).reshape(-1, wide).T, digits)
                cos[q[:, None] == ids[None, :]] = -np.inf
                m = min(k, len(ids))
                # all that are as near as the k-th; which of equal ones stay is settled by their ids
                limit = -np.partition(-cos, m - 1, axis=1)[:, m - 1]
                at, col = np.nonzero((cos >= limit[:, None]) & np.isfinite(cos))
                held.append((q[at], ids[col], cos[at, col]))
                if sum(len(x[0]) for x in held) > HELD:
                    held = [_best(held, k)]
                    if len(held[0][0]) > HELD // 2:  # many queries
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, held.pop())), names=["q", "id", "cos"])
        if held:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, _best(held, k))), names=["q", "id", "cos"])

    best = pairs.select("l_ids", "l_x", "r_ids", "r_x", "wide").mapInArrow(run, "q long, id long, cos double")
    top = best.groupBy("q").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("cos")).alias("far"), "id"))), 1, k).alias("t"))
    return top.select("q", F.explode("t").alias("x")).select("q", F.col("x.id").alias("id"), (-F.col("x.far")).alias("cos"))
