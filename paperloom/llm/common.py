"""What the operators share: tables, staging in the shared folder, joins with small sides, Arrow slices."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, StringType, StructType

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows and bytes of a lookup side up to which it is broadcast (its size is counted first).
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a temporary folder does if driver and
    executors are one process (tests); on a cluster each executor would write to its own disk, so that raises RuntimeError."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="paperloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _MADE:
        _MADE[-1].append(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends there, and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Paths made inside each open scratch().
_MADE: list[list[str]] = []


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what was staged inside. What is lazy must have been written by then, to a path of before."""
    _MADE.append([])
    try:
        yield
    finally:
        for path in _MADE.pop():
            _delete(spark, path)


def dropped(spark: SparkSession, df: DataFrame) -> None:
    """Deletes the files of a staged table that nothing reads any more."""
    for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _delete(spark, parent)


def prefix(df: DataFrame) -> str:
    """What no column's name begins with, so that names made with it clash with none."""
    names, found = [c.lower() for c in df.columns], "_p"
    while any(c.startswith(found) for c in names):
        found += "p"
    return found + "_"


def columns(df: DataFrame) -> list[Column]:
    """All columns, whatever their names."""
    return [F.col(f"`{c}`") for c in df.columns]


CARRIED = "carried_columns"


def packed(df: DataFrame, *names: str) -> DataFrame:
    """df as columns of these names and one struct of all others, in which no name can clash with an operator's."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return df.select(*names, (F.struct(*rest) if rest else F.lit(True)).alias(CARRIED))


def unpacked(rows: DataFrame, df: DataFrame, *names: str) -> DataFrame:
    """The columns of df again, of rows of packed(df, *names)."""
    return rows.select(*(F.col(c) if c in names else F.col(CARRIED).getField(c).alias(c) for c in df.columns))


def _bytes(value: Column, kind: DataType) -> Column:
    """About how many bytes a value takes in a broadcast table."""
    if isinstance(kind, (StringType, BinaryType)):
        size = F.octet_length(value) + 8
    elif isinstance(kind, ArrayType):
        inner = F.size(value) * 8
        if isinstance(kind.elementType, (StringType, BinaryType, ArrayType, StructType)):
            inner = F.aggregate(F.transform(value, lambda x: _bytes(x, kind.elementType).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
        size = inner + 16
    elif isinstance(kind, StructType):
        size = F.lit(16)
        for f in kind.fields:
            size = size + _bytes(value[f.name], f.dataType)
    else:
        size = F.lit(8)
    return F.coalesce(size, F.lit(8)).cast("long")


def is_small(df: DataFrame, rows: int | None = None, most_bytes: int | None = None) -> bool:
    """Whether a staged table has BROADCAST_ROWS and BROADCAST_BYTES at most. Both are counted, not guessed."""
    size = F.lit(0).cast("long")
    for f in df.schema.fields:
        size = size + _bytes(F.col(f.name), f.dataType)
    n, total = df.agg(F.count(F.lit(1)), F.sum(size)).first()
    return n <= (BROADCAST_ROWS if rows is None else rows) and (total or 0) <= (BROADCAST_BYTES if most_bytes is None else most_bytes)


def joined_small(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Joins a side that is usually small, has at most one row a key and is staged. If its rows and bytes, counted first, are within
    bounds it is broadcast; else both sides are dealt out by key, and what adaptive execution finds to be a partition with a hot
    key's rows it splits by the tasks that wrote them. So a key with a third of the left rows doesn't stay in one task, and no
    other key's row is copied."""
    return left.join(F.broadcast(right) if is_small(right) else right, keys, how)


def _place(batch: pa.RecordBatch, column: str | int) -> int:
    """A column by name, or by place where names may occur twice or in another case."""
    return column if isinstance(column, int) else batch.schema.get_field_index(column)


def slices(batches: Iterator[pa.RecordBatch], text: str | int, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that the text column of each has max_bytes at most (or one row): whole texts, bounded memory."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(_place(batch, text))), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(lengths.astype(np.int64)) - lengths) // max_bytes
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, name: str | int) -> list[bytes]:
    """The column's UTF-8 bytes; null as empty."""
    column = batch.column(_place(batch, name))
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def mix64(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective mix of 64-bit integers (the finaliser of splitmix64), for each salt another."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64, copy=True)
        z += np.uint64((salt * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) % (1 << 64))
        z ^= z >> np.uint64(30)
        z *= np.uint64(0xBF58476D1CE4E5B9)
        z ^= z >> np.uint64(27)
        z *= np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return z


class Hashes(dict):
    """token -> unsigned 64-bit hash, remembered for up to `most` tokens."""

    def __init__(self, most: int = 1 << 18):
        super().__init__()
        self.most = most

    def __missing__(self, token: bytes) -> int:
        import xxhash

        if len(self) >= self.most:
            self.clear()
        h = self[token] = xxhash.xxh3_64_intdigest(token)
        return h

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))
