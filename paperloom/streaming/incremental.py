"""Incremental forms: passes that resume over arriving files, and windowed counts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder in spark.checkpoint.dir, which driver and executors share. Where that is unset a temporary one does if they are one process (tests); on
    a cluster that raises RuntimeError."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="paperloom-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def arriving(spark: SparkSession, folder: str, schema: StructType | str, kind: str = "json", glob: str = "*", files_at_once: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_at_once).format(kind).load(folder)


def resumed(stream: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Applies a pass to what arrived since the last run. A batch writes its own folder and writes it anew when it is run again
    after a failure, so each input row counts once."""

    def write(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, at: str, by: list[str], width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """(start, by..., n): rows a window and key; windows older than the watermark leave the state in update and append mode."""
    grouped = stream.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), *by)
    return grouped.agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), *by, "n")


def completed(spark: SparkSession, counts: DataFrame, name: str) -> DataFrame:
    """The table that a finished stream of counts amounts to."""
    out, last = work_dir(spark, name), {}

    def write(batch: DataFrame, number: int) -> None:
        last["path"] = f"{out}/batch={number}"
        batch.write.mode("overwrite").parquet(last["path"])

    run = counts.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", work_dir(spark, name + "-state")).trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(counts.schema).parquet(last["path"]) if last else spark.createDataFrame([], counts.schema)
