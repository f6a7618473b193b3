"""A training corpus from raw documents: toxic and low-quality documents go, near copies become one, benchmark passages
go, and the rest is mixed to target weights. Each stage reads what the one before wrote.

Every stage but the last returns the columns of its input as they are, whatever their names and other columns; the quality rules change text, and
n_chars with it, where lines are removed. Null ids, texts and sources and repeated rows are rows like others, an empty table stays empty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import common, decontaminate, jaccard_join, line_frequency, mixing, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model, fitted on the labelled ones among them, doesn't find toxic."""
    model = toxicity.train(docs, common.table(spark, sf_dir, "labels"))
    return common.unpacked(toxicity.scored(common.packed(docs, "text"), model).filter(~F.col("toxic")), docs, "text")


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without the lines that too many documents of their host hold."""
    key = ("doc_id", "source", "text")
    kept = line_frequency.cleaned(line_frequency.judged(common.packed(docs, *key)))
    out = kept.select(*(c for c in (*key, common.CARRIED)), F.col("removed").isNotNull().alias("cut"))
    if "n_chars" in docs.columns:
        was = F.col(common.CARRIED).getField("n_chars")
        out = out.withColumn(common.CARRIED, F.col(common.CARRIED).withField("n_chars", F.when(F.col("cut"), F.length("text")).otherwise(was).cast(docs.schema["n_chars"].dataType)))
    return common.unpacked(out, docs, *key)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies: that with the least doc_id, one with an id before those without. Rows are told apart
    by a number of their own, so that repeated and null ids neither save nor remove a row."""
    row = common.prefix(docs) + "row"
    rows = common.staged(docs.withColumn(row, F.monotonically_increasing_id()), "near-copies-rows")
    found = jaccard_join.near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"), numbered=True).select(F.col("doc_id").alias(row), "class_id")
    size = found.groupBy("class_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("class_id")
    many = common.staged(common.joined_small(found, common.staged(size, "near-copies-classes"), ["class_id"], "left_semi"), "near-copies-members")
    named = common.joined_small(rows.select(row, F.col("doc_id").cast("long").alias("id")), many, [row], "inner")
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col(row).alias("row"))
    stays = common.staged(named.groupBy("class_id").agg(F.min(order).alias("m")).select(F.col("m.row").alias(row)), "near-copies-stay")
    extra = common.staged(common.joined_small(many, stays, [row], "left_anti").select(row), "near-copies")
    return common.joined_small(rows, extra, [row], "left_anti").select(*common.columns(docs))


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark doesn't contaminate."""
    return decontaminate.clean(docs, common.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, whole, with how often and how much the mix takes of each: size, source_size, target, taken and copies."""
    return mixing.mixed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", apply_quality_rules),
    ("n-gram Jaccard join", join_near_copies),
    ("benchmark decontamination", decontaminate_benchmark),
    ("mixing sources to target weights", mix_sources),
]

#: SQL can't express the trained model of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage staged is deleted when its output is written."""
    docs = common.table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        path = common.new_path(spark, f"pipeline-{number}")
        with common.scratch(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        if number:
            common.dropped(spark, docs)
        docs = spark.read.schema(out.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
