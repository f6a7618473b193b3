"""Orders, pages of results, samples and sheets for reviewers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def most_common(rows: DataFrame, key: str) -> DataFrame:
    """(key, n), the most frequent first, ties in order of the key."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), key)


def nulls_as(rows: DataFrame, keys: list[str], value=0) -> DataFrame:
    """In order of keys, null being `value`."""
    return rows.orderBy(*(F.coalesce(k, F.lit(value)) for k in keys))


def nulls_last(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.orderBy(*(F.col(k).asc_nulls_last() for k in keys))


def head(rows: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n by an order: every task keeps n rows at most."""
    return rows.orderBy(*order).limit(n)


def page(rows: DataFrame, order: list[Column], start: int, count: int) -> DataFrame:
    """`count` rows from the start-th on, counted from 0."""
    return rows.orderBy(*order).offset(start).limit(count)


def tiers(rows: DataFrame, kind: str, priority: dict[str, int], capped: str | None = None, most: int = 40, order: str = "id") -> DataFrame:
    """rows with tier, by kind (5 for others); of one kind `most` rows in order of a column at most."""
    ranked = rows.withColumn("tier", F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in priority.items() for x in p]), F.col(kind)), F.lit(5)))
    if capped is None:
        return ranked
    few = ranked.filter(F.col(kind) == capped).orderBy(order).limit(most)
    return ranked.filter(~F.col(kind).eqNullSafe(capped)).unionByName(few)


def first_seen(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key: partial minima before the shuffle."""
    whole = F.struct(*[F.col(order).alias("_o"), *(F.col(c) for c in rows.columns)])
    return rows.groupBy(F.col(key).alias("_k")).agg(F.min_by(whole, order).alias("_r")).select(*(F.col(f"_r.{c}").alias(c) for c in rows.columns))


def audit_sample(questions: DataFrame, seen: DataFrame, per_class: int, least: int, seed: int = 0) -> DataFrame:
    """questions(qid, subject, match) to look at: per_class of each subject and class, and more of a subject's others until it has `least`; none that was seen(qid), and no stubs and legends. The order is a
    hash of the key and a seed, so reruns agree."""
    pool = questions.filter(~F.col("match").isin("parent_stub", "legend")).join(seen.select("qid"), "qid", "left_anti").withColumn("_h", F.xxhash64("qid", F.lit(seed)))
    cell, rest = Window.partitionBy("subject", "match").orderBy("_h", "qid"), Window.partitionBy("subject").orderBy(F.col("_in").desc(), "_h", "qid")
    ranked = pool.withColumn("_in", F.row_number().over(cell) <= per_class).withColumn("_r", F.row_number().over(rest))
    return ranked.filter(F.col("_in") | (F.col("_r") <= least)).drop("_h", "_in", "_r")


def dense_sample(pages: DataFrame, measure: Column, group: str, most: dict, take: dict, seed: int = 0) -> DataFrame:
    """Of each group the `most` densest pages(key, ...), and of those `take` by a hash."""
    by = Window.partitionBy(group).orderBy(F.desc("density"), F.desc("key"))
    limit = lambda d: F.element_at(F.create_map(*[F.lit(x) for p in d.items() for x in p]), F.col(group))
    top = pages.withColumn("density", measure).withColumn("_r", F.row_number().over(by)).filter(F.col("_r") <= limit(most))
    chosen = Window.partitionBy(group).orderBy(F.xxhash64("key", F.lit(seed)), "key")
    return top.withColumn("_r", F.row_number().over(chosen)).filter(F.col("_r") <= limit(take)).drop("_r")


def flagged_units(questions: DataFrame, strict: bool = False) -> DataFrame:
    """(unit_id) of units with a question that has no answer, one against the numbering or one shared with another; and, if not strict, one supported by its label only."""
    width = F.substring("answer", 1, 60)
    shared = F.col("answer").isNotNull() & (F.col("answer") != "") & (F.count(F.lit(1)).over(Window.partitionBy("unit_id", width)) > 1)
    bad = (F.col("match") == "none") | F.coalesce(F.col("label_agree") == 0, F.lit(False)) | shared
    if not strict:
        bad = bad | (F.col("match") == "label_supported")
    return questions.withColumn("_bad", bad).filter("_bad").select("unit_id").distinct()


def sheet(questions: DataFrame, blocks: DataFrame, width: int = 110) -> DataFrame:
    """(unit_id, text): a unit's questions, with their flags and answers, above its blocks(unit_id, block, label, text)."""
    from ..functions.text import short
    from .align import flags

    q = flags(questions).select("unit_id", F.lit(0).alias("part"), F.col("ix").alias("at"), F.concat(F.split_part("qid", F.lit("__"), F.lit(-1)), F.lit(" ["), F.concat_ws(",", "match", "flags"), F.lit("] "), short(F.col("question"), width), F.lit(" -> "), F.coalesce(short(F.col("answer"), width), F.lit("-"))).alias("line"))
    b = blocks.select("unit_id", F.lit(1).alias("part"), F.col("block").alias("at"), F.concat(F.lit("  ["), "block", F.lit("] a"), F.coalesce("label", F.lit("-")), F.lit(": "), short(F.col("text"), width)).alias("line"))
    lines = q.unionByName(b).groupBy("unit_id").agg(F.array_sort(F.collect_list(F.struct("part", "at", "line"))).alias("l"))
    return lines.select("unit_id", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("text"))


def decisions(questions: DataFrame, automatic: DataFrame, overrides: DataFrame) -> DataFrame:
    """A row for each override: (qid, unit_id, old_match, old_answer, match, blocks, changed, reason, by), changed null where the automatic run had no such question."""
    a = automatic.select("qid", F.col("match").alias("old_match"), F.col("answer").alias("old_answer"), F.lit(True).alias("_had"))
    rows = questions.select("qid", "unit_id", "match", "answer").join(overrides.select("qid", "blocks", F.col("note").alias("reason"), "by"), "qid").join(a, "qid", "left")
    return rows.withColumn("changed", F.when(F.col("_had"), ~F.col("old_answer").eqNullSafe(F.col("answer")))).drop("_had")
