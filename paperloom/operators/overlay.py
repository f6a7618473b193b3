"""Keyed merges: upserts, resumable work, human corrections, regressions, samples, key permutations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upsert(prior: DataFrame, new: DataFrame, keys: list[str], skipped: Column | None = None) -> DataFrame:
    """New rows replace prior ones of their key; skipped new rows replace nothing and are left out."""
    fresh = new if skipped is None else new.filter(~skipped)
    return prior.join(fresh.select(*keys).distinct(), keys, "left_anti").unionByName(fresh)


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key. Tasks keep one row a key before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return rows.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*").select(*rows.columns)


def pending(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work whose key isn't done."""
    return work.join(done, keys, "left_anti")


def regressions(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """Keys whose value changed, null-safe."""
    joined = before.select(key, F.col(value).alias("before")).join(after.select(key, F.col(value).alias("after")), key)
    return joined.filter(~F.col("before").eqNullSafe(F.col("after")))


def overlaid(automatic: DataFrame, overrides: DataFrame, key: str, value: str) -> DataFrame:
    """An override's value wins; by tells which it is."""
    o = overrides.select(key, F.col(value).alias("_o"), F.lit(True).alias("_is"))
    joined = automatic.join(o, key, "left")
    return joined.withColumns({value: F.when(F.col("_is"), F.col("_o")).otherwise(F.col(value)), "by": F.when(F.col("_is"), "human").otherwise("auto")}).drop("_o", "_is")


def stratified(rows: DataFrame, strata: list[str], key: str, cap: int) -> DataFrame:
    """`cap` rows of each stratum, in the order of their keys' md5."""
    window = Window.partitionBy(*strata).orderBy(F.md5(F.col(key).cast("string").cast("binary")), key)
    return rows.withColumn("_r", F.row_number().over(window)).filter(F.col("_r") <= cap).drop("_r")


def unique_label_fix(questions: DataFrame, blocks: DataFrame, unit: str, label: str, block: str) -> DataFrame:
    """Questions whose unit has exactly one block of their label, with that block."""
    single = blocks.groupBy(unit, label).agg(F.count(F.lit(1)).alias("n"), F.min(block).alias(block)).filter("n = 1").drop("n")
    return questions.join(single, [unit, label])


def permuted(rows: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """Keys replaced by mapping(old, new), all at once."""
    return rows.join(mapping, rows[key] == mapping["old"], "left").withColumn(key, F.coalesce("new", key)).drop("old", "new")


def permuted_everywhere(tables: dict[str, tuple[DataFrame, list[str]]], mapping: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """Tables, each with the columns that hold a key, with mapping(old, new) applied to all of them at once, and a log: (table, column, old, new, n) of what changed in how many
    rows. Written as one version (sources.versions), so that no reader meets one table with new keys and another with old ones."""
    new, logs = {}, []
    for name, (df, columns) in tables.items():
        new[name] = df
        for column in columns:
            new[name] = permuted(new[name], mapping, column)
            counts = df.groupBy(F.col(column).alias("old")).agg(F.count(F.lit(1)).alias("n")).join(mapping, "old")
            logs.append(counts.select(F.lit(name).alias("table"), F.lit(column).alias("column"), "old", "new", "n"))
    return new, reduce(DataFrame.unionByName, logs)


def first_of_each(rows: DataFrame, key: str, order: str) -> tuple[DataFrame, DataFrame]:
    """The first row of each key, and the keys that come more than once with how often."""
    whole = F.struct(*rows.columns)
    first = rows.groupBy(F.col(key).alias("_k")).agg(F.min_by(whole, order).alias("_r")).select("_r.*")
    return first, rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def swapped_topics(name: Column, subject: str, year: int, which: str = "both", session: str = "") -> Column:
    """A name, key or text in which topics 1 and 2 of a subject's year are exchanged: those of exams, of solutions or of both. Combined files keep theirs."""
    base = f"bac_{subject}_{year}_sujet"
    after = {"exam": r"(?!_and)(?!_solution)(?![A-Za-z0-9])", "solution": rf"(?=_solution{session}(?![A-Za-z0-9]))", "both": r"(?!_and)(?![A-Za-z0-9])"}[which]
    # through a mark that no name has, so that a name is exchanged once
    mark = F.regexp_replace(name, rf"{base}1{after}", f"{base}\u0000")
    return F.regexp_replace(F.regexp_replace(mark, rf"{base}2{after}", f"{base}1"), f"{base}\u0000", f"{base}2")


def override_set(overrides: DataFrame, questions: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """overrides(qid, blocks, note, by, from_unit) with new ones in place of those of their keys, and a log: what a question(qid, match, answer_label, answer) had before, which override it had, what it has now."""
    merged = upsert(overrides, new, ["qid"])
    before = overrides.select("qid", F.col("blocks").alias("previous_blocks"), F.col("note").alias("previous_note"))
    had = questions.select("qid", F.struct("match", "answer_label", "answer").alias("old_mapping"))
    now = F.when(F.col("blocks").isNull(), "solution_missing").otherwise("human")
    log = new.join(had, "qid", "left").join(before, "qid", "left").withColumn("match", now)
    return merged, log.select("qid", "old_mapping", "previous_blocks", "previous_note", "match", "blocks", "from_unit", F.col("note").alias("reason"), "by")


def with_fallback(rows: DataFrame, first: DataFrame, second: DataFrame, key: str, value: str) -> DataFrame:
    """rows with a value from the first table that has one for the key."""
    a, b = first.select(key, F.col(value).alias("_a")), second.select(key, F.col(value).alias("_b"))
    return rows.join(a, key, "left").join(b, key, "left").withColumn(value, F.coalesce("_a", "_b")).drop("_a", "_b")


def retry(work: DataFrame, results: DataFrame, key: str, quality: str = "quality_score", skipped: str = "skipped") -> DataFrame:
    """Work whose last result had no quality and wasn't skipped."""
    bad = results.filter((F.coalesce(quality, F.lit(0.0)) == 0) & ~F.coalesce(skipped, F.lit(False))).select(key)
    return work.join(bad, key, "left_semi")


def within_budget(calls: DataFrame, order: str, cost: str, most: float) -> DataFrame:
    """Calls made before their sum reached the budget. The log is one of a run, read in order."""
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return calls.withColumn("_spent", F.coalesce(F.sum(cost).over(w), F.lit(0.0))).filter(F.col("_spent") < most).drop("_spent")
