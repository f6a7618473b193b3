"""Headings of exam texts and the numbered items below them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.text import western_digits

#: Numbers that may open an item: before any other one, and after a smaller one.
FIRST_AT_MOST, LATER_AT_MOST = fixed.FIRST_AT_MOST, fixed.LATER_AT_MOST

HEADING = (
    rf"(?U)^[\s#*_\-]*({fixed.EXERCISE}|{fixed.PART})\s+({'|'.join(fixed.ORDINALS)})[\s:：*_]*"
    rf"(?:\(?\s*([\d٠-٩]+(?:[.,]\d+)?)\s*\)?\s*(?:{fixed.POINTS})\b[^\n]*)?"
)


def plain(line: Column) -> Column:
    """Without vowel signs and inline markup."""
    return F.regexp_replace(F.regexp_replace(line, fixed.MARKS, ""), fixed.MARKUP, "")


def fragments(line: Column) -> Column:
    """Table cells, parts between line breaks and between slashes that stand alone."""
    return F.split(plain(line), r"<br\s*/?>|\||\s/\s")


def headings(lines: DataFrame) -> DataFrame:
    """lines(unit, i, line) -> (unit, i, kind, number, points): the first exercise and the first part of each line."""
    found = lines.select("unit", "i", F.posexplode(fragments(F.col("line"))).alias("at", "f"))
    field = lambda k: F.nullif(F.regexp_extract("f", HEADING, k), F.lit(""))
    named = lambda values: F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    parts = found.select("unit", "i", "at", field(1).alias("k"), field(2).alias("o"), F.replace(western_digits(field(3)), F.lit(","), F.lit(".")).try_cast("double").alias("points")).filter("k IS NOT NULL")
    typed = parts.select("unit", "i", "at", F.when(F.col("k") == fixed.PART, "part").otherwise("exercise").alias("kind"), F.element_at(named(fixed.ORDINALS), F.col("o")).alias("number"), "points")
    first = typed.groupBy("unit", "i", "kind").agg(F.min_by(F.struct("number", "points"), "at").alias("h"))
    return first.select("unit", "i", "kind", "h.number", "h.points")


def opened(labels: DataFrame, order: list[str]) -> DataFrame:
    """labels(unit, n, dotted, ...order) -> (unit, k, n): the labels that open an item, k their place from 1 on.

    A dotted label, the next number and 1 always open one; so does a number of at most FIRST_AT_MOST while none is open, and a larger
    number of at most LATER_AT_MOST. What opens depends on what did before: a fold over the unit's labels, which are those of one text."""
    listed = labels.groupBy("unit").agg(F.array_sort(F.collect_list(F.struct(*order, "n", "dotted"))).alias("l"))

    def step(state: Column, x: Column) -> Column:
        last, n = state["last"], x["n"]
        opens = x["dotted"] | (n == F.coalesce(last, F.lit(0)) + 1) | (n == 1) | (last.isNull() & (n <= FIRST_AT_MOST)) | ((n > last) & (n <= LATER_AT_MOST))
        opens, k = F.coalesce(opens, F.lit(False)), state["k"] + 1
        return F.struct(k.alias("k"), F.when(opens, n).otherwise(last).alias("last"), F.when(opens, F.array_append(state["out"], F.struct(k.alias("k"), n.alias("n")))).otherwise(state["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("k"), F.lit(None).cast("int").alias("last"), F.array().cast("array<struct<k:int,n:int>>").alias("out"))
    return listed.select("unit", F.inline(F.aggregate("l", start, step, lambda s: s["out"])))
