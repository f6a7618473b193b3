"""Column functions that mend text: figures drawn in markup, turned years, patches, score blocks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .arrays import let

YEARS = (2008, 2026)

# Markup in which figures are drawn, what counts as a label in it, alternative texts that name nothing.
IMAGE, DRAWING, TAG, TIKZ = r"!\[[^\]]*\]\([^)]*\)", r"<svg\b.*?</svg>", r"<img\b[^>]*>", r"\\begin\{tikzpicture\}.*?\\end\{tikzpicture\}"
#: A fence goes up to the next one, a page's mark or the end.
FENCE = r"```[^\n`]*(?:\n.*?)??(?:```|(?=\n\s*\[PAGE\s+\d+\]\s*(?:\n|\z))|\z)"
FIGURE = f"(?sU)({IMAGE}|{DRAWING}|{TAG}|{TIKZ}|{FENCE})"
LABEL = r"(?U)([A-Za-zÀ-ÿ\u0600-\u06FF][A-Za-zÀ-ÿ\u0600-\u06FF0-9_'^,.\-]*|\d+(?:[.,]\d+)?\s*[A-Za-z%°]*)"
NAMELESS = ("graph", "image", "figure", "img")
MOST_LABELS = 40


def _labels(drawing: Column) -> Column:
    found = F.array_distinct(F.filter(F.transform(F.regexp_extract_all(drawing, F.lit(LABEL), F.lit(1)), lambda x: F.trim(x, F.lit(" .,"))), lambda x: F.length(x) > 1))
    return let(F.slice(found, 1, MOST_LABELS), lambda ls: F.when(F.size(ls) > 0, F.concat(F.lit("labels: "), F.array_join(ls, ", "))).otherwise(""))


def _figure(markup: Column) -> Column:
    """What stands for a piece of markup: its alternative text, or the labels that are drawn in it."""
    alt, inside = T.strip(F.regexp_extract(markup, r"^!\[([^\]]*)\]", 1)), F.regexp_replace(markup, r"(?s)^```[^\n`]*|```$", "")
    said = (
        F.when(markup.startswith("!["), F.when(F.lower(alt).isin(*NAMELESS), "").otherwise(alt))
        .when(markup.startswith("<svg"), "")
        .when(markup.startswith("<img"), F.regexp_extract(markup, 'alt="([^"]*)"', 1))
        .when(markup.startswith("```"), let(_labels(inside), lambda ls: F.concat_ws("; ", F.lit("ASCII rendition removed"), F.nullif(ls, F.lit("")))))
        .otherwise(_labels(markup))
    )
    nothing = markup.rlike(r"^```[^\n`]*\s*$")  # a fence that opens at the very end
    return F.when(nothing, "").otherwise(let(said, lambda x: F.when(x == "", "[FIGURE]").otherwise(F.concat(F.lit("[FIGURE: "), x, F.lit("]")))))


def figures(text: Column) -> Column:
    """A text whose drawn figures are [FIGURE] marks with their labels or alternative texts. Markup is found in one pass, the first that opens first, and what is
    inside it is no figure of its own; the text between is what a split at the same pattern leaves."""
    drawn = F.transform(F.regexp_extract_all(text, F.lit(FIGURE), F.lit(1)), _figure)
    return F.when(text.rlike(FIGURE), F.array_join(F.zip_with(F.split(text, FIGURE, -1), drawn, lambda gap, x: F.concat(gap, F.coalesce(x, F.lit("")))), "")).otherwise(text)


def year_turned_back(text: Column, year: Column) -> Column:
    """The digits of a file's year, where they stand reversed."""
    return F.when(year.between(*YEARS), F.replace(text, F.reverse(year.cast("string")), year.cast("string"))).otherwise(text)


def years_turned_back(text: Column, first: int = YEARS[0], last: int = YEARS[1]) -> Column:
    """All years of a span, the latest first."""
    return reduce(lambda t, y: F.replace(t, F.lit(str(y)[::-1]), F.lit(str(y))), range(last, first - 1, -1), text)


def patched(texts: DataFrame, patches: DataFrame) -> DataFrame:
    """texts(stem, content) with patches(stem, seq, old, new, everywhere) applied in order, to the first place or everywhere, and log, which holds (old, status, n) for each.
    A text's patches are few; texts without any stay as they are."""
    listed = patches.groupBy("stem").agg(F.array_sort(F.collect_list(F.struct("seq", "old", "new", "everywhere"))).alias("_p"))

    def step(state: Column, p: Column) -> Column:
        text = state["text"]
        n = F.when(p["old"] == "", 0).otherwise(((F.length(text) - F.length(F.replace(text, p["old"], F.lit("")))) / F.length(p["old"])).cast("int"))
        at = F.call_function("locate", p["old"], text)
        first = F.concat(F.substring(text, F.lit(1), at - 1), p["new"], F.substring(text, at + F.length(p["old"]), F.length(text)))
        done = F.when(n == 0, text).when(p["everywhere"], F.replace(text, p["old"], p["new"])).otherwise(first)
        entry = F.struct(p["old"].alias("old"), F.when(n > 0, "OK").otherwise("NOT_FOUND").alias("status"), F.coalesce(n, F.lit(0)).alias("n"))
        return F.struct(done.alias("text"), F.array_append(state["log"], entry).alias("log"))

    none = F.array().cast("array<struct<old:string,status:string,n:int>>")
    folded = F.aggregate(F.coalesce("_p", F.array().cast("array<struct<seq:int,old:string,new:string,everywhere:boolean>>")), F.struct(F.col("content").alias("text"), none.alias("log")), step)
    joined = texts.join(listed.withColumn("_p", F.col("_p").cast("array<struct<seq:int,old:string,new:string,everywhere:boolean>>")), "stem", "left")
    return joined.withColumn("_f", folded).select(*(F.col(c) if c != "content" else F.col("_f.text").alias("content") for c in texts.columns), F.col("_f.log").alias("log"))


def with_scores(page: Column, reading: Column) -> tuple[Column, Column]:
    """A page with a block of scores at its end, and whether it was APPENDED; readings that say there is none, that it has to be read again or that
    it is in the text already are skipped, and so are pages that have a block."""
    skip = reading.isNull() | reading.rlike("^(?:NO_SCORES|RECHECK|SCORES_ALREADY_IN_TEXT)") | F.contains(page, F.lit("[SCORES"))
    block = F.concat(F.lit("[SCORES — read from source image, top→bottom: "), reading, F.lit("]"))
    return F.when(skip, page).otherwise(F.concat(page, F.lit("\n"), block)), F.when(skip, "SKIP").otherwise("APPENDED")


def merged_fields(caption: Column, corrections: Column, fields: list[str]) -> Column:
    """A caption with the corrections' fields that aren't empty."""
    return F.struct(*(F.coalesce(F.nullif(corrections[f], F.lit("")), caption[f]).alias(f) for f in fields))
