"""Order-dependent operators as windows: carried markers, runs, gaps, occurrences, tiers, turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed


def pages_of(texts: DataFrame) -> DataFrame:
    """texts(stem, content) cut at [PAGE n] lines: (stem, page_num, text); text before the first marker is dropped and of
    repeated markers the last page stays."""
    number = F.regexp_extract("line", r"^\[PAGE\s+(\d+)\]", 1)
    order = Window.partitionBy("stem").orderBy("i")
    rows = texts.select("stem", F.posexplode(F.split("content", "\n")).alias("i", "line")).withColumn("mark", F.nullif(number, F.lit("")).cast("int"))
    rows = rows.withColumn("nth", F.count("mark").over(order)).withColumn("page_num", F.last("mark", True).over(order))
    body = rows.filter("nth > 0 AND mark IS NULL").groupBy("stem", "nth").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "line"))), lambda x: x["line"]).alias("lines"))
    marks = rows.filter("mark IS NOT NULL").select("stem", "nth", "page_num")
    joined = marks.join(body, ["stem", "nth"], "left").withColumn("text", F.coalesce(F.trim(F.array_join("lines", "\n")), F.lit("")))
    return joined.groupBy("stem", "page_num").agg(F.max_by("text", "nth").alias("text"))


def runs(rows: DataFrame, unit: str, order: str, number: str) -> DataFrame:
    """rows with run: a new one starts where the number doesn't grow."""
    w = Window.partitionBy(unit).orderBy(order)
    return rows.withColumn("run", F.sum(F.coalesce((F.col(number) <= F.lag(number).over(w)).cast("int"), F.lit(1))).over(w))


def gaps(rows: DataFrame, unit: str, number: str) -> DataFrame:
    """(unit, after): numbers followed by their second successor where the next is missing."""
    w = Window.partitionBy(unit).orderBy(number)
    return rows.select(unit, number).distinct().withColumn("_n", F.lead(number).over(w)).filter(F.col("_n") == F.col(number) + 2).select(unit, F.col(number).alias("after"))


def islands(rows: DataFrame, unit: str, order: str, value: str) -> DataFrame:
    """(unit, island, value, first, last, n): runs of equal values."""
    w = Window.partitionBy(unit).orderBy(order)
    marked = rows.withColumn("island", F.sum((~F.col(value).eqNullSafe(F.lag(value).over(w)) | (F.row_number().over(w) == 1)).cast("int")).over(w))
    return marked.groupBy(unit, "island").agg(F.first(value).alias(value), F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n"))


def occurrences(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return rows.withColumn("occurrence", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def parent_stubs(rows: DataFrame, unit: str, order: list[str], label: str) -> DataFrame:
    """rows with stub: whether the unit's next label lies below this one (2 before 2.1). A null label is no stub."""
    following = F.lead(label).over(Window.partitionBy(unit).orderBy(*order))
    return rows.withColumn("stub", F.coalesce(following.startswith(F.concat(label, F.lit("."))), F.lit(False)))


def shared_answers(rows: DataFrame, unit: str, order: list[str], answer: str, width: int = 60) -> DataFrame:
    """rows with shared: whether an earlier answer of the unit begins with the same `width` characters. Null answers share nothing."""
    w = Window.partitionBy(unit, F.substring(answer, 1, width)).orderBy(*order)
    return rows.withColumn("shared", F.col(answer).isNotNull() & (F.row_number().over(w) > 1))


def nth_pages(texts: DataFrame) -> DataFrame:
    """texts(stem, content) cut at every page mark: (stem, page_num, text), pages numbered as they come."""
    parts = texts.select("stem", F.posexplode(F.split("content", r"\[PAGE \d+\]")).alias("page_num", "text"))
    return parts.filter("page_num > 0").withColumn("text", F.regexp_replace("text", r"(?U)^\s+|\s+$", ""))


def rendered(pages: DataFrame) -> DataFrame:
    """(stem, content) of pages(stem, page_num, text), in order, each below its mark."""
    part = F.concat(F.lit("[PAGE "), F.col("page_num"), F.lit("]\n"), F.col("text"))
    listed = pages.groupBy("stem").agg(F.array_sort(F.collect_list(F.struct("page_num", part.alias("t")))).alias("l"))
    return listed.select("stem", F.array_join(F.transform("l", lambda x: x["t"]), "\n\n").alias("content"))


def replaced_pages(pages: DataFrame, new: DataFrame) -> DataFrame:
    """pages(stem, page_num, text) with new texts where there are some."""
    own = new.select("stem", "page_num", F.col("text").alias("_new"))
    return pages.join(own, ["stem", "page_num"], "left").withColumn("text", F.coalesce("_new", "text")).drop("_new")


def page_lines(chars: DataFrame) -> DataFrame:
    """(stem, page_num, text) from chars(stem, page_num, seq, text, x0, top): characters within a row of three points are a line, read from right to left if it is Arabic by
    more than 30 %, with its runs of digits turned back; blank lines are left out."""
    from ..functions import text as T

    row = (F.rint(F.col("top") / 3) * 3).alias("row")
    lines = chars.groupBy("stem", "page_num", row).agg(F.collect_list(F.struct("seq", "x0", "text")).alias("c"))
    joined = lambda order: F.array_join(F.transform(F.array_sort(F.transform("c", order)), lambda x: x["text"]), "")
    as_come = joined(lambda x: F.struct(x["seq"].alias("k"), x["text"].alias("text")))
    left = joined(lambda x: F.struct(x["x0"].alias("k"), x["seq"].alias("s"), x["text"].alias("text")))
    right = joined(lambda x: F.struct((-x["x0"]).alias("k"), x["seq"].alias("s"), x["text"].alias("text")))
    share = T.count_of(as_come, T.ARABIC) / F.greatest(F.length(T.strip(as_come)), F.lit(1))
    line = F.when(share > 0.3, T.restored_digits(T.strip(T.nfkc(right)))).otherwise(T.strip(left))
    kept = lines.select("stem", "page_num", "row", line.alias("line")).filter("line <> ''")
    listed = kept.groupBy("stem", "page_num").agg(F.array_sort(F.collect_list(F.struct("row", "line"))).alias("l"))
    return listed.select("stem", "page_num", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("text"))


def carried(lines: DataFrame, unit: str, order: list[str], marker: str, name: str = "carried", partitions: int | None = None) -> DataFrame:
    """lines with the last marker that isn't null up to each line of its unit, null before the first: a prefix scan for units of any size.

    Lines are dealt out by ranges of unit and order and written, which fixes who holds what. Each stretch (a unit's lines on one task) is scanned by itself; what a stretch
    ends with goes on as a table of one row a stretch, of which a unit has no more than there were tasks. So a unit, a file of any length say, is never in one task. Lines
    that are equal in all of `order` have no order among themselves. Null units are one unit; an empty table gives none."""
    from ..streaming.incremental import work_dir

    p = "_scan"
    dealt = [*([partitions] if partitions else []), unit, *order]
    rows = lines.repartitionByRange(*dealt).withColumn(f"{p}_at", F.spark_partition_id())
    path = work_dir(lines.sparkSession, "carried")
    rows.write.parquet(path)
    rows = lines.sparkSession.read.schema(rows.schema).parquet(path)
    # of markers at one place the largest, at a stretch's end as within it
    end = F.max(F.when(F.col(marker).isNotNull(), F.struct(*order, F.col(marker).alias(f"{p}_m"))))
    ends = rows.groupBy(F.col(unit).alias(f"{p}_u"), F.col(f"{p}_at").alias(f"{p}_a")).agg(end[f"{p}_m"].alias(f"{p}_end"))
    before = Window.partitionBy(f"{p}_u").orderBy(f"{p}_a").rowsBetween(Window.unboundedPreceding, -1)
    brought = ends.select(f"{p}_u", f"{p}_a", F.last(f"{p}_end", ignorenulls=True).over(before).alias(f"{p}_brought"))
    within = Window.partitionBy(unit, f"{p}_at").orderBy(*order, F.col(marker).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    scanned = rows.withColumn(f"{p}_own", F.last(marker, ignorenulls=True).over(within))
    joined = scanned.join(brought, F.col(unit).eqNullSafe(F.col(f"{p}_u")) & (F.col(f"{p}_at") == F.col(f"{p}_a")))
    return joined.select(*lines.columns, F.coalesce(f"{p}_own", f"{p}_brought").alias(name))


def paged_lines(lines: DataFrame, partitions: int | None = None) -> DataFrame:
    """lines(stem, block, seq, line) of files of any size, as files.lines() gives them: (stem, block, seq, page_num, line), page_num that of the last [PAGE n] line. Lines before the first mark and
    the marks themselves are dropped; what pages_of() does where a file is a row."""
    mark = F.regexp_extract("line", fixed.PAGE_MARK, 1).try_cast("int")
    found = carried(lines.withColumn("mark", mark), "stem", ["block", "seq"], "mark", "page_num", partitions)
    return found.filter("mark IS NULL AND page_num IS NOT NULL").select("stem", "block", "seq", "page_num", "line")
