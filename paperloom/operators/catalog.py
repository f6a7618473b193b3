"""Typed catalogue of exam files from their names, dimension look-ups, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..functions.text import western_digits


def subjects(spark: SparkSession) -> DataFrame:
    """The seven subjects, with the beginnings of their files' names."""
    rows = [(*r, [f"bac_{code}_" for code in (r[0], *(wrong for wrong, right in fixed.ALIASES.items() if right == r[0]))]) for r in fixed.SUBJECT_ROWS]
    return spark.createDataFrame(rows, "code string, folder string, name_ar string, name_fr string, coefficient int, duration_hours double, pipeline string, file_prefixes array<string>")


def year_regimes(spark: SparkSession) -> DataFrame:
    """(year, era, completion_pct, sessions, censored, sealed) of 2008-2026."""
    rows = [(y, era, done, [(i, kind) for i, kind in enumerate(kinds, 1)], censored, sealed) for y, era, done, kinds, censored, sealed in fixed.YEAR_ROWS]
    return spark.createDataFrame(rows, "year int, era string, completion_pct double, sessions array<struct<session:int,session_type:string>>, censored boolean, sealed boolean")


def years_in_era(years: DataFrame, era: str) -> DataFrame:
    return years.filter(F.col("era") == era)


def training_years(years: DataFrame) -> DataFrame:
    """Years that models may be fitted on."""
    return years.filter(~F.col("sealed"))


def two_sessions(years: DataFrame) -> DataFrame:
    return years.filter(F.size("sessions") == 2)


def year(years: DataFrame, number: int) -> dict:
    """One year; KeyError for one that isn't there."""
    found = years.filter(F.col("year") == number).first()
    if found is None:
        raise KeyError(number)
    return found.asDict(recursive=True)


def keywords(spark: SparkSession, maps: dict[str, dict[str, dict[str, list[str]]]]) -> DataFrame:
    """(subject, topic, lang, keyword) of a syllabus, given as subject -> topic -> language -> words."""
    rows = [(s, t, lang, w) for s, topics in maps.items() for t, langs in topics.items() for lang, words in langs.items() for w in words]
    return spark.createDataFrame(rows, "subject string, topic string, lang string, keyword string")


def _subject(raw: Column) -> Column:
    """A subject's code; null for what is none. Misspelt ones are known."""
    code = western_digits(F.lower(raw))
    aliases = F.create_map(*[F.lit(x) for pair in fixed.ALIASES.items() for x in pair])
    code = F.coalesce(F.element_at(aliases, code), code)
    return F.when(code.isin(*fixed.SUBJECTS), code)


_RECORD = ("filename", "family", "subject", "year", "topic_choice", "type", "session", "session_type", "duplicate")


def manifest(files: DataFrame) -> DataFrame:
    """files(filename) of exams parsed: family A exam, B solution, C combined (a duplicate); subject null means unparsed."""
    name, part = F.col("filename"), lambda rx, k: F.nullif(F.regexp_extract("filename", rx, k), F.lit(""))
    both = name.rlike(fixed.COMBINED_NAME) & ~name.rlike(fixed.SINGLE_NAME)
    field = lambda single, combined: F.coalesce(part(fixed.SINGLE_NAME, single), part(fixed.COMBINED_NAME, combined))
    subject = _subject(field(1, 1))
    known, session = subject.isNotNull(), field(5, 4).cast("int")
    number, solution = western_digits(field(2, 2)).cast("int"), field(4, 3).isNotNull()
    out = files.select(
        "filename",
        F.when(known, F.when(both, "C").when(solution, "B").otherwise("A")).alias("family"),
        subject.alias("subject"),
        F.when(known, number).alias("year"),
        F.when(known, F.when(both, "both").otherwise(part(fixed.SINGLE_NAME, 3))).alias("topic_choice"),
        F.when(known, F.when(solution, "solution").otherwise("exam")).alias("type"),
        F.when(known, session).alias("session"),
        F.when(known & session.isNotNull(), F.when(session == 1, "normal").when(number == 2016, "reexam").when(number == 2017, "exceptional").otherwise("normal")).alias("session_type"),
        F.when(known, both).alias("duplicate"),
    )
    return _with_year(out)


def _with_year(records: DataFrame) -> DataFrame:
    years = year_regimes(records.sparkSession).select("year", "era", "censored", "sealed")  # 19 rows
    return records.join(F.broadcast(years), "year", "left").select(*_RECORD, "era", "censored", "sealed")


def other_records(files: DataFrame, pattern: str, kind: str) -> DataFrame:
    """files(filename) of programmes or thresholds parsed; names that begin with a dot are left out, subject null means unparsed."""
    subject = _subject(F.nullif(F.regexp_extract("filename", pattern, 1), F.lit("")))
    has_year = kind == "threshold"
    number = western_digits(F.regexp_extract("filename", pattern, 2)).try_cast("int") if has_year else F.lit(None).cast("int")
    null = lambda t: F.lit(None).cast(t)
    out = files.filter(~F.col("filename").startswith(".")).select(
        "filename", null("string").alias("family"), subject.alias("subject"), F.when(subject.isNotNull(), number).alias("year"), null("string").alias("topic_choice"),
        F.when(subject.isNotNull(), kind).alias("type"), null("int").alias("session"), null("string").alias("session_type"), F.when(subject.isNotNull(), False).alias("duplicate"),
    )
    return _with_year(out)


def built(exams: DataFrame, programmes: DataFrame, thresholds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All records of three folders' files(filename), and the names that couldn't be parsed."""
    rows = manifest(exams).unionByName(other_records(programmes, fixed.PROGRAMME_NAME, "programme")).unionByName(other_records(thresholds, fixed.THRESHOLD_NAME, "threshold"))
    return rows.filter("subject IS NOT NULL"), rows.filter("subject IS NULL").select("filename")


#: The slots of a complete year, in the order in which missing ones are named.
SLOTS = (("topic1_exam", "1", "exam"), ("topic1_solution", "1", "solution"), ("topic2_exam", "2", "exam"), ("topic2_solution", "2", "solution"))


def coverage(records: DataFrame) -> DataFrame:
    """Which of the four slots each (subject, year, session) has, and the missing ones; combined files and other families don't count."""
    has = [F.max(((F.col("topic_choice") == t) & (F.col("type") == k)).cast("int")).alias(name) for name, t, k in SLOTS]
    found = records.filter(F.col("family").isin("A", "B") & ~F.col("duplicate")).groupBy("subject", "year", "session").agg(*has)
    missing = F.array_compact(F.array(*(F.when(F.col(name) == 0, name) for name, _, _ in SLOTS)))
    return found.withColumn("missing", missing)
