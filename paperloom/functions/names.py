"""Column functions on names and keys: stems, images, pages, questions; image sizes and boxes; scopes of records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed


def part(text: Column, pattern: str, group: int) -> Column:
    """A group of a pattern; null where it doesn't match or took no part."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def stem(name: Column) -> Column:
    """(subject, year, sujet, session, doc_type) of a text's stem; null for a name of another form."""
    field = lambda k: part(name, fixed.STEM, k)
    made = F.struct(
        field(1).alias("subject"),
        field(2).cast("int").alias("year"),
        field(3).cast("int").alias("sujet"),
        field(5).cast("int").alias("session"),
        F.when(field(4).isNotNull(), "solution").otherwise("exam").alias("doc_type"),
    )
    return F.when(name.rlike(fixed.STEM), made)


def image(name: Column) -> Column:
    """(stem, subject, year, page_num, img_index) of an image's name; page and index are 1 where it names none."""
    bare = F.regexp_replace(name, r"\.[^./]*$", "")
    has = F.contains(bare, F.lit("_page"))
    head, tail = F.regexp_replace(bare, "_page(?!.*_page).*$", ""), F.regexp_extract(bare, "_page((?!.*_page).*)$", 1)
    parts = F.split(head, "_")
    number = lambda pattern: F.coalesce(F.when(has, part(tail, pattern, 1).try_cast("int")), F.lit(1))
    return F.struct(
        head.alias("stem"),
        F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("unknown")).alias("subject"),
        F.when(F.try_element_at(parts, F.lit(3)).rlike("^[0-9]+$"), F.try_element_at(parts, F.lit(3)).try_cast("int")).alias("year"),
        number(r"^([0-9]+)(?:_img[^_]*)?$").alias("page_num"),
        number(r"_img([0-9]+)$").alias("img_index"),
    )


def page_key(key: Column) -> Column:
    """(stem, page_num, subject) of stem__pN."""
    own = part(key, fixed.PAGE_KEY, 1)
    return F.struct(own.alias("stem"), part(key, fixed.PAGE_KEY, 2).cast("int").alias("page_num"), F.try_element_at(F.split(own, "_"), F.lit(2)).alias("subject"))


def question_key(qid: Column) -> Column:
    """(unit_id, label, occurrence, stem) of unit__qLABEL, with #n from the second of a label on."""
    unit, rest = F.split_part(qid, F.lit("__q"), F.lit(1)), F.split_part(qid, F.lit("__q"), F.lit(2))
    nth = F.nullif(F.split_part(rest, F.lit("#"), F.lit(2)), F.lit("")).cast("int")
    return F.struct(unit.alias("unit_id"), F.split_part(rest, F.lit("#"), F.lit(1)).alias("label"), F.coalesce(nth, F.lit(1)).alias("occurrence"), F.split_part(unit, F.lit("__"), F.lit(1)).alias("stem"))


def solution_stem(exam: Column) -> Column:
    """The stem of an exam's answer key: _solution comes before the session."""
    return F.when(exam.rlike("_session[0-9]$"), F.regexp_replace(exam, "_(session[0-9])$", "_solution_$1")).otherwise(F.concat(exam, F.lit("_solution")))


def exam_stem(solution: Column) -> Column:
    return F.replace(solution, F.lit("_solution"), F.lit(""))


def in_scope(family: Column, duplicate: Column, subject: Column, subjects: tuple[str, ...] = fixed.SUBJECTS) -> Column:
    """Single exams and solutions of known subjects; duplicates are none."""
    return ~duplicate & family.isin("A", "B") & subject.isin(*subjects)


def page_scan(width: Column, height: Column, most: int = 2_000_000) -> Column:
    """Whether an image is a scan of a whole upright page: by its pixels and the ratio of its sides."""
    ratio = width / F.nullif(height, F.lit(0))
    return F.coalesce((width.cast("long") * height > most) & (ratio > 0.55) & (ratio < 0.85), F.lit(False))


def wants_caption(subject: Column, width: Column, height: Column, least: int = 10_000) -> Column:
    """Images of science subjects with pixels enough that are no scans of pages."""
    return subject.isin(*fixed.SCIENCE) & (width.cast("long") * height >= least) & ~page_scan(width, height)


def big_enough(width: Column, height: Column, least: int = 50) -> Column:
    return F.greatest(width, height) >= least


def crop(box: Column, page_width: Column, page_height: Column, scale: Column, scan_share: float = 0.8) -> Column:
    """(left, top, right, bottom, page_scan) in pixels from the top of box(x0, y0, x1, y1) in points from the bottom; null for empty boxes."""
    x0, y0, x1, y1 = (box[k] for k in ("x0", "y0", "x1", "y1"))
    pixels = lambda v: (v * scale).cast("int")
    made = F.struct(
        F.greatest(F.lit(0), pixels(x0)).alias("left"),
        F.greatest(F.lit(0), pixels(page_height - y1)).alias("top"),
        F.least(pixels(page_width), pixels(x1)).alias("right"),
        F.least(pixels(page_height), pixels(page_height - y0)).alias("bottom"),
        ((x1 - x0) * (y1 - y0) / (page_width * page_height) >= scan_share).alias("page_scan"),
    )
    return F.when((x1 > x0) & (y1 > y0) & (made["right"] > made["left"]) & (made["bottom"] > made["top"]), made)
