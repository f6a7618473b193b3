"""Texts of exams and answer keys cut into units: exercises of science subjects, sections of language subjects.

Lines that open or close something are marked by patterns; a scan over these marks, which are few, carries what is open, and the lines between them are
cut out of the text's array. Everything stays in the text's row, in array expressions; captions meet units by page in a join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.arrays import cut_at, following, let, places, scan
from ..functions.text import all_lines, strip, western_digits
from . import reading as L
from .segments import HEADING, fragments

#: Text before the first heading, or beside none, is a unit of its own from so many characters on.
LEAST_PREAMBLE = 300
#: Characters of a line that is the prose of a passage, and how many lines on another one comes.
PROSE, NEXT_PROSE = 150, 5
# Fixed value: a page of an answer key that is a stray copy of another key's.
SKIPPED_PAGES = frozenset({("bac_physic_2024_sujet1_solution", 5)})

_LINE = "struct<page:int,line:string>"
_UNIT = (
    "struct<part:string,exercise_label:string,exercise_index:int,section_key:string,section_label:string,points:double,points_source:string,pages:array<int>,"
    "lines:array<string>,subparts:array<string>,heading_inferred:boolean,whole_document:boolean>"
)
_NONE = f"array<{_UNIT}>"


def _named(values: dict, key: Column) -> Column:
    """The value of a key; null for others."""
    return reduce(lambda c, x: c.when(key == x[0], x[1]), list(values.items())[1:], F.when(key == next(iter(values)), next(iter(values.values()))))


def _found(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _points(text: Column) -> Column:
    return F.replace(western_digits(text), F.lit(","), F.lit(".")).try_cast("double")


def _first(values: Column, test) -> Column:
    return F.get(F.filter(values, test), F.lit(0))


def pages_of(content: Column) -> Column:
    """The lines below each page mark, as page and line; what is before the first mark is dropped, and so is page 0."""
    mark = r"^\[PAGE (\d+)\]\s*$"

    def page(run: Column) -> Column:
        number = F.regexp_extract(F.get(run, F.lit(0)), mark, 1).try_cast("int")
        return let(number, lambda n: F.struct(n.alias("page"), F.transform(F.slice(run, F.lit(2), F.greatest(F.size(run) - 1, F.lit(0))), lambda x: F.struct(n.alias("page"), x.alias("line"))).alias("lines")))

    return let(all_lines(content), lambda lines: F.filter(F.transform(cut_at(lines, places(lines, lambda x: x.rlike(mark))), page), lambda p: p["page"] > 0))


def _unit(lines: Column, pages: Column, **fields) -> Column:
    """A unit of these lines (strings) with the fields named; others are null, false or empty."""
    start = {"heading_inferred": F.lit(False), "whole_document": F.lit(False), "subparts": F.array().cast("array<string>")}
    values = start | {k: v if isinstance(v, Column) else F.lit(v) for k, v in fields.items()} | {"lines": lines, "pages": pages}
    names = [x.split(":")[0] for x in _UNIT[7:-1].split(",")]
    return F.struct(*(values.get(n, F.lit(None)).alias(n) for n in names)).cast(_UNIT)


def _texts(run: Column, headed: bool) -> Column:
    """A run's lines without blanks at their ends; that of a heading without those before it too."""
    tail = lambda x: F.regexp_replace(x["line"], r"(?U)\s+$", "")
    return F.transform(run, (lambda x, i: F.when(i == 0, strip(x["line"])).otherwise(tail(x))) if headed else tail)


def _pages(run: Column) -> Column:
    return F.array_distinct(F.transform(run, lambda x: x["page"]))


def merged(units: Column, key) -> Column:
    """One unit for each key, in the order of the first: a heading that comes again goes on with its unit."""

    def one(mine: Column) -> Column:
        joined = {"lines": F.flatten(F.transform(mine, lambda u: u["lines"])), "pages": F.array_distinct(F.flatten(F.transform(mine, lambda u: u["pages"])))}
        first = F.get(mine, F.lit(0))
        return first.withField("lines", joined["lines"]).withField("pages", joined["pages"])

    return let(units, lambda us: F.transform(F.array_distinct(F.transform(us, key)), lambda k: let(F.filter(us, lambda u: key(u).eqNullSafe(k)), one)))


# ---- exercises

_MARK = "struct<i:int,exercise:string,points:string,part:string,part_points:string,topic:int>"


def marks_of(lines: Column) -> Column:
    """The lines that name an exercise, a part or a topic: place, and what their first fragment of each kind says."""
    kinds = f"{fixed.EXERCISE}|{fixed.PART}|الموضوع"

    def read(x: Column, i: Column) -> Column:
        def of(parts: Column) -> Column:
            kind = lambda f: _found(f, HEADING, 1)
            e, p = _first(parts, lambda f: kind(f) != fixed.PART), _first(parts, lambda f: kind(f) == fixed.PART)
            t = _first(parts, lambda f: f.rlike("(?U)" + fixed.TOPIC_MARK))
            topic = F.when(t.isNotNull(), F.least(_named(fixed.ORDINALS, F.regexp_extract(t, "(?U)" + fixed.TOPIC_MARK, 1)), F.lit(2)))
            return F.struct(i.alias("i"), _found(e, HEADING, 2).alias("exercise"), _found(e, HEADING, 3).alias("points"), _found(p, HEADING, 2).alias("part"), _found(p, HEADING, 3).alias("part_points"), topic.alias("topic")).cast(_MARK)

        return F.when(L.plain(x["line"]).rlike(kinds), let(fragments(x["line"]), of))

    return F.filter(F.transform(lines, read), lambda m: m["exercise"].isNotNull() | m["part"].isNotNull() | m["topic"].isNotNull())


def restarts(marks: Column, own: Column) -> Column:
    """The first mark of another topic after which the numbering begins anew: the next exercise isn't above the highest before. Null without one.

    Two scans over the marks: the highest number so far, and from the end the next one."""
    number = lambda m: _named(fixed.ORDINALS, m["exercise"])

    def pick(ms: Column) -> Column:
        numbers = F.transform(ms, number)
        highest = scan(numbers, F.lit(0), lambda s, n: F.greatest(s, F.coalesce(n, F.lit(0))), "int")
        upcoming = F.reverse(scan(F.reverse(numbers), F.lit(None), lambda s, n: F.coalesce(n, s), "int"))
        foreign = lambda z: z["m"]["topic"].isNotNull() & (z["m"]["topic"] != own) & (F.coalesce(z["next"], F.lit(1 << 30)) <= F.coalesce(z["before"], F.lit(0)))
        # a topic's own line counts on neither side
        z = F.transform(
            F.arrays_zip(ms.alias("m"), F.concat(F.array(F.lit(0)), highest).alias("before"), F.concat(F.slice(upcoming, F.lit(2), F.greatest(F.size(upcoming) - 1, F.lit(0))), F.array(F.lit(None).cast("int"))).alias("next")),
            lambda x: F.struct(x["m"].alias("m"), x["before"].alias("before"), x["next"].alias("next")),
        )
        return _first(z, lambda x: x["m"].isNotNull() & foreign(x))["m"]

    return F.when(F.size(marks) > 0, let(marks, pick))


_EVENT = "struct<here:boolean,part:string,part_points:double,i:int,opens:boolean,closes:boolean,sub:string,ord:string,points:double,source:string>"


def _events(marks: Column) -> Column:
    """What each mark does: a part with points, or outside an exercise, closes what is open and holds for what follows; a part without is one of the open exercise's; an
    exercise opens, with its own points or else the part's."""

    def step(s: Column, m: Column) -> Column:
        pts, own = _points(m["part_points"]), _points(m["points"])
        sub = m["part"].isNotNull() & pts.isNull() & s["here"]
        section, opens = m["part"].isNotNull() & ~sub, m["exercise"].isNotNull()
        name = F.concat(F.lit(fixed.PART + " "), m["part"])
        part, part_points = F.when(section, name).otherwise(s["part"]), F.when(section, pts).otherwise(s["part_points"])
        return F.struct(
            (opens | (s["here"] & ~section)).alias("here"), part.alias("part"), part_points.alias("part_points"), m["i"].alias("i"), opens.alias("opens"), section.alias("closes"), F.when(sub, name).alias("sub"),
            m["exercise"].alias("ord"), F.coalesce(own, part_points).alias("points"), F.when(own.isNotNull(), "heading").when(part_points.isNotNull(), "part").alias("source"),
        )

    return scan(marks, F.from_json(F.lit('{"here": false}'), _EVENT), step, _EVENT)


def exercises(pages: Column, sujet: Column, solution: Column) -> Column:
    """(units, notes) of pages_of() of a science subject."""

    def cut(lines: Column, events: Column, foreign: Column) -> Column:
        borders = F.filter(events, lambda e: e["opens"] | e["closes"])

        def of(bs: Column) -> Column:
            ends = F.transform(following(F.transform(bs, lambda b: b["i"])), lambda p: F.coalesce(p["next"], F.size(lines)))
            runs = F.zip_with(bs, ends, lambda b, end: F.struct(b.alias("b"), end.alias("end")))
            slice_ = lambda r: F.slice(lines, r["b"]["i"] + 1, r["end"] - r["b"]["i"])

            def unit(r: Column) -> Column:
                b = r["b"]
                subs = F.transform(F.filter(events, lambda e: e["sub"].isNotNull() & (e["i"] > b["i"]) & (e["i"] <= r["end"])), lambda e: e["sub"])
                return let(slice_(r), lambda run: _unit(_texts(run, True), _pages(run), part=b["part"], exercise_label=F.concat(F.lit("التمرين "), b["ord"]), exercise_index=_named(fixed.ORDINALS, b["ord"]), points=b["points"], points_source=b["source"], subparts=subs))

            found = merged(F.transform(F.filter(runs, lambda r: r["b"]["opens"]), unit), lambda u: F.struct(u["part"].alias("part"), u["exercise_index"].alias("index")))
            before = F.slice(lines, F.lit(1), F.coalesce(F.get(bs, F.lit(0))["i"], F.size(lines)))
            outside = F.concat(before, F.flatten(F.transform(F.filter(runs, lambda r: ~r["b"]["opens"]), lambda r: F.slice(lines, r["b"]["i"] + 2, r["end"] - r["b"]["i"] - 1))))
            return F.struct(F.coalesce(found, F.array().cast(_NONE)).alias("units"), F.filter(_texts(F.coalesce(outside, before), False), lambda x: strip(x) != "").alias("body"))

        return let(borders, lambda bs: let(of(bs), lambda f: finished(f["units"], f["body"], foreign)))

    def finished(units: Column, body: Column, foreign: Column) -> Column:
        first = F.get(units, F.lit(0))
        infer = F.coalesce((first["exercise_index"] != 1) & (F.length(F.array_join(body, "")) > LEAST_PREAMBLE), F.lit(False))
        inferred = _unit(body, F.array(F.get(pages, F.lit(0))["page"]), part=first["part"], exercise_label="التمرين الأول", exercise_index=1, heading_inferred=True)
        everything = F.flatten(F.transform(pages, lambda p: F.transform(p["lines"], lambda x: x["line"])))
        whole = _unit(everything, F.transform(pages, lambda p: p["page"]), whole_document=True)
        out = F.when(infer, F.array_prepend(units, inferred)).when((F.size(units) == 0) & solution & (F.size(pages) > 0), F.array(whole)).otherwise(units)
        notes = F.array_compact(F.array(F.when(foreign.isNotNull(), F.concat(F.lit("dropped content after topic "), foreign["topic"].cast("string"), F.lit(" at p"), foreign["page"].cast("string"))), F.when(infer, "inferred the first exercise")))
        return F.struct(out.alias("units"), notes.alias("notes"))

    def read(lines: Column) -> Column:
        def kept(marks: Column) -> Column:
            def within(m: Column) -> Column:
                foreign = F.when(m.isNotNull(), F.struct(m["topic"].alias("topic"), F.get(lines, m["i"])["page"].alias("page")))
                own = F.when(m.isNotNull(), F.slice(lines, F.lit(1), m["i"])).otherwise(lines)
                events = _events(F.filter(marks, lambda x: m.isNull() | (x["i"] < m["i"])))
                return let(own, lambda ls: let(events, lambda es: cut(ls, es, foreign)))

            return let(restarts(marks, sujet), within)

        return let(marks_of(lines), kept)

    return let(F.flatten(F.transform(pages, lambda p: p["lines"])), read)


# ---- sections

_EXPLORATION = r"(?=\b[Tt]ext\s+[Ee]xploration\b)"


def section_of(line: Column, subject: Column) -> Column:
    """The section that a line's first telling fragment opens: key and points."""

    def rule(f: Column, pattern: str, key: str) -> Column:
        # points belong to the last form of a heading only
        full = f"(?iU)^(?:{fixed.SECTION_LEAD}{pattern}(?:{fixed.SECTION_POINTS.replace('?P<pts>', '')})?)"
        return F.when(f.rlike(full), F.struct(F.lit(key).alias("key"), _points(_found(f, full, 1)).alias("points")))

    each = {s: (lambda f, rules=rules: F.coalesce(*(rule(f, p, k) for k, p in rules))) for s, rules in fixed.SECTION_RULES.items()}
    of = lambda f: reduce(lambda c, s: c.when(subject == s, each[s](f)), list(each)[1:], F.when(subject == next(iter(each)), each[next(iter(each))](f)))
    return _first(F.transform(fragments(line), of), lambda x: x.isNotNull())


def passage(lines: Column) -> Column:
    """Where a passage begins: the first long line that isn't numbered and has another long one among the next five. Null without one."""
    long_ = lambda x: F.length(strip(x)) >= PROSE
    near = lambda i: F.exists(F.slice(lines, i + 2, F.lit(NEXT_PROSE)), long_)
    return F.get(F.filter(F.transform(lines, lambda x, i: F.when(long_(x) & ~x.rlike(r"(?U)^\s*\d+[\.\)\-]") & near(i), i)), lambda i: i.isNotNull()), F.lit(0))


_SECTION_EVENT = "struct<here:string,i:int,opens:boolean,closes:boolean,points:double>"
_POPPED = f"struct<n:int,going:boolean,passage:{_UNIT},notes:array<string>>"


def sections(pages: Column, subject: Column, exam: Column) -> Column:
    """(units, notes) of pages_of() of a language subject."""
    name = lambda key: _named(fixed.SECTION_NAMES, key)
    text_unit = lambda lines, pages_: _unit(lines, pages_, section_key="text", section_label=fixed.SECTION_NAMES["text"], heading_inferred=True)
    # a key's line may have a heading in its middle
    parts = lambda x: F.transform(F.filter(F.split(x["line"], _EXPLORATION), lambda p: (strip(p) != "") | (strip(x["line"]) == "")), lambda p: F.struct(x["page"].alias("page"), p.alias("line")))
    lines_ = F.flatten(F.transform(pages, lambda p: p["lines"]))
    lines_ = let(lines_, lambda ls: F.when((subject == "english") & ~exam, F.flatten(F.transform(ls, parts))).otherwise(ls))

    def step(s: Column, m: Column) -> Column:
        ends = m["key"] == "questions"  # ends the passage, and is no section
        closes = ends & F.coalesce(s["here"] == "text", F.lit(False))
        opens = ~ends & ~m["key"].eqNullSafe(s["here"])
        here = F.when(closes, F.lit(None).cast("string")).when(ends, s["here"]).otherwise(m["key"])
        return F.struct(here.alias("here"), m["i"].alias("i"), opens.alias("opens"), closes.alias("closes"), m["points"].alias("points"))

    def cut(lines: Column, marks: Column) -> Column:
        events = scan(marks, F.from_json(F.lit("{}"), _SECTION_EVENT), step, _SECTION_EVENT)
        questions = F.transform(F.filter(marks, lambda m: m["key"] == "questions"), lambda m: m["i"])
        left = lambda a, n, qs: F.filter(F.transform(F.slice(lines, a + 1, n), lambda x, k: F.when(~F.array_contains(qs, k + a), x)), lambda x: x.isNotNull())

        def of(bs: Column, qs: Column) -> Column:
            ends = F.transform(following(F.transform(bs, lambda b: b["i"])), lambda p: F.coalesce(p["next"], F.size(lines)))
            runs = F.zip_with(bs, ends, lambda b, end: F.struct(b.alias("b"), left(b["i"], end - b["i"], qs).alias("run")))
            unit = lambda r: _unit(_texts(r["run"], True), _pages(r["run"]), section_key=r["b"]["here"], section_label=name(r["b"]["here"]), points=r["b"]["points"])
            before = left(F.lit(0), F.coalesce(F.get(bs, F.lit(0))["i"], F.size(lines)), qs)
            outside = F.concat(before, F.coalesce(F.flatten(F.transform(F.filter(runs, lambda r: r["b"]["closes"]), lambda r: r["run"])), F.array().cast(f"array<{_LINE}>")))
            found = F.coalesce(F.transform(F.filter(runs, lambda r: r["b"]["opens"]), unit), F.array().cast(_NONE))
            return F.struct(found.alias("units"), _texts(outside, False).alias("outside"))

        found = let(F.filter(events, lambda e: e["opens"] | e["closes"]), lambda bs: let(questions, lambda qs: of(bs, qs)))
        return let(found, lambda f: let(without_foreign(f["units"]), lambda w: finished(w["units"], f["outside"], w["notes"])))

    def without_foreign(units: Column) -> Column:
        """Late sections before a primary one are the end of the other topic; the passage may be in them."""
        key = lambda u: u["section_key"]

        def pop(s: Column, x: Column) -> Column:
            u, rest = x["u"], F.slice(units, x["k"] + 2, F.greatest(F.size(units) - x["k"] - 1, F.lit(0)))
            drops = s["going"] & exam & key(u).isin(*fixed.LATE_SECTIONS) & F.exists(rest, lambda r: key(r).isin(*fixed.PRIMARY_SECTIONS))
            start = F.when(~F.exists(rest, lambda r: key(r) == "text"), passage(u["lines"]))

            def done(at: Column) -> Column:
                got = drops & at.isNotNull()
                recovered = text_unit(F.slice(u["lines"], at + 1, F.size(u["lines"]) - at), u["pages"])
                note = F.array_compact(F.array(F.concat(F.lit("dropped leading "), key(u)), F.when(got, "recovered the passage")))
                return F.struct(F.when(drops, s["n"] + 1).otherwise(s["n"]).alias("n"), (drops & ~got).alias("going"), F.when(got, recovered).otherwise(s["passage"]).alias("passage"), F.when(drops, F.concat(s["notes"], note)).otherwise(s["notes"]).alias("notes"))

            return let(start, done)

        start = F.struct(F.lit(0).alias("n"), F.lit(True).alias("going"), F.lit(None).cast(_UNIT).alias("passage"), F.array().cast("array<string>").alias("notes")).cast(_POPPED)
        popped = F.get(F.reverse(scan(F.transform(units, lambda u, k: F.struct(u.alias("u"), k.alias("k"))), start, pop, _POPPED)), F.lit(0))
        kept = lambda p: F.slice(units, p["n"] + 1, F.greatest(F.size(units) - p["n"], F.lit(0)))
        out = let(F.coalesce(popped, start), lambda p: F.struct(merged(F.when(p["passage"].isNotNull(), F.array_prepend(kept(p), p["passage"])).otherwise(kept(p)), key).alias("units"), p["notes"].alias("notes")))
        return out

    def finished(units: Column, outside: Column, notes: Column) -> Column:
        body = F.filter(outside, lambda x: ~strip(x).rlike("(?U)" + fixed.HEADER_LINE))
        lacks = subject.isin("arabe", "francais") & exam & (F.size(units) > 0) & ~F.exists(units, lambda u: u["section_key"] == "text")
        whole = _unit(F.flatten(F.transform(pages, lambda p: F.transform(p["lines"], lambda x: x["line"]))), F.transform(pages, lambda p: p["page"]), section_key="whole", section_label="whole document", whole_document=True)
        first = F.array(F.get(pages, F.lit(0))["page"])
        out = let(body, lambda b: F.when(lacks & (F.length(F.array_join(b, "")) > LEAST_PREAMBLE), F.array_prepend(units, text_unit(b, first))).when((F.size(units) == 0) & (F.size(pages) > 0), F.array(whole)).otherwise(units))
        return F.struct(out.alias("units"), notes.alias("notes"))

    def read(lines: Column) -> Column:
        def mark(x: Column, i: Column) -> Column:
            return let(section_of(x["line"], subject), lambda f: F.when(f.isNotNull(), F.struct(i.alias("i"), f["key"].alias("key"), f["points"].alias("points"))))

        return let(F.filter(F.transform(lines, mark), lambda m: m.isNotNull()), lambda marks: cut(lines, marks))

    return let(lines_, read)


def segmented(texts: DataFrame, skipped=SKIPPED_PAGES) -> DataFrame:
    """The units of texts(stem, content). A text without content or pages, and one whose name has another form or is a combined file's, gives none."""
    name = lambda k: _found(F.col("stem"), fixed.STEM, k)
    own = texts.filter(F.col("stem").rlike(fixed.STEM) & F.col("content").isNotNull()).select(
        "stem", name(1).alias("subject"), name(2).cast("int").alias("year"), name(3).cast("int").alias("sujet"), name(5).cast("int").alias("session"), F.when(name(4).isNotNull(), "solution").otherwise("exam").alias("doc_type"), pages_of(F.col("content")).alias("pages")
    )
    for s in sorted({s for s, _ in skipped}):
        stray = [page for stem, page in skipped if stem == s]
        own = own.withColumn("pages", F.when(F.col("stem") == s, F.filter("pages", lambda p: ~p["page"].isin(stray))).otherwise(F.col("pages")))  # noqa: B023  used at once
    language, exam = F.col("subject").isin(*fixed.SECTION_RULES), F.col("doc_type") == "exam"
    science = own.filter(~language).withColumn("found", exercises(F.col("pages"), F.col("sujet"), ~exam))
    spoken = own.filter(language).withColumn("found", sections(F.col("pages"), F.col("subject"), exam))
    # an outer generator is not pushed through, so what was found is worked out once
    each = science.unionByName(spoken).select("stem", "subject", "year", "sujet", "session", "doc_type", F.col("found.notes").alias("notes"), F.posexplode("found.units").alias("k", "u"))
    ix = F.col("k") + 1
    text = F.regexp_replace(strip(F.array_join("u.lines", "\n")), r"\n{3,}", "\n\n")
    made = each.select("*", ix.alias("ix"), F.concat(F.col("stem"), F.when(F.col("subject").isin(*fixed.SECTION_RULES), "__s").otherwise("__ex"), ix.cast("string")).alias("id"), text.alias("text"))
    return made.select(
        "id", "stem", "subject", "year", "sujet", "session", "doc_type", "ix", "u.part", "u.exercise_label", "u.exercise_index", "u.section_key", "u.section_label", "u.points", "u.points_source", "u.pages", "text",
        F.regexp_extract_all("text", F.lit(f"({fixed.FIGURE_MARK})"), F.lit(1)).alias("figures"), L.items(F.col("text"), F.col("subject") == "english").alias("items"), F.when(F.size("u.subparts") > 0, F.col("u.subparts")).alias("subparts"),
        "u.heading_inferred", "u.whole_document", "notes",
    )


def with_captions(units: DataFrame, captions: DataFrame) -> DataFrame:
    """units with the captions(stem, page_num, caption_file, content_type) of their pages, in page order; full pages of text are none."""
    own = captions.filter(~F.col("content_type").eqNullSafe("full_page_text")).select("stem", F.col("page_num").alias("page"), "caption_file")
    at = units.select("id", "stem", F.posexplode("pages").alias("at", "page")).join(own, ["stem", "page"])
    listed = at.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "caption_file"))), lambda x: x["caption_file"]).alias("captions"))
    return units.join(listed, "id", "left").withColumn("captions", F.coalesce("captions", F.array().cast("array<string>")))


def report(units: DataFrame) -> DataFrame:
    """By subject and type: files, units, exams' units without points, whole documents, and how many texts have which sections or number of units."""
    files = units.groupBy("subject", "doc_type", "stem").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("points").isNull() & (F.col("doc_type") == "exam")).alias("unpriced"),
        F.bool_or("whole_document").alias("whole"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ix", "section_key"))), lambda x: x["section_key"]), "+").alias("keys"),
    )
    shape = F.when(F.col("keys") != "", F.col("keys")).otherwise(F.col("n").cast("string"))
    return files.groupBy("subject", "doc_type", shape.alias("shape")).agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("units"), F.sum("unpriced").alias("points_missing"), F.count_if("whole").alias("whole_documents"))


def sanity(units: DataFrame, total: float = 20.0) -> DataFrame:
    """(stem, points_off, n_exam, n_solution): exams whose points don't sum up, and those with another number of units than their key."""
    base = F.replace("stem", F.lit("_solution"), F.lit(""))
    by = units.groupBy(base.alias("stem")).agg(
        F.sum(F.when(F.col("doc_type") == "exam", F.coalesce("points", F.lit(0.0)))).alias("points"),
        F.count_if(F.col("doc_type") == "exam").alias("n_exam"),
        F.count_if(F.col("doc_type") == "solution").alias("n_solution"),
    )
    off = F.coalesce(F.col("points") != total, F.lit(False))
    return by.filter(off | ((F.col("n_solution") > 0) & (F.col("n_exam") != F.col("n_solution")))).select("stem", off.alias("points_off"), "n_exam", "n_solution")
