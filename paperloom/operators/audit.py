"""Audits of a corpus as one table of findings, and what is counted from it; states of pages, files and fixes.

A finding is (stem, subject, page_num, severity, tag, detail); page_num is null for a whole file. Every check is a column of the page's
or file's row, exploded once; only counts are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed
from ..functions import quality as Q
from ..functions import text as T

_KEYS = ("stem", "subject")


def _exploded(rows: DataFrame, tags: Column, severity: str, page: Column | None = None) -> DataFrame:
    number = F.lit(None).cast("int") if page is None else page
    each = rows.select(*_KEYS, number.cast("int").alias("page_num"), F.explode(tags).alias("t"))
    return each.select(*_KEYS, "page_num", F.lit(severity).alias("severity"), "t.tag", "t.detail")


def findings(files: DataFrame, texts: DataFrame, pages: DataFrame) -> DataFrame:
    """All findings for files(stem, subject, type, n_pages): texts(stem, content) are what was extracted, pages(stem, page_num, text) its pages.

    A file without text or with an empty one has that finding only. n_pages null or below 1 means that the file couldn't be read."""
    joined = files.join(texts, "stem", "left")
    state = joined.select(*_KEYS, "type", "n_pages", "content")
    absent = Q.found((F.col("content").isNull(), "MISSING_TXT", None), (F.col("content") == "", "EMPTY_TXT", None))
    there = state.filter("content IS NOT NULL AND content <> ''")
    counted = pages.groupBy("stem").agg(F.count(F.lit(1)).alias("n"), F.sum(Q.length(F.col("text"))).alias("chars"))
    shape = there.join(counted, "stem", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    counts = Q.found(
        (F.coalesce("n_pages", F.lit(-1)) <= 0, "PDF_UNREADABLE", F.col("n_pages")),
        ((F.col("n_pages") > 0) & (F.col("n_pages") != F.col("n")), "PAGE_COUNT_MISMATCH", F.concat_ws("/", "n_pages", "n")),
    )
    expected = there.select(*_KEYS, F.explode(F.sequence(F.lit(1), F.greatest(F.coalesce("n_pages", F.lit(1)), F.lit(1)))).alias("page_num"))
    each = expected.join(pages.select("stem", "page_num", "text"), ["stem", "page_num"], "left").withColumn("n", F.coalesce(Q.length(F.col("text")), F.lit(0)))
    mean = each.groupBy("stem").agg(F.avg("n").alias("mean"))
    short = Q.found((F.col("n") == 0, "EMPTY_PAGE", None), (F.col("n").between(1, 29), "SHORT_PAGE", F.col("n")))
    low = Q.found(((F.col("mean") > 200) & (F.col("n") < 20), "LOW_RELATIVE_PAGE", F.col("n")))
    own = pages.join(files.select(*_KEYS), "stem").join(there.select("stem"), "stem", "left_semi")
    parts = [
        _exploded(state, absent, "issue"),
        _exploded(shape, counts, "issue"),
        _exploded(each, short, "issue", F.col("page_num")),
        _exploded(each.join(mean, "stem"), low, "warning", F.col("page_num")),
        _exploded(own, Q.page_issues(F.col("text"), F.col("subject")), "issue", F.col("page_num")),
        _exploded(there, Q.file_issues(F.col("content")), "issue"),
        _exploded(there, Q.file_warnings(F.col("content"), F.col("subject"), F.col("type")), "warning"),
    ]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def passed(files: DataFrame, found: DataFrame) -> DataFrame:
    """files with n_issues, n_warnings and pass: a file without issues passes."""
    n = found.groupBy("stem").agg(F.count_if(F.col("severity") == "issue").alias("n_issues"), F.count_if(F.col("severity") == "warning").alias("n_warnings"))
    joined = files.join(n, "stem", "left").fillna(0, ["n_issues", "n_warnings"])
    return joined.withColumn("pass", F.col("n_issues") == 0)


def statistics(judged: DataFrame) -> DataFrame:
    """Of passed(): by subject, and over all with subject null, files that pass, have issues, have warnings only."""
    outcome = judged.select("subject", "pass", (F.col("pass") & (F.col("n_warnings") > 0)).alias("_w"))
    return outcome.rollup("subject").agg(F.count(F.lit(1)).alias("total"), F.count_if("pass").alias("n_pass"), F.count_if(~F.col("pass")).alias("n_issues"), F.count_if("_w").alias("n_warnings_only"))


def tag_counts(found: DataFrame) -> DataFrame:
    """(severity, tag, n, files), the most frequent first."""
    return found.groupBy("severity", "tag").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("stem").alias("files")).orderBy(F.desc("n"), "tag")


def rolled_up(checks: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """(name, severity, n) of named tables of bad cases; those without any are OK."""
    out = None
    for name, (severity, rows) in checks.items():
        one = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), F.when(F.col("n") > 0, severity).otherwise("OK").alias("severity"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def integrity(pages: DataFrame) -> DataFrame:
    """One row: files, pages, characters, and pages with each fault that no page should have; files whose pages don't run from 1 on."""
    faults = Q.integrity(F.col("text"))
    per_file = pages.groupBy("stem").agg(
        F.count(F.lit(1)).alias("n"), F.min("page_num").alias("lo"), F.max("page_num").alias("hi"), F.count_distinct("page_num").alias("d"),
        F.sum(F.length("text")).alias("chars"), *(F.count_if(c).alias(k) for k, c in faults.items()),
    )
    runs = (F.col("lo") == 1) & (F.col("hi") == F.col("n")) & (F.col("d") == F.col("n"))
    total = [F.sum(k).alias(k) for k in faults]
    return per_file.agg(F.count(F.lit(1)).alias("text_files"), F.sum("n").alias("text_pages"), F.sum("chars").alias("page_text_chars"), *total, F.count_if(~runs).alias("nonsequential_files"))


def key_differences(sides: dict[str, DataFrame], key: str) -> DataFrame:
    """(key, has_SIDE...) of keys that some side lacks: none if all have the same."""
    out = None
    for name, df in sides.items():
        one = df.select(key, F.lit(name).alias("_side"))
        out = one if out is None else out.unionByName(one)
    has = [F.bool_or(F.col("_side") == n).alias(f"has_{n}") for n in sides]
    grouped = out.groupBy(key).agg(*has)
    missing = F.lit(False)
    for n in sides:
        missing = missing | ~F.col(f"has_{n}")
    return grouped.filter(missing)


def image_problems(images: DataFrame, stems: DataFrame) -> DataFrame:
    """(filename, problem) of images(filename, size_bytes, magic): empty, no PNG by its first bytes, or of a name that fits no text."""
    own = images.withColumn("stem", F.nullif(F.regexp_extract("filename", fixed.IMAGE_NAME, 1), F.lit(""))).join(stems.select("stem").distinct().withColumn("_has", F.lit(True)), "stem", "left")
    problem = F.array_compact(
        F.array(F.when(F.col("size_bytes") == 0, "zero_size"), F.when((F.col("size_bytes") > 0) & (F.hex("magic") != "89504E47"), "bad_header"), F.when(F.col("_has").isNull(), "orphan"))
    )
    return own.select("filename", F.explode(problem).alias("problem"))


def caption_problems(captions: DataFrame, images: DataFrame) -> DataFrame:
    """(caption_file, problem) of captions(caption_file, image_file, description, stem, page_num): no JSON (all null), no such image, no description,
    a name or a page other than the image's."""
    from ..functions import names

    base = F.element_at(F.split("image_file", "/"), -1)
    there = images.select(F.col("filename").alias("_image"), F.lit(True).alias("_has")).dropDuplicates(["_image"])
    rows = captions.withColumn("_image", base).join(there, "_image", "left").withColumn("_i", names.image(base))
    readable = F.col("image_file").isNotNull()
    bare = lambda c: F.regexp_replace(c, r"\.[^.]*$", "")
    problem = F.array_compact(
        F.array(
            F.when(~readable, "bad_json"),
            F.when(readable & F.col("_has").isNull(), "broken_reference"),
            F.when(readable & (F.trim(F.coalesce("description", F.lit(""))) == ""), "empty_description"),
            F.when(readable & (bare(base) != bare(F.col("caption_file"))), "other_name"),
            F.when(readable & (~F.col("stem").eqNullSafe(F.col("_i.stem")) | ~F.col("page_num").eqNullSafe(F.col("_i.page_num"))), "other_page"),
        )
    )
    return rows.select("caption_file", F.explode(problem).alias("problem"))


def image_coverage(listed: DataFrame, found: DataFrame, most: int = 10) -> DataFrame:
    """By subject, and over all with subject null: images listed(subject, image_path), those found(image_path), those missing, and `most` names of these."""
    rows = listed.join(found.select("image_path").distinct().withColumn("_has", F.lit(True)), "image_path", "left")
    gone = F.when(F.col("_has").isNull() & F.col("image_path").isNotNull(), F.col("image_path"))
    by = rows.groupBy("subject").agg(F.count(F.lit(1)).alias("n"), F.count("_has").alias("on_disk"), F.count(gone).alias("missing"))
    first = rows.select("subject", gone.alias("p")).dropna(subset=["p"]).withColumn("r", F.row_number().over(Window.partitionBy("subject").orderBy("p"))).filter(F.col("r") <= most)
    sample = first.groupBy("subject").agg(F.array_sort(F.collect_list("p")).alias("sample"))
    total = by.agg(F.lit(None).cast("string").alias("subject"), F.sum("n").alias("n"), F.sum("on_disk").alias("on_disk"), F.sum("missing").alias("missing")).withColumn("sample", F.lit(None).cast("array<string>"))
    return by.join(sample, "subject", "left").unionByName(total)


def manifest_problems(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """(path, problem): files of a manifest(path) that aren't in files(path, size_bytes), are empty, or share their stem with another path."""
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    rows = manifest.select("path", stem.alias("stem")).join(files.select("path", "size_bytes"), "path", "left")
    twice = rows.groupBy("stem").agg(F.count_distinct("path").alias("n")).filter("n > 1").select("stem", F.lit(True).alias("_twice"))
    problem = F.array_compact(F.array(F.when(F.col("size_bytes").isNull(), "missing"), F.when(F.col("size_bytes") == 0, "zero_bytes"), F.when(F.col("_twice"), "duplicate_stem")))
    return rows.join(twice, "stem", "left").select("path", F.explode(problem).alias("problem")).distinct()


def invalid_pdfs(files: DataFrame) -> DataFrame:
    """(path, size_bytes, reason) of files(path, size_bytes, valid_pdf) that should be PDFs and aren't."""
    reason = F.when(F.col("size_bytes") == 0, "0-byte file").otherwise("not a PDF (magic bytes mismatch)")
    return files.filter(F.col("valid_pdf").isNotNull() & ((F.col("size_bytes") == 0) | ~F.col("valid_pdf"))).select("path", "size_bytes", reason.alias("reason"))


def fixed_page_regressions(fixed_keys: DataFrame, pages: DataFrame, backups: DataFrame, least: int = 80) -> DataFrame:
    """(key, problem) of pages once fixed: gone, too short, or less than half as long as before."""
    rows = fixed_keys.select("key").join(pages.select("key", F.col("text").alias("now")), "key", "left").join(backups.select("key", F.col("text").alias("was")), "key", "left")
    short = F.length("now") < least
    halved = (F.length("was") > 0) & (2 * F.length("now") < F.length("was"))
    problem = F.array_compact(F.array(F.when(F.col("now").isNull(), "missing"), F.when(short, "too_short"), F.when(halved, "shrunk")))
    return rows.select("key", F.explode(problem).alias("problem"))


# ---- states

BAD_VERDICTS = ("minor_issues", "major_issues", "reprocess")


def needs_work(local_issues: Column, verdict: Column, bad: tuple[str, ...] = BAD_VERDICTS) -> Column:
    return (F.size(local_issues) > 0) | F.coalesce(verdict.isin(*bad), F.lit(False))


def page_status(needs: Column, new_text: Column) -> Column:
    """pending for pages that need nothing, corrected where a text came back, else reprocess_failed."""
    return F.when(~needs, "pending").when(F.coalesce(new_text, F.lit("")) != "", "corrected").otherwise("reprocess_failed")


def file_states(files: DataFrame, pages: DataFrame) -> DataFrame:
    """files(stem, subject, has_text, has_pdf) with overall_verdict, final_status and corrections from pages(stem, needs, status)."""
    by = pages.groupBy("stem").agg(F.count_if(F.col("status") == "corrected").alias("corrections"), F.count_if(F.col("status") == "reprocess_failed").alias("failed"), F.count_if("needs").alias("problems"))
    rows = files.join(by, "stem", "left").fillna(0, ["corrections", "failed", "problems"])
    cases = [
        (~F.col("has_text"), "missing", "failed_missing_txt"),
        (~F.col("has_pdf"), "error", "failed_missing_pdf"),
        (F.col("failed") > 0, "partial_failure", "verified_with_failures"),
        ((F.col("problems") > 0) & (F.col("corrections") == 0), "issues_found", "verified_issues_uncorrected"),
        (F.col("corrections") > 0, "corrected", "verified_corrected"),
        (F.lit(True), "good", "verified_pass"),
    ]
    pick = lambda k: F.coalesce(*(F.when(c[0], c[k]) for c in cases))
    return rows.select("stem", "subject", pick(1).alias("overall_verdict"), pick(2).alias("final_status"), "corrections")


STATUSES = ("verified_pass", "verified_corrected", "verified_issues_uncorrected", "verified_with_failures")


def state_summary(states: DataFrame) -> DataFrame:
    """Files by subject, and over all with subject null, in each final status; statuses are compared whole."""
    status = F.col("final_status")
    known = [F.count_if(status == s).alias(s) for s in STATUSES]
    missing = F.contains(status, F.lit("missing"))
    return states.rollup("subject").agg(F.count(F.lit(1)).alias("total"), *known, F.count_if(missing).alias("missing"), F.count_if(~missing & ~status.isin(*STATUSES)).alias("error"))


def really_uncorrected(states: DataFrame, pages: DataFrame) -> DataFrame:
    """(stem) of files left uncorrected or with failures in which a page has a bad verdict, a local issue or failed: pages(stem, needs, status)."""
    real = pages.filter(F.col("needs") | (F.col("status") == "reprocess_failed")).select("stem").distinct()
    return states.filter(F.col("final_status").isin("verified_issues_uncorrected", "verified_with_failures")).select("stem").join(real, "stem", "left_semi")


#: What a stage of fixing makes of the state before it.
_FIXES = (
    ("reextract", "FAITHFUL", "FIXED_VERIFIED"), ("reextract", None, "UNRESOLVED"),
    ("halves", "FAITHFUL", "FIXED_VERIFIED"), ("halves", "IMPROVED", "PARTIAL_IMPROVED"), ("halves", None, "UNRESOLVED"),
    ("quarters", "FAITHFUL", "FIXED_VERIFIED"), ("quarters", None, "UNRESOLVED_FINAL"),
    ("reverify", "CORRUPTED", "CORRUPTED"),
)


def fix_states(events: DataFrame) -> DataFrame:
    """(key, status) after events(key, ts, stage, verdict): stages reextract, halves, quarters and reverify, in order of time. A reverification demotes what it finds
    corrupted and changes nothing else; errors change nothing. The events of a key are few and folded in its row."""
    listed = events.filter("verdict IS DISTINCT FROM 'ERROR'").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("ts", "stage", "verdict"))).alias("e"))

    def step(state: Column, e: Column) -> Column:
        out = None
        for stage, verdict, to in _FIXES:
            here = (e["stage"] == stage) & (F.lit(True) if verdict is None else F.coalesce(e["verdict"] == verdict, F.lit(False)))
            out = F.when(here, to) if out is None else out.when(here, to)
        return out.otherwise(state)

    return listed.select("key", F.aggregate("e", F.lit("CORRUPTED"), step).alias("status"))


def retriable(checkpoint: DataFrame, status: str = "status") -> DataFrame:
    """A checkpoint without its errors, so that their keys are done again."""
    return checkpoint.filter(~F.col(status).eqNullSafe("ERROR"))


def rebuilt_methods(files: DataFrame, pages: DataFrame, last_scanned: int = 2014, least: int = 50) -> DataFrame:
    """(stem, year, page_count, total_chars, method_breakdown) of files(stem, year, has_report), from pages(stem, page_num, n_chars, reprocessed): by which method each page was most likely
    read. Scanned years and pages that were read anew or have next to no text went through the model; without a report the file's year and text decide
    for all pages. Files without report and pages are left out."""
    sums = pages.groupBy("stem").agg(F.sum("n_chars").alias("total_chars"), F.count(F.lit(1)).alias("page_count"))
    rows = pages.join(files, "stem").join(sums.select("stem", "total_chars"), "stem")
    scanned = F.coalesce(F.col("year") <= last_scanned, F.lit(False))
    alone = F.when(scanned | (F.col("total_chars") == 0), "gemini").otherwise("pdfplumber")
    method = F.when(~F.col("has_report"), alone).when(scanned | F.coalesce("reprocessed", F.lit(False)) | (F.coalesce("n_chars", F.lit(0)) <= least), "gemini").otherwise("pdfplumber")
    counted = rows.groupBy("stem", method.alias("method")).agg(F.count(F.lit(1)).alias("n"))
    maps = counted.groupBy("stem").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("method", "n")))).alias("method_breakdown"))
    return files.join(sums, "stem", "left").join(maps, "stem", "left").filter("has_report OR page_count IS NOT NULL").select("stem", "year", F.coalesce("page_count", F.lit(0)).alias("page_count"), F.coalesce("total_chars", F.lit(0)).alias("total_chars"), "method_breakdown")


def method_totals(files: DataFrame) -> DataFrame:
    """(method, n) over all files' maps."""
    return files.select(F.explode("method_breakdown").alias("method", "n")).groupBy("method").agg(F.sum("n").alias("n"))


def within_guard(n_chars: Column, n_pages: Column) -> Column:
    """Mean characters of a page, whole."""
    return F.floor(n_chars / F.greatest(n_pages, F.lit(1))).cast("long")


def disputed_pages(pages: DataFrame) -> DataFrame:
    """Pages whose text is garbled: pages(stem, subject, page_num, text) with the share of suspicious lines and the digit runs that may be turned."""
    return pages.select("stem", "subject", "page_num", Q.suspicious_share(F.col("text")).alias("share"), F.size(Q.digit_runs(F.col("text"))).alias("n_runs"), T.arabic_density(F.col("text")).alias("density")).filter("share > 0.6 OR n_runs > 0")
