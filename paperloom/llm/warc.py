"""WARC archives: writing pages with revisits for equal payloads, and reading by boundary-chain verification.

Archives are uncompressed, so that one file is read by many tasks. Each task cuts its byte range at the record magic and
emits, for every candidate, the offset of its record and of the record's successor by the stated length. Chains are
followed inside the range first, which leaves one pointer from each candidate to the first offset beyond the range;
pointer jumping over those from the start of each file finds the ranges' true entries, and only candidates on the chain
from an entry are records. Magic inside a payload is on no chain.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import joined_small, new_path, staged, table

MAGIC, END = "WARC/1.1\r\n", "\r\n\r\n"
#: Payloads of so many bytes are stored once.
LEAST = 100
#: Offsets are joined within buckets of 2^16 bytes.
BUCKET_BITS = 16
_LENGTH = re.compile(rb"(?:^|\r\n)content-length:[ \t]*([0-9]{1,18})[ \t]*(?=\r\n)", re.I)


def with_firsts(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """pages(page_id, url, html) with payload, payload_bytes, payload_digest and refers_to: for all but the smallest page_id of equal payloads, that one."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2(F.col("payload").cast("binary"), 256)})
    groups = rows.filter(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = staged(groups.filter("n > 1 AND first IS NOT NULL").select("payload_digest", "first"), "warc-firsts")
    marked = joined_small(rows, firsts, ["payload_digest"], "left")
    return marked.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))).drop("first")


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for null; line ends in values are escaped."""
    safe = F.regexp_replace(F.regexp_replace(value.cast("string"), "\r", "%0D"), "\n", "%0A")
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def write(marked: DataFrame, path: str) -> None:
    """Writes the rows of with_firsts() as archives, one file a task, through Spark's own committer."""
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, "").otherwise(F.col("payload"))
    record = F.concat(
        F.lit(MAGIC),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(">"))),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _header("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        _header("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _header("Content-Type", F.when(~revisit, "text/html; charset=utf-8")),
        _header("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
        block,
    )
    marked.select(record.alias("value")).write.option("lineSep", END).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The files cut at the magic: (value, file, start of the range)."""
    rows = spark.read.option("lineSep", MAGIC).text(path)
    return rows.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def parse(piece: bytes) -> tuple[int, int, dict[bytes, bytes]] | None:
    """(bytes of the header, stated length, fields) of what follows a magic; None if it can't be a record."""
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return None
    found = _LENGTH.search(piece, 0, end + 2)
    if not found:
        return None
    fields = {}
    for line in piece[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    return end + 4, int(found[1]), fields


_CANDIDATE = (
    "file string, start long, seq long, at long, size long, next long, leaves long, whole boolean, n_bytes long, digest string, type string, id string, stated string, refers string"
)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every piece with its place in its range: at (bytes after the range's first piece), next (its successor's place, null if no record can start
    here), leaves (the first place beyond the range on its chain)."""
    size = len(MAGIC)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key, rows) -> pa.RecordBatch:
            known = {r[1] for r in rows}
            last = rows[-1][1] + rows[-1][2]
            leaves: dict[int, int] = {}
            for r in reversed(rows):
                if r[3] is not None:
                    to = r[3]
                    leaves[r[1]] = leaves.get(to, to if to >= last or to not in known else -1) if to < last else to
            cells = [(key[0], key[1], *r[:4], leaves.get(r[1], -1), *r[4:]) for r in rows]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*cells), [pa.string(), *[pa.int64()] * 6, pa.bool_(), pa.int64(), *[pa.string()] * 5])],
                names=[x.split()[0] for x in _CANDIDATE.split(", ")],
            )

        key, rows, at = None, [], 0
        for batch in batches:
            for value, file, start in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, start) != key:
                    if rows:
                        yield out(key, rows)
                    key, rows, at = (file, start), [], 0
                # a range's pieces follow a magic, but for what is before the first one of the file
                length, head = len(value) + size, None
                head = parse(value) if rows or start > 0 or at > 0 else None
                if head is None:
                    rows.append((len(rows), at, length, None, False, None, None, None, None, None, None))
                else:
                    body = value[head[0] : head[0] + head[1]]
                    whole = len(body) == head[1]
                    text = lambda k, f=head[2]: f[k].decode("utf-8", "replace") if k in f else None
                    rows.append(
                        (
                            len(rows), at, length, at + head[0] + head[1] + len(END) + size, whole, head[1], hashlib.sha256(body).hexdigest() if whole else None,
                            text(b"warc-type"), text(b"warc-record-id"), text(b"warc-payload-digest"), text(b"warc-refers-to"),
                        )
                    )
                at += length
        if rows:
            yield out(key, rows)

    return _pieces(spark, path).mapInArrow(run, _CANDIDATE)


def reachable(found: DataFrame) -> DataFrame:
    """The candidates on the chains from the files' starts, with base (the offset of their range)."""
    spark = found.sparkSession
    ranges = staged(found.groupBy("file", "start").agg(F.sum("size").alias("size")), "warc-ranges")
    # ranges of one file in order: few and narrow rows, whatever the records' size
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    bases = staged(ranges.select("file", "start", F.coalesce(F.sum("size").over(before), F.lit(0)).cast("long").alias("base")), "warc-bases")
    placed = found.join(bases, ["file", "start"])
    # the first piece of a file is what is before its first magic: its chain starts behind it
    entry = placed.filter("start = 0 AND seq = 0").select("file", F.col("size").alias("at"))
    jumps = staged(placed.filter("next IS NOT NULL AND leaves >= 0").select("file", (F.col("base") + F.col("at")).alias("at"), (F.col("base") + F.col("leaves")).alias("to")), "warc-jumps")
    entries, n = staged(entry, "warc-entries"), -1
    while n != (m := entries.count()):
        n = m
        moved = entries.join(jumps, ["file", "at"]).select("file", F.col("to").alias("at"))
        entries = staged(entries.union(moved).distinct(), "warc-entries")
        double = jumps.select("file", F.col("at").alias("from"), F.col("to").alias("at")).join(jumps, ["file", "at"], "left")
        jumps = staged(double.select("file", F.col("from").alias("at"), F.coalesce("to", "at").alias("to")), "warc-jumps")
    # from each entry along its range
    inside = placed.filter("next IS NOT NULL").select("file", "start", "seq", (F.col("base") + F.col("at")).alias("at"), (F.col("base") + F.col("next")).alias("next"))
    marked = inside.join(entries.withColumn("entry", F.lit(True)), ["file", "at"], "left").select("file", "start", "seq", "at", "next", F.coalesce("entry", F.lit(False)).alias("entry"))

    def follow(part: pa.Table) -> pa.Table:
        rows = sorted(zip(part.column("at").to_pylist(), part.column("next").to_pylist(), part.column("entry").to_pylist(), range(part.num_rows)))
        on: set[int] = set()
        keep = []
        for at, to, entry, i in rows:
            if entry or at in on:
                on.add(to)
                keep.append(i)
        return part.select(["file", "start", "seq"]).take(pa.array(keep, pa.int64()))

    true = marked.groupBy("file", "start").applyInArrow(follow, "file string, start long, seq long")
    return placed.join(true, ["file", "start", "seq"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """(type, id, url-independent fields) of every record: file, offset, type, id, stated digest, refers, n_bytes and digest of the payload read."""
    found = staged(candidates(spark, path), "warc-candidates")
    true = staged(reachable(found).withColumn("offset", F.col("base") + F.col("at") - len(MAGIC)), "warc-records")
    broken = true.filter("NOT whole")
    if not broken.take(1):
        return true
    # records with magic in their payload: their pieces are read again and put together
    spans = broken.select("file", F.col("offset").alias("lo"), (F.col("base") + F.col("next") - len(MAGIC)).alias("hi"))
    pieces = found.join(true.select("file", "start", "base").distinct(), ["file", "start"])
    # a piece meets the records that reach into its bucket of offsets only
    bucket = lambda c: F.shiftright(c, BUCKET_BITS)
    spans = spans.withColumn("bucket", F.explode(F.sequence(bucket(F.col("lo")), bucket(F.col("hi") - 1))))
    offset = F.col("base") + F.col("at") - len(MAGIC)
    placed = pieces.withColumn("offset", offset).withColumn("bucket", bucket(F.greatest("offset", F.lit(0))))
    owned = placed.join(spans, ["file", "bucket"]).filter("offset >= lo AND offset < hi").select("file", "start", "seq", "lo", "n_bytes")
    owned = staged(owned, "warc-pieces")

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, seq = None, 0
        for batch in batches:
            numbers = []
            for file, start in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                key, seq = ((file, start), 0) if (file, start) != key else (key, seq + 1)
                numbers.append(seq)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], names=["value", "file", "start", "seq"])

    values = _pieces(spark, path).mapInArrow(numbered, "value binary, file string, start long, seq long")
    mine = joined_small(values, owned.dropDuplicates(["file", "start", "seq"]), ["file", "start", "seq"], "inner")

    def whole(part: pa.Table) -> pa.Table:
        part = part.sort_by([("start", "ascending"), ("seq", "ascending")])
        data = MAGIC.encode().join(part.column("value").to_pylist())
        size, stated, _ = parse(data)
        body = data[size : size + stated]
        return pa.table({"file": part.column("file")[:1], "offset": part.column("lo")[:1], "_bytes": pa.array([len(body)]), "_digest": pa.array([hashlib.sha256(body).hexdigest()])})

    fixed = staged(mine.groupBy("file", "lo").applyInArrow(whole, "file string, offset long, _bytes long, _digest string"), "warc-fixed")
    return joined_small(true, fixed, ["file", "offset"], "left").withColumns({"n_bytes": F.coalesce("_bytes", "n_bytes"), "digest": F.coalesce("_digest", "digest")}).drop("_bytes", "_digest")


def _page(c: str) -> Column:
    return F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1).try_cast("long")


def resolved(records: DataFrame) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest (of the full payload; a revisit's is its response's), record_type, refers_to."""
    rows = records.select(_page("id").alias("page_id"), "n_bytes", "digest", F.col("type").alias("record_type"), _page("refers").alias("refers_to"), "stated")
    rows = staged(rows, "warc-rows")
    wanted = rows.filter("record_type = 'revisit'").select(F.col("refers_to").alias("page_id"), F.regexp_replace("stated", "^sha256:", "").alias("digest")).distinct()
    full = staged(rows.filter("record_type = 'response'").join(wanted, ["page_id", "digest"], "left_semi").groupBy("page_id", "digest").agg(F.max("n_bytes").alias("_bytes")), "warc-full")
    right = full.select(F.col("page_id").alias("_page"), F.concat(F.lit("sha256:"), "digest").alias("stated"), "_bytes", F.col("digest").alias("_digest"))
    keyed = rows.withColumn("_page", F.col("refers_to"))
    out = joined_small(keyed, right, ["_page", "stated"], "left")
    revisit = F.col("record_type") == "revisit"
    return out.select(
        "page_id",
        F.when(revisit, F.col("_bytes")).otherwise(F.col("n_bytes")).cast("long").alias("payload_bytes"),
        F.when(revisit, F.col("_digest")).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes pages(page_id, url, html) as archives in the shared folder, reads them back, and returns a row per page.

    A null html is an empty payload; a null url has no header line; rows without page_id are written and read back without; of equal payloads
    rows with the smallest page_id are responses (all of them, if repeated), the others revisits. An empty table gives none.
    Other columns are ignored."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write(with_firsts(pages), path)
    return resolved(read(spark, path))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS NOT NULL AND first <> page_id THEN first END AS refers_to
FROM f
"""
