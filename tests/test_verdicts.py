"""Verdicts over arriving events: the same last states in one batch and in many, retries, late events, states that are given up."""

import pytest
from pyspark.sql import functions as F

from paperloom.streaming import incremental, verdicts
from paperloom.plans import records

SCHEMA = "key string, at timestamp, seq long, stage string, verdict string"


def replayed(spark, folder, checkpoint, **options):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(folder)
    out, rows = verdicts.verdicts(stream, **options), []
    run = out.writeStream.outputMode("update").foreachBatch(lambda df, n: rows.extend((n, *r) for r in df.collect())).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()
    return rows


def written(spark, events, folder, parts):
    """One file a part, in order of time; files are read in order of their age."""
    import os

    for i, part in enumerate(parts):
        events.filter(part).coalesce(1).write.mode("append").parquet(folder)
        for name in os.listdir(folder):
            path = os.path.join(folder, name)
            if name.startswith("part-") and os.path.getmtime(path) > 1_700_000_000 + 10 * len(parts):
                os.utime(path, (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))


@pytest.mark.parametrize("batches", [1, 6])
def test_replay_gives_the_states_of_the_batch_query(spark, tmp_path, batches):
    sf = "/root/testdata/sf0.001"
    stage = F.when(F.col("event_type") == "view", "reextract").when(F.col("event_type") == "click", "halves").when(F.col("event_type") == "purchase", "quarters").otherwise("reverify")
    verdict = F.element_at(F.array(*map(F.lit, ("FAITHFUL", "CORRUPTED", "IMPROVED", "ERROR"))), (F.col("event_id") % 4 + 1).cast("int"))
    events = spark.read.parquet(f"{sf}/events.parquet").select(F.col("user_id").cast("string").alias("key"), F.date_trunc("millisecond", "ts").alias("at"), F.col("event_id").alias("seq"), stage.alias("stage"), verdict.alias("verdict"))
    cuts = [r[0] for r in events.select(F.expr(f"inline(transform(percentile_approx(unix_millis(at), array({', '.join(str(k / batches) for k in range(1, batches))} )), x -> struct(x)))")).collect()] if batches > 1 else []
    edges = [-1, *cuts, 1 << 60]
    written(spark, events, str(tmp_path / "in"), [f"unix_millis(at) > {a} AND unix_millis(at) <= {b}" for a, b in zip(edges, edges[1:])])
    rows = replayed(spark, str(tmp_path / "in"), str(tmp_path / "state"), forget="36500 days", retry="36500 days")
    assert len({n for n, *_ in rows}) >= batches
    last = {}
    for n, key, status, at, seq, errors, action in sorted(rows, key=lambda r: r[0]):
        assert action == "STATE"
        last[key] = status
    want = {str(r["key"]): r["status"] for r in records.fix_cascade(spark, sf).collect()}
    assert {k: s for k, s in last.items() if k in want} == want


def test_retries_late_events_and_forgetting(spark, tmp_path):
    import datetime as dt

    t = lambda minutes: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)
    rows = [
        [("a", t(0), 1, "halves", "IMPROVED"), ("b", t(0), 1, "halves", "ERROR"), ("c", t(1), 1, "reextract", "FAITHFUL")],
        [("z", t(300), 9, "reverify", "CORRUPTED")],
        [("y", t(300), 9, "reverify", "CORRUPTED")],
        [("b", t(301), 2, "halves", "FAITHFUL"), ("a", t(295), 2, "quarters", "FAITHFUL"), ("a", t(280), 3, "halves", "CORRUPTED")],
        [("z", t(9_000), 10, "reverify", "FAITHFUL")],
        [("z", t(9_001), 11, "reverify", "FAITHFUL")],
    ]
    folder = str(tmp_path / "in")
    frame = spark.createDataFrame([(*r, i) for i, part in enumerate(rows) for r in part], SCHEMA + ", part int")
    written(spark, frame, folder, [f"part = {i}" for i in range(len(rows))])
    got = replayed(spark, folder, str(tmp_path / "state"), late="10 minutes", retry="60 minutes", forget="2 days", most=2)
    by = {}
    for n, key, status, at, seq, errors, action in sorted(got, key=lambda r: r[0]):
        by.setdefault(key, []).append((action, status, errors))
    assert by["c"] == [("STATE", "FIXED_VERIFIED", 0), ("FORGOTTEN", "FIXED_VERIFIED", 0)]
    assert by["b"][0] == ("STATE", "CORRUPTED", 1) and ("RETRY", "CORRUPTED", 2) in by["b"] and by["b"][-2:] == [("STATE", "FIXED_VERIFIED", 0), ("FORGOTTEN", "FIXED_VERIFIED", 0)]
    assert by["a"][:2] == [("STATE", "PARTIAL_IMPROVED", 0), ("STATE", "FIXED_VERIFIED", 0)]
    assert by["z"][-1][1] == "CORRUPTED" and incremental.work_dir(spark, "x")
