"""Versioned tables under concurrent readers and writers; prefix scans over files of many ranges."""

import threading

import pytest
from pyspark.sql import functions as F

from paperloom.operators import overlay, sequences
from paperloom.sources import files
from paperloom.sources.versions import Conflict, Versions


def numbers(spark, n, k):
    return spark.range(n).select(F.col("id").alias("k"), F.lit(k).alias("v"))


def test_versions(spark, tmp_path):
    v = Versions(spark, str(tmp_path / "t"))
    assert v.version() == 0 and v.snapshot() == {} and v.history() == []
    assert v.commit({"a": numbers(spark, 3, 1), "b": numbers(spark, 3, 1)}, note="first") == 1
    assert v.commit({"a": v.read("a").withColumn("v", F.lit(2))}) == 2  # read from here, and the other table stays
    assert v.read("a").first()["v"] == 2 and v.read("a", 1).first()["v"] == 1 and v.read("b").first()["v"] == 1
    with pytest.raises(Conflict):
        v.commit({"b": numbers(spark, 1, 3)}, since=1)
    assert v.version() == 2 and [(e["version"], e["changed"], e["note"]) for e in v.history()] == [(1, ["a", "b"], "first"), (2, ["a"], "")]
    gone = v.sweep(keep=1, older=0)
    assert len(gone) == 2 and v.read("b").count() == v.read("a").count() == 3  # version 1's a, and b of the writer that failed


def test_of_writers_that_began_together_one_commits(spark, tmp_path):
    v = Versions(spark, str(tmp_path / "t"))
    v.commit({"a": numbers(spark, 1, 0)})
    done = []

    def write(k):
        try:
            done.append(v.commit({"a": numbers(spark, 1, k)}, since=1))
        except Conflict:
            done.append(None)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(done, key=str) == [2, None, None, None] and v.version() == 2


def test_readers_meet_whole_versions_only(spark, tmp_path):
    v = Versions(spark, str(tmp_path / "t"))
    v.commit({"a": numbers(spark, 5, 1), "b": numbers(spark, 5, 1)})
    stop, seen, wrong = threading.Event(), set(), []

    def read():
        while not stop.is_set():
            try:
                now = v.snapshot()
                values = {(n, r["v"]) for n, df in now.items() for r in df.collect()}
                seen.add(max(x for _, x in values))
                if len({x for _, x in values}) != 1 or len(values) != 2:
                    wrong.append(values)
            except Exception as e:  # noqa: BLE001
                wrong.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    for k in range(2, 6):
        v.commit({"a": numbers(spark, 5, k), "b": numbers(spark, 5, k)})
    stop.set()
    reader.join()
    assert not wrong and len(seen) > 1


def test_keys_change_everywhere(spark):
    people, visits = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string"), spark.createDataFrame([(1, 2), (2, 2), (3, 1), (None, 1)], "who int, whom int")
    mapping = spark.createDataFrame([(1, 2), (2, 1)], "old int, new int")
    new, log = overlay.permuted_everywhere({"people": (people, ["id"]), "visits": (visits, ["who", "whom"])}, mapping)
    assert sorted((r["id"], r["name"]) for r in new["people"].collect()) == [(1, "b"), (2, "a"), (3, "c")]
    assert sorted((r["who"] or 0, r["whom"]) for r in new["visits"].collect()) == [(0, 2), (1, 1), (2, 1), (3, 2)]
    assert sorted(map(tuple, log.filter("`table` = 'visits' AND column = 'whom'").collect())) == [("visits", "whom", 1, 2, 2), ("visits", "whom", 2, 1, 2)]


@pytest.mark.parametrize("partitions", [1, 7, 50])
def test_carried_markers(spark, partitions):
    rows = [(u, i, (i * 7919) % 13 if (i * 31) % 17 == 0 else None) for u in ("long", "short", None) for i in range(2000 if u == "long" else 5)]
    got = sequences.carried(spark.createDataFrame(rows, "u string, i int, m int").repartition(3), "u", ["i"], "m", "c", partitions).collect()
    want, last = {}, {}
    for u, i, m in rows:
        last[u] = m if m is not None else last.get(u)
        want[u, i] = last[u]
    assert {(r["u"], r["i"]): r["c"] for r in got} == want and len(got) == len(rows)
    assert sequences.carried(spark.createDataFrame([], "u string, i int, m int"), "u", ["i"], "m").count() == 0


def test_pages_of_a_file_that_many_tasks_read(spark, tmp_path):
    lines, want, page = [], {}, None
    for i in range(40_000):
        if i % 1_111 == 500:
            page = i // 1_111 + 1
            lines.append(f"[PAGE {page}]")
        else:
            lines.append(f"line {i}")
            if page:
                want[f"line {i}"] = page
    (tmp_path / "book.txt").write_text("\n".join(lines))
    (tmp_path / "note.txt").write_text("no mark\nat all")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        read = files.lines(spark, str(tmp_path))
        assert read.rdd.getNumPartitions() > 10
        got = sequences.paged_lines(read, 9).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {r["line"]: r["page_num"] for r in got} == want and {r["stem"] for r in got} == {"book"}
    ordered = [r["line"] for r in sorted(got, key=lambda r: (r["block"], r["seq"]))]
    assert ordered == [x for x in lines if x in want]
