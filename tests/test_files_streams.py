import json

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from paperloom.sources import files
from paperloom.streaming import incremental


def test_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.pdf").write_bytes(b"%PDF-1.4")
    (tmp_path / "b.pdf").write_bytes(b"")
    (tmp_path / "c.PDF").write_bytes(b"text")
    (tmp_path / "n.txt").write_text("one\ntwo")
    (tmp_path / "a b+c.txt").write_text("")
    got = {r["filename"]: (r["size_bytes"], r["valid_pdf"]) for r in files.catalogued(spark, str(tmp_path)).collect()}
    assert got == {"a.pdf": (8, True), "b.pdf": (0, False), "c.PDF": (4, False), "n.txt": (7, None), "a b+c.txt": (0, None)}
    assert sorted(tuple(r) for r in files.texts(spark, str(tmp_path)).collect()) == [("a b+c", ""), ("n", "one\ntwo")]
    assert files.catalogued(spark, str(tmp_path / "missing")).count() == files.texts(spark, str(tmp_path / "missing")).count() == 0


def test_json(spark, tmp_path):
    rows, entries, bad = tmp_path / "rows.json", tmp_path / "entries.json", tmp_path / "lines.jsonl"
    rows.write_text(json.dumps([{"n": 1}, {"n": 2}]))
    entries.write_text(json.dumps({"a": {"n": 1}, "b": {"n": 2}}))
    bad.write_text('{"n": 1}\n{broken\n')
    assert sorted(r["n"] for r in files.json_rows(spark, str(rows), "n int", True).collect()) == [1, 2]
    assert [r["n"] for r in files.json_rows(spark, str(bad), "n int").collect()] == [1]
    assert sorted(tuple(r) for r in files.json_entries(spark, str(entries), StructType([StructField("n", IntegerType())])).collect()) == [("a", 1), ("b", 2)]
    assert files.json_rows(spark, str(tmp_path / "missing"), "n int").count() == 0
    out = str(tmp_path / "out")
    files.write_json(spark.createDataFrame([("x", 1), ("y", 2)], "s string, n int"), out, ["s"])
    assert files.json_rows(spark, out + "/s=x", "n int").count() == 1
    for _ in range(2):
        files.append_log(spark.createDataFrame([(1,)], "n int"), str(tmp_path / "log"))
    assert files.json_rows(spark, str(tmp_path / "log"), "n int").count() == 2


def test_resumed(spark, tmp_path):
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    run = lambda: incremental.resumed(incremental.arriving(spark, str(source), "n int"), lambda df: df.select((F.col("n") * 2).alias("m")), out, state).awaitTermination()
    (source / "1.json").write_text('{"n": 1}\n')
    run()
    (source / "2.json").write_text('{"n": 2}\n')
    run()
    run()
    assert sorted(r["m"] for r in spark.read.parquet(out).collect()) == [2, 4]


def test_windowed_counts(spark, tmp_path):
    (tmp_path / "1.json").write_text('{"ts": "2024-01-01T00:10:00Z", "k": "a"}\n{"ts": "2024-01-01T00:50:00Z", "k": "a"}\n{"ts": "2024-01-01T01:00:00Z", "k": "b"}\n')
    stream = incremental.arriving(spark, str(tmp_path), "ts timestamp, k string")
    got = incremental.completed(spark, incremental.windowed_counts(stream, "ts", ["k"]), "counts").collect()
    assert sorted((r["start"].hour, r["k"], r["n"]) for r in got) == [(0, "a", 2), (1, "b", 1)]
