"""What the findings of round 4 are about."""

from collections import Counter

import duckdb

import __spark_entry__ as entry
from paperloom.operators import figures


def test_overlapping_boxes_are_joined_by_runs(spark, monkeypatch, capsys):
    """A cell's right boxes are joined as runs, whatever their length, where each was compared with each left one; equal places, sides that only touch, boxes over many cells, nulls
    and no boxes at all. Cells aren't put together by their bytes (they came in one task)."""
    boxes = [(i % 2, i, float(i * 137 % 97), float(i * 71 % 89), float(i * 137 % 97 + 5), float(i * 71 % 89 + 4)) for i in range(300)]
    boxes += [(0, 1000 + i, 50.0, 50.0, 60.0, 60.0) for i in range(80)] + [(0, 2000 + i, 60.0, 50.0 + 10 * i, 70.0, 60.0 + 10 * i) for i in range(4)]
    boxes += [(1, 3000 + i, -30.0 - i, -250.0, 450.0, 210.0 + i) for i in range(4)] + [(0, 4000, None, 1.0, 2.0, 2.0), (0, 4003, 1.0, 1.0, None, 2.0), (None, 4001, 1.0, 1.0, 9.0, 9.0)]
    df = spark.createDataFrame(boxes, "page int, id int, x0 double, y0 double, x1 double, y1 double")
    left, right = df.filter("id % 4 < 2"), df.filter("id % 4 > 1")
    whole = [b for b in boxes if None not in b]
    pairs = Counter((a[0], a[1], b[1]) for a in whole if a[1] % 4 < 2 for b in whole if b[0] == a[0] and b[1] % 4 > 1 and a[2] < b[4] and b[2] < a[4] and a[3] < b[5] and b[3] < a[5])
    for run, cell in ((1, 200.0), (3, 64.0), (figures.RUN, 200.0), (1000, 200.0)):
        monkeypatch.setattr(figures, "RUN", run)
        assert Counter(map(tuple, figures.overlapping(left, right, ["page"], cell).collect())) == pairs
    assert figures.overlapping(left, right.limit(0), ["page"]).count() == figures.overlapping(left.limit(0), right, ["page"]).count() == 0
    found = figures.overlapping(left, right, ["page"])
    found.explain()
    assert "inline(_boxes" in capsys.readouterr().out
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1


def test_overlapping_boxes_are_those_of_sql(spark, tmp_path):
    """Many boxes in a few cells, more than a run holds."""
    rows = [(i, 97 * (i % 3), None if i % 50 == 0 else i * 7919 % 30011 / 100) for i in range(6_000)]
    spark.createDataFrame(rows, "event_id long, user_id long, value double").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
        told = db.execute(entry.oracle_sql()["overlapping_boxes"]).fetchall()
    assert told and Counter(map(tuple, entry.queries()["overlapping_boxes"](spark, str(tmp_path)).collect())) == Counter(told)
