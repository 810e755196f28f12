"""The stream of changes against the batch plan, scan by scan, with restarts."""

import random

from pyspark.sql import functions as F

from papyrion.operators import incremental
from papyrion.streaming import changes


def test_stream_equals_plan(spark, tmp_path):
    rng = random.Random(3)
    scans, out, checkpoint = str(tmp_path / "scans"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    listings = [{f"f{i}": rng.choice("ab") for i in range(12) if rng.random() < 0.7} for _ in range(6)]
    listings[3] = {}
    time = lambda k: f"2024-01-{k + 1:02d} 00:00:00"

    def write(batch, number):
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    frame = lambda rows: spark.createDataFrame(list(rows.items()), "file_key string, hash string")
    for upto in (2, 3, 4, 6):  # the query ends and starts anew between these
        for k in range({2: 0, 3: 2, 4: 3, 6: 4}[upto], upto):
            changes.add_scan(frame(listings[k]), scans, time(k))
        changes.follow(spark, scans, checkpoint, write).awaitTermination()
        got = spark.read.parquet(out).select("file_key", "status", F.date_format("scan", "yyyy-MM-dd HH:mm:ss").alias("scan"))
        got = sorted((r["scan"], r["file_key"], r["status"]) for r in got.collect())
        want, state = [], {}
        for k in range(upto):
            planned = incremental.plan(frame(listings[k]), frame(state)).collect()
            want += [(time(k), r["file_key"], r["status"]) for r in planned]
            state = listings[k]
        assert got == sorted(want)


def test_many_files_share_a_key_of_the_state(spark, tmp_path, monkeypatch):
    """Calls to the state follow the buckets, not the files; each scan is one batch of several files."""
    monkeypatch.setattr(changes, "BUCKETS", 3)
    first, second = ({f"f{i}": str(i % a) for i in range(400) if i % b} for a, b in ((5, 3), (4, 7)))
    frame = lambda rows: spark.createDataFrame(list(rows.items()), "file_key string, hash string")
    scans, batches = str(tmp_path / "scans"), {}
    for k, rows in enumerate((first, second), 1):
        changes.add_scan(frame(rows), scans, f"2024-01-0{k} 00:00:00")
    assert len(list((tmp_path / "scans").glob("*.parquet"))) == 2 * changes.PARTS
    query = changes.follow(spark, scans, str(tmp_path / "checkpoint"), lambda batch, number: batches.__setitem__(number, batch.select("file_key", "status", F.dayofmonth("scan")).collect()))
    query.awaitTermination()
    got = sorted((r["file_key"], r["status"]) for rows in batches.values() for r in rows if r[2] == 2)
    assert got == sorted((r["file_key"], r["status"]) for r in incremental.plan(frame(second), frame(first)).collect())
    keys = [op.numRowsTotal for p in query.recentProgress for op in p.stateOperators]
    assert max(keys) <= 20  # two buckets' timers and values, where 500 files were each a key
