"""What changed in a folder, as a stream over its listings.

Each scan of a folder is a listing (file_key, hash, scan), appended to a table.
One stateful operator holds every file's last hash and the scan that saw it
last.  Files are kept in hash buckets: a bucket is one key, whose files are one
Arrow table in its state, so a batch costs a few calls to the state store for
each bucket and not for each file.  Rows of a scan come out as new, modified or
unchanged; a file that a scan does not list comes out as deleted, by a timer
that the watermark of the later scan sets off.  State and timers are in the
query's checkpoint, so a restarted query goes on where it was.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from papyrion.session import ship_package

SCANS = "file_key string, hash string, scan timestamp"
CHANGES = "file_key string, status string, scan timestamp"
#: Keys of the state.  Like the number of shuffle partitions it is fixed with a query's checkpoint.
BUCKETS = 4096
#: Files that each scan is written as; a batch takes so many, which is one scan.
PARTS = 16
_HELD = pa.schema([("file", pa.string()), ("hash", pa.string()), ("seen", pa.int64())])
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def add_scan(listing: DataFrame, path: str, scan: str) -> None:
    """Append a listing (file_key, hash, ...) as the scan of that time, which is later than all before.

    A listing without files is kept too, as one row without a file, so the
    files before it are found to be deleted.
    """
    at = F.lit(scan).cast("timestamp")
    part = F.pmod(F.xxhash64("file_key"), F.lit(PARTS)).cast("int")
    rows = listing.select("file_key", "hash", at.alias("scan"), part.alias("part"))
    none = F.lit(None).cast("string")
    # a mark in every part, so that a scan is always the same number of files
    marks = listing.sparkSession.range(PARTS).select(none.alias("file_key"), none.alias("hash"), at.alias("scan"), F.col("id").cast("int").alias("part"))
    rows.unionByName(marks).repartitionById(PARTS, F.col("part")).drop("part").write.option("maxRecordsPerFile", 0).mode("append").parquet(path)


class _Files(StatefulProcessor):
    """The files of a bucket, with last hash and scan (milliseconds); the timer of a scan is due when a later one has been seen."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "files binary")

    def _read(self) -> dict[str, tuple[str | None, int]]:
        if not self.held.exists():
            return {}
        with pa.ipc.open_stream(self.held.get()[0]) as r:
            files, hashes, seen = (c.to_pylist() for c in r.read_all().columns)
        return dict(zip(files, zip(hashes, seen)))

    def _write(self, held: dict[str, tuple[str | None, int]]) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if not held:
            self.held.clear()
            return
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, _HELD) as w:
            w.write_table(pa.table([list(held), [h for h, _ in held.values()], [t for _, t in held.values()]], schema=_HELD))
        self.held.update((out.getvalue().to_pybytes(),))
        self.handle.registerTimer(min(t for _, t in held.values()) + 1)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        out, now, held = [], timerValues.getCurrentWatermarkInMs(), self._read()
        given = [r for frame in rows for r in zip(frame["scan"].tolist(), (None if h is None or h != h else h for h in frame["hash"]), frame["file_key"].tolist())]
        for scan, hash_, file in sorted(given, key=lambda r: (r[0], r[1] is not None, r[1] or "")):
            at, last = int(scan.timestamp() * 1000), held.get(file)
            if last is not None and last[1] < now < at:  # it was missing in a scan whose timer has not run yet
                out.append((file, "deleted", pd.Timestamp(now, unit="ms")))
                last = None
            out.append((file, "new" if last is None else "unchanged" if last[0] == hash_ else "modified", scan))
            held[file] = (hash_, at)
        self._write(held)
        yield pd.DataFrame(out, columns=["file_key", "status", "scan"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, held = timerValues.getCurrentWatermarkInMs(), self._read()
        gone = [file for file, (_, seen) in held.items() if seen < now]
        self._write({file: last for file, last in held.items() if last[1] >= now})
        yield pd.DataFrame([(file, "deleted", pd.Timestamp(now, unit="ms")) for file in gone], columns=["file_key", "status", "scan"])

    def close(self) -> None:
        pass


def changes(scans: DataFrame) -> DataFrame:
    """(file_key, status, scan) of a stream of scans (file_key, hash, scan), one scan in a batch.

    The session has to keep state in RocksDB (``follow`` sees to it).  A row
    without a file only marks its scan.
    """
    ship_package(scans.sparkSession)
    named = scans.withColumn("file_key", F.coalesce("file_key", F.lit("")))
    marked = named.withColumn("bucket", F.pmod(F.xxhash64("file_key"), F.lit(BUCKETS))).withWatermark("scan", "0 seconds")
    found = marked.groupBy("bucket").transformWithStateInPandas(_Files(), CHANGES, outputMode="Append", timeMode="EventTime")
    return found.where("file_key <> ''")


def follow(spark: SparkSession, path: str, checkpoint: str, write: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Give the changes of all scans that were added to ``path`` since the last call to ``write``, a batch at a time."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        scans = spark.readStream.schema(SCANS).option("maxFilesPerTrigger", PARTS).parquet(path)
        return changes(scans).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(_PROVIDER, before)
