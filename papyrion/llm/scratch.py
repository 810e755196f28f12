"""Intermediate tables in the folder that a cluster's machines share.

Iterative jobs cut their lineage by writing a table and reading it back.  The
folder is ``spark.checkpoint.dir``; where a session on one machine has none
(tests), one temporary folder is made and set for the whole session.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from papyrion.session import set_checkpoint_folder, ship_package


class Scratch:
    """Tables of one job.  A table lives until ``drop`` or the end of the folder."""

    def __init__(self, spark: SparkSession, job: str):
        ship_package(spark)
        self.spark = spark
        self.folder = f"{set_checkpoint_folder(spark)}/papyrion-{job}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and return a reader of the written rows."""
        df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def _in_hadoop(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def write_bytes(self, data: bytes, name: str) -> str:
        """Write a small file and return its URI."""
        path, files = self._in_hadoop(name)
        out = files.create(path)
        out.write(data)
        out.close()
        return self.path(name)

    def drop(self, name: str) -> None:
        """Delete a table that no returned DataFrame reads any more."""
        path, files = self._in_hadoop(name)
        files.delete(path, True)

    def drop_all_but(self, *names: str) -> None:
        """Delete the job's tables that no returned DataFrame reads any more."""
        path, files = self._in_hadoop("")
        for found in files.listStatus(path):
            if found.getPath().getName() not in names:
                files.delete(found.getPath(), True)
