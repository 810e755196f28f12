"""Small files in folders that all machines share, through Hadoop's file systems."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, uri: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, uri: str) -> bool:
    path, files = _at(spark, uri)
    return files.exists(path)


def names(spark: SparkSession, uri: str) -> list[str]:
    """The names in a folder, sorted; none if there is no such folder."""
    path, files = _at(spark, uri)
    return sorted(f.getPath().getName() for f in files.listStatus(path)) if files.exists(path) else []


def delete(spark: SparkSession, uri: str) -> None:
    path, files = _at(spark, uri)
    files.delete(path, True)


def read_text(spark: SparkSession, uri: str) -> str | None:
    """The content of a small file, or None if there is none."""
    path, files = _at(spark, uri)
    if not files.exists(path):
        return None
    opened = files.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
    finally:
        opened.close()


def write_text(spark: SparkSession, uri: str, text: str) -> None:
    """Write a small file beside its place and move it there in one step, so readers see the old or the new content."""
    jvm = spark.sparkContext._jvm
    path, files = _at(spark, uri)
    files.mkdirs(path.getParent())
    beside = jvm.org.apache.hadoop.fs.Path(path.getParent(), f"_{uuid.uuid4().hex}")
    out = files.create(beside)
    out.write(text.encode())
    out.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(beside, path, how)
