"""A session with the settings that this library expects."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])


def set_checkpoint_folder(spark: SparkSession) -> str:
    """The folder that all machines share for intermediate tables, from ``spark.checkpoint.dir``.

    A session on one machine that has none gets a temporary one.
    """
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("papyrion.scratch.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        folder = "file://" + tempfile.mkdtemp(prefix="papyrion-")
        spark.conf.set("papyrion.scratch.dir", folder)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_folder(spark: SparkSession, job: str) -> str:
    """The name of a new folder below the shared one."""
    return f"{set_checkpoint_folder(spark)}/papyrion-{job}-{uuid.uuid4().hex}"


def saved(df: DataFrame, job: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, for plans that use dear rows several times."""
    path = scratch_folder(df.sparkSession, job)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def session(app: str = "papyrion", master: str | None = None, shuffle_partitions: int | None = None, **settings: str) -> SparkSession:
    """UTC, ANSI mode and adaptive execution; anything else is Spark's default or the caller's."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    base = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    if shuffle_partitions:
        base["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in (base | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
