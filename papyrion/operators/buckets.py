"""Tables in hash buckets of a key, of which a change writes only the touched ones.

A table is a Parquet folder partitioned by ``bucket``, a hash of the key; the
number of buckets is fixed when the table is made.  Upserts and deletions read
and replace the buckets of the given keys (dynamic partition overwrite); other
files stay as they are.  Looking up a key reads its bucket only.  A bucket that
is large, for instance by one hot key, is written by several tasks.

A partition's new files are complete before its old ones go, and a change that
failed between two buckets can be repeated with the same outcome.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from papyrion.sources import shared

_LAYOUT = "_layout.json"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def _bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn("bucket", bucket_of(F.col(key), buckets)).hint("rebalance", "bucket")


def create(df: DataFrame, path: str, key: str, buckets: int = 64) -> None:
    """Write ``df`` as a new table; rows without a key share a bucket."""
    spark = df.sparkSession
    shared.write_text(spark, f"{path}/{_LAYOUT}", json.dumps({"key": key, "buckets": buckets, "schema": df.schema.jsonValue()}))
    _bucketed(df, key, buckets).write.mode("append").partitionBy("bucket").parquet(path)
    if not any(n.startswith("bucket=") for n in shared.names(spark, path)):  # so that plain readers find the columns
        df.limit(0).coalesce(1).write.parquet(f"{path}/bucket=0")


def is_table(spark: SparkSession, path: str) -> bool:
    return shared.exists(spark, f"{path}/{_LAYOUT}")


def _layout(spark: SparkSession, path: str) -> dict:
    text = shared.read_text(spark, f"{path}/{_LAYOUT}")
    if text is None:
        raise FileNotFoundError(f"no table at {path}")
    return json.loads(text)


def _read(spark: SparkSession, path: str) -> DataFrame:
    schema = StructType.fromJson(_layout(spark, path)["schema"]).add("bucket", IntegerType())
    return spark.read.schema(schema).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path).drop("bucket")


def lookup(spark: SparkSession, path: str, *keys) -> DataFrame:
    """The rows of the given key values; only their buckets are read."""
    layout = _layout(spark, path)
    wanted = [F.pmod(F.xxhash64(F.lit(k).cast("string")), F.lit(layout["buckets"])).cast("int") for k in keys]
    return _read(spark, path).where(F.col("bucket").isin(wanted) & F.col(layout["key"]).isin(*keys)).drop("bucket")


def append(df: DataFrame, path: str) -> None:
    """Add rows without looking for their keys."""
    layout = _layout(df.sparkSession, path)
    _bucketed(df, layout["key"], layout["buckets"]).write.mode("append").partitionBy("bucket").parquet(path)


def replace_partitions(df: DataFrame, path: str, column: str, touched: list) -> None:
    """Replace the partitions ``touched`` of a folder by the rows of ``df``, which has no other partitions; those left without rows go."""
    spark = df.sparkSession
    folders = {f"{path}/{column}={value}" for value in touched}
    before = {f: shared.names(spark, f) for f in folders}
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    for folder, held in before.items():
        if held and shared.names(spark, folder) == held:  # nothing was written there: the partition has no rows any more
            shared.delete(spark, folder)


def _change(spark: SparkSession, path: str, keys: DataFrame, new: DataFrame | None) -> None:
    layout = _layout(spark, path)
    key, buckets = layout["key"], layout["buckets"]
    touched = sorted(r["bucket"] for r in keys.select(bucket_of(F.col(key), buckets).alias("bucket")).distinct().collect())  # at most ``buckets`` numbers
    if not touched:
        return
    old = _read(spark, path)
    left = old.where(F.col("bucket").isin(touched)).join(keys.select(key).distinct(), key, "left_anti").select(*old.columns)
    rows = left if new is None else left.unionByName(new.withColumn("bucket", bucket_of(F.col(key), buckets)).select(*old.columns))
    replace_partitions(rows.hint("rebalance", "bucket"), path, "bucket", touched)


def upsert(new: DataFrame, path: str, keys: DataFrame | None = None) -> None:
    """Replace all rows of each key of ``keys`` (by default those of ``new``) by the rows of ``new``, all of which have one of these keys.

    Rows without a key replace nothing and are added.
    """
    _change(new.sparkSession, path, new if keys is None else keys, new)


def delete(keys: DataFrame, path: str) -> None:
    """Take all rows of the given keys out."""
    _change(keys.sparkSession, path, keys, None)
