"""An inverted-file index for nearest neighbours.

Centroids are fitted on a bounded sample (``rows_per_list`` rows for each list);
every vector then goes to the list of its nearest centroid, and the table is
partitioned by list.  A query looks into the ``probes`` lists with the nearest
centroids, so a search reads those partitions only and compares each query with
their rows only.

Each list also has its radius.  With ``exact`` a second step looks into every
further list that could hold a nearer row: by the triangle inequality no row of
a list is nearer than the centroid's distance less the radius.

    path/data/list=7/...   vec_id, embedding, other columns
    path/lists             list, centroid, radius, rows
    path/model             the fitted centroids, for adding rows
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from papyrion.operators import buckets, nearest
from papyrion.operators.vector import METRICS, filtered
from papyrion.session import saved, set_checkpoint_folder
from papyrion.sources import shared


@dataclass(frozen=True)
class IndexConfig:
    #: Lists; by default the square root of the number of rows, at most ``max_lists``.
    lists: int | None = None
    max_lists: int = 4096
    #: Rows of the sample for each list.  At most ``max_lists`` times so many rows train the centroids.
    rows_per_list: int = 256
    iterations: int = 8
    seed: int = 17
    #: ``cosine`` compares directions: centroids and lists are those of the vectors at unit length.
    metric: str = "l2sq"


def _placed(embedding: Column, metric: str) -> Column:
    """The vector in the space of the centroids."""
    x = embedding.cast("array<double>")
    if metric != "cosine":
        return x
    norm = F.sqrt(F.aggregate(x, F.lit(0.0), lambda t, v: t + v * v))
    return F.transform(x, lambda v: F.when(norm > 0, v / norm).otherwise(0.0))


def _distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda t, v: t + v))


def build(vectors: DataFrame, path: str, config: IndexConfig = IndexConfig()) -> None:
    """Index all rows of ``vectors`` (vec_id, embedding, other columns) that have an embedding, in a new folder."""
    spark = vectors.sparkSession
    rows = vectors.where("embedding is not null")
    total = rows.count()
    lists = config.lists or min(config.max_lists, max(1, math.isqrt(total)))
    share = min(1.0, lists * config.rows_per_list / max(1, total))
    # a share of the ids by hash: the same rows at every run, however they are partitioned
    sample = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < math.ceil(share * (1 << 20)))
    if total:
        model = KMeans(k=lists, maxIter=config.iterations, seed=config.seed, initSteps=1).fit(sample.select(array_to_vector(_placed(F.col("embedding"), config.metric)).alias("features")))
        model.write().save(f"{path}/model")
        _append(rows, path, model, config)
    else:
        rows.withColumn("from_center", F.lit(0.0)).write.parquet(f"{path}/data/list=0")
    _describe(spark, path)


def _centers(spark: SparkSession, path: str) -> DataFrame:
    """(list, centroid): at most ``max_lists`` rows."""
    found = KMeansModel.load(f"{path}/model").clusterCenters() if shared.exists(spark, f"{path}/model") else []
    return spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(found)], "list int, centroid array<double>")


def _append(rows: DataFrame, path: str, model: KMeansModel, config: IndexConfig) -> None:
    held = rows.columns
    placed = rows.withColumn("placed", _placed(F.col("embedding"), config.metric)).withColumn("features", array_to_vector("placed"))
    placed = model.setPredictionCol("list").transform(placed).join(F.broadcast(_centers(rows.sparkSession, path)), "list")
    placed = placed.select(*held, "list", _distance(F.col("placed"), F.col("centroid")).alias("from_center"))
    # a task for a list, several for a large one
    placed.hint("rebalance", "list").write.mode("append").partitionBy("list").parquet(f"{path}/data")


def _describe(spark: SparkSession, path: str) -> None:
    sizes = spark.read.parquet(f"{path}/data").groupBy("list").agg(F.max("from_center").alias("radius"), F.count(F.lit(1)).alias("rows"))
    _centers(spark, path).join(sizes, "list").coalesce(1).write.mode("overwrite").parquet(f"{path}/lists")


def add(vectors: DataFrame, path: str, config: IndexConfig = IndexConfig()) -> None:
    """Put further rows into the lists of their nearest centroids, which stay as they are.  To replace rows, ``remove`` their ids first."""
    _append(vectors.where("embedding is not null"), path, KMeansModel.load(f"{path}/model"), config)
    _describe(vectors.sparkSession, path)


def remove(ids: DataFrame, path: str) -> None:
    """Take the rows of ``ids`` (vec_id) out.  Only lists that hold one of them are written anew."""
    spark = ids.sparkSession
    data, gone = spark.read.parquet(f"{path}/data"), ids.select("vec_id").distinct()
    touched = sorted(r["list"] for r in data.select("list", "vec_id").join(gone, "vec_id", "left_semi").select("list").distinct().collect())
    if touched:
        left = data.where(F.col("list").isin(touched)).join(gone, "vec_id", "left_anti").select(*data.columns)
        buckets.replace_partitions(left.hint("rebalance", "list"), f"{path}/data", "list", touched)
        _describe(spark, path)


def _pruned(data: DataFrame, places: DataFrame) -> DataFrame:
    """The partitions of ``data`` that some place names; the driver gets at most ``max_lists`` numbers."""
    return data.where(F.col("list").isin(sorted(r["list"] for r in places.select("list").distinct().collect())))


def _best(found: DataFrame, n: int) -> DataFrame:
    return found.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vec_id"))).where(F.col("place") <= n)


def search(spark: SparkSession, path: str, queries: DataFrame, n: int = 5, probes: int | None = None, exact: bool = False, filters: dict[str, str] | None = None, config: IndexConfig = IndexConfig()) -> DataFrame:
    """(query_id, vec_id, distance, place): the ``n`` nearest rows of each query (query_id, embedding) in its ``probes`` nearest lists.

    By default a query looks into 55 percent of the lists, at least 8, which is
    enough for nearly all neighbours even where vectors hardly form clusters;
    where they do, far fewer are.  With ``exact`` also those of every other list that may hold a nearer one, so
    the result is that of a search through all rows.  Distances are those of
    ``vector.METRICS``; rows whose distance is null are not found.  Query ids
    are unique; a query without an embedding finds nothing.
    """
    data, lists = spark.read.parquet(f"{path}/data"), spark.read.parquet(f"{path}/lists")
    set_checkpoint_folder(spark)
    probes = probes or max(8, math.ceil(0.55 * lists.count()))
    asked = queries.where("embedding is not null").select("query_id", F.col("embedding").alias("q"), _placed(F.col("embedding"), config.metric).alias("placed"))
    # queries times lists, which are few
    ranked = asked.crossJoin(F.broadcast(lists)).withColumn("apart", _distance(F.col("placed"), F.col("centroid"))).drop("placed", "centroid", "rows")
    # read by several jobs below, and dear: a distance for each query and list
    ranked = saved(ranked.withColumn("nth", F.row_number().over(Window.partitionBy("query_id").orderBy("apart", "list"))), "places")
    metric = METRICS[config.metric]

    total, width = asked.agg(F.count(F.lit(1)), F.max(F.size("q"))).first()
    indexed = lists.agg(F.sum("rows")).first()[0] or 0

    def among(places: DataFrame) -> DataFrame:
        """In groups (see ``nearest``), to each of which a query goes once, with the lists that it looks into."""
        rows = filtered(_pruned(data, places), filters).select("list", "vec_id", "embedding")
        each = places.groupBy("query_id").agg(F.first("q").alias("q"), F.collect_set("list").alias("lists"))
        found = nearest.among(rows, each, n, config.metric, width or 0, nearest.groups(spark, indexed, nearest.GROUP_ROWS), max(1, -(-total // nearest.GROUP_QUERIES)))
        odd = lambda c: ~nearest.regular(F.col(c), width or 0, config.metric)
        compare = lambda rows, places: rows.join(places.select("list", "query_id", "q"), "list").select("query_id", "vec_id", metric(F.col("embedding"), F.col("q")).alias("distance"))
        found = found.unionByName(compare(rows.where(odd("embedding")), places)).unionByName(compare(rows.where(~odd("embedding")), places.where(odd("q"))))
        return _best(found.where("distance is not null"), n)

    first = among(ranked.where(F.col("nth") <= probes))
    if not exact:
        return first
    first = first.checkpoint()
    bound = first.where(F.col("place") == n).select("query_id", F.col("distance").alias("kth"))
    inner = F.greatest(F.col("apart") - F.col("radius"), F.lit(0.0))
    # the square of a distance at unit length is twice the cosine distance
    least = inner * inner / (2 if config.metric == "cosine" else 1)
    more = ranked.where(F.col("nth") > probes).join(bound, "query_id", "left").where(F.col("kth").isNull() | (least <= F.col("kth") + 1e-9))
    return _best(first.drop("place").unionByName(among(more).drop("place")), n)
