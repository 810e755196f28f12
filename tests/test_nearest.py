"""Nearest neighbours in groups against the column expression, for every pair."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from papyrion.operators import nearest, vector


@pytest.mark.parametrize("metric", ["l2sq", "cosine"])
def test_groups_give_the_expression_s_distances(spark, metric, monkeypatch):
    import random

    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(5)]) for i in range(300)]
    rows += [(1000 + i, rows[i % 3][1]) for i in range(60)]  # copies: ties go by id
    rows += [(2000, None), (2001, [1.0, None, 0.0, 0.0, 0.0]), (2002, [1.0]), (2003, [float("nan")] * 5), (2004, [0.0] * 5), (2005, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (2006, [])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    q = v.where("vec_id % 50 = 0 or vec_id > 2000").select(F.col("vec_id").alias("query_id"), "embedding")
    monkeypatch.setattr(nearest, "groups", lambda *a: 3)
    got = vector.nearest_batch(v, q, 4, metric, block_rows=6)
    pairs = v.crossJoin(q.withColumnRenamed("embedding", "q")).select("query_id", "vec_id", vector.METRICS[metric](F.col("embedding"), F.col("q")).alias("distance"))
    w = Window.partitionBy("query_id").orderBy(F.col("distance").asc_nulls_last(), "vec_id")
    want = pairs.withColumn("place", F.row_number().over(w)).where("place <= 4")
    rows_of = lambda df: sorted((r["query_id"], r["place"], r["vec_id"], str(r["distance"])) for r in df.collect())
    assert rows_of(got) == rows_of(want)


def test_no_pair_is_compared_in_the_plan(spark):
    """Regular pairs go by groups; tables are crossed only if they have odd rows."""
    v = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(50)], "vec_id long, embedding array<float>")
    plan = vector.nearest_batch(v, v.select(F.col("vec_id").alias("query_id"), "embedding"), 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Join" not in plan
