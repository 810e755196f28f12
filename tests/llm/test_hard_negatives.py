"""Lookup-table scores against numpy, mining against plain loops."""

import random

import numpy as np
import pytest

from papyrion.llm import hard_negatives as hn
from papyrion.llm.hard_negatives import NegativeConfig

INF, NAN = float("inf"), float("nan")


@pytest.mark.parametrize("dims,most", [(64, 256), (5, 1), (13, 1 << 20), (8, 0), (0, 0)])
def test_scores_are_exact(dims, most):
    rng = np.random.default_rng(dims)
    rows, anchors = rng.integers(-most, most + 1, (90, dims)), rng.integers(-most, most + 1, (17, dims))
    planes = hn.bit_planes(rows)
    tables = hn.subset_sums(anchors, planes.shape[1], hn._fits(anchors, len(planes)))
    assert (hn.scores(planes, tables) == rows @ anchors.T).all()


def plain(rows, config):
    taken = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            label = (label + 1) % config.labels if i % config.relabel_every == 0 else label
            taken.append((i, label, [int(np.floor(x * config.scale)) for x in v]))
    out = []
    for i, label, v in taken:
        if i % config.anchor_every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in taken if j != i]
        positives = sorted(r[:2] for r in scored if r[2] == label)[: config.positives]
        for p, j in positives:
            fits = sorted(r[:2] for r in scored if r[2] != label and config.low_percent * -p <= 100 * -r[0] <= config.high_percent * -p)
            out += [(i, j, k + 1, n, -p, -s) for k, (s, n) in enumerate(fits[: config.negatives])]
    return sorted(out)


@pytest.mark.parametrize("config", [NegativeConfig(anchor_every=5), NegativeConfig(anchor_every=3, anchor_rows=4, candidate_rows=16, group_blocks=2, low_percent=10, negatives=7)])
def test_mining(spark, config):
    rng = random.Random(4)
    vector = lambda n=11: [rng.choice([-0.4, 0.0, 0.1, 0.25, 0.5]) for _ in range(n)]  # noqa: E731  # few values, so many ties
    rows = [(i, vector(), rng.randrange(4)) for i in range(-10, 150)]
    rows += [(200, None, 1), (201, vector(), None), (None, vector(), 1), (202, [None, *vector(10)], 1), (203, [NAN, *vector(10)], 1), (204, [INF, *vector(10)], 2)]
    rows += [(210, vector(3), 1), (211, [], 2), (212, vector(19), 3), (220, [-0.5] * 11, 9)]
    rows += [(i, [0.5] * 11, i % 2) for i in range(300, 340)]  # a hot vector
    given = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, score string, anchor int").repartition(5)
    got = hn.mine(given, config)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == plain(rows, config)


def test_repeated_rows_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    rows = spark.createDataFrame([(0, [1.0], 2), (0, [1.0], 2), (1, [1.0], 3), (2, [0.75], 1), (2, [0.75], 1)], schema)
    got = sorted(map(tuple, hn.mine(rows, NegativeConfig(relabel_every=0, labels=4)).collect()))
    assert got == []  # no other row has the anchors' label
    one = rows.unionAll(spark.createDataFrame([(3, [1.0], 2)], schema))
    got = sorted(map(tuple, hn.mine(one, NegativeConfig(relabel_every=0)).collect()))
    assert got == sorted(2 * [(0, 3, 1, 2, 65536, 49152), (0, 3, 2, 2, 65536, 49152)])
    assert hn.mine(rows.limit(0)).count() == 0
    with pytest.raises(Exception, match="components"):
        hn.mine(spark.createDataFrame([(0, [1e7], 1)], schema)).count()
