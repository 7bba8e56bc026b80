import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumencube.llm import negatives
from lumencube.llm.queries import ORACLES, op13_hard_negatives

from .oracle import assert_same

DATA = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, every=50, positives=5, k=3, least=50, most=95):
    """Python's integers over all pairs."""
    by_id = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        by_id[i] = min(by_id.get(i, (label, v)), (label, v))
    good = {i: (label, [int(math.floor(256 * x)) for x in v]) for i, (label, v) in by_id.items()}
    out = []
    for a, (label, v) in good.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, m == label) for i, (m, w) in good.items() if i != a and len(w) == len(v))
        for p, positive, same in [x for x in scored if x[2]][:positives]:
            fit = [(-s, i) for s, i, m in scored if not m and -least * p <= -100 * s <= -most * p][:k]
            out += [(a, positive, n + 1, i, -p, s) for n, (s, i) in enumerate(fit)]
    return sorted(out)


def found(frame):
    assert frame.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, frame.collect()))


def test_the_whole_table_equals_sql(spark):
    assert_same(op13_hard_negatives(spark, DATA), ORACLES["op13_hard_negatives"], DATA)


def some(n, dim=6, labels=3, seed=4):
    rng = np.random.default_rng(seed)
    return [(k, (rng.integers(-3, 4, dim) / 4).tolist(), int(rng.integers(labels))) for k in range(n)]


def test_ties_and_blocks(spark, monkeypatch):
    rows = some(700)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = plain(rows, every=10)
    assert want
    assert found(negatives.hard_negatives(frame, every=10)) == want
    assert found(negatives.hard_negatives(frame, every=10, positives=2, k=6, least=10, most=120)) == plain(rows, 10, 2, 6, 10, 120)
    monkeypatch.setattr(negatives, "BROADCAST_BYTES", 1000)  # a grid on the shuffle
    got = negatives.hard_negatives(frame, every=10)
    assert found(got) == want
    plan = got._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_lists_that_are_passed_on_early():
    group = np.array([0, 0, 1, 0, 1, 2])
    got = negatives.best(group, np.array([9, 3, 5, 4, 1, 7]), np.array([5, 5, 2, 8, 2, -1]), 2)
    assert [x.tolist() for x in got] == [[0, 0, 1, 1, 2], [4, 3, 1, 5, 7], [8, 5, 2, 2, -1]]
    lists = negatives._Lists(3, 2)
    lists.add(group, np.array([9, 3, 5, 4, 1, 7]), np.array([5, 5, 2, 8, 2, -1]))
    assert lists.floor.tolist() == [5, 2, np.iinfo(np.int64).min]


def test_products_are_exact_beyond_float64():
    big = np.array([[2.0**40 + 1, 3.0], [5.0, -(2.0**40) - 7]])
    got = negatives.products(big[:, :1] * 1.0, np.array([[2.0**20 + 1], [-3.0]]))
    assert got.tolist() == [[(2**40 + 1) * (2**20 + 1), -3 * (2**40 + 1)], [5 * (2**20 + 1), -15]]
    lists = negatives._Lists(1, 2)
    with pytest.raises(OverflowError):
        lists.add(np.array([0]), np.array([1]), negatives.products(big, big)[0, :1])
    assert negatives._windows(np.array([7, 0, -7, 2**62]), 50, 95)[0].tolist() == [4, 0, -3, 2**61]
    assert negatives._windows(np.array([7, 0, -7, 2**62]), 50, 95)[1].tolist() == [6, 0, -7, 95 * 2**62 // 100]


def test_edge_cases(spark):
    rows = some(120, dim=4)
    rows += [(150, None, 1), (200, [1.0, None, 1.0, 1.0], 1), (250, [float("nan")] * 4, 1), (300, [float("inf")] * 4, 1), (350, [1.0] * 4, None), (None, [1.0] * 4, 1)]
    rows += [(400, [], 0), (450, [], 0), (451, [], 1), (500, [1.0, 2.0], 0), (501, [1.0, 1.0], 0), (502, [0.5, 1.0], 1), (550, [0.0] * 4, 1)]
    rows += [(600, [1e9, 2.0, 3.0], 0), (601, [3.0, 1.0, 1.0], 0), (602, [2.0, 1.0, 1.0], 1)]  # beyond 2^53
    rows += [(7, [1.0] * 4, 2)] * 3 + [(7, [0.5] * 4, 2)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit("clash")).withColumn("rank", F.lit(0)).withColumn("vector", F.lit(1))
    assert found(negatives.hard_negatives(frame)) == plain(rows)
    assert {r[0] for r in plain(rows)} >= {50, 100, 400, 500}
    assert negatives.hard_negatives(frame.limit(0)).count() == 0


def test_floor_of_scaled_components(spark):
    values = [0.1, -0.1, 1 / 256, -1 / 256, 0.0, -0.0, 1.5 / 256, -1.5 / 256, 2.5 / 256, -2.5 / 256, 1e-300, -1e-300, 1e12 + 0.3]
    got = negatives.usable(spark.createDataFrame([(1, values, 0)], SCHEMA)).first()
    assert got.vector == [float(math.floor(256 * x)) for x in values] and got.dim == len(values)
