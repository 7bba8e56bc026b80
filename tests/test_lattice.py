import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lumencube.operators import lattice as L
from lumencube.sources.versions import Conflict

SCHEMA = "a string, `b.c` int, x double, id long"
DIMS = ["a", "b.c"]


def rows(n, seed):
    rng = random.Random(seed)
    return [(rng.choice(["u", "v", None]), rng.choice([1, 2, None]), rng.choice([None, float(rng.randrange(50))]), rng.randrange(400)) for _ in range(n)]


def measures():
    return {"n": L.rows(), "known": L.count("x"), "sum": L.total("x"), "low": L.least("x"), "high": L.most("x"), "ids": L.distinct("id"), "mid": L.quantile("x", 0.5)}


def plain(data, sets):
    cells = defaultdict(list)
    for a, b, x, i in data:
        for s in sets:
            level = 2 * ("a" not in s) + ("b.c" not in s)
            cells[level, a if "a" in s else None, b if "b.c" in s else None].append((x, i))
    out = {}
    for key, held in cells.items():
        xs = [x for x, _ in held if x is not None]
        out[key] = (len(held), len(xs), sum(xs) if xs else None, min(xs, default=None), max(xs, default=None), len({i for _, i in held}), sorted(xs))
    return out


def check(frame, want):
    got = {(r.level, r.a, r["b.c"]): r for r in frame.collect()}
    assert set(got) == set(want)
    for key, (n, known, total, low, high, ids, xs) in want.items():
        r = got[key]
        assert (r.n, r.known, r.sum, r.low, r.high) == (n, known, total, low, high)
        assert abs(r.ids - ids) <= max(1, 4 * 1.04 / 64 * ids)
        if xs:
            below, upto = sum(x < r.mid for x in xs) / len(xs), sum(x <= r.mid for x in xs) / len(xs)
            assert below - 0.03 <= 0.5 <= upto + 0.03
        else:
            assert r.mid is None


@pytest.mark.parametrize("sets", [None, L.rollup(*DIMS), L.cube(*DIMS), [("b.c",), ()]])
def test_halves_merge_to_the_whole(spark, tmp_path, sets):
    one, two = rows(300, 1), rows(200, 2)
    store = L.Lattice(spark, str(tmp_path / "l"), DIMS, measures(), sets)
    store.add(spark.createDataFrame(one, SCHEMA))
    store.add(spark.createDataFrame(two, SCHEMA))
    used = sets or [tuple(DIMS)]
    check(store.read(), plain(one + two, used))
    check(store.read(version=1), plain(one, used))
    store.compact()
    check(store.read(), plain(one + two, used))
    again = L.Lattice(spark, str(tmp_path / "l"), DIMS, measures(), sets)
    again.add(spark.createDataFrame(one, SCHEMA))
    check(again.read(), plain(one + two + one, used))


def test_groupings_that_are_not_stored(spark, tmp_path):
    data = rows(300, 3)
    store = L.Lattice(spark, str(tmp_path / "l"), DIMS, {"n": L.rows(), "ids": L.distinct("id")}, [DIMS])
    store.add(spark.createDataFrame(data, SCHEMA))
    assert {(r["b.c"], r.n) for r in store.group("b.c").collect()} == {(k[2], v[0]) for k, v in plain(data, [("b.c",)]).items()}
    assert [r.n for r in store.group().collect()] == [300]
    with pytest.raises(KeyError):
        store.group("z")
    other = L.Lattice(spark, str(tmp_path / "m"), DIMS, {"n": L.rows()}, [("a",)])
    other.add(spark.createDataFrame(data, SCHEMA))
    with pytest.raises(ValueError):
        other.group("b.c")


def test_rows_are_aggregated_once(spark, tmp_path):
    """Grouping sets repeat finest cells, not rows."""
    store = L.Lattice(spark, str(tmp_path / "l"), DIMS, {"n": L.rows(), "sum": L.total("x")}, L.cube(*DIMS))
    plan = store.cells(spark.createDataFrame(rows(50, 4), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and plan.index("Expand") < plan.rindex("HashAggregate") and plan.count("Scan") == 1


def test_errors_and_empty_tables(spark, tmp_path):
    store = L.Lattice(spark, str(tmp_path / "l"), DIMS, {"n": L.rows()}, L.cube(*DIMS))
    with pytest.raises(ValueError):
        store.read()
    store.add(spark.createDataFrame([], SCHEMA))
    assert [r.n for r in store.read().collect()] in ([], [0])
    with pytest.raises(ValueError):
        L.Lattice(spark, str(tmp_path / "l"), DIMS, {"n": L.count("x")}, L.cube(*DIMS)).read()
    with pytest.raises(ValueError):
        L.Lattice(spark, str(tmp_path / "k"), DIMS, {"n": L.rows()}, [("z",)])
    with pytest.raises(ValueError):
        L.Lattice(spark, str(tmp_path / "k"), ["a"], {"a": L.rows()})
    with pytest.raises(KeyError):
        store.add(spark.range(1))
    store.versions.publish(store.versions.latest(), {"shape": store.shape, "cells": []})
    with pytest.raises(Conflict):
        store.versions.publish(1, {"shape": store.shape, "cells": []})
    alone = L.Lattice(spark, str(tmp_path / "n"), [], {"n": L.rows()})
    alone.add(spark.range(5).select(F.col("id")))
    alone.add(spark.range(2).select(F.col("id")))
    assert [(r.level, r.n) for r in alone.read().collect()] == [(0, 7)]
