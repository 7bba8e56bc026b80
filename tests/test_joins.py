import datetime
import random

import pytest
from pyspark.sql import functions as F

from lumencube.core import Dataset
from lumencube.operators import intervals
from lumencube.operators.asof import asof_join
from lumencube.operators.intervals import JoinOverlaps, Span, overlap_join


def lies(lo, hi, closed, point):
    if point:
        return lo is not None
    return lo is None or hi is None or (lo <= hi if closed else lo < hi)


def meet(a, b):
    """(low, high, closed, point) of both sides."""
    if not lies(*a) or not lies(*b):
        return False
    before = lambda x, y: x[0] is None or y[1] is None or (x[0] <= y[1] if y[2] or y[3] else x[0] < y[1])
    return before(a, b) and before(b, a)


def plain(left, right, how, closed_l=False, closed_r=False, point=False):
    """All pairs, one after the other; rows are (id, key, low, high)."""
    a = lambda r: (r[2], r[2] if point else r[3], closed_l, point)
    hits = {l: [r for r in right if l[1] == r[1] and meet(a(l), (r[2], r[3], closed_r, False))] for l in left}
    if how == "semi":
        return sorted((l[0],) for l in left if hits[l])
    if how == "anti":
        return sorted((l[0],) for l in left if not hits[l])
    out = [(l[0], r[0]) for l in left for r in hits[l]]
    return sorted(out + [(l[0], -1) for l in left if how == "left" and not hits[l]])


def rows(n, seed, scale, spread, whole=True):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        low = rng.uniform(-spread, spread)
        high = low + rng.choice([0, 1, -1, 3, 40, spread]) * rng.random() * scale
        low, high = (int(low), int(high)) if whole else (low, high)
        out.append((k, rng.choice(["a", "b", None]), None if rng.random() < 0.05 else low, None if rng.random() < 0.05 else high))
    return out


def frames(spark, left, right, kind):
    a = spark.createDataFrame(left, f"id long, `the.key` string, low {kind}, high {kind}")
    b = spark.createDataFrame(right, f"rid long, rkey string, rlow {kind}, rhigh {kind}")
    return a, b


def got(frame, how):
    return sorted((r.id,) if how in ("semi", "anti") else (r.id, -1 if r.rid is None else r.rid) for r in frame.collect())


@pytest.mark.parametrize("how", ["inner", "left", "semi", "anti"])
@pytest.mark.parametrize("kind", ["long", "double"])
@pytest.mark.parametrize("point", [False, True])
def test_overlaps_equal_all_pairs(spark, how, kind, point):
    left, right = rows(60, 1, 5, 1000, kind == "long"), rows(50, 2, 9, 1000, kind == "long")
    right += [(900, "a", -(10**15) if kind == "long" else -1e300, 10**15 if kind == "long" else 1e300), (901, "b", None, None)]  # one interval over everything
    right += [right[0], right[-1]]  # repeated rows
    a, b = frames(spark, left, right, kind)
    for closed in (False, True) if how == "inner" else (False,):
        spans = Span("low") if point else Span("low", "high", closed), Span("rlow", "rhigh", closed)
        frame = overlap_join(a, b, *spans, on=[("the.key", "rkey")], how=how)
        assert got(frame, how) == plain(left, right, how, closed, closed, point)


def test_full_bins_are_split(spark):
    rng = random.Random(5)
    left = [(k, "a", rng.randrange(100), 0) for k in range(400)] + [(k, "b", 7, 0) for k in range(400, 420)]
    right = [(k, "a", rng.randrange(100), 0) for k in range(120)]
    right = [(k, key, low, low + rng.choice([3, 60, 10**9])) for k, key, low, _ in right]
    a, b = frames(spark, left, right, "long")
    for how in ("inner", "anti"):
        frame = overlap_join(a, b, Span("low"), Span("rlow", "rhigh"), on=[("the.key", "rkey")], how=how, bin_rows=25)
        assert got(frame, how) == plain(left, right, how, point=True)
        plan = frame._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "sa#" in plan


def test_rows_are_repeated_for_levels_not_for_bins(spark):
    """An interval over everything adds one bin for each point, and lies in two."""
    points = spark.range(1000).select(F.col("id").alias("x"))
    spans = spark.createDataFrame([(k * 10, k * 10 + 4) for k in range(100)] + [(0, 10**12)], "low long, high long")
    a, b = intervals._Side(points, Span("x"), [], "l", "whole"), intervals._Side(spans, Span("low", "high"), [], "r", "whole")
    levels = [sorted(r[0] for r in s.placed().select(f"{s.tag}level").distinct().collect()) for s in (a, b)]
    assert levels[0] == [0] and len(levels[1]) == 2
    assert a.binned(a.placed(), levels[1]).count() == 2 * 1000
    assert b.binned(b.placed(), levels[0]).count() <= 2 * 101
    frame = overlap_join(points, spans, Span("x"), Span("low", "high"))
    assert frame.count() == 1000 + 400
    plan = frame._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "decimal(12,3)", "float"])
def test_kinds_of_bounds(spark, kind):
    values = {"date": "date_add(date'2020-03-01', cast(id as int))", "timestamp": "timestamp'2020-03-29 00:00:00' + make_dt_interval(0, cast(id as int), 0, 0.25)", "timestamp_ntz": "timestamp_ntz'1960-01-01 00:00:00' + make_dt_interval(0, cast(id as int), 0, 0.25)"}
    value = values.get(kind, f"cast(id * 1.5 as {kind})")
    a = spark.range(40).selectExpr("id", f"{value} as x")
    b = spark.range(0, 40, 4).selectExpr("id", f"{value} as low").join(spark.range(2, 42, 4).selectExpr("id - 2 as id", f"{value} as high"), "id").withColumnRenamed("id", "rid")
    found = overlap_join(a, b, Span("x"), Span("low", "high"))
    assert sorted((r.id, r.rid) for r in found.collect()) == [(k, k // 4 * 4) for k in range(40) if k % 4 < 2]


def test_errors_and_empty_tables(spark):
    a, b = frames(spark, rows(5, 3, 5, 10), rows(5, 4, 5, 10), "long")
    spans = Span("low", "high"), Span("rlow", "rhigh")
    for how in ("inner", "left", "semi", "anti"):
        assert overlap_join(a.limit(0), b, *spans, how=how).count() == 0
        assert overlap_join(a, b.limit(0), *spans, how=how).count() == (5 if how in ("left", "anti") else 0)
    with pytest.raises(ValueError):
        overlap_join(a, b, Span("low"), Span("rlow"))
    with pytest.raises(ValueError):
        overlap_join(a, a, *[Span("low", "high")] * 2)
    with pytest.raises(ValueError):
        overlap_join(a, b, *spans, how="outer")
    with pytest.raises(KeyError):
        overlap_join(a, b, Span("no"), spans[1])
    with pytest.raises(TypeError):
        overlap_join(a, b.withColumn("rlow", F.current_date()).withColumn("rhigh", F.current_date()), *spans)
    done = JoinOverlaps(b, *spans).apply(Dataset(a)).history[-1]
    assert done.metrics["rows_before"] == 5


def plain_asof(left, right, direction, exact, tolerance=None):
    out = []
    for i, key, when in left:
        fit = []
        for j, k, w in right:
            if when is None or w is None or k != key:
                continue
            gap = (when - w) * (1 if direction == "backward" else -1)
            if gap > 0 or (gap == 0 and exact):
                fit.append((gap, -j, j))
        best = min(fit, default=None)
        out.append((i, best[2] if best and (tolerance is None or best[0] <= tolerance) else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("keys", [["a", "b", None], ["one"]])
def test_asof_over_many_ranges(spark, direction, exact, keys):
    """Few right rows, so that most ranges of a key have none and take what earlier ranges carry."""
    rng = random.Random(len(keys))
    time = lambda: rng.choice([None, *range(300)])
    left = [(k, rng.choice(keys), time()) for k in range(500)]
    right = [(k, rng.choice(keys), time()) for k in range(12)]
    right += [(50 + k, keys[0], 200) for k in range(5)]  # ties
    a = spark.createDataFrame(left, "id long, key string, at long").repartition(7)
    b = spark.createDataFrame(right, "rid long, rkey string, then long").repartition(3)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = asof_join(a, b, "at", "then", on=[("key", "rkey")], columns=["rid"], direction=direction, exact=exact, ties=["rid"]).collect()
        near = asof_join(a, b, "at", "then", on=[("key", "rkey")], direction=direction, exact=exact, ties=["rid"], tolerance=F.lit(20)).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert sorted(((r.id, r.rid) for r in got), key=str) == plain_asof(left, right, direction, exact)
    assert sorted(((r.id, r.rid) for r in near), key=str) == plain_asof(left, right, direction, exact, 20)


def test_asof_edges(spark):
    a = spark.createDataFrame([(1, 5.0, [1, 2], "x"), (1, 5.0, [1, 2], "x"), (2, None, None, "y"), (3, float("nan"), [], "z")], "id long, `k.ey` double, list array<int>, l string")
    a = a.withColumn("at", F.timestamp_seconds("id"))
    b = spark.createDataFrame([(5.0, "first"), (None, "null key")], "key double, name string").withColumn("then", F.timestamp_seconds(F.lit(0)))
    got = asof_join(a, b, "at", "then", on=[("k.ey", "key")])
    assert got.columns == [*a.columns, "name", "then"]
    assert sorted((r.id, r.name) for r in got.collect()) == [(1, "first"), (1, "first"), (2, "null key"), (3, "null key")]
    assert asof_join(a.limit(0), b, "at", "then").count() == 0
    assert [r.name for r in asof_join(a, b.limit(0), "at", "then").collect()] == [None] * 4
    assert got.where("id = 1").first().list == [1, 2] and got.first().then is None or isinstance(got.first().then, datetime.datetime)
    with pytest.raises(ValueError):
        asof_join(a, b, "at", "then", direction="nearest")
    with pytest.raises(ValueError):
        asof_join(a, b.withColumnRenamed("name", "l"), "at", "then")
    with pytest.raises(TypeError):
        asof_join(a, b.withColumn("then", F.lit(1)), "at", "then")
    with pytest.raises(TypeError):
        asof_join(a, b.withColumn("key", F.array("key")), "at", "then", on=[("list", "key")])


@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("kind", ["long", "double"])
def test_totals_equal_pairs_aggregated(spark, closed, kind, monkeypatch):
    left, right = rows(300, 7, 5, 100, kind == "long"), rows(80, 8, 9, 100, kind == "long")
    left += [(900 + k, "a", None if k else 5, None) for k in range(3)] * 2  # repeated rows, and some that lie nowhere
    right += [(80, "a", None, None), (81, "c", 1, 2), (82, "b", 5, 5), (None, "a", 0, 9), (83, "b", 9, -9)]
    number = lambda x: None if x is None else (int if kind == "long" else float)(x)
    left, right = ([(i, key, number(lo), number(hi)) for i, key, lo, hi in side] for side in (left, right))
    a, b = frames(spark, left, right, kind)
    want = []
    for l in left:
        hits = [r[0] for r in right if l[1] == r[1] and r[0] is not None and meet((l[2], l[2], False, True), (r[2], r[3], closed, False))]
        want.append((l[0], len(hits), min(hits, default=-1)))
    for nodes in (1 << 16, 2):  # all blocks come down to the places, or few
        monkeypatch.setattr(intervals, "_NODES", nodes)
        found = intervals.overlap_totals(a, b, "low", Span("rlow", "rhigh", closed), "rid", on=[("the.key", "rkey")])
        assert found.columns == [*a.columns, "n", "least"]
        assert sorted((r.id, r.n, -1 if r.least is None else r.least) for r in found.collect()) == sorted(want)


def test_totals_make_no_pairs(spark):
    """3,000 spans over each of 3,000 points are 9 million pairs; blocks are a few dozen a span."""
    points, spans = spark.range(3000).select(F.col("id").alias("x")), spark.range(3000).select(F.col("id").alias("rid"), (-F.col("id") - 1).alias("low"), (F.col("id") + 3000).alias("high"))
    frame = intervals.overlap_totals(points, spans, "x", Span("low", "high"), "rid")
    assert frame.where("n = 3000 AND least = 0").count() == 3000
    plan = frame._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(ValueError):
        intervals.overlap_totals(points, spans, "x", Span("low"), "rid")


def test_bands_query_totals_without_joining_spans_to_points(spark, tmp_path, monkeypatch):
    from lumencube.plans import registry_joins

    from .oracle import connect, differences

    spark.createDataFrame([(k, k % 3 if k % 11 else None, float(k % 50) * 20) for k in range(200)], "c_custkey long, c_nationkey int, c_acctbal double").coalesce(1).write.parquet(str(tmp_path / "w/customer"))
    spark.createDataFrame([(k, k % 4 if k % 7 else None, float(k) * 11) for k in range(90)], "s_suppkey long, s_nationkey int, s_acctbal double").coalesce(1).write.parquet(str(tmp_path / "w/supplier"))
    for t in ("customer", "supplier"):
        (part,) = (tmp_path / "w" / t).glob("part-*.parquet")
        part.rename(tmp_path / f"{t}.parquet")
    monkeypatch.setattr(registry_joins, "overlap_join", None)
    query = registry_joins.balances_in_open_bands
    from lumencube.plans.registry import ORACLES

    assert differences(query(spark, str(tmp_path)), ORACLES["balances_in_open_bands"], connect(tmp_path)) == ""


@pytest.mark.parametrize("kind", ["long", "double"])
@pytest.mark.parametrize("closed", [False, True])
def test_packs_of_points_equal_all_pairs(spark, monkeypatch, kind, closed):
    """Points on either side, with and without keys, nulls, repeated rows and open bounds; packs of four, cells of few rows."""
    for name, value in (("PACK", 2), ("TASK_MEETS", 20), ("CELL_MEETS", 10)):
        monkeypatch.setattr(intervals, name, value, raising=False)
    points, spans = rows(90, 11, 5, 60, kind == "long"), rows(60, 12, 9, 60, kind == "long")
    points, spans = points + points[:20] + [(300 + k, "a", points[5][2], None) for k in range(20)], spans + spans[:10] + [(900, "a", None, None), (901, None, None, points[5][2])]
    a, b = frames(spark, points, spans, kind)
    with_keys = plain(points, spans, "inner", True, closed, True)
    bare = plain([(i, 0, lo, hi) for i, _, lo, hi in points], [(i, 0, lo, hi) for i, _, lo, hi in spans], "inner", True, closed, True)
    point, span = Span("low"), Span("rlow", "rhigh", closed)
    assert got(overlap_join(a, b, point, span, on=[("the.key", "rkey")], bin_rows=16), "inner") == with_keys
    assert got(overlap_join(b, a, span, point, on=[("rkey", "the.key")], bin_rows=16), "inner") == with_keys
    frame = overlap_join(a, b, point, span, bin_rows=16)
    assert got(frame, "inner") == bare and frame.columns == [*a.columns, *b.columns]


def test_many_pairs_of_few_rows_get_many_tasks(spark, monkeypatch):
    """Rows and bytes are few, pairs are many: the join has tasks for its pairs, none makes most of them, and looks at packs."""
    for name, value in (("PACK", 4), ("TASK_MEETS", 100), ("CELL_MEETS", 200)):
        monkeypatch.setattr(intervals, name, value, raising=False)
    points = spark.range(2000).select(F.col("id").alias("x"))
    spans = spark.range(500).select((F.col("id") * 3).alias("low"), (F.col("id") * 3 + 400).alias("high"))
    frame = overlap_join(points, spans, Span("x"), Span("low", "high"), bin_rows=1000)
    made = [r[0] for r in frame.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(made) == 500 * 400 and len(made) > 16 and max(made) < 30_000
    assert "explode" in frame._jdf.queryExecution().toString()
