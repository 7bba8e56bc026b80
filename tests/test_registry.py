import pytest

from lumencube.plans.registry import ORACLES, QUERIES

from .oracle import connect, differences

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    frame = QUERIES[name](spark, DATA)
    if name in ORACLES:
        assert differences(frame, ORACLES[name], con) == ""
    else:
        assert frame.count() > 0


def test_transitive_pairs_of_every_key(spark, tmp_path):
    keys = range(1, 1500, 7)
    spark.createDataFrame([(k,) for k in keys], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    after = {}
    for k in keys:
        after.setdefault(k, set()).update((k // 3, k // 5))
    after.setdefault(0, set()).add(7)
    want = set()
    for a in after:
        front = seen = set(after[a])
        while front:
            front = {c for b in front for c in after.get(b, ())} - seen
            seen = seen | front
        want |= {(a, b) for b in seen}
    got = [tuple(r) for r in QUERIES["transitive_pairs"](spark, str(tmp_path)).collect()]
    assert len(got) == len(want) and set(got) == want and max(a for a, _ in got) > 400
