import random

import xxhash
from pyspark.sql import functions as F

from lumencube.llm import simhash

DATA = "/root/testdata/sf0.01"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_groups(fps, radius=4):
    ids, root = list(fps), {i: i for i in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def as_long(x):
    return x - (1 << 64) if x >> 63 else x


def test_masks_cover_every_pair_within_the_radius():
    masks, rng = simhash.covering_masks(4), random.Random(1)
    assert len(masks) == 31 and min(m.bit_count() for m in masks) >= 32
    for _ in range(20000):
        diff = sum(1 << bit for bit in rng.sample(range(64), rng.randint(0, 4)))
        assert any(not diff & m for m in masks)


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    groups = plain_groups(fps)
    got = simhash.near_duplicates(docs).collect()
    assert {r.doc_id: (r.fp, r.component_id) for r in got} == {i: (as_long(fps[i]), groups[i]) for i in texts}


def test_pieces_of_long_texts_agree_with_the_whole(monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 50)
    text = " ".join(f"Wörd{i % 37}\tx{i}" for i in range(900))
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)
    for short in ("", " \n", "One", "a b C", "a b c d"):
        assert simhash.fingerprint(short.encode()) == plain_fingerprint(short)


def test_large_buckets_lose_no_link(spark):
    rng = random.Random(3)
    base, fps = rng.getrandbits(64), set()
    for k in range(700):
        x = base if k % 2 else rng.getrandbits(64)
        for bit in rng.sample(range(64), rng.randint(0, 7)):
            x ^= 1 << bit
        fps.add(x)
    by_fp = {x: x for x in sorted(fps)}
    want = {}
    for x, root in plain_groups(by_fp).items():
        want.setdefault(root, set()).add(as_long(x))
    frame = spark.createDataFrame([(as_long(x),) for x in fps], "fp long")
    from lumencube.llm.components import connected_components

    got = {}
    for r in connected_components(simhash.links(frame, bucket_rows=3)).collect():
        got.setdefault(r.component, set()).add(r.node)
    assert sorted(map(sorted, got.values())) == sorted(sorted(x) for x in want.values() if len(x) > 1)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t"), (7, "Same text here"), (5, "same TEXT  here"), (5, "same TEXT  here"), (None, "same text here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(None))
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 1), (2, 1), (3, 1), (7, 5), (5, 5), (5, 5), (None, 5)], key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_components_with_a_hub(spark):
    from lumencube.llm.components import connected_components

    hub, leaves = 1_000_000, 100_000
    star = spark.range(1, leaves + 1).select(F.col("id").alias("a"), F.lit(hub).cast("long").alias("b"))
    chain = spark.range(2_000_000, 2_000_040).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = connected_components(star.unionByName(chain)).groupBy("component").count().collect()
    assert {tuple(r) for r in got} == {(1, leaves + 1), (2_000_000, 41)}


def test_a_hubs_join_can_be_split(spark, monkeypatch):
    from lumencube.llm import components

    plans = []

    def kept(frame, path, *rest):
        if "/large" in path or "/cc" in path:
            plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return real(frame, path, *rest)

    real = components.written
    monkeypatch.setattr(components, "written", kept)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    components.connected_components(spark.createDataFrame([(1, 9), (2, 9), (3, 9)], "a long, b long")).collect()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [p for p in plans if "SortMergeJoin" in p]
    assert len(joins) > 3
    for plan in joins:
        below = plan.split("SortMergeJoin", 1)[1]
        assert below.count("Exchange") == 2 and "HashAggregate" not in below
