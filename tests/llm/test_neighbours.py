import numpy as np
from pyspark.sql import functions as F

from lumencube.llm import neighbours
from lumencube.llm.queries import op8_nearest_vectors

DATA = "/root/testdata/sf0.01"


def plain(rows, k=20, every=20):
    good = {i: np.array(v, np.float64) for i, v in rows if i is not None and v is not None and None not in v and len(v)}
    good = {i: v for i, v in good.items() if np.isfinite(v).all() and v.any()}
    out = {}
    for q in good:
        if q % every == 0:
            scored = sorted((-float(good[q] @ v), i) for i, v in good.items() if i != q and len(v) == len(good[q]))
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) / max(len(w), 1) for q, w in want.items() if w])


def test_recall_and_scores(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want, got = plain(rows), found(op8_nearest_vectors(spark, DATA))
    assert set(got) == set(want) and all(len(got[q]) == 20 for q in want)
    assert recall(got, want) > 0.99
    vectors = {i: np.array(v, np.float64) for i, v in rows}
    for q, list_ in got.items():
        for i, s in list_:
            assert abs(s - vectors[q] @ vectors[i]) < 1e-12


def test_estimates_hold_their_bounds():
    rng = np.random.default_rng(2)
    x, q = rng.standard_normal((500, 96)) + 0.5, rng.standard_normal((40, 96))
    c = x.mean(axis=0)
    code, length, own = neighbours.encode(x, c)
    assert code.shape == (500, 12)
    got, error = neighbours.estimates(code, length, own, 96, q @ neighbours.rotation(96), np.linalg.norm(q, axis=1), 3.0)
    off = np.abs(got - (x - c) @ q.T)
    assert (off <= error).mean() > 0.99
    assert abs((got - (x - c) @ q.T).mean()) < 0.2


def test_edge_cases(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.standard_normal(7).tolist()) for k in range(50)]
    rows += [(60, [1.0] * 7)] * 3 + [(80 + k, [1.0] * 7) for k in range(30)]
    rows += [(120, None), (140, []), (160, [0.0] * 7), (180, [1.0, None] + [1.0] * 5), (200, [float("nan")] * 7), (220, [float("inf")] * 7), (None, [1.0] * 7), (240, [1.0, 2.0]), (260, [3.0, 4.0]), (280, [5.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("vector", F.lit("x")).withColumn("rank", F.lit(0))
    want, got = plain(rows), found(neighbours.nearest(frame))
    assert {q: [i for i, _ in w] for q, w in got.items()} == {q: [i for i, _ in w] for q, w in want.items() if w}
    assert neighbours.nearest(frame.limit(0)).count() == 0


def test_blocks_of_queries_agree(spark, tmp_path):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet")
    index = neighbours.build(rows, str(tmp_path / "index"))
    queries = index.rows.where("vec_id % 50 = 0").select("vec_id", "vector")
    assert found(neighbours.search(index, queries, block_rows=3)) == found(neighbours.search(index, queries))
    loaded = neighbours.Index.load(spark, str(tmp_path / "index"))
    assert found(neighbours.search(loaded, queries)) == found(neighbours.search(index, queries))


def test_repeated_rows_leave_room_for_others(spark, tmp_path):
    way = np.random.default_rng(5).standard_normal(16)
    rows = [row for k in range(1, 401) for row in [(k, (k * way).tolist())] * 2]
    index = neighbours.build(spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1), str(tmp_path / "index"))
    got = found(neighbours.search(index, spark.createDataFrame([(1000, way.tolist())], "vec_id long, vector array<double>")))
    assert [i for i, _ in got[1000]] == list(range(400, 380, -1))


def test_counts_are_inner_products_with_bits():
    rng = np.random.default_rng(7)
    bits, u = rng.integers(0, 2, (130, 192)), rng.integers(0, 16, (9, 192))
    rotated = u * 0.25 - 1.0
    rotated[:, 0], rotated[:, 1] = -1.0, 2.75  # so that u is what quantizing gives
    q = neighbours.Quantized.of(rotated)
    u = np.rint((rotated + 1) * 4).astype(int)
    got = neighbours._counts(neighbours._words(np.packbits(bits.astype(np.uint8), axis=1, bitorder="little")), q.planes)
    assert (got == bits @ u.T).all() and np.allclose(q.lost, 0, atol=1e-9)


def test_scans_read_codes_and_few_rows_survive(spark, tmp_path):
    rng = np.random.default_rng(8)
    frame = spark.createDataFrame([(k, rng.standard_normal(64).tolist()) for k in range(2000)], "vec_id long, embedding array<double>")
    index = neighbours.build(frame, str(tmp_path / "index"))
    assert len(index.rows.first().code) == 64
    queries = index.rows.where("vec_id % 200 = 0").select("vec_id", "vector")
    ids = [r.vec_id for r in queries.collect()]
    block = neighbours._Block.of(np.array(ids), np.array([r.vector for r in queries.collect()]), index.centroids[64], index.seed)
    rows = index.rows.collect()
    vectors = np.array([r.vector for r in rows])
    exact = vectors @ block.vectors.T
    kth = np.sort(exact, axis=0)[-21]
    sieve = neighbours._sieve({64: block}, {64: kth}, 3.0)
    left = index.rows.select(*neighbours.CODES).mapInArrow(sieve, "row long, queries array<int>").collect()
    pairs = {(r.row, j) for r in left for j in r.queries}
    assert len(pairs) < 0.15 * 2000 * len(ids)
    wanted = {(rows[i].row, j) for i, j in zip(*np.nonzero(exact >= kth)) if rows[i].vec_id != ids[j]}
    assert len(wanted & pairs) >= 0.99 * len(wanted)
    plan = neighbours.mapped(index.rows.select(*neighbours.CODES), sieve, "row long, queries array<int>")._jdf.queryExecution().executedPlan().toString()
    assert "vector" not in plan.split("ReadSchema")[1]
