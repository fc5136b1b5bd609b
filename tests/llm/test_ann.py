import numpy as np

from ledgerlake.llm.ann import ROUTES, Forest, _plan, nearest
from ledgerlake.llm.queries import QUERIES
from pyspark.sql import functions as F


def exact(ids, vectors, k=5):
    u = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    out = {}
    for i, q in enumerate(u):
        if ids[i] % 50 == 0:
            score = u @ q
            score[i] = -9
            out[ids[i]] = set(ids[np.argsort(-score)[:k]])
    return out


def test_recall_of_the_query(spark):
    folder = "/root/testdata/sf0.01"
    data = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    ids, vectors = data.vec_id.to_numpy(), np.stack(data.embedding).astype(float)
    found = QUERIES["op2_neighbours"](spark, folder).toPandas()
    truth, u = exact(ids, vectors), {i: v for i, v in zip(ids, vectors)}
    assert set(found.query_id) == set(truth)
    hit = sum(len(truth[q] & set(g.vec_id)) for q, g in found.groupby("query_id"))
    assert hit >= 0.9 * 5 * len(truth)
    for q, g in found.groupby("query_id"):
        g = g.sort_values("rank")
        assert g["rank"].tolist() == [1, 2, 3, 4, 5] and g.score.is_monotonic_decreasing
        for v, s in zip(g.vec_id, g.score):
            assert abs(s - u[q] @ u[v] / np.linalg.norm(u[q]) / np.linalg.norm(u[v])) < 1e-12


def test_clusters_need_few_candidates():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((60, 48))
    vectors = np.repeat(centres, 20, axis=0) + 0.1 * rng.standard_normal((1200, 48))
    forest = Forest(vectors)
    sizes, hits = [], 0
    for q, at in forest.candidates(vectors[:100], forest.tune(5)):
        score = vectors @ vectors[q] / np.linalg.norm(vectors, axis=1)
        score[q] = -np.inf
        hits += len(set(np.argsort(-score)[:5]) & set(at))
        sizes.append(len(at))
    assert hits >= 450 and np.mean(sizes) < 200


def table_of(spark, vectors):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def recall(vectors, found, k=5):
    truth = exact(np.arange(len(vectors)), vectors, k)
    assert set(found.query_id) == set(truth)
    return sum(len(truth[q] & set(g.vec_id)) for q, g in found.groupby("query_id")) / (k * len(truth))


def blocks_met(spark, vectors, block):
    rows = table_of(spark, vectors).select(F.col("vec_id").alias("row"), F.col("embedding").alias("vec"), F.size("embedding").alias("dim"))
    (trees, depth, level), = _plan(rows, 5, block).values()
    return trees << (depth - level), 1 << depth, trees


def test_queries_of_clusters_meet_few_blocks_and_fewer_as_the_table_grows(spark):
    rng = np.random.default_rng(5)
    shares = []
    for clusters in (150, 600):
        centres = rng.standard_normal((clusters, 32))
        vectors = np.repeat(centres, 20, axis=0) + 0.05 * rng.standard_normal((20 * clusters, 32))
        met, blocks, trees = blocks_met(spark, vectors, 128)
        shares.append(met / blocks / trees)
        found = nearest(table_of(spark, vectors), F.col("vec_id") % 50 == 0, block=128).toPandas()
        assert recall(vectors, found) >= 0.9
    assert shares[1] <= shares[0] / 2 and shares[1] <= 0.1


def test_without_structure_all_blocks_are_met(spark):
    vectors = np.random.default_rng(6).standard_normal((1000, 48))
    met, blocks, trees = blocks_met(spark, vectors, 128)
    assert met <= blocks and trees <= ROUTES
    found = nearest(table_of(spark, vectors), F.col("vec_id") % 50 == 0, block=128).toPandas()
    assert recall(vectors, found) >= 0.9


def test_a_third_of_equal_vectors_and_two_lengths(spark):
    rng = np.random.default_rng(7)
    same, others, short = np.ones((400, 8)), rng.standard_normal((800, 8)), rng.standard_normal((30, 3))
    rows = [(i, v.tolist()) for i, v in enumerate([*same, *others, *short])]
    found = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, block=100).toPandas()
    for q in (0, 50, 350):
        got = found[found.query_id == q].sort_values("rank")
        assert got.vec_id.tolist() == [i for i in range(6) if i != q][:5] and (abs(got.score - 1) < 1e-12).all()
    assert (found.groupby("query_id").size() == 5).all() and not found.duplicated(["query_id", "vec_id"]).any()
    last = found[found.query_id == 1200]
    assert (last.vec_id >= 1200).all() and not (found[found.query_id < 1200].vec_id >= 1200).any()


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [1.0, nan]), (6, [inf, 1.0]), (7, [1.0, None]),
        (8, [1.0, 0.0, 0.0]), (9, []), (50, [3.0, 0.0]), (50, [3.0, 0.0]), (None, [5.0, 0.0]), (100, None), (150, [1e-200, 0.0]),
    ]
    vectors = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, row int, score string")
    found = nearest(vectors, F.col("vec_id") % 50 == 0).collect()
    by = {}
    for r in found:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, round(r.score, 9)))
    assert sorted(by[0]) == [(1, 1, 1.0), (2, 50, 1.0), (3, 50, 1.0), (4, 150, 1.0), (5, None, 1.0)]
    assert len(by[50]) == 10 and sorted(by[150])[0] == (1, 0, 1.0) and 100 not in by
    few = nearest(vectors.filter("vec_id in (0, 2, 8)"), F.col("vec_id") % 50 == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in few] == [(0, 1, 2)]
    assert nearest(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0
