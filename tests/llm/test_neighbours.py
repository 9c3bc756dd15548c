"""Nearest neighbours: recall against brute force, exact scores and ranks, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedward.llm.neighbours import nearest_neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SCHEMA)


def plain(query, vector):
    """The inner product, component by component."""
    total = 0.0
    for a, b in zip(query.tolist(), vector.tolist(), strict=True):
        total += a * b
    return total


def exact(rows, k):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([np.float32(v) for _, v in rows]).astype(float)
    out = {}
    for i, v in zip(ids, vectors, strict=True):
        if i % 20 == 0:
            scores = [plain(v, other) for other in vectors]
            best = sorted((-s, j) for s, j in zip(scores, ids, strict=True) if j != i)[:k]
            out[int(i)] = [(int(j), -s) for s, j in best]
    return out


def clustered(n, seed, dimension=24):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dimension))
    vectors = centres[rng.integers(0, 12, n)] + 0.8 * rng.normal(size=(n, dimension))
    return [(i, v * rng.uniform(0.5, 2)) for i, v in enumerate(vectors.astype(np.float32))]


@pytest.mark.parametrize("options", [{}, {"bucket_rows": 40, "shard_rows": 50, "shard_queries": 20}])
def test_recall(spark, options):
    rows = clustered(3000, 1)
    found = nearest_neighbours(table(spark, rows), **options).toPandas().sort_values(["query_id", "rank"])
    truth = exact(rows, 20)
    vectors = np.array([v for _, v in rows]).astype(float)
    hits = 0
    for query, group in found.groupby("query_id"):
        assert group["rank"].tolist() == list(range(1, len(group) + 1)) and len(group) <= 20
        assert query not in group["vec_id"].tolist()
        assert group["score"].tolist() == [plain(vectors[query], vectors[j]) for j in group["vec_id"]]
        assert group["score"].is_monotonic_decreasing
        hits += len({j for j, _ in truth[query]} & set(group["vec_id"]))
    assert set(found["query_id"]) == set(truth)
    assert hits / sum(map(len, truth.values())) >= 0.9


def test_copies_and_odd_rows(spark):
    rows = clustered(60, 3, 8)
    hot = np.ones(8, np.float32)
    rows += [(i, hot) for i in range(100, 180)]
    odd = [(200, None), (220, [0.0] * 8), (240, [np.nan] + [1.0] * 7), (260, [None] + [1.0] * 7), (280, [np.inf] + [1.0] * 7),
           (300, [1.0] * 5), (None, hot), (100, hot), (320, [])]
    wide = table(spark, rows + odd).withColumn("score", F.lit("x")).withColumn("rank", F.lit(0))
    found = nearest_neighbours(wide).toPandas().sort_values(["query_id", "rank"])
    truth = exact(rows, 20)
    assert set(found["query_id"]) == set(truth)
    for query in (100, 120, 140, 160):
        got = found[found["query_id"] == query]
        want = truth[query]
        # Equal vectors, hence equal scores: ties go to the smaller ids.
        assert list(zip(got["vec_id"], got["score"], strict=True)) == want
    assert nearest_neighbours(wide.limit(0)).count() == 0
    few = nearest_neighbours(table(spark, [(20, [1.0, 0.0]), (3, [0.5, 0.5]), (4, [0.0, 0.0])])).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in few] == [(20, 1, 3, 0.5)]


def hot_cluster(n, seed, dimension=24):
    """A third of all rows in one dense cluster, the others in clusters, and queries far from all of them."""
    rng = np.random.default_rng(seed)
    rows = clustered(n, seed, dimension)
    hot = rng.normal(size=dimension)
    rows = [(i, hot + 0.01 * rng.normal(size=dimension) if i % 3 == 0 else v) for i, v in rows]
    rows = [(i, 30 * rng.normal(size=dimension) if i % 400 == 20 else v) for i, v in rows]
    return [(i, np.asarray(v, np.float32)) for i, v in rows]


@pytest.mark.parametrize("options", [{}, {"bucket_rows": 4, "exact_queries": 3}, {"bucket_rows": 4, "width": 0.3}])
def test_every_query_has_all_its_rows(spark, options):
    rows = hot_cluster(1500, 7)
    found = nearest_neighbours(table(spark, rows), **options).toPandas().sort_values(["query_id", "rank"])
    truth = exact(rows, 20)
    assert found.groupby("query_id").size().to_dict() == {query: 20 for query in truth}
    vectors = np.array([v for _, v in rows]).astype(float)
    hits = 0
    for query, group in found.groupby("query_id"):
        assert group["rank"].tolist() == list(range(1, 21)) and group["vec_id"].is_unique
        assert query not in group["vec_id"].tolist()
        assert group["score"].tolist() == [plain(vectors[query], vectors[j]) for j in group["vec_id"]]
        hits += len({j for j, _ in truth[query]} & set(group["vec_id"]))
    assert hits / sum(map(len, truth.values())) >= 0.9


def test_few_rows_are_all_found_and_own_vectors_do_not_count(spark):
    rng = np.random.default_rng(2)
    few = [(i, v) for i, v in enumerate(rng.normal(size=(12, 8)))]
    found = nearest_neighbours(table(spark, few), bucket_rows=1, width=0.2).toPandas()
    assert found["query_id"].tolist() == [0] * 11 and set(found["vec_id"]) == set(range(1, 12))
    hot = np.ones(8)
    several = [(0, hot + 0.001 * rng.normal(size=8)) for _ in range(40)] + [(i, v) for i, v in few if i]
    found = nearest_neighbours(table(spark, several)).toPandas()
    assert len(found) == 40 * 11 and 0 not in found["vec_id"].tolist()


def test_scores_do_not_depend_on_shards_or_partitions(spark):
    data = table(spark, clustered(1200, 5))
    options = [{}, {"shard_rows": 70}, {"shard_rows": 333, "shard_queries": 7}]
    found = [nearest_neighbours(data.repartition(n), **o).collect() for n, o in zip((1, 7, 3), options, strict=True)]
    assert len({frozenset(tuple(row) for row in rows) for rows in found}) == 1


def test_lengths_are_searched_by_themselves(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=8 if i % 3 else 5)) for i in range(240)]
    found = nearest_neighbours(table(spark, rows)).toPandas().sort_values(["query_id", "rank"])
    groups = [[r for r in rows if len(r[1]) == n] for n in (5, 8)]
    truth = exact(groups[0], 20) | exact(groups[1], 20)
    assert set(found["query_id"]) == set(truth) == {i for i, _ in rows if i % 20 == 0}
    lengths = {i: len(v) for i, v in rows}
    assert all(lengths[q] == lengths[j] for q, j in zip(found["query_id"], found["vec_id"], strict=True))
    hits = sum(len({j for j, _ in truth[q]} & set(g["vec_id"])) for q, g in found.groupby("query_id"))
    assert hits / sum(map(len, truth.values())) >= 0.9


def test_exact_search_deals_no_row(spark):
    from feedward.llm import neighbours

    rows = clustered(300, 4)
    pool = table(spark, rows).selectExpr("vec_id", "CAST(embedding AS array<double>) AS vec")
    key = F.struct(F.xxhash64("vec_id").alias("x"), F.lit(1).cast("long").alias("y")).alias("query")
    queries = pool.filter("vec_id % 20 = 0").select(key, F.col("vec_id").alias("query_id"), "vec")
    found = neighbours._exact(pool, queries, 20, 4).toPandas().sort_values(["query_id", "rank"])
    truth = exact(rows, 20)
    assert {q: list(zip(g["vec_id"], g["score"], strict=True)) for q, g in found.groupby("query_id")} == truth
