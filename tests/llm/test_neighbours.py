"""Nearest neighbours: recall against brute force, exact scores, edge cases."""

import numpy as np
from pyspark.sql import functions as F

from revmart.llm import registry
from revmart.llm.neighbours import nearest_neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=20, every=20):
    """{query: [(id, score)]} over sound vectors of the query's length."""
    sound = [
        (i, np.array(v, dtype=np.float32).astype(float)) for i, v, *_ in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    out = {}
    for q, v in sound:
        if q % every == 0:
            scored = [(-float(v @ w), i) for i, w in sound if i != q and len(w) == len(v)]
            out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def found_of(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(found, want):
    return np.mean([len({i for i, _ in found[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want])


def test_query_recall(spark, sf01):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf01}/embeddings.parquet").collect()]
    found, want = found_of(registry.QUERIES["op8_pruned_graph_neighbours"](spark, sf01)), brute(rows)
    assert found.keys() == want.keys() and recall(found, want) >= 0.98
    vectors = {i: np.array(v, dtype=float) for i, v, *_ in rows}
    assert all(abs(s - vectors[q] @ vectors[i]) < 1e-12 for q in found for i, s in found[q])


def test_several_shards_and_blocks(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.3 * rng.normal(size=16)).astype(float).tolist(), 0) for i in range(2400)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = found_of(nearest_neighbours(df, F.col("vec_id") % 20 == 0, shard_rows=500, query_block=40, search_beam=80))
    want = brute(rows)
    assert found.keys() == want.keys() and recall(found, want) >= 0.95


def test_copies_and_ties_go_by_id(spark):
    rows = [(i, [1.0, 2.0], 0) for i in range(300)] + [(1000 + i, [0.5, float(i)], 0) for i in range(3)]
    found, want = found_of(nearest_neighbours(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0)), brute(rows)
    assert found == want


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (20, [0.0, 1.0], 1), (3, [0.0, 0.0], 1), (40, None, 1), (5, [nan, 1.0], 1), (60, [inf, 1.0], 1), (7, [None, 1.0], 1),
            (8, [], 1), (None, [1.0, 1.0], 1), (9, [-3.0, 4.0], 1), (80, [1.0, 2.0, 3.0], 1), (11, [3.0, 2.0, 1.0], 1), (20, [0.0, 1.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA + "").selectExpr("*", "1 as shard", "2 as id", "'x' as vector", "0.5 as score")
    found = found_of(nearest_neighbours(df, F.col("vec_id") % 20 == 0))
    assert {q: [i for i, _ in hits] for q, hits in found.items()} == {0: [20, 20, 9], 20: [9, 0], 80: [11]}
    assert nearest_neighbours(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0
    assert nearest_neighbours(spark.createDataFrame([(0, [1.0], 1)], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0


def test_an_id_stored_often_hides_no_other(spark):
    rows = [(20, [1.0, 0.0], 0)] * 25 + [(i, [1.0, 0.0], 0) for i in range(1000, 1005)] + [(i, [0.5, 0.1], 0) for i in range(2001, 2031)]
    found = found_of(nearest_neighbours(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0))
    assert found == brute(rows)
    assert [i for i, _ in found[20][:5]] == [1000, 1001, 1002, 1003, 1004]
