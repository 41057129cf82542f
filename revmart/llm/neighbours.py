"""Approximate nearest neighbours by robust-pruned directed graphs.

Vectors are dealt by hash to shards of about ``shard_rows``; each shard gets
a graph of its own (``neighbour_graph``), and every query searches every
shard by a beam. The shards' best are merged to the query's best.

Copies of a vector are one point of the graph, which keeps as many of their
distinct ids as a query can need, the smallest ones, and how often each occurs: no copy is lost to a full edge
list, and ties between copies go by id exactly.

Scale. Building is linear: a task holds one shard. Searching sends every
block of ``query_block`` queries to every shard; a task holds one block and
one shard. Both sizes are fixed, so more vectors make more tasks, not larger
ones. Hot vectors are cut to the ids they need before the shuffle.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revmart.llm.common import buckets_for, checkpointed, require_columns
from revmart.llm.neighbour_graph import beam_search, build_graph, lifted

SHARD_ROWS = 4096
QUERY_BLOCK = 4096
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 160
ALPHA = 1.2
SEED = 7
SEARCH_ROWS = 256  # queries that step through a graph together
INDEX = "dim int, shard int, entry boolean, vector array<double>, ids array<long>, times array<long>, edges array<int>"
FOUND = "query_id long, vec_id long, score double"


def _sound(vector: Column) -> Column:
    """Not NULL, not zero, every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def distinct_vectors(vectors: DataFrame, copies: int) -> DataFrame:
    """One row per distinct vector with its ``copies`` smallest ids (``ids``)
    and how often each occurs (``times``, cut at ``copies``)."""
    counted = vectors.groupBy("vector", "id").agg(F.least(F.count("*"), F.lit(copies)).alias("times"))
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    few = counted.withColumn("place", place).where(F.col("place") <= copies)
    held = few.groupBy("vector").agg(F.array_sort(F.collect_list(F.struct("id", "times"))).alias("held"))
    return held.select("vector", F.col("held.id").alias("ids"), F.col("held.times").alias("times"))


def build_index(
    points: DataFrame,
    shard_rows: int = SHARD_ROWS,
    degree: int = DEGREE,
    beam: int = BUILD_BEAM,
    alpha: float = ALPHA,
    seed: int = SEED,
) -> tuple[DataFrame, int]:
    """``points`` (``vector``, ``ids``, ``times``) to the rows of all shards' graphs, and the number of shards.

    Vectors of different lengths are never compared; each length has shards
    of its own. A row has its out-edges as places in the shard, rows in order.
    """
    shards = buckets_for(points.count(), shard_rows)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("first", kind="stable", ignore_index=True)
        vectors = np.array(rows["vector"].tolist(), dtype=np.float64)
        edges, entry = build_graph(lifted(vectors), degree, beam, alpha, seed)
        return pd.DataFrame({
            "dim": rows["dim"], "shard": rows["shard"], "entry": np.arange(len(rows)) == entry,
            "vector": list(vectors), "ids": rows["ids"], "times": rows["times"], "edges": list(edges.astype(np.int32)),
        })

    dealt = points.select(
        F.size("vector").alias("dim"),
        F.pmod(F.xxhash64(F.lit("shard"), "vector"), F.lit(shards)).cast("int").alias("shard"),
        F.col("vector").cast("array<double>").alias("vector"),
        "ids",
        "times",
        F.col("ids")[0].alias("first"),
    )
    dealt = dealt.repartition(4 * shards, "dim", "shard")  # few heavy groups: AQE would gather them in fewer tasks
    return dealt.groupBy("dim", "shard").applyInPandas(lambda r: build(r), INDEX), shards


def _search(beam: int, k: int):
    def search(queries: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or index.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        index = index.sort_values("first", kind="stable", ignore_index=True)
        vectors = np.array(index["vector"].tolist(), dtype=np.float64)
        edges = np.array(index["edges"].tolist(), dtype=np.int64)
        entry = int(index["entry"].to_numpy().argmax())
        points = lifted(vectors)
        norms = np.einsum("ij,ij->i", points, points)
        copies = [np.repeat(i, t) for i, t in zip(index["ids"], index["times"], strict=True)]
        out: list[tuple[int, int, float]] = []
        wanted = np.array(queries["vector"].tolist(), dtype=np.float64)
        own = queries["id"].to_numpy()
        for a in range(0, len(wanted), SEARCH_ROWS):
            part = wanted[a : a + SEARCH_ROWS]
            found, _ = beam_search(points, norms, edges, entry, np.column_stack([part, np.zeros(len(part))]), beam)
            scores = np.einsum("qd,qkd->qk", part, vectors[np.maximum(found, 0)])
            scores[found < 0] = -np.inf
            best = np.argsort(-scores, axis=1, kind="stable")[:, : k + 1]
            for i, row in enumerate(best):
                query = int(own[a + i])
                hits = [(-scores[i, j], v) for j in row if found[i, j] >= 0 for v in copies[found[i, j]] if v != query]
                out += [(query, int(v), float(-s)) for s, v in sorted(hits)[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return search


def nearest_neighbours(
    embeddings: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    query_block: int = QUERY_BLOCK,
    degree: int = DEGREE,
    build_beam: int = BUILD_BEAM,
    search_beam: int = SEARCH_BEAM,
    alpha: float = ALPHA,
) -> DataFrame:
    """For every row that ``is_query`` holds for, the ``k`` other rows found
    with the largest inner product: ``query_id``, ``rank`` (from 1),
    ``vec_id``, ``score`` (in double precision). Ties go to the smaller id.

    Vectors that are NULL, empty, zero, or hold a NULL, NaN or infinity take
    no part, nor do rows without an id. Ids are numbers. Rows that share an id ask
    with the least of their vectors. Repeated rows are found as often as
    they occur, but a query finds no row with its own id. With fewer than ``k`` other rows a
    query finds all. An empty table gives no rows.
    """
    require_columns(embeddings, id_col, vector_col)
    sound = embeddings.where(F.col(id_col).isNotNull() & _sound(F.col(vector_col)))
    vectors = sound.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    points = checkpointed(distinct_vectors(vectors, k + 1))
    index, shards = build_index(points, shard_rows, degree, build_beam, alpha)

    asking = sound.where(is_query).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    queries = asking.groupBy("id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector"))
    blocks = buckets_for(queries.count(), query_block)
    block = F.pmod(F.xxhash64(F.lit("block"), "id"), F.lit(blocks)).cast("int")
    parts, keys = 4 * shards * blocks, ["dim", "shard", "block"]
    asked = queries.withColumn("block", block).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    served = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("first", F.col("ids")[0])
    found = (
        asked.repartition(parts, *keys).groupBy(*keys)
        .cogroup(served.repartition(parts, *keys).groupBy(*keys))
        .applyInPandas(lambda q, i: _search(search_beam, k)(q, i), FOUND)
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
