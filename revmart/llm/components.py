"""Connected components of a graph given as edges, by union-find and stars.

The first round shrinks each partition's edges to a star per local tree by
union-find (trees of at most ``TREE_NODES`` nodes at a time, so a task's memory
does not follow its rows); every round then points every
node's neighbours at the smallest one it sees (large star, small star). The
rounds end when nothing moves; each round's edges are cut from their lineage
by a reliable checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmart.llm.common import checkpointed, keyed_table

EDGE = "u long, v long"
#: Nodes that a task's trees hold before they are written as stars and begun anew (some 20 MB).
TREE_NODES = 1 << 17


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over one partition's edges; each node with its smallest peer
    among the edges since the trees were last begun."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def stars() -> Iterator[pa.RecordBatch]:
        nodes = list(parent)
        for at in range(0, len(nodes), 10_000):
            pairs = [(x, find(x)) for x in nodes[at : at + 10_000]]
            pairs = [(u, v) for u, v in pairs if u != v]
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["u", "v"])
        parent.clear()

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            a, b = find(u), find(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) >= TREE_NODES:
            yield from stars()
    yield from stars()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (``u``, ``v``: longs) to ``node``, ``component``: every node
    that has an edge to another, and the smallest node of its component.

    Loops and repeated edges are allowed, edges with a NULL end are ignored;
    no edges give no rows.
    """
    stars = edges.where("u is not null and v is not null and u <> v").select("u", "v")
    # edges come in many small partitions; a tree grown over more of them leaves fewer rows
    stars = stars.coalesce(2 * edges.sparkSession.sparkContext.defaultParallelism)
    stars = checkpointed(stars.mapInArrow(_local_stars, EDGE))  # v < u from here on
    moved = stars.limit(1).count()
    while moved:
        # large star: every larger neighbour of a node to the node's smallest peer
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = keyed_table(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        after = checkpointed(small)
        # settled: every node has one parent and no parent has one
        parents = after.groupBy("u").agg(F.count("*").alias("n"))
        moved = (
            parents.where("n > 1").limit(1).count()
            or after.join(parents.select(F.col("u").alias("p")), after["v"] == F.col("p"), "left_semi").limit(1).count()
        )
        stars = after
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
