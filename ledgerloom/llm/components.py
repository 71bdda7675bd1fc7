"""Connected components: tasks contract their links, alternating large-star and small-star steps connect the rest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean_checkpoint, prepare
from .trie import join_labels

HOT_SHARE = 8  # a hub holds over 1 / (HOT_SHARE * partitions) of all ends
LINKS = 1 << 18  # that a task contracts at a time, about


def _signature(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _with_least(edges: DataFrame, total: int) -> DataFrame:
    """edges with m, the least v of their u.

    The least neighbour of a hub, a node with over 1 / (HOT_SHARE * partitions)
    of all edges, is broadcast: there are fewer than HOT_SHARE * partitions hubs,
    and what is left for the shuffled join is even.
    """
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(1, total // (HOT_SHARE * parts))
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_n"))
    hubs = F.broadcast(least.filter(F.col("_n") > most).select("u", F.col("m").alias("_hub")))
    others = least.filter(F.col("_n") <= most).select("u", "m")
    met = edges.join(hubs, "u", "left")
    return met.filter("_hub is not null").select("u", "v", F.col("_hub").alias("m")).unionByName(met.filter("_hub is null").select("u", "v").join(others, "u"))


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both, 2 * total).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).filter("u != v").distinct()


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    met = _with_least(down, total)
    # an edge to the least neighbour stays, the others move on to it
    return met.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _contracted(edges: DataFrame, total: int) -> DataFrame:
    """Links that connect the same nodes: of every ``LINKS`` links or so, each node and the least one that they connect it with.

    Partitions are as many as so many links need; up to LINKS in all are one, and its links point to the roots.
    """
    most = LINKS

    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        nodes, ends = np.unique(np.concatenate([table.column(c).to_numpy() for c in ("u", "v")]), return_inverse=True)
        root = join_labels(np.arange(len(nodes)), *np.split(ends, 2))
        moved = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[root[moved]])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= most:
                yield stars(held)
                held, n = [], 0
        if n:
            yield stars(held)

    return edges.coalesce(max(1, -(-total // most))).mapInArrow(run, edges.schema)


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """Columns node, root for every node of an edge; root is the least node of its component.

    Links are contracted by tasks before they meet; while more are left than one
    task contracts at a time, stars connect them, round by round. Minima are
    pre-aggregated, and those of hubs are broadcast, so a node with very many
    neighbours is never gathered in one task; every round is checkpointed. Loops,
    repeated and reversed edges change nothing; edges with a null end are ignored;
    no edges give no rows.
    """
    prepare(edges.sparkSession)
    e = lean_checkpoint(edges.select(F.col(u).alias("u"), F.col(v).alias("v")).filter("u != v"))
    before = (e.count(),)
    if before[0] > LINKS:
        e = lean_checkpoint(_contracted(e, before[0]).distinct())
        before = _signature(e)
    while before[0] > LINKS:
        e = lean_checkpoint(_small_star(_large_star(e, before[0]), before[0]))
        after = _signature(e)
        if after == before:
            break
        before = after
    else:
        e = lean_checkpoint(_contracted(e, before[0]))
    # each edge now points from a node to its root
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
