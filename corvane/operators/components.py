"""Connected components of an edge table.

Alternating large-star and small-star rounds: every round is two partially
aggregated group-bys and two joins on node ids, and the number of rounds grows
with the logarithm of the longest path. A large star keeps one row per node
for each neighbour, so a hub of any degree is never gathered into a list. A
table that is counted to be small is joined by one task instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.runtime import settle

#: Edges up to which one task joins them in memory (16 bytes an edge); beyond it the rounds are distributed.
LOCAL_EDGES = 1_000_000


def _local(batches):
    """Union-find over a bounded edge table: rows (node, component)."""
    import numpy as np
    import pandas as pd

    parts = [(b["u"].to_numpy(), b["v"].to_numpy()) for b in batches]
    if not parts:
        return
    u, v = (np.concatenate(x) for x in zip(*parts))
    names, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    up = np.arange(len(names))
    while len(a):
        while not np.array_equal(up, nxt := up[up]):
            up = nxt
        x, y = up[a], up[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
    yield pd.DataFrame({"node": names, "component": names[up]})


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Relink each node's larger (or smaller) neighbours to its least one."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.where("v < u")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        # the node itself hangs below its least neighbour, as do the others
        out = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60, local_edges: int | None = None) -> DataFrame:
    """``edges`` (u, v: same ordered type) to rows (node, component).

    ``component`` is the least node reachable, the node itself included. Rows
    with a null end are dropped, loops and repeats do no harm; nodes that have
    no edge do not occur in the result. An empty table gives an empty table.
    The result is the same on either side of ``local_edges`` (``LOCAL_EDGES``).
    """
    now = settle(
        edges.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    small = LOCAL_EDGES if local_edges is None else local_edges
    if now.limit(small + 1).count() <= small:
        kind = now.schema["u"].dataType.simpleString()
        return now.coalesce(1).mapInPandas(_local, f"node {kind}, component {kind}")
    mark = None
    for _ in range(max_rounds):
        now = settle(_star(_star(now, True), False))
        row = now.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        if (row["n"], row["h"]) == mark:
            break
        mark = (row["n"], row["h"])
    else:
        raise RuntimeError("components did not settle")
    links = now.groupBy("u").agg(F.min("v").alias("component"))
    roots = now.select("v").distinct().join(links, F.col("v") == F.col("u"), "left_anti")
    return links.select(F.col("u").alias("node"), "component").union(roots.select(F.col("v").alias("node"), F.col("v").alias("component")))
