"""Connected components of a distributed edge list, by alternating stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import stored


#: Ids of hot nodes that a join broadcasts at most, and neighbours that a hot node has at least.
HOT_IDS, HOT_NEIGHBOURS = 100_000, 64


def components(edges: DataFrame, hot_neighbours: int = HOT_NEIGHBOURS) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Each round links every node's larger neighbours to its smallest one, then its
    smaller neighbours likewise, until nothing changes: a logarithmic number of rounds,
    each two aggregates that combine on the map side and two equi-joins, in which the links
    of a star's centre stay where they are read. Edges are written to the shared folder
    after a round; none reach the driver. Links of a node to itself, with a NULL and
    repeated ones count for nothing.
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
               "edges")
    state = _state(e)
    while state[0]:
        hot = max(hot_neighbours, 2 * state[0] // HOT_IDS)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_with_least(both, hot)[0].where("v > u")
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")))
        met, low = _with_least(stored(large, "large"), hot)
        small = (met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = stored(small, "edges")
        last, state = state, _state(e)
        if state == last:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _with_least(edges: DataFrame, hot: int) -> tuple[DataFrame, DataFrame]:
    """``edges`` (u, v) with m, the least v of their u; and u with m once each.

    Nodes with over ``hot`` edges are joined by broadcast, so that no task meets all edges of
    one. Of ``E`` edges fewer than ``E / hot`` nodes have so many, which bounds what is sent.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    centres = F.broadcast(least.where(F.col("n") > hot).select("u", "m"))
    others = least.where(F.col("n") <= hot).select("u", "m")
    met = edges.join(centres, "u").unionByName(edges.join(centres.select("u"), "u", "left_anti").join(others, "u"))
    return met, least.select("u", "m")


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def spanning_roots(n: int, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For ``n`` items and links between them, the item of least ``rank`` that each one reaches."""
    order = np.argsort(rank, kind="stable")
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    low = place.copy()  # least place reached so far
    while True:
        new = low.copy()
        np.minimum.at(new, left, low[right])
        np.minimum.at(new, right, low[left])
        new = new[order[new]]  # jump to what the reached item reaches
        if (new == low).all():
            break
        low = new
    return order[low]
