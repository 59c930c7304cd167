"""Connected components by contraction, as joins over the links that are left.

Up to `LOCAL` links, 16 bytes each, are contracted in the driver's arrays in the same way.

Defined results: links of a node with itself and repeated links change nothing; a null
end makes no link; without links there are no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import Scratch

#: Links that the driver contracts by itself, in about 20 MB; with more, joins do.
LOCAL = 200_000


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """node, comp (the smallest node reachable) for the nodes of links (a, b).

    Each round points every node at its smallest neighbour, follows these pointers twice
    and maps the links through them; links inside a component vanish. The number of
    links at least halves along any path, so rounds grow with the log of the longest.
    """
    edges = scratch.table(links.where("a != b").select("a", "b"))
    if edges.count() <= LOCAL:
        ends = edges.toArrow()
        node, comp = contracted(*(ends[x].to_numpy() for x in "ab"))
        found = scratch.spark.createDataFrame(pa.table({"node": node, "comp": comp}), "node long, comp long")
        return scratch.table(found, drop=[edges])
    edges = scratch.table(ordered(edges), drop=[edges])
    comp = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("comp"))
    known = scratch.table(comp)
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("to")).select(F.col("a").alias("from"), "to")
        first = scratch.table(to)
        up = first
        for _ in range(2):
            again = first.select(F.col("from").alias("to"), F.col("to").alias("_next"))
            up = up.join(again, "to", "left").select("from", F.coalesce("_next", "to").alias("to"))
        up = scratch.table(up, drop=[first])
        low = up.select(F.col("from").alias("a"), F.col("to").alias("_a"))
        high = up.select(F.col("from").alias("b"), F.col("to").alias("_b"))
        mapped = edges.join(low, "a").join(high, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
        edges = scratch.table(ordered(mapped), drop=[edges])
        known = scratch.table(known.join(up, F.col("comp") == F.col("from"), "left").select("node", F.coalesce("to", "comp").alias("comp")), drop=[known, up])
    scratch.drop(edges)
    return known


def contracted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ends of the links (a, b) and the smallest node that each reaches."""
    nodes, ends = np.unique(np.concatenate((a, b)).astype(np.int64), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    comp = np.arange(len(nodes))
    while len(x):
        up = np.arange(len(nodes))
        np.minimum.at(up, x, y)
        np.minimum.at(up, y, x)
        while not np.array_equal(up, again := up[up]):
            up = again
        comp, x, y = up[comp], up[x], up[y]
        x, y = x[x != y], y[x != y]
    return nodes, nodes[comp]


def ordered(links: DataFrame) -> DataFrame:
    """Distinct links between two nodes, the smaller first."""
    return links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def merged(comp: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """``comp`` (node, comp) after further links (a, b); nodes that it lacks are their own.

    Only the links between components are worked on, up to `LOCAL` rows of both in the
    driver's arrays. ``comp`` is dropped.
    """
    if links.count() + comp.count() <= LOCAL:
        old, new = comp.toArrow(), links.where("a != b").toArrow()
        a, b = (np.concatenate((old[x].to_numpy(), new[y].to_numpy())) for x, y in (("node", "a"), ("comp", "b")))
        node, low = contracted(a, b)
        found = scratch.spark.createDataFrame(pa.table({"node": node, "comp": low}), "node long, comp long")
        return scratch.table(found, drop=[comp])
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    new = ends.join(comp, "node", "left_anti").select("node", F.col("node").alias("comp"))
    every = scratch.table(comp.unionByName(new))
    a, b = (every.select(F.col("node").alias(x), F.col("comp").alias(f"_{x}")) for x in "ab")
    between = links.join(a, "a").join(b, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    found = connected_components(between, scratch)
    up = found.select(F.col("node").alias("_from"), F.col("comp").alias("_to"))
    return scratch.table(every.join(up, F.col("comp") == F.col("_from"), "left").select("node", F.coalesce("_to", "comp").alias("comp")), drop=[every, comp, found])
