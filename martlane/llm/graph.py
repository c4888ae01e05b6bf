"""Connected components by alternating large and small stars.

Each round replaces edges so that nodes hang on smaller neighbours; after a
logarithmic number of rounds every node hangs on the smallest of its
component.  A round is two aggregations (combined before the shuffle) and
joins back, so a node of any degree is fine; edges are written to the shared
folder after each round, which cuts the lineage, and the round before goes.  A
round reads its edges in tasks of about ``ROWS``, so few edges need few tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martlane.llm.common import discard, stored

ROWS = 250_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges``: u > v.  Large: link the larger neighbours of u to its least;
    small: link u's smaller neighbours, and u, to the least of them."""
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = (edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(least.select("u", F.col("m").alias("v"))))
    return out.filter("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, b) pairs -> (node, component), stored: the smallest node reachable.
    Nodes without a link do not appear; null ends are ignored."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stored(edges.filter("u > v").distinct(), "edges", ROWS)
    state = None
    while True:
        fresh = stored(_star(_star(edges, True), False), "edges", ROWS)
        discard(edges)
        edges, before = fresh, state
        state = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if state == before:
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    out = stored(nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct()),
                 "components", ROWS)
    discard(edges)
    return out
