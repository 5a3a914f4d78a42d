"""Connected components by contraction.

Every node points to the neighbour (or itself) with the smallest hash; edges are rewritten to what
their ends point to, and what has become a loop or a repetition goes. The order of hashes does not
follow the order of ids, so the edges shrink by a constant share each round, and a star needs
two rounds. Pointers and edges are written every round, which cuts lineage and lets a join on a node
of very many edges be split among tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.sources.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node with an edge (a, b); the component is its smallest node."""
    edges = scratch.stage(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    moved: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        place = lambda c: F.xxhash64(F.lit("component"), c)
        nearest = both.groupBy(F.col("a").alias("node")).agg(F.min_by("b", place(F.col("b"))).alias("to"))
        # A node stays where it is if its own hash is the smallest.
        to = F.when(place(F.col("to")) < place(F.col("node")), F.col("to")).otherwise(F.col("node"))
        pointers = scratch.stage(nearest.select("node", to.alias("to")), "pointers")
        moved.append(pointers)
        ends = edges
        for end in ("a", "b"):
            step = pointers.select(F.col("node").alias(end), F.col("to").alias(f"{end}2"))
            ends = ends.join(step, end)
        pairs = ends.filter("a2 <> b2").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
        edges = scratch.stage(pairs.distinct(), "edges")
    if not moved:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    # From the last round back: what a node points to is, later, what that one ended at.
    ended = moved.pop()
    while moved:
        earlier = moved.pop()
        later = ended.select(F.col("node").alias("to"), F.col("to").alias("end"))
        joined = earlier.join(later, "to", "left")
        ended = scratch.stage(joined.select("node", F.coalesce("end", "to").alias("to")), "ends")
    least = scratch.stage(ended.groupBy("to").agg(F.min("node").alias("component")), "least")
    return ended.join(least, "to").select("node", "component")
