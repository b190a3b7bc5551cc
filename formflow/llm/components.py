"""Connected components by contraction with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formflow.session import materialise


def _jumped(parents: DataFrame) -> DataFrame:
    """Follow (node, root) until every root is its own root: doubles the reach in each step."""
    while True:
        up = parents.select(F.col("node").alias("__node"), F.col("root").alias("__root"))
        stepped = materialise(parents.join(up, parents.root == up["__node"], "left").select(
            "node", F.coalesce("__root", "root").alias("root"), (F.coalesce("__root", "root") != F.col("root")).alias("moved")), "component-roots")
        if stepped.where("moved").isEmpty():
            return stepped.select("node", "root")
        parents = stepped.select("node", "root")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the root is the smallest node of its component.

    Each round hangs every node below its smallest neighbour, follows the pointers, and goes on with the edges between
    different roots, which at least halves their number of nodes. All steps are joins and aggregates on written tables.
    """
    edges = materialise(edges.select("a", "b").where("a <> b").distinct(), "component-edges")
    roots = None
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("near")))
        parents = both.groupBy("node").agg(F.least("node", F.min("near")).alias("root"))
        parents = _jumped(materialise(parents, "component-parents"))
        if roots is None:
            roots = parents
        else:
            up = parents.select(F.col("node").alias("__node"), F.col("root").alias("__root"))
            roots = materialise(roots.join(up, roots.root == up["__node"], "left").select("node", F.coalesce("__root", "root").alias("root")), "component-all")
        of_a, of_b = (parents.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")) for c in "ab")
        edges = materialise(edges.join(of_a, "a").join(of_b, "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "component-edges")
    return roots if roots is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
