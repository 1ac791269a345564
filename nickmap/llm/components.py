"""Connected components of a graph given by its edges, for graphs with vertices of any degree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _jumped(hooks: DataFrame) -> DataFrame:
    """``hooks`` (v, root), each pointing to a smaller vertex, with every pointer moved on to the end of its chain."""
    while True:
        further = hooks.select(F.col("v").alias("root"), F.col("root").alias("next"))
        hooks = written(hooks.join(further, "root", "left").select("v", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "hooks")
        if hooks.where("moved").isEmpty():
            return hooks.select("v", "root")
        hooks = hooks.select("v", "root")


def connected_components(edges: DataFrame) -> DataFrame:
    """v, root for each vertex of ``edges`` (u, v of one orderable type): root is the least vertex it can reach.

    Each round hooks every vertex to its least smaller neighbour, follows the hooks to their ends, and contracts the
    edges, so at least half of the vertices that are left with an edge vanish. The hooks of a round are summed by vertex
    before they are dealt out, and all joins are between written tables, whose large keys Spark can split. Edges between
    equal or null vertices count for nothing; without edges the result is empty.
    """
    edges = written(edges.select(F.greatest("u", "v").alias("v"), F.least("u", "v").alias("u")).where("u < v").distinct(), "edges")
    found = None
    while not edges.isEmpty():
        hooks = _jumped(written(edges.groupBy("v").agg(F.min("u").alias("root")), "hooks"))
        mapped = lambda df, name: df.join(hooks.select(F.col("v").alias(name), "root"), name, "left").withColumn(name, F.coalesce("root", name)).drop("root")
        found = hooks if found is None else written(mapped(found.withColumnRenamed("root", "to"), "to").withColumnRenamed("to", "root").unionByName(hooks), "components")
        pairs = mapped(mapped(edges, "u"), "v").where("u <> v")
        edges = written(pairs.select(F.greatest("u", "v").alias("v"), F.least("u", "v").alias("u")).distinct(), "edges")
    if found is None:
        return edges.select("v", F.col("u").alias("root"))
    roots = found.select(F.col("root").alias("v"), "root").distinct()
    return found.unionByName(roots)
