"""Connected components of a distributed edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.scratch import Scratch


def components(spark: SparkSession, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node that occurs in an edge; label is the smallest node of its component.

    Each round points every node to its smallest neighbour or itself, replaces nodes by what they point to
    and drops loops and repeats. A component loses at least its non-minimal nodes each round, so the number of
    rounds grows with the logarithm of its size; what is left of the edges is written to the shared folder.
    Null ends and loops link nothing. No edges: an empty result.
    """
    scratch = Scratch(spark, "components")
    kind = edges.schema[a].dataType
    both = edges.select(F.col(a).cast(kind).alias("u"), F.col(b).cast(kind).alias("v")).where("u is not null and v is not null and u <> v")
    left = scratch.keep(both.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges0")
    nodes, turn = None, 0
    while not left.isEmpty():
        turn += 1
        near = left.select("u", "v").unionByName(left.select(F.col("v").alias("u"), F.col("u").alias("v")))
        to = near.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("to"))
        # one jump: to the pointer of the pointer
        jump = to.alias("x").join(to.select(F.col("u").alias("w"), F.col("to").alias("far")), F.col("to") == F.col("w"), "left").select("u", F.coalesce("far", "to").alias("to"))
        jump = scratch.keep(jump, f"to{turn}")
        if nodes is None:
            nodes = jump.select(F.col("u").alias("node"), F.col("to").alias("label"))
        else:
            nodes = nodes.join(jump, F.col("label") == F.col("u"), "left").select("node", F.coalesce("to", "label").alias("label"))
        nodes = scratch.keep(nodes, f"nodes{turn}")
        shrunk = left.join(jump.select(F.col("u").alias("x"), F.col("to").alias("nu")), F.col("u") == F.col("x")).select("nu", "v")
        shrunk = shrunk.join(jump.select(F.col("u").alias("x"), F.col("to").alias("nv")), F.col("v") == F.col("x")).where("nu <> nv")
        left = scratch.keep(shrunk.select(F.least("nu", "nv").alias("u"), F.greatest("nu", "nv").alias("v")).distinct(), f"edges{turn}")
    if nodes is None:
        return left.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return nodes
