"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from simmart.llm.common import Scratch, stored
from simmart.operators.skew import splittable_join


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in a link (a, b); root is the smallest node
    of its component.

    In each round a node moves to the neighbour of the smallest hash, its own
    included; links then join the nodes' new places, and those within a place
    go. Hashes change from round to round, so that paths shrink as fast as
    stars. Rounds end when no link is left: their count grows as the logarithm
    of the largest component. Each round's links and moves are stored
    until the result is.
    """
    scratch = Scratch(links.sparkSession, "components")
    links = scratch.stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("place", F.col("node"))
    number = 0
    while not links.isEmpty():
        order = F.xxhash64("b", F.lit(number))
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moves = both.groupBy("a").agg(F.min(F.struct(order.alias("h"), "b")).alias("best"))
        own = F.struct(F.xxhash64("a", F.lit(number)).alias("h"), F.col("a").alias("b"))
        moves = scratch.stored(moves.select("a", F.least("best", own)["b"].alias("to")), "moves")
        moved = splittable_join(links, moves, ["a"]).select("b", F.col("to").alias("x"))
        moved = splittable_join(moved, moves.withColumnRenamed("a", "b"), ["b"]).select("x", F.col("to").alias("y"))
        links = scratch.stored(
            moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "links",
        )
        # Places without links left stay where they are.
        nodes = splittable_join(nodes, moves.withColumnsRenamed({"a": "place"}), ["place"], "left")
        nodes = scratch.stored(nodes.select("node", F.coalesce("to", "place").alias("place")), "places")
        number += 1
    roots = nodes.groupBy("place").agg(F.min("node").alias("root"))
    found = stored(splittable_join(nodes, roots, ["place"]).select("node", "root"), "components")
    scratch.clear()
    return found
