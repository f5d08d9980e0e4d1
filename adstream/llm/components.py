"""Connected components of a graph of links, by alternating stars.

Each round hangs a node's larger neighbours on its smallest neighbour, then the
smaller ones on the smallest, until nothing changes. Nodes and links stay in
tables of the shared folder; the driver sees one answer a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstream.llm.tables import discard, split_join, stored


def _hang(links: DataFrame, large: bool) -> DataFrame:
    """Links (a, b) with a > b, hung on the smallest of each node's neighbours."""
    down = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        near = down.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        smallest = near.groupBy("u").agg(F.min("v").alias("m"))
        hung = split_join(near.where("v > u"), smallest, ["u"])
        hung = hung.select(F.col("v").alias("a"), F.least("u", "m").alias("b"))
    else:
        smallest = down.groupBy("u").agg(F.min("v").alias("m"))
        hung = split_join(down, smallest, ["u"])
        rest = hung.select(F.col("v").alias("a"), F.col("m").alias("b"))
        hung = rest.unionByName(smallest.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return hung.where("a <> b").distinct()


def _unsettled(links: DataFrame) -> bool:
    """Whether a node still hangs on two others, or on one that hangs itself."""
    ends = F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("up")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("up")),
    )
    nodes = links.select(F.explode(ends).alias("end")).groupBy("end.node")
    counted = nodes.agg(F.sum("end.up").alias("ups"), F.count("*").alias("ends"))
    return not counted.where("ups > 1 or (ups = 1 and ends > 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of each node with a link, from links (a, b) in any order.

    A component is its smallest node. Null ends and links of a node to itself
    count for nothing; no link gives no row.
    """
    now = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stored(now.where("a <> b").distinct(), "links")
    while _unsettled(now):
        before, now = now, stored(_hang(_hang(now, True), False), "links")
        discard(before)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return roots.unionByName(now.select(F.col("a").alias("node"), F.col("b").alias("component")))
