"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import drop, materialize, steps


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: every node hands its neighbours to the smallest of them.

    ``edges`` has ``u > v``. The large star looks at all neighbours and moves the larger
    ones; the small star moves a node's smaller neighbours.
    """
    if large:
        around = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.select("u", "v")
    least = around.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    joined = around.join(least, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").bitwiseAND(F.lit((1 << 40) - 1)))).first()


def components(edges: DataFrame, tag: str = "components") -> DataFrame:
    """``node, component`` for every node of the links ``a, b``; component is the smallest node.

    Each step is two aggregations and joins over edges and is written to the shared
    folder, so lineage stays short. The number of edges never grows, stars settle in a
    number of steps that grows with the logarithm of the longest chain, and only a count
    and a checksum reach the driver. Self-links and repeated links are ignored; nodes
    with no other link are absent.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = materialize(e, tag)
    before = None
    while True:
        state = _state(e)
        if state == before:
            break
        before = state
        with steps() as own:
            moved = own.keep(_star(materialize(_star(e, True), tag), False), tag)
        drop(e)
        e = moved
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
