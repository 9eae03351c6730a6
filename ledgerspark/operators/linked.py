"""Keys that belong together because something holds both: connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.scratch import delete, written


def components(edges: DataFrame) -> DataFrame:
    """``key, part`` of all keys in the links ``a, b``; a part is named by its least key.

    In every round a key takes the least name among itself and its neighbours, and then
    the name of the key that it is named after, so names travel twice as far each round.
    A round is written to the shared folder, and only a sum reaches the driver. All
    steps are aggregations and equi-joins on thin rows. No key means no rows.
    """
    both = edges.where("a <> b")
    both = both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both, edge_path = written(both, "links")
    if both.isEmpty():
        return both.select(F.col("a").alias("key"), F.col("b").alias("part"))
    names, path = written(both.groupBy(F.col("a").alias("key")).agg(F.least(F.col("key"), F.min("b")).alias("part")), "names")
    while True:
        near = both.join(names.select(F.col("key").alias("b"), "part"), "b").groupBy(F.col("a").alias("key")).agg(F.min("part").alias("near"))
        taken = names.join(near, "key").select("key", F.least("part", "near").alias("via"), "part")
        further = names.select(F.col("key").alias("via"), F.col("part").alias("next"))
        moved = taken.join(further, "via").select("key", F.least("via", "next").alias("part"), (F.least("via", "next") != F.col("part")).alias("moved"))
        after, after_path = written(moved, "names")
        still = after.where("moved").limit(1).count()
        delete(path)
        names, path = after.select("key", "part"), after_path
        if not still:
            delete(edge_path)
            return names
