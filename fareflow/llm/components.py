"""Connected components of a link table, as joins and aggregations."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import stored


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of the links (``a``, ``b``, longs).

    Each round every node points to its lowest neighbour (or itself) under an order drawn anew
    for the round, pointers are followed once more, and the links are rewritten to the pointers'
    ends; links inside one end vanish.  Each round at least halves the ends that still have
    links, so a logarithm of the node count suffices.  A hub's links are first reduced by
    partial aggregation; the joins are plain shuffle joins, which AQE splits where a hub is hot.
    Each round's tables are written to the shared folder, so lost executors recompute little.
    """
    def distinct(df: DataFrame) -> DataFrame:
        return stored(df.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")

    links, roots, number = distinct(links), None, 0
    while not links.isEmpty():
        salt = F.lit(random.Random(number).getrandbits(63))
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = F.least(F.min(F.col("b").bitwiseXOR(salt)), F.col("a").bitwiseXOR(salt)).bitwiseXOR(salt)
        hooks = stored(both.groupBy("a").agg(lowest.alias("to")), "hooks")
        jumps = stored(hooks.join(hooks.select(F.col("a").alias("to"), F.col("to").alias("end")), "to")
                       .select(F.col("a").alias("node"), "end"), "jumps")
        if roots is None:
            roots = jumps.select("node", F.col("end").alias("root"))
        else:
            roots = stored(roots.join(jumps.select(F.col("node").alias("root"), "end"), "root", "left")
                           .select("node", F.coalesce("end", "root").alias("root")), "roots")
        links = distinct(links.join(jumps.select(F.col("node").alias("a"), F.col("end").alias("ea")), "a")
                         .join(jumps.select(F.col("node").alias("b"), F.col("end").alias("eb")), "b")
                         .select(F.col("ea").alias("a"), F.col("eb").alias("b")))
        number += 1
    if roots is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
