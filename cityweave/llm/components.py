"""Connected components by alternating large-star and small-star steps.

Edges stay distributed; each round is written to the shared folder, so a lost
executor re-reads the last round.  The driver sees one count and checksum a
round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityweave.llm.shared import written

MAX_ROUNDS = 100


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (least node reachable) for every node of ``edges(a, b)`` but the components' own least nodes.

    Loops and repeated edges are allowed; edges with a null end are ignored.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links, seen = written(links, "edges"), None
    for _ in range(MAX_ROUNDS):
        state = links.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
        if state == seen or not state[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = state
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = written(small.unionByName(least.withColumnRenamed("m", "b")).distinct(), "edges")
    raise RuntimeError(f"components did not settle within {MAX_ROUNDS} rounds")
