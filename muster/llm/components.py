"""Connected components of links, by contraction.

Each round, every vertex points to the neighbour (or itself) of least priority,
by a hash that differs between rounds; pointers are followed once more, and
links are rewritten to the vertices reached, without repeats and loops.  The
number of vertices that still have links falls by a constant factor a round, so
long chains take a logarithmic number of rounds.  A vertex with very many links
is met only by aggregations with partial sums and by joins that adaptive
execution splits.  Nothing is collected; every round is written to the shared
folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.sources.scratch import cut

def connected_components(links: DataFrame) -> DataFrame:
    """(id, component): for each vertex of the links (a, b), the smallest vertex it is linked to.

    Null vertices take no part; a link of a vertex with itself gives a
    component of one vertex.
    """
    links = cut(links.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b")).dropna().distinct())
    ends = F.explode(F.array("a", "b")).alias("id")
    members = cut(links.select(ends).distinct().withColumn("root", F.col("id")))
    rest = cut(links.where("a <> b"))
    round_ = 0
    while not rest.isEmpty():
        round_ += 1
        pointers = _pointers(rest, round_)
        onward = pointers.select(F.col("id").alias("to"), F.col("to").alias("next"))
        pointers = cut(pointers.join(onward, "to").select("id", F.col("next").alias("to")))
        members = cut(
            members.join(pointers.withColumnRenamed("id", "root"), "root", "left")
            .select("id", F.coalesce("to", "root").alias("root"))
        )
        for side in ("a", "b"):
            moved = pointers.select(F.col("id").alias(side), F.col("to").alias(f"{side}_to"))
            rest = rest.join(moved, side)
        rest = cut(
            rest.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b"))
            .where("a <> b")
            .distinct()
        )
    least = members.groupBy("root").agg(F.min("id").alias("component"))
    return members.join(least, "root").select("id", "component")


def _pointers(links: DataFrame, round_: int) -> DataFrame:
    """(id, to) for each vertex: of itself and its neighbours, the one of least priority."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def ranked(vertex: str):
        return F.struct(F.xxhash64(vertex, F.lit(round_)).alias("rank"), F.col(vertex).alias("vertex"))

    least = both.groupBy("a").agg(F.min(ranked("b")).alias("other"))
    chosen = least.select(F.col("a").alias("id"), F.least(ranked("a"), "other")["vertex"].alias("to"))
    return cut(chosen)
