"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill.llm.common import stored


def _stars(links: DataFrame, larger_only: bool) -> DataFrame:
    """Links v - u become links v - m, m the least of u's neighbours and u; for all v, or for v > u only."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    side = both.where("b > a") if larger_only else both.where("b <= a")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    new = side.join(least, "a").select(F.col("b").alias("v"), "m")
    if not larger_only:
        new = new.unionAll(least.select(F.col("a").alias("v"), "m"))
    return new.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def components(links: DataFrame, rounds: int = 40) -> DataFrame:
    """(id, component) for every id of links(a, b): the least id that links lead to.

    Each round is two shuffles of the links; a hub's links are pre-aggregated for its least neighbour and its
    join is one that adaptive execution splits. The number of rounds grows with the logarithm of the longest chain.
    """
    links = stored(links.select("a", "b").where("a <> b").distinct(), "links")
    for _ in range(rounds):
        new = stored(_stars(_stars(links, True), False), "links")
        state = [x.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0))).first() for x in (links, new)]
        if state[0] == state[1]:
            return new.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(new.select(F.col("b"), F.col("b")).distinct())
        links = new
    raise RuntimeError("links did not settle")
