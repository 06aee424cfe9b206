"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.common import stored

MAX_ROUNDS = 60


def connected_components(links: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable) for every node of ``links`` (a, b).

    Every round hangs each node's larger neighbours on its smallest one, then each node and its
    smaller neighbours on the smallest of them, until nothing changes; the number of rounds
    grows with the logarithm of the components' size. Rows only shrink in number, so a large
    component never gathers in one task: minima are combined before the shuffle, and a hub's
    neighbours are joined with one row. Null ends and self-links are left out.
    """
    now = stored(links.select("a", "b").where("a <> b").distinct(), "links")
    before = None
    for _ in range(MAX_ROUNDS):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = (
            both.where("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        down = stored(down.where("a <> b").distinct(), "links")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
        )
        now = stored(small.where("a <> b").distinct(), "links")
        # Equal tables have equal sums; unequal ones agree by chance once in 2**64.
        sums = now.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"),
        ).first()
        if before == (sums["n"], sums["s"]):
            return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = (sums["n"], sums["s"])
    raise RuntimeError("the components did not settle")
