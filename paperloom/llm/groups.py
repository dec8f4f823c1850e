"""Groups that links form, without bringing links or groups to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.session import materialize

#: Rounds before it gives up; each about halves the depth of a group.
MOST_ROUNDS = 60


def _signature(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*links.columns))).first())


def components(links: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """(key, node, root): the least node that each linked node hangs together with, the least one itself included.

    Alternates large and small stars: every node hands its least neighbour to its greater ones, then to its lesser
    ones, until nothing changes. Least neighbours are found by a partial aggregation, so a node with very many
    links is one row a task. Each round is written into the shared folder; only its size and a checksum reach the
    driver.
    """
    now = materialize(links.where(F.col(a) != F.col(b)).select(key, F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    seen = _signature(now)
    for _ in range(MOST_ROUNDS):
        both = now.unionByName(now.select(key, F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(key, "u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, [key, "u"]).select(key, F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy(key, "u").agg(F.min("v").alias("m"))
        small = large.join(low, [key, "u"]).where(F.col("v") != F.col("m")).select(key, F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(small.unionByName(low.select(key, "u", F.col("m").alias("v"))).distinct())
        before, seen = seen, _signature(now)
        if seen == before:
            break
    else:
        raise RuntimeError(f"groups did not settle in {MOST_ROUNDS} rounds")
    return now.select(key, F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(key, F.col("v").alias("node"), F.col("v").alias("root")).distinct())
