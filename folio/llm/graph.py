"""Connected components of an edge table, by alternating star contraction.

Large-star / small-star rounds (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014).  Every round is a few aggregates and joins over
stage tables; no component or link list is ever held by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import Stages


#: Rows of a written stage per partition: a stage of few links is a few files,
#: however many shuffle partitions the session has.
ROWS_PER_PARTITION = 100_000


def connected_components(edges: DataFrame, stages: Stages, name: str = "cc", rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is
    its smallest node.  Loops, repeated edges and either direction are fine;
    an empty table gives an empty table."""
    edge = F.col("a") > F.col("b")
    links = stages.put(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(edge).distinct(), f"{name}-e")
    held, before = f"{name}-e", None
    size = links.count()

    def put(df: DataFrame, step: str) -> DataFrame:
        return stages.put(df.coalesce(1 + size // ROWS_PER_PARTITION), f"{name}-{step}")

    for i in range(rounds):
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Smallest nodes are written, so the joins with them are plain
        # shuffles (or broadcasts) that adaptive execution can split.
        low = put(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), f"l{i}")
        # large star: every larger neighbour moves to the smallest node around.
        large = put(both.filter(F.col("b") > F.col("a")).join(low, "a")
                    .select(F.col("b").alias("a"), F.col("m").alias("b")).filter(edge).distinct(), f"s{i}")
        # small star: smaller neighbours are joined through their smallest one.
        least = put(large.groupBy("a").agg(F.min("b").alias("m")), f"m{i}")
        nxt = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
               .union(least.select("a", F.col("m").alias("b"))).filter(edge).distinct())
        new = put(nxt, f"n{i}")
        mark = new.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        stages.drop(held, f"{name}-l{i}", f"{name}-s{i}", f"{name}-m{i}")
        links, held, size = new, f"{name}-n{i}", mark["n"]
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return links.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node").unionByName(
        links.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node")))
